"""Incremental feature runs as daily files arrive (Structured Streaming).

The file catalog (one row per delivered file: DateiID, Datum, DateiName,
Pruefziffer) is read as a stream. Each micro-batch collects the days that
became complete (an order file and a snapshot file) and computes their
feature rows with the multi-date plan in one job, replacing those date
partitions in the target. The stream's checkpoint lives under
``spark.checkpoint.dir`` so a restarted or failed run resumes with the files
it has not processed yet; ``availableNow`` processes what is there and stops,
which fits a scheduled daily run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.operators import features as FE
from depotlens.operators import files as FI
from depotlens.session import ensure_checkpoint_dir
from depotlens.sinks.tables import replace_dates
from depotlens.sources.catalog import SourceTables

CATALOG_SCHEMA = "DateiID long, Datum date, DateiName string, Pruefziffer int"


def feature_stream(spark: SparkSession, catalog_dir: str, tables: SourceTables, out: str,
                   fp: P.FeatureParams = P.FeatureParams(), name: str = "depot-features"):
    """Start the stream (trigger availableNow) and return the StreamingQuery."""
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    arriving = spark.readStream.schema(CATALOG_SCHEMA).parquet(catalog_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        # Days touched by this batch that are complete in the whole catalog.
        touched = batch.select("Datum").distinct()
        complete = FI.complete_days(spark.read.schema(CATALOG_SCHEMA).parquet(catalog_dir))
        dates = complete.join(touched, "Datum").select(F.col("Datum").alias("as_of"))
        feats = FE.depot_features_multi(tables, dates, fp)
        replace_dates(feats, f"{out}/features", "Score_Datum")

    return (arriving.writeStream.foreachBatch(process)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start())
