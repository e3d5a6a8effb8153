"""The daily run and the historical backfill as Spark jobs.

Daily run for one cut-off date (the chain of the book's daily steps):
features -> general score, readiness, alerts, segments, leads -> validation.
The feature base is written once (partition of its date) and every later
step reads it back, so each step's plan starts from a stored table and a
lost executor re-reads it instead of recomputing the history.

Backfill: all complete file days of a date range in ONE job
(``depot_features_multi``): no per-day loop re-reading the order history.
Dates already present in the target are skipped unless ``overwrite``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.operators import features as FE
from depotlens.operators import files as FI
from depotlens.operators import quality as QC
from depotlens.operators import rules as RU
from depotlens.sinks.tables import replace_dates
from depotlens.sources.catalog import SourceTables, day_load, path_exists


@dataclass
class DailyOutputs:
    features: DataFrame
    score: DataFrame
    readiness: DataFrame
    alerts: DataFrame
    segments: DataFrame
    leads: DataFrame
    validation: DataFrame


def run_daily(spark: SparkSession, tables: SourceTables, as_of, out: str,
              fp: P.FeatureParams = P.FeatureParams(), sp: P.SegmentParams = P.SegmentParams(),
              lp: P.LeadParams = P.LeadParams(), by_file: bool = False) -> DailyOutputs:
    """Compute and store every daily table of ``as_of`` under ``out/<table>``
    (partitioned by date, replaced idempotently). ``by_file`` loads the day by
    its file ids (``day_load``), as a production run over delivered files does."""
    d = str(as_of)
    if by_file:
        tables = day_load(tables, d)
    base = FE.feature_base_at(tables, as_of, fp)
    replace_dates(base, f"{out}/feature_base", "Score_Datum", [d])
    base = spark.read.parquet(f"{out}/feature_base").where(F.col("Score_Datum") == F.lit(d).cast("date"))
    feats = FE.finish_features(base, fp)
    replace_dates(feats, f"{out}/features", "Score_Datum", [d])
    feats = spark.read.parquet(f"{out}/features").where(F.col("Score_Datum") == F.lit(d).cast("date"))

    score = RU.general_score(base)
    ready = RU.invest_readiness(feats)
    replace_dates(score, f"{out}/scoring", "Score_Datum", [d])
    replace_dates(ready, f"{out}/invest_readiness", "Score_Datum", [d])
    score = spark.read.parquet(f"{out}/scoring").where(F.col("Score_Datum") == F.lit(d).cast("date"))
    ready = spark.read.parquet(f"{out}/invest_readiness").where(F.col("Score_Datum") == F.lit(d).cast("date"))

    al = RU.alerts(feats, ready)
    replace_dates(al, f"{out}/alerts", "Alert_Datum", [d])
    seg = RU.segments(feats, sp)
    replace_dates(seg, f"{out}/segments", "Score_Datum", [d])
    seg = spark.read.parquet(f"{out}/segments").where(F.col("Score_Datum") == F.lit(d).cast("date"))

    leads = RU.leads(RU.lead_frame(feats, ready, score, seg), lp)
    replace_dates(leads.drop("ready", "Cash_abs"), f"{out}/leads", "Score_Datum", [d])

    # Validation against the previous stored date (only the two dates are read).
    hist = spark.read.parquet(f"{out}/features")
    hist_ready = spark.read.parquet(f"{out}/invest_readiness")
    a = F.lit(d).cast("date")
    prev_d = hist.where(F.col("Score_Datum") < a).select(F.max("Score_Datum")).scalar()
    two = (F.col("Score_Datum") == a) | (F.col("Score_Datum") == prev_d)
    lead_rows = spark.read.parquet(f"{out}/leads").where(two)
    val = QC.validation_log(hist.where(two), hist_ready.where(two), spark.read.parquet(f"{out}/scoring").where(two),
                            spark.read.parquet(f"{out}/segments").where(two), lead_rows).where(F.col("Log_Datum") == a)
    replace_dates(val, f"{out}/validation_log", "Log_Datum", [d])
    return DailyOutputs(feats, score, ready, al, seg, leads, val)


def run_backfill(spark: SparkSession, tables: SourceTables, out: str, months: int = 24, start=None, end=None,
                 overwrite: bool = False, fp: P.FeatureParams = P.FeatureParams(), by_file: bool = False) -> DataFrame:
    """Feature table for every complete day in the range, in one job, written
    by date partition. Returns the dates processed. ``by_file`` takes each day's
    snapshots from its own file and orders as far as its file has them (as
    ``day_load`` does), so no depot keeps a portfolio that its day's file no
    longer holds, and no day knows an order that came later."""
    dates = FI.backfill_dates(tables.files, months=months, start=start, end=end)
    if not overwrite and path_exists(spark, f"{out}/features"):
        existing = spark.read.parquet(f"{out}/features").select("Score_Datum")
        dates = FI.dates_missing_in_target(dates, existing)
    if by_file:
        days = FI.complete_days(tables.files).select(F.col("Datum").alias("as_of"), "DateiID_U", "DateiID_B").join(dates, "as_of", "left_semi")
        feats = FE.depot_features_file_days(tables, days, fp)
    else:
        feats = FE.depot_features_multi(tables, dates, fp)
    replace_dates(feats, f"{out}/features", "Score_Datum")  # only the computed dates change
    return dates
