"""SparkSession construction and cluster-safe scratch locations.

The library never creates its own session inside operators: every operator
takes DataFrames and returns DataFrames. ``get_spark`` is only a convenience
for tests, the bench and command-line runs.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every session of the engine should carry. AQE re-plans joins and
# coalesces shuffle partitions at runtime; the session time zone is fixed so
# DATE/TIMESTAMP casts do not depend on the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_LOCAL: dict[str, str] = {}  # folders of local sessions without the setting


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "depotlens", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine's base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder ``spark.checkpoint.dir`` of the session.

    On a cluster the setting must name a folder that driver and executors
    share (HDFS/S3/...); a missing setting is an error. Only a local session
    (tests, bench) gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="depotlens-store-")
    return _LOCAL[app]


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors' Python (once a session), for Arrow functions that refer to it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="depotlens-code-")) / "depotlens_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))  # the driver serves it; executors need no shared code folder
    _shipped.add(context.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/depotlens-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Store ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Used where one intermediate result (e.g. the day's feature base) feeds
    many downstream steps: each step scans only the columns and dates it
    needs, and a lost executor re-reads the files instead of recomputing
    their lineage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/depotlens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
