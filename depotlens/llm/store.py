"""Written intermediate tables in the folder that all executors share.

The folder is the session's ``spark.checkpoint.dir``. A local session without
that setting (tests) gets a temporary one; a cluster session without it is an
error, because executors cannot read each other's local disks.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_local_folders: dict[str, str] = {}  # of local sessions without the setting, by application


def shared_dir(spark: SparkSession) -> str:
    """The shared folder as a full URI, so that Spark and the tasks' own file access mean the same place."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="depotlens-llm-")
        folder = _local_folders[context.applicationId]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if full.startswith("file:/") and not full.startswith("file://"):
        full = "file://" + full.removeprefix("file:")
    return full.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Rows handed to Python at once: whole texts travel in these batches, so they stay small.
ARROW_ROWS = 500
_ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession):
    """Small Arrow batches for the jobs run inside; the session's own setting is put back."""
    before = spark.conf.get(_ARROW_ROWS_KEY)
    spark.conf.set(_ARROW_ROWS_KEY, str(ARROW_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS_KEY, before)


#: Bytes, as stored, up to which a table of an operator's own is sent to every task. In memory it takes up to some
#: 30 times that, on the driver first, and several are sent at once.
BROADCAST_BYTES = 256 << 10
_BROADCAST_KEYS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def small_broadcasts(function):
    """For a function that runs all its jobs before it returns: tables that grow with the input are joined by shuffling
    once they pass ``BROADCAST_BYTES``, whatever the session allows. A lower setting of the session stays."""

    @wraps(function)
    def run(docs: DataFrame, *args, **kwargs):
        spark = docs.sparkSession
        size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        plain, adaptive = _BROADCAST_KEYS
        before = {plain: spark.conf.get(plain)}
        if (own := spark.conf.get(adaptive, None)) is not None:
            before[adaptive] = own
        try:
            for k, v in before.items():
                if not v.startswith("-") and size(v) > BROADCAST_BYTES:
                    spark.conf.set(k, str(BROADCAST_BYTES))
            return function(docs, *args, **kwargs)
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if _running:
        _running[-1].append(path)
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_running: list[list[str]] = []  # the tables written by the ``tidy`` functions that are running, innermost last


def tidy(function):
    """For a function whose result is the last table it stores: its other tables are removed when it returns.

    If it fails they stay, as do the tables of functions without this mark.
    """

    @wraps(function)
    def run(*args, **kwargs):
        _running.append([])
        try:
            result = function(*args, **kwargs)
        finally:
            written = _running.pop()
        spark = result.sparkSession
        for path in written[:-1]:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        if _running:
            _running[-1].extend(written[-1:])
        return result

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_share(key: Column, share: Column | float) -> Column:
    """Whether a row falls in a sample of the given share, by 53 bits of a hash of its key: as even for one row in 10^12 as for one in ten."""
    return F.shiftrightunsigned(key, 11).cast("double") < share * F.lit(float(1 << 53))


_shipped: set[str] = set()


def mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)``, with this package sent to the executors' Python first (once a session)."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="depotlens-py-")) / "depotlens_py.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))  # the driver serves it; executors need no shared code folder
        _shipped.add(context.applicationId)
    return df.mapInArrow(run, schema)
