"""Idempotent writes to partitioned tables.

* ``replace_dates``   – replace the partitions of the given dates (dynamic
  partition overwrite); wanted dates that got no rows are removed after the
  write succeeded, so a re-run that produces nothing for a date also clears
  that date and a failed write leaves the old rows.
* ``replace_range``   – the same for all dates of a closed range.
* ``merge_upsert``    – MERGE by key for plain Parquet: the merged result is
  written to a new version directory and the table pointer moves to it; the
  version being read is never overwritten in place, and a commit that was not
  computed from the newest version is refused and merged again.
  ``sinks.parts`` does the same and rewrites only the parts that change.
* ``merged_keep_new`` – predictions: new rows replace rows with the same key.
* ``append``          – evaluation rows, registry rows.
* ``write_clustered`` – sorted files with ranges that do not overlap.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.operators.timeline import Periods
from depotlens.session import materialize


def merged_keep_new(existing: DataFrame, new: DataFrame, keys, date_col: str | None = None) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``new``, plus all of ``new``.

    ``date_col`` names the date of the key: existing rows outside the span of
    new dates then stay without being joined.
    """
    if date_col is None:
        kept = existing.join(new.select(*keys), list(keys), "left_anti")
    else:
        dates = materialize(new.select(date_col).distinct())  # a calendar
        lo, hi = (dates.select(f(date_col)).scalar() for f in (F.min, F.max))
        inside = F.coalesce(F.col(date_col).between(lo, hi), F.lit(False))
        kept = existing.where(~inside).unionByName(existing.where(inside).join(new.select(*keys), list(keys), "left_anti"))
    return kept.unionByName(new, allowMissingColumns=True)


def _partition_files(spark: SparkSession, path: str, date_col: str) -> dict[str, frozenset[str]]:
    """File names per stored date."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    found = {}
    for s in fs.listStatus(root):
        name = s.getPath().getName()
        if name.startswith(f"{date_col}="):
            found[name.removeprefix(f"{date_col}=")] = frozenset(f.getPath().getName() for f in fs.listStatus(s.getPath()))
    return found


def stored_dates(spark: SparkSession, path: str, date_col: str) -> list[str]:
    """The dates that the table at ``path`` holds (none if there is no table)."""
    return sorted(_partition_files(spark, path, date_col))


OPEN_FILES = 16  # dates that a task writes at once; with more of them its rows are sorted by date
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_files(spark: SparkSession):
    """A few dates' files are written side by side while a job runs; the session's own setting is put back."""
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def replace_dates(df: DataFrame, path: str, date_col: str, dates: list | None = None) -> None:
    """Replace the ``date_col`` partitions present in ``df``; listed ``dates``
    without rows are removed (like DELETE + INSERT). ``df`` is computed once.

    The new rows are written first. Only after that succeeded, a listed date
    whose files are still those of before (so the write had no rows for it) is
    removed; a failing job therefore changes nothing.
    """
    _replace(df, path, date_col, None if dates is None else {str(d) for d in dates}.__contains__)


def replace_range(df: DataFrame, path: str, date_col: str, start, end) -> None:
    """Replace all dates from ``start`` to ``end`` (both included) by the rows of ``df``, which must lie in that range."""
    lo, hi = str(start), str(end)
    day = F.col(date_col).cast("date")
    inside = df.where(day.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    _replace(inside, path, date_col, lambda d: lo <= d <= hi)


def _replace(df: DataFrame, path: str, date_col: str, wanted) -> None:
    spark = df.sparkSession
    before = _partition_files(spark, path, date_col) if wanted else {}
    with _open_files(spark):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)
    if wanted:
        after = _partition_files(spark, path, date_col)
        for d, names in before.items():
            if wanted(d) and after.get(d) == names:
                p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{date_col}={d}")
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_clustered(df: DataFrame | Periods, path: str, by: list[str], rows_per_file: int = 2_000_000, laid_out=None) -> None:
    """Write ``df`` in sorted files of about ``rows_per_file`` rows whose ranges of ``by`` follow one another, so that a
    lookup of a depot or a range of them reads few files and row groups.

    Files are ranges of the whole ``by`` (depot and date, say), so a depot with
    very many rows is spread over several. The ranges come from a sample; one
    that turns out too full is cut in order while it is written. ``df`` is read
    twice (it is counted first), so it should be stored.

    Of periods (``by`` is their key and the date) the ranges are cut over the
    periods, and only those are shuffled; ``laid_out`` makes the rows of a range's
    periods where they are written.
    """
    if isinstance(df, Periods):
        files = max(1, -(-(df.weighted().agg(F.sum("n_days")).first()[0] or 0) // rows_per_file))
        rows = df.rows.repartitionByRange(files, by[0], "e").sortWithinPartitions(by[0], "e")
        ordered = (laid_out or Periods.per_day)(Periods(rows, df.dates))
    else:
        files = max(1, -(-df.count() // rows_per_file))
        ordered = df.repartitionByRange(files, *by).sortWithinPartitions(*by)
    ordered.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file + rows_per_file // 4).parquet(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    """A small report (diagnosis, schema differences, importances) as CSV with a header, one file, replaced on a re-run."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


class CommitConflict(RuntimeError):
    """Another writer has committed a version after the one this commit was computed from."""


class Pointers:
    """Numbered pointer files ``_CURRENT.<n>`` of a table: the highest number is the table.

    A writer creates the number after the one it read, with its whole content
    and only if nobody else has: by a hard link on local disks, by a rename that
    refuses an existing name elsewhere (atomic on HDFS; an object store must
    offer an equally strict rename). Pointers are never deleted, so a stop at
    any point leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()
        self._Path = spark._jvm.org.apache.hadoop.fs.Path

    def _fs(self, p):
        return p.getFileSystem(self._conf)

    def newest(self) -> tuple[int, str | None]:
        """(number, content) of the newest pointer; (0, None) for a table without one. Data without any pointer is an error, not an empty table."""
        root = self._Path(self.root)
        fs = self._fs(root)
        names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
        numbers = sorted(int(n.removeprefix("_CURRENT.")) for n in names if n.startswith("_CURRENT.") and n[9:].isdigit())
        if numbers:
            return numbers[-1], self._content(numbers[-1])
        if any(n.startswith(("v=", "data-")) for n in names):
            raise RuntimeError(f"{self.root} holds versions but no pointer to one of them")
        return 0, None

    def _content(self, number: int) -> str:
        path = self._Path(f"{self.root}/_CURRENT.{number}")
        jvm = self.spark._jvm
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(self._fs(path).open(path), "UTF-8"))
        try:
            return reader.readLine().strip()
        finally:
            reader.close()

    def create(self, number: int, content: str) -> None:
        """The pointer ``number``; CommitConflict if it exists."""
        jvm = self.spark._jvm
        tmp, final = self._Path(f"{self.root}/_next.{uuid.uuid4().hex}"), self._Path(f"{self.root}/_CURRENT.{number}")
        fs = self._fs(tmp)
        out = fs.create(tmp, False)
        out.write(bytearray(content.encode("utf-8")))
        out.close()
        try:
            if fs.getUri().getScheme() == "file":
                place = lambda p: jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri())
                jvm.java.nio.file.Files.createLink(place(final), place(tmp))
            else:
                rename = jvm.org.apache.hadoop.fs.Options.Rename
                options = self.spark.sparkContext._gateway.new_array(rename, 1)
                options[0] = rename.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf).rename(tmp, final, options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise CommitConflict(f"another writer has moved {self.root} to version {number} meanwhile") from None
            raise
        finally:
            fs.delete(tmp, False)

    def delete(self, name: str) -> None:
        path = self._Path(f"{self.root}/{name}")
        self._fs(path).delete(path, True)


class VersionedTable:
    """A Parquet table stored as ``<root>/v=<id>`` directories and pointers
    (``Pointers``). Old versions stay readable."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.pointers = Pointers(spark, root)

    def current(self) -> str | None:
        return self.pointers.newest()[1]

    def snapshot(self) -> tuple[int, DataFrame | None]:
        """(number, rows) of the newest version; (0, None) for a new table."""
        number, version = self.pointers.newest()
        return number, None if version is None else self.spark.read.parquet(f"{self.root}/{version}")

    def read(self) -> DataFrame | None:
        return self.snapshot()[1]

    def commit(self, df: DataFrame, base: int | None = None) -> str:
        """Write ``df`` as the version after number ``base`` (that of the snapshot
        it was computed from; the newest if not given). CommitConflict, and no
        change, if there is a newer one by then."""
        newest = self.pointers.newest()[0]
        base = newest if base is None else base
        if newest != base:
            raise CommitConflict(f"{self.root} is at version {newest}, the commit was computed from {base}")
        version = f"v={uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.root}/{version}")
        try:
            self.pointers.create(base + 1, version)
        except CommitConflict:
            self.pointers.delete(version)  # nobody knows of it
            raise
        return version

    def update(self, change, attempts: int = 20) -> DataFrame:
        """Commit ``change(rows)`` (``rows`` is None for a new table), computed anew from the newest version whenever another writer was faster."""
        for _ in range(attempts):
            base, rows = self.snapshot()
            try:
                self.commit(change(rows), base)
                return self.read()
            except CommitConflict:
                continue
        raise CommitConflict(f"{self.root} moved {attempts} times meanwhile")


def merge_upsert(table: VersionedTable, new: DataFrame, keys, combine) -> DataFrame:
    """MERGE ``new`` into the table with ``combine(existing, new)`` and commit a
    new version; merged again if another writer commits in between."""
    return table.update(lambda existing: new if existing is None else combine(existing, new))
