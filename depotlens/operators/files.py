"""File catalog: which daily files exist, which cut-off dates are complete.

Every day brings an order file (name prefix ``comdirect_U-``, orders are
cumulative up to its id) and a snapshot file (``comdirect_B-``, balances and
positions of that day). A day can be scored only when both exist. All outputs
here are calendars (at most one row per day and file kind), so their size is
bounded by the number of days covered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotlens import params as P


def _kind() -> F.Column:
    name = F.col("DateiName")
    return (F.when(name.like(P.FILE_PREFIX_ORDERS + "%"), F.lit("U"))
            .when(name.like(P.FILE_PREFIX_SNAPSHOT + "%"), F.lit("B")))


def latest_files(files: DataFrame, require_checked: bool = False) -> DataFrame:
    """Per day the file id of each kind: highest check digit wins (ties: highest id).

    ``require_checked`` keeps only files with ``Pruefziffer > 0``.
    Result: Datum, DateiID_U, DateiID_B (NULL when the kind is missing).
    """
    f = files.withColumn("kind", _kind()).where(F.col("kind").isNotNull())
    if require_checked:
        f = f.where(F.col("Pruefziffer") > 0)
    best = F.struct(F.col("Pruefziffer"), F.col("DateiID"))
    return (f.groupBy("Datum")
            .agg(F.max_by(F.when(F.col("kind") == "U", F.col("DateiID")),
                          F.when(F.col("kind") == "U", best)).alias("DateiID_U"),
                 F.max_by(F.when(F.col("kind") == "B", F.col("DateiID")),
                          F.when(F.col("kind") == "B", best)).alias("DateiID_B")))


def complete_days(files: DataFrame, require_checked: bool = False) -> DataFrame:
    """Days that have both an order file and a snapshot file (Datum, DateiID_U, DateiID_B)."""
    return (latest_files(files, require_checked)
            .where(F.col("DateiID_U").isNotNull() & F.col("DateiID_B").isNotNull()))


def known_from(orders: DataFrame, days: DataFrame) -> DataFrame:
    """Orders with ``Bekannt_ab``: the first of the wanted file days that knows them.

    A day (``as_of``, ``DateiID_U``) knows the orders dated up to it whose file
    id is at most the day's order file's, so an order delivered late is known
    from the later of its own day and its file's. Orders that no wanted day's
    file holds, or without a file id, are left out. File ids must rise with the
    days: a calendar where they fall stops the job, because a day would then
    lose orders that an earlier day had.

    Ids and days are calendars (a row per file and day at most): one window
    over them finds the days, and the result is broadcast to the orders.
    """
    ids = orders.select("Datei_ID").where(F.col("Datei_ID").isNotNull()).distinct()
    both = (days.select(F.col("DateiID_U").alias("Datei_ID"), F.col("as_of").alias("day"))
            .unionByName(ids.withColumn("day", F.lit(None).cast("date"))))
    at_or_after = Window.orderBy(F.col("Datei_ID").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.min("day").over(at_or_after)
    fallen = F.raise_error(F.lit("order file ids do not rise with the days")).cast("date")
    found = (both.select("Datei_ID", "day", F.when(F.col("day") > first, fallen).otherwise(first).alias("Datei_Tag"))
             .where(F.col("Datei_Tag").isNotNull()).groupBy("Datei_ID").agg(F.min("Datei_Tag").alias("Datei_Tag")))
    return (orders.join(F.broadcast(found), "Datei_ID")
            .withColumn("Bekannt_ab", F.greatest("Orderdatum", "Datei_Tag")).drop("Datei_Tag"))


def last_checked_day(files: DataFrame) -> F.Column:
    """Scalar subquery: the latest day with a checked file (Pruefziffer > 0)."""
    return files.where(F.col("Pruefziffer") > 0).select(F.max("Datum")).scalar()


def backfill_dates(files: DataFrame, months: int = 24, start=None, end=None,
                   require_checked: bool = False) -> DataFrame:
    """Cut-off dates of a backfill: complete days in [start, end].

    Defaults: end = latest checked file day, start = end - ``months`` months.
    The bounds are scalar subqueries (evaluated once, inlined as literals),
    so no join against the catalog is needed. Column: ``as_of``.
    """
    end_c = F.lit(str(end)).cast("date") if end is not None else last_checked_day(files)
    start_c = F.lit(str(start)).cast("date") if start is not None else F.add_months(end_c, -months)
    return (complete_days(files, require_checked)
            .where((F.col("Datum") >= start_c) & (F.col("Datum") <= end_c))
            .select(F.col("Datum").alias("as_of")))


def dates_missing_in_target(wanted: DataFrame, target: DataFrame, date_col: str = "Score_Datum") -> DataFrame:
    """Wanted cut-off dates that the target table does not hold yet (idempotent backfill)."""
    have = target.select(F.col(date_col).alias("as_of")).distinct()
    return wanted.join(have, "as_of", "left_anti")
