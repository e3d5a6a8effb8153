"""Incremental daily features: a stored row per depot that one day's rows move forward.

The state holds what the features need of the past, in a size that does not
grow with it: running totals and last days, the order months, the order and
booking days of the last ``KEPT_DAYS`` days (at most one entry a day and
delivery), and the latest snapshots. Moving on stacks the old state with the
new rows' sums and combines them per depot; only depots with new rows take part,
the others move on where they are, and the history is not read. Windows are cut out of the kept days, so
they expire by themselves. The result is that of ``depot_features`` at the day.

New rows are rows that became known since the state's day: by date, or by
delivery (``files.known_from``), where an order may be older than the state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.columns import month_index
from depotlens.operators import bookings as BK
from depotlens.operators import features as FE
from depotlens.operators import files as FI
from depotlens.operators import orders as OR
from depotlens.operators import positions as POS
from depotlens.session import materialize
from depotlens.sinks.tables import replace_dates, stored_dates
from depotlens.sources.catalog import SourceTables

#: Six months reach back 184 days at most, the deposit window 180.
KEPT_DAYS = 190

_ORDER_DAY = "struct<d:date,n:bigint,vol:bigint>"
_BOOK_DAY = "struct<d:date,u_in:bigint,u_out:bigint,has_in:boolean,small_in:boolean,small:boolean>"
_SNAPSHOT = "struct<" + ",".join(f"{c}:{'double' if c == 'p_hhi' else 'bigint'}" for c in POS.SNAPSHOT_FIELDS) + ">"
SCHEMA = (f"Depotnummer string, o_n bigint, o_vol bigint, months array<int>, o_last_buy date, o_last_trade date, days array<{_ORDER_DAY}>, "
          f"books array<{_BOOK_DAY}>, booked boolean, b_last_cf date, p {_SNAPSHOT}, p_date date, s_saldo double, s_date date, spine boolean")


def _new_sums(new: SourceTables, as_of: Column, fp: P.FeatureParams) -> list[DataFrame]:
    """The state's columns from the new rows up to ``as_of``, one row per depot and source."""
    kept = F.date_sub(as_of, KEPT_DAYS)
    d = F.col("d")
    orders = OR.order_day_rows(new.orders.drop("Bekannt_ab").where(F.col("Orderdatum") <= as_of)).groupBy("Depotnummer").agg(
        F.sum("ev_o_n").alias("o_n"), F.sum("ev_o_vol").alias("o_vol"), F.collect_set(month_index(d)).alias("months"),
        F.max(F.when(F.col("ev_o_buy"), d)).alias("o_last_buy"), F.max(d).alias("o_last_trade"),
        F.collect_list(F.when(d >= kept, F.struct("d", F.col("ev_o_n").alias("n"), F.col("ev_o_vol").alias("vol")))).alias("days"),
        F.lit(True).alias("spine"))
    snaps = POS.position_snapshots(new.positions.where(F.col("Datum") <= as_of), fp.vocab).groupBy("Depotnummer").agg(
        F.max_by(POS.snapshot_struct(), "Datum").alias("p"), F.max("Datum").alias("p_date"), F.lit(True).alias("spine"))
    best = F.max(F.struct("Datum", "Saldosollwert"))
    balances = new.balances.where(F.col("Datum") <= as_of).groupBy(F.col("Kontoreferenz").alias("Depotnummer")).agg(
        best["Saldosollwert"].alias("s_saldo"), best["Datum"].alias("s_date"), F.lit(True).alias("spine"))
    parts = [orders, snaps, balances]
    if new.bookings is not None:
        entry = F.struct("d", F.col("ev_b_in").alias("u_in"), F.col("ev_b_out").alias("u_out"), F.col("ev_b_has_in").alias("has_in"),
                         F.col("ev_b_small_in").alias("small_in"), F.col("ev_b_small").alias("small"))
        parts.append(BK.booking_day_rows(new.bookings.where(F.col("Valutadatum") <= as_of), fp).groupBy("Depotnummer").agg(
            F.collect_list(F.when(d >= kept, entry)).alias("books"), F.lit(True).alias("booked"), F.max(F.when(F.col("ev_b_nz"), d)).alias("b_last_cf")))
    return parts


def advance(state: DataFrame | None, new: SourceTables, as_of, fp: P.FeatureParams | None = None) -> DataFrame:
    """The state at ``as_of`` from an earlier one (None: from nothing) and the rows that became known since."""
    fp, a = fp or P.FeatureParams(), FE.as_date(as_of)
    spark = new.orders.sparkSession
    stacked, staying = spark.createDataFrame([], SCHEMA), None
    for part in _new_sums(new, a, fp):
        stacked = stacked.unionByName(part, allowMissingColumns=True)

    def recent(entries: Column) -> Column:
        return F.filter(entries, lambda x: x["d"] >= F.date_sub(a, KEPT_DAYS))

    if state is not None:
        stacked = materialize(stacked)  # read for the depots' names and for their sums
        moving = stacked.select(F.col("Depotnummer").alias("_moving")).distinct()
        same = F.col("Depotnummer").eqNullSafe(F.col("_moving"))
        columns = [c.split()[0] for c in SCHEMA.split(", ")]
        staying = state.join(moving, same, "left_anti").select(*[recent(F.col(c)).alias(c) if c in ("days", "books") else c for c in columns])
        stacked = stacked.unionByName(state.join(moving, same, "left_semi").select(*columns))

    def joined(c: str) -> Column:
        return F.flatten(F.collect_list(c))

    def lately(c: str) -> Column:
        return recent(joined(c)).alias(c)

    moved = stacked.groupBy("Depotnummer").agg(
        F.sum("o_n").alias("o_n"), F.sum("o_vol").alias("o_vol"), F.array_distinct(joined("months")).alias("months"),
        F.max("o_last_buy").alias("o_last_buy"), F.max("o_last_trade").alias("o_last_trade"), lately("days"),
        lately("books"), F.max("booked").alias("booked"), F.max("b_last_cf").alias("b_last_cf"),
        F.max_by("p", "p_date").alias("p"), F.max("p_date").alias("p_date"),
        F.max_by("s_saldo", "s_date").alias("s_saldo"), F.max("s_date").alias("s_date"), F.max("spine").alias("spine"))
    return moved if staying is None else moved.unionByName(staying)


def state_base(state: DataFrame, as_of, fp: P.FeatureParams | None = None, same_day_snapshots: bool = False) -> DataFrame:
    """Base columns of every depot in the spine from the state of that day."""
    fp, a = fp or P.FeatureParams(), FE.as_date(as_of)
    zero = F.lit(0).cast("bigint")

    def added(entries: str, field: str, days: int) -> Column:
        inside = F.filter(entries, lambda x: (x["d"] >= F.date_sub(a, days)) & x[field].isNotNull())
        return F.aggregate(inside, zero, lambda acc, x: acc + x[field])

    def months(entries: str, keep) -> Column:
        return F.array_distinct(F.transform(F.filter(entries, keep), lambda x: month_index(x["d"])))

    half_year = F.add_months(a, -6)
    dep_months = F.array_distinct(F.transform("_deposits", lambda x: month_index(x["d"])))
    sums = F.transform(dep_months, lambda m: F.aggregate(
        F.filter("_deposits", lambda x: month_index(x["d"]) == m), zero, lambda acc, x: acc + F.coalesce(x["u_in"], zero)) / 10000.0)
    n, mean = F.size("_sums"), F.col("_mean")
    var = F.aggregate("_sums", F.lit(0.0), lambda acc, v: acc + (v - mean) * (v - mean)) / (n - 1)
    traded, booked = F.col("o_n").isNotNull(), F.col("booked").isNotNull()

    def if_there(there: Column, value: Column, name: str) -> Column:
        return F.when(there, value).alias(name)

    p_holds, s_holds, spine = F.lit(True), F.lit(True), F.col("spine")
    if same_day_snapshots:  # a depot without orders exists while the day's file has it
        p_holds, s_holds = F.col("p_date") == a, F.col("s_date") == a
        spine = traded | F.coalesce(p_holds, F.lit(False)) | F.coalesce(s_holds, F.lit(False))
    # Columns of their own: a lambda would compute the sums and their mean again for every element.
    staged = (state.where(spine).withColumn("_deposits", F.filter("books", lambda x: x["has_in"] & (x["d"] >= F.date_sub(a, 180))))
              .withColumn("_sums", sums).withColumn("_mean", F.when(n > 0, F.aggregate("_sums", F.lit(0.0), lambda acc, v: acc + v) / n)))
    return staged.select(
        "Depotnummer", a.alias("Score_Datum"), "o_last_buy", "o_last_trade", "o_n", "o_vol",
        if_there(traded, added("days", "n", 30), "o_n30"), if_there(traded, added("days", "vol", 30), "o_vol30"),
        if_there(traded, added("days", "n", 90), "o_n90"), if_there(traded, added("days", "vol", 90), "o_vol90"),
        if_there(traded, F.size("months"), "o_months"), if_there(traded, F.size(months("days", lambda x: x["d"] >= half_year)), "o_act6"),
        if_there(booked, added("books", "u_in", 30), "b_in30"), if_there(booked, added("books", "u_out", 30), "b_out30"),
        if_there(booked, added("books", "u_in", 90), "b_in90"), if_there(booked, added("books", "u_out", 90), "b_out90"),
        if_there(booked, F.size(months("books", lambda x: x["small_in"] & (x["d"] >= F.date_sub(a, 180)) & (month_index(x["d"]) >= month_index(a) - 3))), "b_plan_months"),
        if_there(booked, F.size(months("books", lambda x: x["small"] & (x["d"] >= half_year))), "b_strength"),
        if_there(booked & (n >= 2), F.sqrt(var), "b_dep_vol"), "b_last_cf",
        *[if_there(p_holds, F.col("p")[c], c) for c in POS.SNAPSHOT_FIELDS], if_there(s_holds, F.col("s_saldo"), "s_saldo"))


def state_features(state: DataFrame, as_of, fp: P.FeatureParams | None = None, same_day_snapshots: bool = False) -> DataFrame:
    """The feature table of the state's day."""
    fp = fp or P.FeatureParams()
    return FE.finish_features(state_base(state, as_of, fp, same_day_snapshots), fp)


def rows_since(tables: SourceTables, since, as_of) -> SourceTables:
    """The rows dated after ``since`` (None: all) up to ``as_of``."""
    def part(df: DataFrame, c: str) -> DataFrame:
        df = df.where(F.col(c) <= FE.as_date(as_of))
        return df if since is None else df.where(F.col(c) > FE.as_date(since))

    return SourceTables(part(tables.orders, "Orderdatum"), part(tables.balances, "Datum"), part(tables.positions, "Datum"),
                        None if tables.bookings is None else part(tables.bookings, "Valutadatum"), tables.files)


def rows_delivered(tables: SourceTables, days: DataFrame, since, as_of) -> SourceTables:
    """As ``rows_since``, by delivery: orders that a wanted file day after ``since`` knows first, snapshots of those days' files.

    ``days`` is the calendar of file days (as_of, DateiID_U, DateiID_B); a
    state that moves by it reads its snapshots with ``same_day_snapshots``.
    """
    known = SourceTables(FI.known_from(tables.orders, days).withColumn("_known", F.col("Bekannt_ab")), FE._on_file_days(tables.balances, days),
                         FE._on_file_days(tables.positions, days), tables.bookings, tables.files)
    later = F.col("_known") <= FE.as_date(as_of)
    if since is not None:
        later = later & (F.col("_known") > FE.as_date(since))
    rest = rows_since(known, since, as_of)
    return SourceTables(known.orders.where(later).drop("_known", "Bekannt_ab"), rest.balances, rest.positions, rest.bookings, tables.files)


def step(spark: SparkSession, tables: SourceTables, as_of, path: str, fp: P.FeatureParams | None = None, days: DataFrame | None = None) -> DataFrame:
    """Move the state stored at ``path`` (a partition per day) to ``as_of`` and give that day's features.

    It starts from the last stored day before ``as_of``, or from the whole
    history if there is none. ``days`` moves by delivery. A day that is run
    again replaces its state; states of later days are then out of date and
    have to be run again as well.
    """
    a = str(as_of)
    since = max((d for d in stored_dates(spark, path, "as_of") if d < a), default=None)
    state = None if since is None else spark.read.parquet(path).where(F.col("as_of") == FE.as_date(since))
    new = rows_since(tables, since, a) if days is None else rows_delivered(tables, days, since, a)
    moved = advance(state, new, a, fp).withColumn("as_of", FE.as_date(a))
    replace_dates(moved, path, "as_of", [a])
    own = spark.read.schema(moved.schema).parquet(path).where(F.col("as_of") == FE.as_date(a))
    return state_features(own, a, fp, same_day_snapshots=days is not None)
