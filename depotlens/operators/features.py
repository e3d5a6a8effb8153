"""The wide per-depot feature table (one row per depot and cut-off date).

Entry points:

* ``depot_features(tables, as_of)``      – one cut-off date (daily update).
* ``depot_features_multi(tables, dates)`` – many cut-off dates in one job
  (historical backfill), no per-date loop and no date x history join.
* ``depot_spine`` / ``depot_spine_multi`` – the depots that exist at a date:
  any order, position snapshot or balance on or before it.

Both feature paths build the same *base* columns (``o_*`` orders, ``b_*``
bookings, ``p_*`` position snapshot, ``s_saldo`` balance) and share
``finish_features``, which turns them into the published columns with the
null rules of the table: counts and amounts are 0 when there is nothing,
``Letzter_Kauf``, ``Cash_over_bestand`` and ``HHI_Concentration`` stay NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.columns import clip, epoch_day, from_units, month_index, safe_div
from depotlens.operators import balances as BAL
from depotlens.operators import bookings as BK
from depotlens.operators import files as FI
from depotlens.operators import orders as OR
from depotlens.operators import positions as POS
from depotlens.operators.timeline import Periods, as_day, cut_at, days_inside, first_of_month_epoch, timeline_periods
from depotlens.sources.catalog import SourceTables

FEATURE_COLUMNS = (
    "Depotnummer", "Score_Datum", "Letzter_Kauf", "Inaktiv_seit_Kauf", "Last_Buy_Days", "Last_Trade_Days",
    "Einzahlung_30d", "Einzahlung_90d", "Sparplan_Klein", "Einzahlung_30d_eff",
    "Auszahlung_30d", "Auszahlung_90d", "Nettoflow_30d", "Nettoflow_90d",
    "Sparplan_Strength_6m", "Deposit_Volatility_6m", "Last_Cashflow_Days",
    "Orderfrequenz", "Orderfrequenz_30d", "Orderfrequenz_90d",
    "ØOrdervolumen", "ØOrdervolumen_30d", "ØOrdervolumen_90d",
    "TechAffin", "Cash_over_bestand", "Cashquote_true", "Cash_abs", "Bestandwert", "Depotwert",
    "Pos_Count", "ZeroPos", "Wertlos_Flag", "HHI_Concentration", "DeepLossShare_50", "WinLoss_Skew",
    "TechWeight", "Cashquote", "Aktienquote", "Activity_Months_6m", "Streak_Inactive_Months",
    "DIY_FrequentSmall", "Inflow_Strength_30d",
)
INT_FEATURES = (
    "Inaktiv_seit_Kauf", "Last_Buy_Days", "Last_Trade_Days", "Sparplan_Klein", "Sparplan_Strength_6m",
    "Last_Cashflow_Days", "Orderfrequenz", "Orderfrequenz_30d", "Orderfrequenz_90d", "TechAffin",
    "Pos_Count", "ZeroPos", "Wertlos_Flag", "Activity_Months_6m", "Streak_Inactive_Months",
    "DIY_FrequentSmall",
)

EPS = 1e-6


def as_date(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


# --------------------------------------------------------------------------
# Spine
# --------------------------------------------------------------------------

def _key_days(tables: SourceTables) -> DataFrame:
    """(Depotnummer, d) of every order, position snapshot and balance."""
    o = tables.orders.select("Depotnummer", F.col("Orderdatum").alias("d"))
    p = tables.positions.select(F.col("Depotreferenz").alias("Depotnummer"), F.col("Datum").alias("d"))
    s = tables.balances.select(F.col("Kontoreferenz").alias("Depotnummer"), F.col("Datum").alias("d"))
    return o.unionByName(p).unionByName(s)


def first_seen(tables: SourceTables) -> DataFrame:
    return _key_days(tables).groupBy("Depotnummer").agg(F.min("d").alias("first_d"))


def depot_spine(tables: SourceTables, as_of) -> DataFrame:
    """Depots that exist at ``as_of`` with ``Score_Datum``."""
    a = as_date(as_of)
    return (_key_days(tables).where(F.col("d") <= a).select("Depotnummer").distinct()
            .withColumn("Score_Datum", a))


def spine_periods(tables: SourceTables, dates: DataFrame) -> Periods:
    """The depots by the period in which they exist, for every date in ``dates`` (column ``as_of``)."""
    return Periods(first_seen(tables).select("Depotnummer", epoch_day("first_d").alias("e"), F.lit(None).cast("int").alias("until")), dates)


def depot_spine_multi(tables: SourceTables, dates: DataFrame) -> DataFrame:
    """(Depotnummer, Score_Datum) for every date in ``dates`` (column ``as_of``)."""
    return spine_periods(tables, dates).per_day("Score_Datum")


# --------------------------------------------------------------------------
# Final columns
# --------------------------------------------------------------------------

def finish_features(base: DataFrame, fp: P.FeatureParams) -> DataFrame:
    """The published columns from the base columns and ``Score_Datum``."""
    return _dated(base.select("Score_Datum", *_held_columns(fp)), fp)


def _dated(held: DataFrame, fp: P.FeatureParams, more=()) -> DataFrame:
    """The published columns: those that count from the date, next to the held ones."""
    dated = dated_columns(fp)
    return held.select(*[dated[c].alias(c) if c in dated else F.col(c) for c in FEATURE_COLUMNS], *more)


def dated_columns(fp: P.FeatureParams, a: Column | None = None) -> dict[str, Column]:
    """The published columns that count from the date ``a`` (``Score_Datum``), over it and the days they count from."""
    a = F.col("Score_Datum") if a is None else a
    days_buy = F.coalesce(F.datediff(a, F.col("Letzter_Kauf")), F.lit(fp.never_days)).cast("bigint")
    days_trade = F.coalesce(F.datediff(a, F.col("_trade")), F.lit(fp.never_days)).cast("bigint")
    streak = F.least(F.lit(fp.streak_cap),
                     F.coalesce(month_index(a) - month_index(F.col("_trade")), F.lit(fp.streak_cap)))
    return {
        "Inaktiv_seit_Kauf": days_buy, "Last_Buy_Days": days_buy, "Last_Trade_Days": days_trade,
        "Last_Cashflow_Days": F.coalesce(F.datediff(a, F.col("_cashflow")), F.lit(fp.no_cashflow_days)).cast("bigint"),
        "Streak_Inactive_Months": streak.cast("bigint")}


def _held_columns(fp: P.FeatureParams) -> list[Column]:
    """What does not change with the date alone: the published columns, and the days that the others count from."""
    z = F.lit(0.0)

    def nz(c):
        return F.coalesce(F.col(c), z)

    def cnt(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("bigint")

    def units(c):
        return F.coalesce(F.col(c), F.lit(0).cast("bigint"))

    def mean(vol, n):
        return F.when(F.col(n) > 0, F.col(vol).cast("double") / F.col(n) / 10000.0).otherwise(z)

    ein30 = from_units(units("b_in30"))
    ein90 = from_units(units("b_in90"))
    aus30 = from_units(units("b_out30"))
    aus90 = from_units(units("b_out90"))
    netto30 = from_units(units("b_in30") - units("b_out30"))
    netto90 = from_units(units("b_in90") - units("b_out90"))
    plan = (F.coalesce(F.col("b_plan_months"), F.lit(0)) >= fp.saving_plan_min_months).cast("bigint")
    saldo = F.col("s_saldo")
    psum = from_units("p_sum")
    cash_abs = F.coalesce(saldo, z)
    bestand = F.coalesce(psum, z)
    depotwert = cash_abs + bestand
    zero_pos = cnt("p_zero")
    n90 = cnt("o_n90")
    vol90 = mean("o_vol90", "o_n90")
    tot_e = from_units("p_tot_e")
    deep = from_units("p_deep")
    win = from_units("p_win")
    loss = from_units("p_loss")
    return [
        F.col("Depotnummer"),
        F.col("o_last_buy").alias("Letzter_Kauf"),
        F.col("o_last_trade").alias("_trade"),
        F.col("b_last_cf").alias("_cashflow"),
        ein30.alias("Einzahlung_30d"),
        ein90.alias("Einzahlung_90d"),
        plan.alias("Sparplan_Klein"),
        F.when((plan == 1) & (ein30 < fp.small_saving_max), z).otherwise(ein30).alias("Einzahlung_30d_eff"),
        aus30.alias("Auszahlung_30d"),
        aus90.alias("Auszahlung_90d"),
        netto30.alias("Nettoflow_30d"),
        netto90.alias("Nettoflow_90d"),
        cnt("b_strength").alias("Sparplan_Strength_6m"),
        nz("b_dep_vol").alias("Deposit_Volatility_6m"),
        cnt("o_months").alias("Orderfrequenz"),
        cnt("o_n30").alias("Orderfrequenz_30d"),
        n90.alias("Orderfrequenz_90d"),
        mean("o_vol", "o_n").alias("ØOrdervolumen"),
        mean("o_vol30", "o_n30").alias("ØOrdervolumen_30d"),
        vol90.alias("ØOrdervolumen_90d"),
        cnt("p_tech_cnt").alias("TechAffin"),
        F.when(saldo.isNotNull() & (psum > 0), saldo / psum).alias("Cash_over_bestand"),
        clip(F.coalesce(safe_div(saldo, saldo + psum + EPS), z), 0.0, 1.0).alias("Cashquote_true"),
        cash_abs.alias("Cash_abs"),
        bestand.alias("Bestandwert"),
        depotwert.alias("Depotwert"),
        cnt("p_cnt").alias("Pos_Count"),
        zero_pos.alias("ZeroPos"),
        ((bestand <= 1) & (zero_pos >= 1)).cast("bigint").alias("Wertlos_Flag"),
        F.col("p_hhi").alias("HHI_Concentration"),
        F.when(tot_e != 0, F.coalesce(deep, z) / tot_e).otherwise(z).alias("DeepLossShare_50"),
        F.when(win.isNotNull() & loss.isNotNull() & (tot_e != 0), (win - loss) / tot_e).otherwise(z)
         .alias("WinLoss_Skew"),
        F.coalesce(safe_div(from_units("p_tech_sum"), psum + EPS), z).alias("TechWeight"),
        clip(F.coalesce(F.when(saldo.isNotNull() & (psum > 0), saldo / psum), z), 0.0, 1.0).alias("Cashquote"),
        F.coalesce(safe_div(from_units("p_aktie_sum"), psum + EPS), z).alias("Aktienquote"),
        cnt("o_act6").alias("Activity_Months_6m"),
        ((n90 >= fp.diy_min_orders_90d) & (vol90 < fp.diy_max_volume_90d)).cast("bigint").alias("DIY_FrequentSmall"),
        F.when(depotwert > 0, netto30 / depotwert).otherwise(z).alias("Inflow_Strength_30d"),
    ]


# --------------------------------------------------------------------------
# One cut-off date
# --------------------------------------------------------------------------

def _empty_bookings_base(spark) -> DataFrame:
    schema = "Depotnummer string, " + ", ".join(
        f"{c} {'date' if c == 'b_last_cf' else ('bigint' if c in ('b_plan_months', 'b_strength') else 'double')}"
        for c in BK.BASE_COLUMNS)
    return spark.createDataFrame([], schema)


def feature_base_at(tables: SourceTables, as_of, fp: P.FeatureParams) -> DataFrame:
    """Base columns of every depot in the spine at ``as_of``.

    Each source is aggregated to one row per depot; the four results are
    stacked and combined with one more aggregation on the depot key (no chain
    of joins). Bookings of accounts outside the spine are dropped there.
    """
    a = as_date(as_of)
    o = OR.order_base_at(tables.orders, a).withColumn("_spine", F.lit(True))
    p = POS.position_base_at(POS.position_snapshots(tables.positions, fp.vocab), a).withColumn("_spine", F.lit(True))
    s = BAL.balance_base_at(tables.balances, a).withColumn("_spine", F.lit(True))
    if tables.bookings is not None:
        b = BK.booking_base_at(tables.bookings, a, fp)
    else:
        b = _empty_bookings_base(tables.orders.sparkSession)
    b = b.withColumn("_spine", F.lit(False))
    stacked = (o.unionByName(p, allowMissingColumns=True)
               .unionByName(s, allowMissingColumns=True)
               .unionByName(b, allowMissingColumns=True))
    cols = list(OR.BASE_COLUMNS) + list(POS.SNAPSHOT_FIELDS) + ["s_saldo"] + list(BK.BASE_COLUMNS)
    return (stacked.groupBy("Depotnummer")
            .agg(F.max("_spine").alias("_spine"), *[F.max(c).alias(c) for c in cols])
            .where(F.col("_spine"))
            .drop("_spine")
            .withColumn("Score_Datum", a))


def depot_features(tables: SourceTables, as_of, fp: P.FeatureParams | None = None) -> DataFrame:
    """Feature table at one cut-off date."""
    fp = fp or P.FeatureParams()
    return finish_features(feature_base_at(tables, as_of, fp), fp)


# --------------------------------------------------------------------------
# Many cut-off dates
# --------------------------------------------------------------------------

def feature_base_multi(tables: SourceTables, dates: DataFrame, fp: P.FeatureParams) -> DataFrame:
    """Base columns for every (depot, date) of ``depot_spine_multi``.

    Evaluated per depot for the days on which something changes (see
    ``depotlens.operators.timeline``): linear cost in the sources' rows,
    independent of how many dates are requested; the dates are laid over the
    result.
    """
    return timeline_periods(tables, dates, fp).per_day("Score_Datum")


def feature_periods(tables: SourceTables, dates: DataFrame, fp: P.FeatureParams | None = None) -> Periods:
    """The feature table for ``dates`` by period: what does not change with the date alone (``features_per_day`` gives the rest)."""
    fp = fp or P.FeatureParams()
    return timeline_periods(tables, dates, fp).select(*_held_columns(fp))


def features_per_day(periods: Periods, fp: P.FeatureParams | None = None, *more: str) -> DataFrame:
    """Feature rows, and ``more`` columns of the periods, for every date of the periods' calendar."""
    return _dated(periods.per_day("Score_Datum"), fp or P.FeatureParams(), more)


#: The day that each of the columns which count from the date counts from.
COUNTED_FROM = {"Inaktiv_seit_Kauf": "Letzter_Kauf", "Last_Buy_Days": "Letzter_Kauf", "Last_Trade_Days": "_trade",
                "Last_Cashflow_Days": "_cashflow", "Streak_Inactive_Months": "_trade"}


def held_by_tests(periods: Periods, bounds: dict[str, set], fp: P.FeatureParams | None = None, *more: str) -> Periods:
    """Feature periods cut where a column that counts from the date passes one of its ``bounds``.

    Any comparison of the named columns with their bounds then has one result
    per period. The published columns (and ``more``) are those of its first
    day; columns that are not named hold for that day only if they count from it.
    """
    marks, inside = [], []
    for c, limits in bounds.items():
        anchor = F.col(COUNTED_FROM[c])
        passed = sorted({f(b) for b in limits for f in (math.ceil, lambda b: math.floor(b) + 1)})
        if c == "Streak_Inactive_Months":
            marks += [first_of_month_epoch(month_index(anchor) + p) for p in passed]
        elif passed:
            inside.append(days_inside(epoch_day(anchor), passed))
    cut = cut_at(periods, marks, inside) if marks or inside else periods
    first_day = cut.rows.withColumn("Score_Datum", as_day(F.col("e")))
    return Periods(_dated(first_day, fp or P.FeatureParams(), ("e", "until", *more)).drop("Score_Datum"), periods.dates)


def _on_file_days(df: DataFrame, days: DataFrame) -> DataFrame:
    """Snapshot rows of the wanted days' files, dated by the file day. ``days`` is a calendar (broadcast)."""
    files = F.broadcast(days.select(F.col("DateiID_B").alias("Datei_ID"), F.col("as_of").alias("_day")))
    return df.join(files, "Datei_ID").withColumn("Datum", F.col("_day")).drop("_day")


def depot_features_file_days(tables: SourceTables, days: DataFrame, fp: P.FeatureParams | None = None, held=None) -> DataFrame:
    """Feature table for many file days in one job, each as its day load gives it.

    ``days`` holds as_of, DateiID_U and DateiID_B. Balances and positions of a
    day are those of its snapshot file only, so a depot that has left the file
    has no portfolio on that day. An order has two days, its own and that of
    the file that brought it (``files.known_from``): windows run by its own
    day, but no date before both knows it. ``held`` as in ``depot_features_multi``.
    """
    fp = fp or P.FeatureParams()
    loaded = SourceTables(FI.known_from(tables.orders, days), _on_file_days(tables.balances, days), _on_file_days(tables.positions, days),
                          tables.bookings, tables.files)
    periods = timeline_periods(loaded, days.select("as_of").distinct(), fp, same_day_snapshots=True)
    return features_per_day(_changed(periods.select(*_held_columns(fp)), held), fp)


def depot_features_multi(tables: SourceTables, dates: DataFrame, fp: P.FeatureParams | None = None, held=None) -> DataFrame:
    """Feature table for every date in ``dates`` (column ``as_of``). ``held``
    changes the columns that do not count from the date (e.g. rounds them):
    once per period, not once per date."""
    return features_per_day(_changed(feature_periods(tables, dates, fp), held), fp)


def _changed(periods: Periods, held) -> Periods:
    return periods if held is None else Periods(held(periods.rows), periods.dates)
