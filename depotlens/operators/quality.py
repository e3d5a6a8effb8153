"""Data-quality operators: ranges, drift against the previous date, lead
coverage, daily label monitoring, schema audit, flow reconciliation, feature
audit, localized number parsing.

All checks are per date (``Score_Datum``) aggregates; comparisons with the
previous date use ``lag`` over the per-date rows, whose number is bounded by
the calendar.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from depotlens import params as P
from depotlens.functions.columns import epoch_day, from_units, money_units, parse_localized_number
from depotlens.functions.text import flow_class_alt
from depotlens.operators.features import COUNTED_FROM, FEATURE_COLUMNS, dated_columns, held_by_tests
from depotlens.operators.quantiles import exact_quantiles, quantiles_per_day
from depotlens.operators.timeline import Periods, as_day

# The schema audit expects the feature table without its two derived cash ratios.
EXPECTED_FEATURE_COLUMNS = tuple(c for c in FEATURE_COLUMNS if c not in P.DERIVED_FEATURE_COLUMNS)


def range_checks(features: DataFrame | Periods, fp: P.FeatureParams | None = None) -> DataFrame:
    """Per date: ratios outside [0, 1] and negative day counts. Feature periods
    (``features.feature_periods``) are cut where a day count changes its sign."""
    ratios, days = ("Cashquote_true", "Cashquote"), ("Last_Buy_Days", "Last_Trade_Days", "Last_Cashflow_Days")
    checks = {f"{c}_out_of_range": (F.col(c) < 0) | (F.col(c) > 1) for c in ratios} | {f"{c}_negative": F.col(c) < 0 for c in days}
    if isinstance(features, Periods):
        held = held_by_tests(features, {c: {0} for c in days}, fp)
        return held.sums_per_day([], {k: F.coalesce(c, F.lit(False)).cast("bigint") for k, c in checks.items()}).drop("n")
    return features.groupBy("Score_Datum").agg(*[F.count_if(c).alias(k) for k, c in checks.items()])


def _per_date_quantiles(frames: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """P50/P80 per date of several (frame, column, tag) at once: the values are
    stacked to (date and tag as one number, value) and one quantile pass runs over all of them."""
    long = None
    for k, (df, col, _) in enumerate(frames):
        part = df.select((epoch_day("Score_Datum").cast("bigint") * len(frames) + k).alias("_grp"), F.col(f"`{col}`").cast("double").alias("v"))
        long = part if long is None else long.unionByName(part)
    q = exact_quantiles(long, "v", {"p50": 0.5, "p80": 0.8}, "_grp")
    which = F.pmod(F.col("_grp"), F.lit(len(frames)))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("_grp") / len(frames)).cast("int"))
    aggs = []
    for k, (_, _, tag) in enumerate(frames):
        aggs += [F.max(F.when(which == k, F.col("p50"))).alias(f"P50_{tag}"), F.max(F.when(which == k, F.col("p80"))).alias(f"P80_{tag}")]
    return q.groupBy(day.alias("Score_Datum")).agg(*aggs)


def _quantiles_of_periods(periods: Periods, columns: dict[str, str]) -> DataFrame:
    """``_per_date_quantiles`` of columns (by tag) of one set of periods."""
    q = quantiles_per_day(periods, list(columns.values()), {"p50": 0.5, "p80": 0.8})
    return q.groupBy("Score_Datum").agg(*[F.max(F.when(F.col("k") == k, F.col(p.lower()))).alias(f"{p}_{tag}")
                                          for k, tag in enumerate(columns) for p in ("P50", "P80")])


def drift(features: DataFrame | Periods, readiness: DataFrame | None = None, qp: P.QcParams = P.QcParams()) -> DataFrame:
    """Validation log per date: row count and P50/P80 of the 90-day order
    volume, the cash ratio and InvestScore, each next to the previous date's,
    with a drift flag and notes. InvestScore comes from ``readiness`` or, when
    it is None, from an ``InvestScore`` column of ``features`` (of periods: always)."""
    if isinstance(features, Periods):
        counts = features.sums_per_day([], {}).withColumnRenamed("n", "Agg_Rows")
        q = _quantiles_of_periods(features, {"Vol90d": "ØOrdervolumen_90d", "Cashquote": "Cashquote_true", "InvestScore": "InvestScore"})
    else:
        counts = features.groupBy("Score_Datum").agg(F.count(F.lit(1)).alias("Agg_Rows"))
        score_src = readiness if readiness is not None else features
        q = _per_date_quantiles([(features, "ØOrdervolumen_90d", "Vol90d"), (features, "Cashquote_true", "Cashquote"),
                                 (score_src, "InvestScore", "InvestScore")])
    d = counts.join(q, "Score_Datum", "left")
    w = Window.orderBy("Score_Datum")  # one row per date: a calendar-sized frame
    for c in ("Agg_Rows", "P50_Vol90d", "P80_Vol90d", "P50_Cashquote", "P80_Cashquote",
              "P50_InvestScore", "P80_InvestScore"):
        d = d.withColumn(f"{c}_Prev" if c != "Agg_Rows" else "Rowcount_Prev", F.lag(c).over(w))
    delta = (F.col("Agg_Rows") - F.col("Rowcount_Prev")) / F.col("Rowcount_Prev") * 100.0
    d = d.withColumn("Rowcount_Delta_Pct", F.when(F.col("Rowcount_Prev") > 0, delta))

    def truthy(c):
        return F.col(c).isNotNull() & (F.col(c) != 0)

    vol_pct = F.abs(F.col("P80_Vol90d") - F.col("P80_Vol90d_Prev")) / F.col("P80_Vol90d_Prev") * 100.0
    sc_pct = F.abs(F.col("P80_InvestScore") - F.col("P80_InvestScore_Prev")) / F.col("P80_InvestScore_Prev") * 100.0
    cash_abs = F.abs(F.col("P80_Cashquote") - F.col("P80_Cashquote_Prev"))
    f_rows = F.coalesce(F.abs(F.col("Rowcount_Delta_Pct")) > qp.rowcount_tol_pct, F.lit(False))
    f_vol = truthy("P80_Vol90d_Prev") & truthy("P80_Vol90d") & (F.col("P80_Vol90d_Prev") > 0) \
        & (vol_pct > qp.vol_q80_tol_pct)
    f_cash = F.col("P80_Cashquote_Prev").isNotNull() & F.col("P80_Cashquote").isNotNull() \
        & (cash_abs > qp.cash_q80_tol_abs)
    f_score = truthy("P80_InvestScore_Prev") & truthy("P80_InvestScore") & (F.col("P80_InvestScore_Prev") > 0) \
        & (sc_pct > qp.score_q80_tol_pct)
    notes = F.concat_ws("; ",
                        F.when(f_rows, F.format_string(f"Rowcount drift %.2f%% > {qp.rowcount_tol_pct}%%",
                                                       F.col("Rowcount_Delta_Pct"))),
                        F.when(f_vol, F.format_string(f"P80 Vol90d drift %.1f%% > {qp.vol_q80_tol_pct}%%", vol_pct)),
                        F.when(f_cash, F.format_string(f"P80 Cashquote drift %.2f > {qp.cash_q80_tol_abs}", cash_abs)),
                        F.when(f_score, F.format_string(f"P80 InvestScore drift %.1f%% > {qp.score_q80_tol_pct}%%",
                                                        sc_pct)))
    return d.select(
        F.col("Score_Datum").alias("Log_Datum"), "Agg_Rows", "Rowcount_Prev", "Rowcount_Delta_Pct",
        "P50_Vol90d", "P80_Vol90d", "P50_Vol90d_Prev", "P80_Vol90d_Prev",
        "P50_Cashquote", "P80_Cashquote", "P50_Cashquote_Prev", "P80_Cashquote_Prev",
        "P50_InvestScore", "P80_InvestScore", "P50_InvestScore_Prev", "P80_InvestScore_Prev",
        (f_rows | f_vol | f_cash | f_score).cast("int").alias("Drift_Flag"),
        F.nullif(notes, F.lit("")).alias("Notes"))


def lead_coverage(features: DataFrame, lead_rows: DataFrame, qp: P.QcParams = P.QcParams()) -> DataFrame:
    """Per date: leads, calls, e-mails, lead rate vs. feature rows and a flag below the minimum rate."""
    agg = features.groupBy("Score_Datum").agg(F.count(F.lit(1)).alias("Agg_Rows"))
    ld = lead_rows.groupBy("Score_Datum").agg(
        F.count(F.lit(1)).alias("Leads_Rows"),
        F.count_if(F.col("Next_Action") == "Call").alias("Leads_Call"),
        F.count_if(F.col("Next_Action") == "Email").alias("Leads_Email"))
    j = agg.join(ld, "Score_Datum", "left").fillna(0, ["Leads_Rows", "Leads_Call", "Leads_Email"])
    rate = F.col("Leads_Rows") / F.col("Agg_Rows") * 100.0
    return j.select("Score_Datum", "Agg_Rows", "Leads_Rows", "Leads_Call", "Leads_Email",
                    rate.alias("Lead_Rate_Pct"),
                    F.when(F.col("Agg_Rows") > 0, (rate < qp.lead_min_rate).cast("int")).otherwise(0)
                    .alias("Coverage_Flag"))


def daily_label_monitor(labels: DataFrame, date_col: str = "Stichtag", horizons=(7, 14, 30),
                        rate_tol: float = 0.5, null_max: float = 0.98, window_days: int = 14) -> DataFrame:
    """Per date: rows, positive rate per horizon, share of rows without a first
    buy; the longest horizon's rate is compared with the median rate of the
    previous ``window_days`` days (flag when it deviates by more than 50 %)."""
    h_last = max(horizons)
    per_day = labels.groupBy(date_col).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col(f"label_T{h}").cast("double")).alias(f"pos_rate_T{h}") for h in horizons],
        F.avg(F.col("first_buy_date").isNull().cast("double")).alias("null_share"))
    w = Window.orderBy(epoch_day(date_col)).rangeBetween(-window_days, -1)  # calendar-sized frame
    med = F.percentile(F.col(f"pos_rate_T{h_last}"), 0.5).over(w)
    per_day = per_day.withColumn("median_prev", med)
    dev = F.abs(F.col(f"pos_rate_T{h_last}") - F.col("median_prev")) / F.col("median_prev")
    return per_day.select(
        "*",
        F.coalesce((F.col("median_prev") > 0) & (dev > rate_tol), F.lit(False)).cast("int").alias("rate_flag"),
        (F.col("null_share") > null_max).cast("int").alias("null_flag"))


def validation_log(features: DataFrame, readiness: DataFrame, scores: DataFrame, segments: DataFrame,
                   lead_rows: DataFrame, qp: P.QcParams = P.QcParams()) -> DataFrame:
    """The joined validation row per date: drift, row counts of the day's
    tables, lead coverage and the combined notes and flag."""
    def rows(df, name):
        return df.groupBy(F.col("Score_Datum").alias("Log_Datum")).agg(F.count(F.lit(1)).alias(name))

    d = drift(features, readiness, qp)
    cov = lead_coverage(features, lead_rows, qp).withColumnRenamed("Score_Datum", "Log_Datum").drop("Agg_Rows")
    j = (d.join(rows(readiness, "IB_Rows"), "Log_Datum", "left")
         .join(rows(scores, "SC_Rows"), "Log_Datum", "left")
         .join(rows(segments, "SEG_Rows"), "Log_Datum", "left")
         .join(cov, "Log_Datum", "left")
         .fillna(0, ["IB_Rows", "SC_Rows", "SEG_Rows", "Leads_Rows", "Leads_Call", "Leads_Email"]))
    low = F.coalesce(F.col("Coverage_Flag") == 1, F.lit(False))
    note = F.when(low, F.format_string(f"Lead rate %.2f%% < {qp.lead_min_rate}%%", F.col("Lead_Rate_Pct")))
    return (j.withColumn("Notes", F.nullif(F.concat_ws("; ", "Notes", note), F.lit("")))
            .withColumn("Drift_Flag", F.greatest(F.col("Drift_Flag"), F.coalesce("Coverage_Flag", F.lit(0)))))


def daily_table_monitor(df: DataFrame | Periods, columns, date_col: str = "Score_Datum", tol: float = 0.5,
                        null_max: float = 0.98, window_days: int = 14) -> DataFrame:
    """Per date and column of features or scores: rows, mean, share of NULLs,
    and flags where the mean leaves the median of the previous ``window_days``
    days by more than ``tol`` or nearly everything is NULL."""
    if isinstance(df, Periods):
        per_day = _means_of_periods(df, columns, date_col)
    else:
        long = df.select(date_col, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns])).alias("x"))
        per_day = long.groupBy(date_col, F.col("x.column_name").alias("column_name")).agg(
            F.count(F.lit(1)).alias("n"), F.avg("x.v").alias("mean"), F.avg(F.col("x.v").isNull().cast("double")).alias("null_share"))
    w = Window.partitionBy("column_name").orderBy(epoch_day(date_col)).rangeBetween(-window_days, -1)  # calendar-sized frame
    per_day = per_day.withColumn("median_prev", F.percentile(F.col("mean"), 0.5).over(w))
    off = F.abs(F.col("mean") - F.col("median_prev")) > tol * F.abs(F.col("median_prev"))
    return per_day.select("*", F.coalesce((F.col("median_prev") != 0) & off, F.lit(False)).cast("int").alias("mean_flag"),
                          (F.col("null_share") > null_max).cast("int").alias("null_flag"))


def _means_of_periods(periods: Periods, columns, date_col: str) -> DataFrame:
    """Rows, mean and share of NULLs per date and column (of finite values)."""
    value = [F.col(f"`{c}`").cast("double") for c in columns]
    sums = {f"s{i}": F.coalesce(v, F.lit(0.0)) for i, v in enumerate(value)} | {f"m{i}": v.isNull().cast("bigint") for i, v in enumerate(value)}
    days = periods.sums_per_day([], sums, date_col)
    there = [F.col("n") - F.col(f"m{i}") for i in range(len(value))]
    return days.select(date_col, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("n"), F.when(there[i] > 0, F.col(f"s{i}") / there[i]).alias("mean"), (F.col(f"m{i}") / F.col("n")).alias("null_share"))
        for i, c in enumerate(columns)])).alias("x")).select(date_col, "x.*")


def schema_audit(spark: SparkSession, df: DataFrame, expected=EXPECTED_FEATURE_COLUMNS) -> DataFrame:
    """Columns missing from ``df`` and columns not in the expected list."""
    have = list(df.columns)
    rows = [(c, "missing") for c in expected if c not in have] + [(c, "extra") for c in have if c not in expected]
    return spark.createDataFrame(rows, "column_name string, status string")


def flow_reconcile(features: DataFrame, bookings: DataFrame, balances: DataFrame, positions: DataFrame,
                   as_of) -> DataFrame:
    """Recompute money flows (second classifier, no transfer exclusion) and the
    cash ratio from the snapshots of the day itself for every depot of the
    feature table; report both values and their differences."""
    a = F.lit(str(as_of)).cast("date")
    b = bookings.where(F.col("Valutadatum") <= a).withColumn("k", flow_class_alt("Buchungtyp"))
    u = money_units("Betrag")
    v = F.col("Valutadatum")
    is_in = F.col("k") == "in"
    is_out = F.col("k").isin("out", "fee_out")
    flows = b.groupBy(F.col("Kontoreferenz").alias("Depotnummer")).agg(
        F.sum(F.when(is_in & (v >= F.date_sub(a, 30)), u)).alias("i30"),
        F.sum(F.when(is_out & (v >= F.date_sub(a, 30)), u)).alias("o30"),
        F.sum(F.when(is_in & (v >= F.date_sub(a, 90)), u)).alias("i90"),
        F.sum(F.when(is_out & (v >= F.date_sub(a, 90)), u)).alias("o90"))
    cash = balances.where(F.col("Datum") == a).groupBy(F.col("Kontoreferenz").alias("Depotnummer")) \
        .agg(F.sum(money_units("Saldosollwert")).alias("cu"))
    val = positions.where(F.col("Datum") == a).groupBy(F.col("Depotreferenz").alias("Depotnummer")) \
        .agg(F.sum(money_units("Kurswert")).alias("vu"))
    f = features.where(F.col("Score_Datum") == a).select(
        "Depotnummer", "Score_Datum", "Einzahlung_30d", "Auszahlung_30d", "Nettoflow_30d",
        "Einzahlung_90d", "Auszahlung_90d", "Nettoflow_90d", "Cashquote")
    j = f.join(flows, "Depotnummer", "left").join(cash, "Depotnummer", "left").join(val, "Depotnummer", "left")

    def units(c):
        return F.coalesce(F.col(c), F.lit(0).cast("bigint"))

    cash_sql = from_units(units("cu"))
    cq_sql = cash_sql / (from_units(units("vu")) + 1e-6)
    out = j.select(
        "Depotnummer", "Score_Datum", "Einzahlung_30d", "Auszahlung_30d", "Nettoflow_30d",
        "Einzahlung_90d", "Auszahlung_90d", "Nettoflow_90d", "Cashquote",
        from_units(units("i30")).alias("inflow_30_sql"), from_units(units("o30")).alias("outflow_30_sql"),
        from_units(units("i30") - units("o30")).alias("netto_30_sql"),
        from_units(units("i90")).alias("inflow_90_sql"), from_units(units("o90")).alias("outflow_90_sql"),
        from_units(units("i90") - units("o90")).alias("netto_90_sql"),
        cash_sql.alias("cash_abs_sql"), cq_sql.alias("cashquote_sql"))
    pairs = [("inflow_30", "Einzahlung_30d"), ("outflow_30", "Auszahlung_30d"), ("netto_30", "Nettoflow_30d"),
             ("inflow_90", "Einzahlung_90d"), ("outflow_90", "Auszahlung_90d"), ("netto_90", "Nettoflow_90d"),
             ("cashquote", "Cashquote")]
    return out.select("*", *[(F.col(f"{k}_sql") - F.col(c)).alias(f"Δ_{k}") for k, c in pairs])


def feature_audit(features: DataFrame, z: float = 3.0) -> DataFrame:
    """Per numeric column: rows, nulls, min, max, mean, sample std-dev, constant
    flag and |z| > 3 outliers; plus the number of duplicate (depot, date) keys.

    The columns are stacked to (column_name, value) once; statistics are one
    aggregation by column name, outliers a second one against the per-column
    statistics (one row per column, broadcast).
    """
    cols = [f.name for f in features.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in ("Depotnummer",)]
    long = features.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("v")) for c in cols]))
        .alias("x")).select("x.*")
    st = long.groupBy("column_name").agg(
        F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("nulls"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"))
    ot = (long.join(F.broadcast(st.select("column_name", F.col("mean").alias("_m"), F.col("std").alias("_s"))),
                    "column_name")
          .groupBy("column_name").agg(F.count_if(F.abs(F.col("v") - F.col("_m")) > z * F.col("_s"))
                                      .alias("outliers_z3")))
    dup = (features.groupBy("Depotnummer", "Score_Datum").count().where(F.col("count") > 1)
           .select(F.count(F.lit(1))).scalar())
    return (st.join(ot, "column_name")
            .withColumn("is_constant", (F.col("min") == F.col("max")).cast("int"))
            .withColumn("duplicate_keys", dup))


def feature_correlations(features: DataFrame, cols, min_abs: float = 0.9) -> DataFrame:
    """Pearson correlation of every pair of ``cols`` (NULL counts as 0) and
    whether it is high; NULL where a column is constant. One aggregation."""
    def value(c):
        return F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))

    pairs = list(combinations(cols, 2))
    once = features.agg(*[F.corr(value(a), value(b)).alias(str(i)) for i, (a, b) in enumerate(pairs)])
    rows = once.select(F.explode(F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(str(i)).alias("r"))
                                           for i, (a, b) in enumerate(pairs)])).alias("x")).select("x.*")
    r = F.when(~F.isnan("r"), F.col("r"))
    return rows.select("column_a", "column_b", r.alias("correlation"), F.coalesce(F.abs(r) >= min_abs, F.lit(False)).cast("int").alias("high"))


def correlation_matrix(features: DataFrame | Periods, cols, min_abs: float = 0.9, fp: P.FeatureParams = P.FeatureParams()) -> DataFrame:
    """As ``feature_correlations``, for many columns: every pair of ``cols`` from one Gram matrix.

    Each task multiplies its Arrow batches with themselves (products about the
    columns' means, so that large amounts do not cancel) and hands over one
    number per pair; those are added up by pair. Constant columns, found by
    their range, correlate with nothing (NULL), as do tables of one row.

    Of feature periods a value counts for each of its days; only the columns
    that count from the date come day by day (``_period_products``).
    """
    cols = list(cols)
    if isinstance(features, Periods):
        return _correlations(*_period_products(features, cols, fp), cols, min_abs)
    value = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in cols]
    plain = features.select(*[v.alias(str(i)) for i, v in enumerate(value)])
    stats = plain.agg(*[F.avg(c).alias(f"m{c}") for c in plain.columns], *[(F.min(c) < F.max(c)).alias(f"v{c}") for c in plain.columns]).first()
    means = np.array([stats[f"m{i}"] or 0.0 for i in range(len(cols))])
    varies = [bool(stats[f"v{i}"]) for i in range(len(cols))]
    a, b = np.triu_indices(len(cols))

    def products(batches):
        gram, ones = np.zeros((len(means), len(means))), np.zeros(len(means))
        rows = 0
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - means
            gram += x.T @ x
            ones += x.sum(axis=0)
            rows += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (a, b, gram[a, b], ones[a], ones[b], np.full(len(a), rows))], ["a", "b", "ab", "sa", "sb", "n"])

    return _correlations(plain.mapInArrow(products, _PRODUCTS), varies, cols, min_abs)


_PRODUCTS = "a long, b long, ab double, sa double, sb double, n long"


def _period_products(periods: Periods, cols: list[str], fp: P.FeatureParams) -> tuple[DataFrame, list[bool]]:
    """Sums of products by pair of ``cols`` from each task, over the rows behind the periods, and whether a column varies."""
    counted = [c for c in cols if c in COUNTED_FROM]
    held = [c for c in cols if c not in COUNTED_FROM]

    def daily(c):
        return F.transform("_days", lambda day: F.coalesce(dated_columns(fp, as_day(day))[c].cast("double"), F.lit(0.0)))

    plain = periods.with_days("_days").select(F.size("_days").alias("n"), *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"h{i}") for i, c in enumerate(held)],
                                              *[daily(c).alias(f"d{i}") for i, c in enumerate(counted)])
    h, dd = [f"h{i}" for i in range(len(held))], [f"d{i}" for i in range(len(counted))]
    stats = plain.agg(*[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(f"m{c}") for c in h], *[F.avg(F.get(c, F.lit(0))).alias(f"m{c}") for c in dd],
                      *[(F.min(c) < F.max(c)).alias(f"v{c}") for c in h], *[(F.min(F.array_min(c)) < F.max(F.array_max(c))).alias(f"v{c}") for c in dd]).first()
    about_h, about_d = (np.array([stats[f"m{c}"] or 0.0 for c in names]) for names in (h, dd))  # any point near the means will do
    place = np.array([(held + counted).index(c) for c in cols])
    a, b = np.triu_indices(len(cols))

    def products(batches):
        k = len(about_h) + len(about_d)
        gram, ones = np.zeros((k, k)), np.zeros(k)
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.zeros((len(n), len(about_h)))
            for i in range(len(about_h)):
                x[:, i] = batch.column(1 + i).to_numpy(zero_copy_only=False) - about_h[i]
            first = np.concatenate([[0], np.cumsum(n)[:-1]])
            y = np.zeros((int(n.sum()), len(about_d)))
            for i in range(len(about_d)):
                y[:, i] = batch.column(1 + len(about_h) + i).flatten().to_numpy(zero_copy_only=False) - about_d[i]
            both = x.T @ np.add.reduceat(y, first, axis=0)
            gram += np.block([[(x * n[:, None]).T @ x, both], [both.T, y.T @ y]])
            ones += np.concatenate([(x * n[:, None]).sum(axis=0), y.sum(axis=0)])
            rows += len(y)
        at, total = gram[np.ix_(place, place)], ones[place]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (a, b, at[a, b], total[a], total[b], np.full(len(a), rows))], ["a", "b", "ab", "sa", "sb", "n"])

    by_column = dict(zip(held + counted, h + dd, strict=True))
    return plain.mapInArrow(products, _PRODUCTS), [bool(stats[f"v{by_column[c]}"]) for c in cols]


def _correlations(parts: DataFrame, varies: list[bool], cols: list[str], min_abs: float) -> DataFrame:
    """The pairs' correlations from the tasks' sums of products."""
    total = parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("ab", "sa", "sb", "n")])
    about_mean = (F.col("ab") - F.col("sa") * F.col("sb") / F.col("n")).alias("cov")
    total = total.select("a", "b", about_mean)
    var = total.where("a = b")
    pairs = (total.where("a < b").alias("p").join(F.broadcast(var.select(F.col("a").alias("ia"), F.col("cov").alias("va"))), F.col("p.a") == F.col("ia"))
             .join(F.broadcast(var.select(F.col("a").alias("ib"), F.col("cov").alias("vb"))), F.col("p.b") == F.col("ib")))
    names, known = F.array(*[F.lit(c) for c in cols]), F.array(*[F.lit(v) for v in varies])
    r = F.when(known[F.col("p.a").cast("int")] & known[F.col("p.b").cast("int")], F.col("cov") / (F.sqrt("va") * F.sqrt("vb")))
    return pairs.select(names[F.col("p.a").cast("int")].alias("column_a"), names[F.col("p.b").cast("int")].alias("column_b"), r.alias("correlation"),
                        F.coalesce(F.abs(r) >= min_abs, F.lit(False)).cast("int").alias("high"))


def localized_numbers(df: DataFrame, cols, min_share: float = 0.7) -> DataFrame:
    """Parse localized numeric text columns; report the parse rate per column
    and whether it reaches ``min_share`` (the column would be kept as numeric)."""
    parsed = df.select(*[parse_localized_number(F.col(c)).alias(c) for c in cols])
    rates = parsed.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in cols])
    long = rates.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("parse_rate"))
                                            for c in cols])).alias("x")).select("x.*")
    return long.withColumn("kept", (F.col("parse_rate") >= min_share).cast("int"))
