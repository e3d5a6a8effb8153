"""Rule operators on the feature table: general score, investment readiness,
alerts, segments, call/e-mail leads.

All rules are column expressions (no Python UDFs). Per-date thresholds
(quantiles, k-th largest score) are computed per ``Score_Datum`` and joined
back on that key; a one-row-per-date frame is bounded by the number of dates
and broadcast.
"""

from __future__ import annotations

import operator
from dataclasses import fields
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.columns import clip, from_units, half_up_decimal
from depotlens.operators.quantiles import exact_quantiles

KEY = ["Depotnummer", "Score_Datum"]


def _num(c: str, default) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(float(default)))


class _Measures(dict):
    """Feature columns as doubles, a missing value as the rules count it; derived measures are filled in."""

    def __missing__(self, name: str) -> Column:
        self[name] = _num(name, P.RULE_MISSING.get(name, 0))
        return self[name]


def measures(**more: Column) -> dict[str, Column]:
    """What the rule tables of ``params`` test, by name: feature columns and shares; ``more`` adds or replaces some."""
    m = _Measures()
    depot = m["Depotwert"]

    def share(amount: Column) -> Column:
        return F.when(depot > 0, amount / depot).otherwise(0.0)

    cash_true = clip(F.col("Cashquote_true").cast("double"), 0.0, 1.0)
    m["Cashquote_true"] = F.coalesce(cash_true, F.lit(0.0))
    m["cash_share"] = clip(F.coalesce(cash_true, F.when(depot > 0, clip(m["Cash_abs"] / depot, 0.0, 1.0)), F.lit(0.0)), 0.0, 1.0)
    m["inflow_share"], m["netflow_share"] = share(m["Einzahlung_30d_eff"]), share(m["Nettoflow_30d"])
    m.update(more)
    return m


_COMPARE = {">=": operator.ge, ">": operator.gt, "<=": operator.le, "<": operator.lt, "=": operator.eq}


def _holds(m: dict[str, Column], alternatives) -> Column:
    """Whether all tests of one alternative hold; a test on a missing measure does not."""
    def test(name: str, comparison: str, bound) -> Column:
        return _COMPARE[comparison](m[name], m[bound] if isinstance(bound, str) else F.lit(bound))

    return F.coalesce(reduce(operator.or_, [reduce(operator.and_, [test(*t) for t in tests]) for tests in alternatives]), F.lit(False))


def _points(m: dict[str, Column], table) -> Column:
    """The sum of the points whose tests hold."""
    return reduce(operator.add, [F.when(_holds(m, (tests,)), F.lit(n)).otherwise(F.lit(0)) for n, tests in table])


# --------------------------------------------------------------------------
# General score (0..100) — computed from the feature base columns
# --------------------------------------------------------------------------

def _score_points(m: dict[str, Column]) -> Column:
    """The general score, 0..100, of the measures."""
    raw = _points(m, P.GENERAL_POINTS)
    capped = F.when(_holds(m, (P.WORTHLESS_IDLE,)), F.least(raw, F.lit(P.WORTHLESS_IDLE_CAP))).otherwise(raw)
    return clip(capped, 0, P.GENERAL_MAX).cast("bigint")


def general_score_expr() -> Column:
    """The general score (0..100) from feature-table columns."""
    return _score_points(measures())


def general_score(base: DataFrame) -> DataFrame:
    """Score table (Depotnummer, Orderfrequenz, ØOrdervolumen, Aktienquote,
    Cashquote, TechFokus, Score, Score_Datum) from ``feature_base_*`` output.

    ØOrdervolumen is the mean absolute order amount of the last 90 days; the
    stock ratio compares the security type case-sensitively and has no
    epsilon; the cash ratio is cash / (cash + value + 1e-6).
    """
    z = F.lit(0.0)
    n30 = F.coalesce(F.col("o_n30"), F.lit(0))
    n90 = F.coalesce(F.col("o_n90"), F.lit(0))
    vol90 = F.when(n90 > 0, F.col("o_vol90").cast("double") / F.col("o_n90") / 10000.0).otherwise(z)
    psum = from_units("p_sum")
    saldo = F.col("s_saldo")
    cash = clip(F.coalesce(F.when(saldo + psum + 1e-6 != 0, saldo / (saldo + psum + 1e-6)), z), 0.0, 1.0)
    aktie = F.when(F.col("p_aktie_exact").isNotNull() & (psum != 0), from_units("p_aktie_exact") / psum).otherwise(z)
    tech = F.coalesce(F.col("p_tech_cnt"), F.lit(0))
    worthless = ((F.coalesce(psum, z) <= 1) & (F.coalesce(F.col("p_zero"), F.lit(0)) >= 1)).cast("int")
    m = {"Orderfrequenz_30d": n30, "Orderfrequenz_90d": n90, "ØOrdervolumen_90d": vol90, "Cashquote_true": cash, "TechAffin": tech,
         "Wertlos_Flag": worthless, "Activity_Months_6m": F.coalesce(F.col("o_act6"), F.lit(0))}
    return base.select(
        "Depotnummer",
        F.col("o_months").cast("bigint").alias("Orderfrequenz"),
        half_up_decimal(vol90, 4).alias("ØOrdervolumen"),
        half_up_decimal(aktie, 6, 10).alias("Aktienquote"),
        half_up_decimal(cash, 6, 10).alias("Cashquote"),
        tech.cast("bigint").alias("TechFokus"),
        _score_points(m).alias("Score"),
        "Score_Datum",
    )


# --------------------------------------------------------------------------
# Investment readiness (0..20)
# --------------------------------------------------------------------------

def invest_score_expr() -> Column:
    """InvestScore from feature columns; missing values take the defaults of
    the rule (0, or 9999 for day counts)."""
    m = measures()
    malus = _points(m, P.INVEST_MALUS)
    relieved = F.when(_holds(m, P.INVEST_RELIEVED), F.greatest(F.lit(0), malus - P.INVEST_RELIEF)).otherwise(malus)
    score = F.greatest(F.lit(0), _points(m, P.INVEST_POINTS) - relieved)
    score = F.when(_holds(m, (P.WORTHLESS_IDLE,)), F.least(score, F.lit(P.WORTHLESS_IDLE_CAP))).otherwise(score)
    return F.least(F.lit(P.INVEST_MAX), score).cast("bigint")


def invest_score_bounds(columns) -> dict[str, set]:
    """The bounds that the readiness score tests each of ``columns`` against."""
    tables = [[tests for _, tests in P.INVEST_POINTS + P.INVEST_MALUS], P.INVEST_RELIEVED, [P.WORTHLESS_IDLE]]
    found: dict[str, set] = {}
    for name, _, bound in (t for table in tables for tests in table for t in tests):
        if name in columns:
            found.setdefault(name, set()).add(bound)
    return found


def invest_readiness(features: DataFrame) -> DataFrame:
    """Readiness export: Depotnummer, Cashquote (true cash ratio), Einzahlung_30d,
    Letzter_Kauf, Inaktiv_seit_Kauf, Orderfrequenz, TechAffin, ØOrdervolumen,
    InvestScore, Score_Datum."""
    return features.select(
        "Depotnummer",
        half_up_decimal(clip(_num("Cashquote_true", 0), 0.0, 1.0), 6, 10).alias("Cashquote"),
        half_up_decimal(F.col("Einzahlung_30d"), 2).alias("Einzahlung_30d"),
        "Letzter_Kauf",
        F.col("Inaktiv_seit_Kauf").cast("bigint").alias("Inaktiv_seit_Kauf"),
        F.col("Orderfrequenz").cast("bigint").alias("Orderfrequenz"),
        F.col("TechAffin").cast("bigint").alias("TechAffin"),
        half_up_decimal(F.col("ØOrdervolumen"), 2).alias("ØOrdervolumen"),
        invest_score_expr().alias("InvestScore"),
        "Score_Datum",
    )


# --------------------------------------------------------------------------
# Alerts
# --------------------------------------------------------------------------

def alerts(features: DataFrame, readiness: DataFrame | None = None) -> DataFrame:
    """All alert rules in one pass: an array of (code, text, severity) per depot,
    filtered to the firing rules and exploded (one row per depot and alert).

    ``readiness`` supplies InvestScore; without it the score rule never fires.
    """
    f = features.where(F.col("Depotnummer").isNotNull())
    if readiness is not None:
        f = f.join(readiness.select(*KEY, "InvestScore"), KEY, "left")
    else:
        f = f.withColumn("InvestScore", F.lit(None).cast("bigint"))
    m = measures(InvestScore=F.col("InvestScore"))
    items = [F.when(_holds(m, condition), F.struct(F.lit(code).alias("Alert_Code"), F.lit(text).alias("Alert_Text"),
                                                   F.lit(sev).alias("Severity")))
             for condition, (code, text, sev) in zip(P.ALERT_CONDITIONS, P.ALERTS, strict=True)]
    fired = F.filter(F.array(*items), lambda x: x.isNotNull())
    return (f.select("Depotnummer", "Score_Datum", F.explode(fired).alias("a"))
            .select("Depotnummer", "a.Alert_Code", "a.Alert_Text", "a.Severity",
                    F.col("Score_Datum").alias("Alert_Datum"), F.lit(P.ALERT_STATUS_OPEN).alias("Status"))
            .dropDuplicates(["Depotnummer", "Alert_Code", "Alert_Datum"]))


# --------------------------------------------------------------------------
# Segments
# --------------------------------------------------------------------------

def segment_cutoffs(features: DataFrame, sp: P.SegmentParams = P.SegmentParams()) -> DataFrame:
    """Per date: vol_cut = P80 of positive ØOrdervolumen_90d (default 5000);
    wealth_cut = max(P75 of positive Depotwert, 25000). Both quantiles come
    from one pass over the stacked (date, measure, value) rows."""
    f = features.where(F.col("Depotnummer").isNotNull())

    def part(col, tag):
        return (f.where(F.col(f"`{col}`") > 0)
                .select(F.struct(F.col("Score_Datum").alias("d"), F.lit(tag).alias("t")).alias("_grp"),
                        F.col(f"`{col}`").cast("double").alias("v")))

    long = part("ØOrdervolumen_90d", "vol").unionByName(part("Depotwert", "wealth"))
    q = exact_quantiles(long, "v", {"q_vol": sp.vol_quantile, "q_wealth": sp.wealth_quantile}, "_grp")
    per_date = q.groupBy(F.col("_grp.d").alias("Score_Datum")).agg(
        F.max(F.when(F.col("_grp.t") == "vol", F.col("q_vol"))).alias("vq"),
        F.max(F.when(F.col("_grp.t") == "wealth", F.col("q_wealth"))).alias("wq"))
    dates = f.select("Score_Datum").distinct()
    return (dates.join(per_date, "Score_Datum", "left")
            .select("Score_Datum",
                    F.coalesce(F.col("vq"), F.lit(sp.vol_default)).alias("vol_cut_90"),
                    F.greatest(F.coalesce(F.col("wq"), F.lit(sp.wealth_min)), F.lit(sp.wealth_min)).alias("wealth_cut")))


def segment_expr(sp: P.SegmentParams = P.SegmentParams()) -> Column:
    """Ordered decision list over feature columns plus ``vol_cut_90``/``wealth_cut``."""
    bounds = {f.name: F.lit(getattr(sp, f.name)) for f in fields(sp)}
    m = measures(vol_cut_90=F.col("vol_cut_90"), wealth_cut=F.col("wealth_cut"), **bounds)
    for name in ("TechWeight", "DeepLossShare_50"):
        m[name] = clip(m[name], 0.0, 1.0)
    return F.coalesce(*[F.when(_holds(m, condition), F.lit(name)) for name, condition in P.SEGMENT_CONDITIONS], F.lit(P.SEG_STANDARD))


def with_cutoffs(features: DataFrame, sp: P.SegmentParams = P.SegmentParams()) -> DataFrame:
    f = features.where(F.col("Depotnummer").isNotNull())
    return f.join(F.broadcast(segment_cutoffs(f, sp)), "Score_Datum")


def segments(features: DataFrame, sp: P.SegmentParams = P.SegmentParams()) -> DataFrame:
    """First matching segment of the ordered decision list per depot and date."""
    return with_cutoffs(features, sp).select("Depotnummer", segment_expr(sp).alias("Segment"), "Score_Datum")


def segment_counts(seg: DataFrame) -> DataFrame:
    """Depots per segment and date (value counts)."""
    return seg.groupBy("Score_Datum", "Segment").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# Leads
# --------------------------------------------------------------------------

LEAD_FEATURES = ("Cashquote_true", "Cash_abs", "Depotwert", "Einzahlung_30d_eff", "Orderfrequenz_30d",
                 "Orderfrequenz_90d", "Last_Buy_Days", "Last_Trade_Days", "Activity_Months_6m", "Wertlos_Flag",
                 "Nettoflow_30d")


def lead_frame(features: DataFrame, readiness: DataFrame, score: DataFrame, seg: DataFrame) -> DataFrame:
    """Features joined with the stored InvestScore, GeneralScore and Segment tables."""
    f = features.select(*KEY, *LEAD_FEATURES)
    return (f.join(readiness.select(*KEY, "InvestScore"), KEY, "left")
            .join(score.select(*KEY, F.col("Score").alias("GeneralScore")), KEY, "left")
            .join(seg.select(*KEY, "Segment"), KEY, "left"))


def lead_frame_direct(features: DataFrame, sp: P.SegmentParams = P.SegmentParams()) -> DataFrame:
    """Same columns as ``lead_frame`` computed in one pass over the feature table
    (scores and segment as expressions; only the per-date cut-offs are joined)."""
    f = with_cutoffs(features, sp)
    return f.select(*KEY, *LEAD_FEATURES, invest_score_expr().alias("InvestScore"),
                    general_score_expr().alias("GeneralScore"), segment_expr(sp).alias("Segment"))


def leads(frame: DataFrame, lp: P.LeadParams = P.LeadParams()) -> DataFrame:
    """Call/E-mail decision per depot and date plus the composite score.

    ``frame`` comes from ``lead_frame`` or ``lead_frame_direct``.
    Threshold: min(P99 of InvestScore, the ``min_calls``-th largest score when
    there are that many depots). Calls that are not ready or not in an allowed
    segment become e-mails; then ready, allowed e-mails are promoted to calls
    (best first) until ``min_calls`` calls exist. The top-k steps use
    ``row_number() <= k``, which Spark evaluates with a partial per-partition
    group limit before the shuffle, so only k rows per partition and date move.
    """
    df = frame
    invest = _num("InvestScore", 0)
    gen = _num("GeneralScore", 0)
    cash = _num("Cash_abs", 0)
    inflow = _num("Einzahlung_30d_eff", 0)
    lbuy = _num("Last_Buy_Days", 0)
    ltrade = _num("Last_Trade_Days", 0)
    act6 = _num("Activity_Months_6m", 0)
    ready = (((cash >= lp.ready_cash_min) | (inflow >= lp.ready_inflow_min) | (lbuy <= lp.ready_last_buy_max))
             & ((act6 > 0) | (ltrade <= lp.ready_recent_activity)))
    allowed = F.coalesce(F.col("Segment"), F.lit("")).isin(*lp.allowed_segments) if lp.enforce_segments \
        else F.lit(True)
    df = df.withColumn("_inv", invest).withColumn("_ready", ready).withColumn("_allowed", allowed)

    # Per-date threshold. InvestScore is an integer 0..20, so the exact
    # percentile's value map holds at most 21 entries per date.
    stats = df.groupBy("Score_Datum").agg(F.count(F.lit(1)).alias("_n"),
                                          F.percentile("_inv", lp.call_quantile).alias("_q"))
    rank_w = Window.partitionBy("Score_Datum").orderBy(F.desc("_inv"), F.asc("Depotnummer"))
    kth = (df.select("Score_Datum", "_inv", F.row_number().over(rank_w).alias("_rn"))
           .where(F.col("_rn") <= lp.min_calls)
           .groupBy("Score_Datum").agg(F.min("_inv").alias("_kth")))
    thr = (stats.join(kth, "Score_Datum", "left")
           .select("Score_Datum", F.when((F.col("_n") >= lp.min_calls) & F.lit(lp.min_calls > 0),
                                         F.least(F.col("_q"), F.col("_kth"))).otherwise(F.col("_q")).alias("_thr")))
    df = df.join(F.broadcast(thr), "Score_Datum")
    df = df.withColumn("_call", (F.col("_inv") >= F.col("_thr")) & F.col("_ready") & F.col("_allowed"))

    calls = df.groupBy("Score_Datum").agg(F.count_if(F.col("_call")).alias("_calls"))
    promo_w = Window.partitionBy("Score_Datum").orderBy(
        F.desc_nulls_last("InvestScore"), F.desc_nulls_last("Cash_abs"), F.asc_nulls_last("Last_Buy_Days"),
        F.desc_nulls_last("GeneralScore"), F.asc("Depotnummer"))
    cands = (df.where(~F.col("_call") & F.col("_ready") & F.col("_allowed"))
             .select(*KEY, F.row_number().over(promo_w).alias("_prn"))
             .where(F.col("_prn") <= lp.min_calls)
             .join(F.broadcast(calls), "Score_Datum")
             .where(F.col("_prn") <= F.greatest(F.lit(0), lp.min_calls - F.col("_calls")))
             .select(*KEY, F.lit(True).alias("_promo")))
    df = df.join(cands, KEY, "left")
    action = F.when(F.col("_call") | F.coalesce(F.col("_promo"), F.lit(False)), "Call").otherwise("Email")
    comp = (invest * 0.6 + gen * 0.4
            + F.when(_num("Wertlos_Flag", 0) >= 1, -5.0).otherwise(0.0)
            + F.when(act6 == 0, -4.0).otherwise(0.0))
    return df.select(
        "Depotnummer", "Score_Datum",
        invest.cast("bigint").alias("InvestScore"),
        gen.cast("bigint").alias("GeneralScore"),
        comp.alias("CompositeScore"),
        "Segment",
        action.alias("Next_Action"),
        F.col("_ready").alias("ready"),
        F.col("Cash_abs"),
    )


def lead_report(lead_rows: DataFrame) -> DataFrame:
    """Per date: total leads, calls, e-mails, ready rate and median cash among calls."""
    is_call = F.col("Next_Action") == "Call"
    counts = lead_rows.groupBy("Score_Datum").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_call).alias("calls"),
        F.count_if(~is_call).alias("emails"),
        F.coalesce(F.avg(F.when(is_call, F.col("ready").cast("double"))), F.lit(0.0)).alias("ready_call_rate"))
    med = exact_quantiles(lead_rows.where(is_call), "Cash_abs", {"median_cash_calls": 0.5}, "Score_Datum")
    return (counts.join(med, "Score_Datum", "left")
            .withColumn("median_cash_calls", F.coalesce(F.col("median_cash_calls"), F.lit(0.0))))
