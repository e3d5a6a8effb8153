"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They run the library's operators over the depot tables derived from the
test tables (``depotlens.sources.fixture``) at the fixture's cut-off date.
Doubles are rounded at the output (6 places; 4 for standard deviations) so
that a different summation order cannot change the compared values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from depotlens import params as P
from depotlens.operators import features as FE
from depotlens.operators import files as FI
from depotlens.operators import labels as LB
from depotlens.operators import metrics as ME
from depotlens.operators import quality as QC
from depotlens.plans import ml as ML
from depotlens.operators import rules as RU
from depotlens.plans.boosting import BoostParams
from depotlens.session import materialize
from depotlens.sources.catalog import SourceTables, day_load, typed_orders
from depotlens.sources.fixture import CUTOFF, fixture_late_orders, fixture_tables

FIXTURE_FEATURES = P.FeatureParams(vocab=P.FIXTURE_VOCAB)
FOUR_PLACES = ("Deposit_Volatility_6m",)
# Means of exact fixed-point sums are bit-identical in every engine; they are
# left unrounded because their true value often sits exactly on a rounding tie.
UNROUNDED = ("ØOrdervolumen", "ØOrdervolumen_30d", "ØOrdervolumen_90d")


def prepare(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def rounded(df: DataFrame, places: int = 6, four=FOUR_PLACES, keep=UNROUNDED) -> DataFrame:
    """Round doubles for comparison (4 places for ``four``, none for ``keep``);
    decimals become doubles."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in keep:
            c = F.round(c, 4 if f.name in four else places)
        out.append(c.alias(f.name))
    return df.select(*out)


_TABLES: dict = {}


def _key(spark: SparkSession, sf_dir: str):
    """Cache key of per-session intermediate results (a restarted context gets new ones)."""
    return (id(spark), spark.sparkContext.applicationId, sf_dir)


def tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    """Typed fixture tables (cached per session and directory, plans only)."""
    prepare(spark)
    key = _key(spark, sf_dir)
    if key not in _TABLES:
        _TABLES[key] = fixture_tables(spark, sf_dir).typed()
    return _TABLES[key]


# --------------------------------------------------------------------------
# Features
# --------------------------------------------------------------------------

def q_depot_features(spark, sf_dir):
    t = tables(spark, sf_dir)
    return rounded(FE.depot_features(t, CUTOFF, FIXTURE_FEATURES))


_DATES: dict = {}


def backfill_dates(spark, sf_dir):
    """The complete days of the 24 months: a calendar, stored once per session and directory because plans read it many times."""
    key = _key(spark, sf_dir)
    if key not in _DATES:
        _DATES[key] = materialize(FI.backfill_dates(tables(spark, sf_dir).files, months=24).coalesce(1))
    return _DATES[key]


def q_depot_features_backfill(spark, sf_dir):
    t = tables(spark, sf_dir)
    return FE.depot_features_multi(t, backfill_dates(spark, sf_dir), FIXTURE_FEATURES, held=rounded)


# --------------------------------------------------------------------------
# Rules (one cut-off date)
# --------------------------------------------------------------------------

_DAILY: dict = {}


def _daily(spark, sf_dir):
    """Feature base of the cut-off date, checkpointed once per session and
    directory; the rule queries start from it."""
    key = _key(spark, sf_dir)
    if key not in _DAILY:
        t = tables(spark, sf_dir)
        _DAILY[key] = materialize(FE.feature_base_at(t, CUTOFF, FIXTURE_FEATURES))
    base = _DAILY[key]
    return base, FE.finish_features(base, FIXTURE_FEATURES)


_LEADS: dict = {}


def _lead_rows(spark, sf_dir):
    """The day's lead rows, checkpointed once per session and directory (the
    report and the coverage check read them several times)."""
    key = _key(spark, sf_dir)
    if key not in _LEADS:
        _, feats = _daily(spark, sf_dir)
        _LEADS[key] = materialize(RU.leads(RU.lead_frame_direct(feats)))
    return _LEADS[key]


def q_general_score(spark, sf_dir):
    base, _ = _daily(spark, sf_dir)
    return rounded(RU.general_score(base))


def q_invest_readiness(spark, sf_dir):
    _, feats = _daily(spark, sf_dir)
    return rounded(RU.invest_readiness(feats))


def q_alerts(spark, sf_dir):
    _, feats = _daily(spark, sf_dir)
    return RU.alerts(feats, RU.invest_readiness(feats))


def q_segment_cutoffs(spark, sf_dir):
    _, feats = _daily(spark, sf_dir)
    return rounded(RU.segment_cutoffs(feats))


def q_segments(spark, sf_dir):
    _, feats = _daily(spark, sf_dir)
    return RU.segments(feats)


def q_segment_counts(spark, sf_dir):
    _, feats = _daily(spark, sf_dir)
    return RU.segment_counts(RU.segments(feats))


def q_leads(spark, sf_dir):
    rows = _lead_rows(spark, sf_dir)
    return rounded(rows.select("Depotnummer", "Score_Datum", "InvestScore", "GeneralScore", "CompositeScore",
                               "Segment", "Next_Action"))


def q_lead_report(spark, sf_dir):
    return rounded(RU.lead_report(_lead_rows(spark, sf_dir)))


# Two file days of the fixture: the yearly position snapshot, and the last day (its file holds balances only).
FILE_DAYS = ("2001-01-01", "2001-08-01")


def q_day_load(spark, sf_dir):
    """Rows, depots and amounts that each table holds on a file day."""
    t = tables(spark, sf_dir)
    parts = []
    for day in FILE_DAYS:
        loaded = day_load(t, day)
        for name, df, key, amount in (("orders", loaded.orders, "Depotnummer", "Cashflow"),
                                      ("balances", loaded.balances, "Kontoreferenz", "Saldosollwert"),
                                      ("positions", loaded.positions, "Depotreferenz", "Kurswert")):
            parts.append(df.agg(F.lit(day).cast("date").alias("file_day"), F.lit(name).alias("table_name"),
                                F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("depots"),
                                F.round(F.sum(amount), 2).alias("amount")))
    return reduce(DataFrame.unionByName, parts)


def q_depot_features_file_day(spark, sf_dir):
    t = tables(spark, sf_dir)
    return reduce(DataFrame.unionByName, [rounded(FE.depot_features(day_load(t, d), d, FIXTURE_FEATURES)) for d in FILE_DAYS])


def q_depot_features_file_days(spark, sf_dir):
    """The same file days in one job over the timeline."""
    t = tables(spark, sf_dir)
    days = FI.complete_days(t.files).where(F.col("Datum").isin([F.lit(d).cast("date") for d in FILE_DAYS]))
    return FE.depot_features_file_days(t, days.select(F.col("Datum").alias("as_of"), "DateiID_U", "DateiID_B"), FIXTURE_FEATURES, held=rounded)


def _backfill_file_days(t):
    """The complete days of the 24 months with their files: a calendar, stored because the plan reads it many times."""
    days = FI.complete_days(t.files).select(F.col("Datum").alias("as_of"), "DateiID_U", "DateiID_B")
    return materialize(days.join(FI.backfill_dates(t.files, months=24), "as_of", "left_semi"))


def q_depot_features_file_backfill(spark, sf_dir):
    """The backfill by file: every complete day of the 24 months, each with the snapshots of its own file, in one job."""
    t = tables(spark, sf_dir)
    return FE.depot_features_file_days(t, _backfill_file_days(t), FIXTURE_FEATURES, held=rounded)


def q_depot_features_late_files(spark, sf_dir):
    """The same backfill where files deliver some orders days, and a few many months, late."""
    t = tables(spark, sf_dir)
    late = SourceTables(typed_orders(fixture_late_orders(spark, sf_dir)), t.balances, t.positions, t.bookings, t.files)
    return FE.depot_features_file_days(late, _backfill_file_days(t), FIXTURE_FEATURES, held=rounded)


def q_leads_stored(spark, sf_dir):
    """The leads as the daily run makes them: features joined with the stored
    readiness, score and segment tables."""
    base, feats = _daily(spark, sf_dir)
    ready, score, seg = (materialize(x) for x in (RU.invest_readiness(feats), RU.general_score(base), RU.segments(feats)))
    rows = RU.leads(RU.lead_frame(feats, ready, score, seg))
    return rounded(rows.select("Depotnummer", "Score_Datum", "InvestScore", "GeneralScore", "CompositeScore",
                               "Segment", "Next_Action"))


QUERIES = {
    "day_load": q_day_load,
    "depot_features_file_day": q_depot_features_file_day,
    "depot_features_file_days": q_depot_features_file_days,
    "depot_features_file_backfill": q_depot_features_file_backfill,
    "depot_features_late_files": q_depot_features_late_files,
    "leads_stored": q_leads_stored,
    "depot_features": q_depot_features,
    "depot_features_backfill": q_depot_features_backfill,
    "general_score": q_general_score,
    "invest_readiness": q_invest_readiness,
    "alerts": q_alerts,
    "segment_cutoffs": q_segment_cutoffs,
    "segments": q_segments,
    "segment_counts": q_segment_counts,
    "leads": q_leads,
    "lead_report": q_lead_report,
}


# --------------------------------------------------------------------------
# File catalog
# --------------------------------------------------------------------------

def q_file_pick_latest(spark, sf_dir):
    return FI.latest_files(tables(spark, sf_dir).files)


def q_file_pick_checked(spark, sf_dir):
    return FI.latest_files(tables(spark, sf_dir).files, require_checked=True)


def q_asof_dates_complete(spark, sf_dir):
    return FI.backfill_dates(tables(spark, sf_dir).files, months=24)


def q_dates_missing_in_target(spark, sf_dir):
    t = tables(spark, sf_dir)
    # The target already holds the dates of the balance snapshots.
    target = t.balances.select(F.col("Datum").alias("Score_Datum")).distinct()
    return FI.dates_missing_in_target(FI.backfill_dates(t.files, months=24), target)


# --------------------------------------------------------------------------
# Labels
# --------------------------------------------------------------------------

LABEL_START = "1999-08-01"
LABEL_END = CUTOFF


def _label_rows(spark, sf_dir, dates):
    """The depots of each date, by period (``per_day`` gives the rows)."""
    return FE.spine_periods(tables(spark, sf_dir), dates)


def q_investment_events(spark, sf_dir):
    t = tables(spark, sf_dir)
    return LB.investment_events(t.orders, t.bookings)


def q_label_invest(spark, sf_dir):
    t = tables(spark, sf_dir)
    dates = backfill_dates(spark, sf_dir)
    return LB.invest_labels(_label_rows(spark, sf_dir, dates), t.orders, t.bookings, horizons=(7, 14)).per_day("stichtag")


def q_upsert_labels(spark, sf_dir):
    """T7 labels exist for the first year of the backfill; a T14 run over the
    last 18 months is merged in."""
    t = tables(spark, sf_dir)
    dates = backfill_dates(spark, sf_dir)
    first = dates.where(F.col("as_of") < F.lit("2000-08-01").cast("date"))
    last = dates.where(F.col("as_of") >= F.lit("2000-02-01").cast("date"))
    existing = LB.invest_labels(_label_rows(spark, sf_dir, first), t.orders, t.bookings, horizons=(7,)).per_day("stichtag")
    new = LB.invest_labels(_label_rows(spark, sf_dir, last), t.orders, t.bookings, horizons=(14,)).per_day("stichtag")
    return LB.upsert_labels(existing, new)


def q_first_target_buy(spark, sf_dir):
    return LB.first_target_buy(tables(spark, sf_dir).orders, LABEL_START, LABEL_END)


def q_pre_first_target(spark, sf_dir):
    t = tables(spark, sf_dir)
    return LB.pre_first_target(FE.depot_spine(t, CUTOFF), t.orders)


def q_label_first_buy(spark, sf_dir):
    t = tables(spark, sf_dir)
    spine = FE.depot_spine_multi(t, FI.backfill_dates(t.files, months=24))
    rows = (LB.pre_first_target(spine, t.orders)
            .where((F.col("Pre_First_Target") == 1)
                   & F.col("Score_Datum").between(F.lit(LABEL_START).cast("date"), F.lit(LABEL_END).cast("date")))
            .select("Depotnummer", F.col("Score_Datum").alias("Stichtag")))
    return LB.first_buy_labels(rows, LB.first_target_buy(t.orders, LABEL_START, LABEL_END))


QUERIES.update({
    "file_pick_latest": q_file_pick_latest,
    "file_pick_checked": q_file_pick_checked,
    "asof_dates_complete": q_asof_dates_complete,
    "dates_missing_in_target": q_dates_missing_in_target,
    "investment_events": q_investment_events,
    "label_invest": q_label_invest,
    "upsert_labels": q_upsert_labels,
    "first_target_buy": q_first_target_buy,
    "pre_first_target": q_pre_first_target,
    "label_first_buy": q_label_first_buy,
})


# --------------------------------------------------------------------------
# Ranking metrics: the readiness score evaluated against investment labels
# --------------------------------------------------------------------------

_EVAL: dict = {}
_BACKFILL: dict = {}


def _feature_periods(spark, sf_dir):
    """The 24-month backfill by period, checkpointed once per session and directory."""
    key = _key(spark, sf_dir)
    if key not in _BACKFILL:
        p = FE.feature_periods(tables(spark, sf_dir), backfill_dates(spark, sf_dir), FIXTURE_FEATURES)
        _BACKFILL[key] = FE.Periods(materialize(p.rows), p.dates)
    return _BACKFILL[key]


def backfill_features(spark, sf_dir):
    """The 24-month backfill feature table, read from its stored periods."""
    return FE.features_per_day(_feature_periods(spark, sf_dir), FIXTURE_FEATURES)


EVAL_LABELS = tuple(f"label_invest_T{h}" for h in (7, 14, 30))
_LABELLED: dict = {}


def labelled_periods(spark, sf_dir):
    """The backfill features with label_invest_T7/T14/T30 by period, checkpointed once per session and directory."""
    key = _key(spark, sf_dir)
    if key not in _LABELLED:
        t = tables(spark, sf_dir)
        p = LB.invest_labels(_feature_periods(spark, sf_dir), t.orders, t.bookings, horizons=(7, 14, 30))
        _LABELLED[key] = FE.Periods(materialize(p.rows), p.dates)
    return _LABELLED[key]


def labelled_features(spark, sf_dir):
    """The backfill features with their labels, read from their stored periods."""
    return FE.features_per_day(labelled_periods(spark, sf_dir), FIXTURE_FEATURES, *EVAL_LABELS)


def _scored(periods, *more):
    """Feature periods cut where the readiness score changes, with the published columns of their first day and ``InvestScore``."""
    held = FE.held_by_tests(periods, RU.invest_score_bounds(FE.COUNTED_FROM), FIXTURE_FEATURES, *more)
    return FE.Periods(held.rows.withColumn("InvestScore", RU.invest_score_expr()), held.dates)


def eval_periods(spark, sf_dir):
    """(Depotnummer, InvestScore, label_invest_T7/T14/T30) over the 24-month
    backfill by period, checkpointed once per session and directory."""
    key = _key(spark, sf_dir)
    if key not in _EVAL:
        p = _scored(labelled_periods(spark, sf_dir), *EVAL_LABELS).select("Depotnummer", "InvestScore", *EVAL_LABELS)
        _EVAL[key] = FE.Periods(materialize(p.rows), p.dates)
    return _EVAL[key]


def eval_base(spark, sf_dir):
    """The rows of ``eval_periods`` by (Depotnummer, Score_Datum)."""
    return eval_periods(spark, sf_dir).per_day()


def _long(ep, horizons=(7, 14)):
    """The evaluated periods by horizon; ``n_days`` rows of a depot, one after another, stand behind each."""
    eb = ep.weighted()
    parts = [eb.select(F.lit(f"T{h}").alias("horizon"), "Depotnummer", "e", "n_days",
                       F.col("InvestScore").cast("double").alias("score"), F.col(f"label_invest_T{h}").alias("label"))
             for h in horizons]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_average_precision(spark, sf_dir):
    return rounded(ME.average_precision(_long(eval_periods(spark, sf_dir)), "horizon", "score", "label", weight="n_days"))


def q_precision_lift_at_k(spark, sf_dir):
    return rounded(ME.precision_lift_at_k(_long(eval_periods(spark, sf_dir)), "horizon", "score", "label",
                                          ["Depotnummer", "e"], ks=(0.01, 0.03, 0.05, 0.10), weight="n_days"))


def q_eval_horizons(spark, sf_dir):
    return rounded(ME.eval_summary(_long(eval_periods(spark, sf_dir), (7, 14, 30)), "horizon", "score", "label",
                                   ["Depotnummer", "e"], weight="n_days"))


def _calibrated(spark, sf_dir):
    """p_invest_{H}d by period: the observed event rate of depots with the same
    InvestScore (a binned calibration of the rule score)."""
    ep = eval_periods(spark, sf_dir)
    rates = ep.weighted().groupBy("InvestScore").agg(*[
        (F.sum(F.col(f"label_invest_T{h}") * F.col("n_days")) / F.sum("n_days")).alias(f"p_invest_{h}d") for h in (7, 14, 30)])
    return FE.Periods(ep.rows.join(F.broadcast(rates), "InvestScore"), ep.dates)


def q_horizon_monotone(spark, sf_dir):
    cols = ("p_invest_7d", "p_invest_14d", "p_invest_30d")
    cal = _calibrated(spark, sf_dir)
    lifted = ME.monotone_horizons(cal.rows, cols).select("Depotnummer", "e", "until", *cols)
    return FE.Periods(rounded(lifted), cal.dates).per_day()


def _ranked(spark, sf_dir):
    """The prediction rows of every date: rounded probability, score and rank within the date."""
    cal = _calibrated(spark, sf_dir).select("Depotnummer", "p_invest_7d", F.round("p_invest_7d", 6).alias("p_invest"))
    r = ME.rank_in_run(cal, "Score_Datum", "p_invest_7d")
    return r.select(F.col("Score_Datum").alias("run_date"), "Depotnummer", "p_invest", "score", "rank_in_run")


def q_rank_in_run(spark, sf_dir):
    return _ranked(spark, sf_dir)


QUERIES.update({
    "average_precision": q_average_precision,
    "precision_lift_at_k": q_precision_lift_at_k,
    "eval_horizons": q_eval_horizons,
    "horizon_monotone": q_horizon_monotone,
    "rank_in_run": q_rank_in_run,
})


# --------------------------------------------------------------------------
# Data quality
# --------------------------------------------------------------------------

def q_qc_ranges(spark, sf_dir):
    return QC.range_checks(_feature_periods(spark, sf_dir), FIXTURE_FEATURES)


def q_qc_drift(spark, sf_dir):
    p = _scored(_feature_periods(spark, sf_dir)).select("Depotnummer", "ØOrdervolumen_90d", "Cashquote_true", "InvestScore")
    return rounded(QC.drift(FE.Periods(materialize(p.rows), p.dates)))


def q_qc_lead_coverage(spark, sf_dir):
    _, feats = _daily(spark, sf_dir)
    return rounded(QC.lead_coverage(feats, _lead_rows(spark, sf_dir)))


def q_qc_daily_monitor(spark, sf_dir):
    return rounded(QC.daily_label_monitor(q_label_first_buy(spark, sf_dir)))


VALIDATION_DAYS = ("2001-07-31", CUTOFF)


def q_validation_log(spark, sf_dir):
    """Validation rows of two consecutive days from the day's own tables."""
    t = tables(spark, sf_dir)
    dates = spark.range(1).select(F.explode(F.array(*[F.lit(d).cast("date") for d in VALIDATION_DAYS])).alias("as_of"))
    base = materialize(FE.feature_base_multi(t, dates, FIXTURE_FEATURES))
    feats = materialize(FE.finish_features(base, FIXTURE_FEATURES))
    ready, score, seg = (materialize(x) for x in (RU.invest_readiness(feats), RU.general_score(base), RU.segments(feats)))
    lead_rows = materialize(RU.leads(RU.lead_frame(feats, ready, score, seg)))
    return rounded(QC.validation_log(feats, ready, score, seg, lead_rows))


MONITORED = ("Einzahlung_30d", "Cashquote_true", "Depotwert", "HHI_Concentration", "InvestScore")


def q_qc_table_monitor(spark, sf_dir):
    """Daily monitor of features and of the readiness score."""
    return rounded(QC.daily_table_monitor(_scored(_feature_periods(spark, sf_dir)), MONITORED), places=4)


def q_flow_reconcile(spark, sf_dir):
    t = tables(spark, sf_dir)
    _, feats = _daily(spark, sf_dir)
    # The cash ratio over an empty portfolio is cash / 1e-6 (~1e9): those two
    # columns stay unrounded (they are computed by identical operations).
    return rounded(QC.flow_reconcile(feats, t.bookings, t.balances, t.positions, CUTOFF), places=4,
                   keep=("cashquote_sql", "Δ_cashquote"))


def q_feature_audit(spark, sf_dir):
    _, feats = _daily(spark, sf_dir)
    return rounded(QC.feature_audit(feats), four=("mean", "std"))


CORRELATED = ("Orderfrequenz", "Orderfrequenz_90d", "Depotwert", "Bestandwert", "Cash_abs", "Pos_Count", "Einzahlung_90d", "Sparplan_Klein")


def q_feature_correlations(spark, sf_dir):
    _, feats = _daily(spark, sf_dir)
    return rounded(QC.feature_correlations(feats, CORRELATED))


def _localized_customers(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    # Balances as German-formatted text ("1.234,56") next to a text column.
    return c.select("c_custkey", F.translate(F.format_number("c_acctbal", 2), ",.", ".,").alias("acctbal_text"),
                    F.col("c_name"))


def q_localized_numbers(spark, sf_dir):
    from depotlens.functions.columns import parse_localized_number
    c = _localized_customers(spark, sf_dir)
    return c.select("c_custkey", "acctbal_text", parse_localized_number("acctbal_text").alias("acctbal"),
                    parse_localized_number("c_name").alias("name_as_number"))


def q_numeric_column_coverage(spark, sf_dir):
    return rounded(QC.localized_numbers(_localized_customers(spark, sf_dir), ["acctbal_text", "c_name"]))


QUERIES.update({
    "qc_ranges": q_qc_ranges,
    "qc_drift": q_qc_drift,
    "qc_lead_coverage": q_qc_lead_coverage,
    "qc_daily_monitor": q_qc_daily_monitor,
    "validation_log": q_validation_log,
    "qc_table_monitor": q_qc_table_monitor,
    "flow_reconcile": q_flow_reconcile,
    "feature_audit": q_feature_audit,
    "feature_correlations": q_feature_correlations,
    "localized_numbers": q_localized_numbers,
    "numeric_column_coverage": q_numeric_column_coverage,
})


# --------------------------------------------------------------------------
# Models: time split, class weights, calibrated boosted trees
# --------------------------------------------------------------------------

TRAIN_START = "1999-08-01"
TRAIN_END = "2001-02-01"
TEST_END = CUTOFF


def _split_frame(spark, sf_dir):
    """Rows and positives by date, score and labels (``n`` equal rows each), split by time."""
    eb = eval_periods(spark, sf_dir).sums_per_day(["InvestScore", *EVAL_LABELS], {})
    train = ML.time_split(eb.where(F.col("Score_Datum") <= F.lit(TRAIN_END).cast("date")), TRAIN_END, weight="n")
    test = eb.where(F.col("Score_Datum") > F.lit(TRAIN_END).cast("date")).withColumn("split", F.lit("test"))
    return train.unionByName(test)


def q_model_time_split(spark, sf_dir):
    s = _split_frame(spark, sf_dir)
    return s.groupBy("split").agg(F.sum("n").alias("n"),
                                  F.sum(F.col("label_invest_T7") * F.col("n")).cast("bigint").alias("positives_T7"),
                                  F.min("Score_Datum").alias("first_date"), F.max("Score_Datum").alias("last_date"))


def q_class_weights(spark, sf_dir):
    s = materialize(_split_frame(spark, sf_dir).where(F.col("split") == "train"))
    parts = [ML.class_weights(s, f"label_invest_T{h}", weight="n").withColumn("horizon", F.lit(f"T{h}")) for h in (7, 14, 30)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out.select("horizon", "pos", "neg", "scale_pos_weight"))


FRAME_START, FRAME_END = "2001-06-01", "2001-07-31"


def _localized(c):
    return F.translate(F.format_number(c, 2), ",.", ".,")


def _training_rows(periods, places):
    """The rows of typed periods: rounded once per period, ``days_since_last_buy`` once per row."""
    return ML.days_since(FE.Periods(rounded(periods.rows, places), periods.dates).per_day())


def q_training_frame(spark, sf_dir):
    """Features with labels over two months, typed: one named and one free
    column arrive as localised text, another column stays text."""
    feats = _feature_periods(spark, sf_dir).select(
        "Depotnummer", "Letzter_Kauf", "TechAffin", _localized("Depotwert").alias("Depotwert"),
        _localized("Cash_abs").alias("Cash_text"), F.concat(F.lit("Gruppe "), "Depotnummer").alias("Gruppe"))
    frame = ML.training_frame(feats, eval_periods(spark, sf_dir), "label_invest_T7", FRAME_START, FRAME_END)
    return _training_rows(ML.typed_frame(frame, named=("Depotwert", "TechAffin")), 2)


def q_training_frame_backfill(spark, sf_dir):
    """All features with labels over the whole backfill, typed: two named amounts and a free one arrive as localised text."""
    p = _feature_periods(spark, sf_dir)
    feats = FE.Periods(p.rows.withColumns({c: _localized(c) for c in ("Depotwert", "Bestandwert", "Cash_abs")})
                       .withColumn("Gruppe", F.concat(F.lit("Gruppe "), "Depotnummer")), p.dates)
    frame = ML.training_frame(feats, eval_periods(spark, sf_dir), "label_invest_T7", LABEL_START, LABEL_END)
    counted = FE.dated_columns(FIXTURE_FEATURES)  # whole days: numbers, typed as DOUBLE below
    columns = [c for c in FE.FEATURE_COLUMNS if c not in ("Depotnummer", "Score_Datum", "Letzter_Kauf")]
    typed = ML.typed_frame(frame, named=[c for c in columns if c != "Cash_abs" and c not in counted])
    rows = _training_rows(typed, 6)
    own = [counted[c].cast("double").alias(c) if c in counted else F.col(c) for c in FE.FEATURE_COLUMNS]
    return rows.select("Depotnummer", "Score_Datum", *[c for c, n in zip(own, FE.FEATURE_COLUMNS) if n not in ("Depotnummer", "Score_Datum")],
                       "Gruppe", "label_invest_T7", "days_since_last_buy")


_MODELS: dict = {}
MODEL = BoostParams(trees=60, step=0.15)  # the library's default is 400 trees of step 0.05; each tree is four passes over the rows


def dealt(periods, rows_per_task: int = 1_000_000):
    """The periods in as many tasks, by depot and in order, as their rows need that are laid out or scored."""
    tasks = max(1, -(-(periods.weighted().agg(F.sum("n_days")).first()[0] or 0) // rows_per_task))
    return FE.Periods(periods.rows.repartition(tasks, "Depotnummer").sortWithinPartitions("Depotnummer", "e"), periods.dates)


def split_periods(periods, split):
    """The periods by part of a time split (rows of Score_Datum and ``split``): a split is a matter of the date."""
    days = materialize(split.select(F.col("Score_Datum").alias("as_of"), "split").distinct().coalesce(1))
    return {part: FE.Periods(periods.rows, days.where(F.col("split") == part).select("as_of")) for part in ("train", "calib", "test")}


def invest_model(spark, sf_dir):
    """The calibrated T7 model, and the periods of the test days."""
    key = _key(spark, sf_dir)
    if key not in _MODELS:
        periods = dealt(labelled_periods(spark, sf_dir))
        parts = split_periods(periods, _split_frame(spark, sf_dir))
        cols = ML.numeric_feature_columns(FE.features_per_day(periods, FIXTURE_FEATURES), "label_invest_T7")
        bundle = ML.fit_calibrated(parts["train"], parts["calib"], cols, "label_invest_T7", MODEL, FIXTURE_FEATURES)
        _MODELS[key] = (bundle, parts["test"])
    return _MODELS[key]


def q_train_score_invest(spark, sf_dir):
    bundle, test = invest_model(spark, sf_dir)
    scored = ML.score_periods(bundle, test, "p_invest", FIXTURE_FEATURES).per_day()
    return scored.select("Depotnummer", "Score_Datum", "p_invest", "label_invest_T7")


def q_feature_importance(spark, sf_dir):
    bundle, _ = invest_model(spark, sf_dir)
    return ML.feature_importances(spark, bundle)


def q_upsert_predictions(spark, sf_dir):
    """Predictions of a first run (dates up to 2001-05-01) merged with a second
    run over 2001-04-01 onwards: the second run's rows replace equal keys."""
    from depotlens.sinks.tables import merged_keep_new
    run = _ranked(spark, sf_dir)
    first = run.where(F.col("run_date") <= F.lit("2001-05-01").cast("date")).withColumn("model_version", F.lit("v1"))
    second = run.where(F.col("run_date") >= F.lit("2001-04-01").cast("date")).withColumn("model_version", F.lit("v2"))
    return merged_keep_new(first, second, ["run_date", "Depotnummer"], "run_date")


QUERIES.update({
    "training_frame": q_training_frame,
    "training_frame_backfill": q_training_frame_backfill,
    "model_time_split": q_model_time_split,
    "class_weights": q_class_weights,
    "train_score_invest": q_train_score_invest,
    "feature_importance": q_feature_importance,
    "upsert_predictions": q_upsert_predictions,
})


def q_first_buy_features(spark, sf_dir):
    t = tables(spark, sf_dir)
    _, feats = _daily(spark, sf_dir)
    return rounded(LB.first_buy_features(feats, t.orders, CUTOFF), keep=("Avg_Ticket_90d",))


def q_first_buy_features_backfill(spark, sf_dir):
    t = tables(spark, sf_dir)
    return LB.first_buy_features(_feature_periods(spark, sf_dir), t.orders, held=lambda rows: rounded(rows, keep=("Avg_Ticket_90d",)))


QUERIES["first_buy_features"] = q_first_buy_features
QUERIES["first_buy_features_backfill"] = q_first_buy_features_backfill


# --------------------------------------------------------------------------
# Building blocks of the feature table, one query each
# --------------------------------------------------------------------------

def q_depot_spine(spark, sf_dir):
    return FE.depot_spine(tables(spark, sf_dir), CUTOFF)


def q_balance_last_snapshot(spark, sf_dir):
    from depotlens.operators.balances import balance_base_at
    return rounded(balance_base_at(tables(spark, sf_dir).balances, F.lit(CUTOFF).cast("date")))


def q_position_last_snapshot(spark, sf_dir):
    from depotlens.operators import positions as POS
    t = tables(spark, sf_dir)
    snap = POS.position_base_at(POS.position_snapshots(t.positions, FIXTURE_FEATURES.vocab),
                                F.lit(CUTOFF).cast("date"))
    return rounded(snap)


def q_booking_classes(spark, sf_dir):
    from depotlens.operators.bookings import classified
    b = classified(tables(spark, sf_dir).bookings, FIXTURE_FEATURES.vocab)
    return b.groupBy("Buchungtyp", "klasse", "internal").agg(F.count(F.lit(1)).alias("n"),
                                                              F.round(F.sum("Betrag"), 4).alias("amount"))


QUERIES.update({
    "depot_spine": q_depot_spine,
    "balance_last_snapshot": q_balance_last_snapshot,
    "position_last_snapshot": q_position_last_snapshot,
    "booking_classes": q_booking_classes,
})
