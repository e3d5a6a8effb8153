"""What is measured over periods equals what is measured over their rows, one per depot and date."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.operators import features as FE
from depotlens.operators import labels as LB
from depotlens.operators import metrics as ME
from depotlens.operators import quality as QC
from depotlens.operators import rules as RU
from depotlens.operators.ranking import ranks_per_day
from depotlens.plans import ml as ML
from depotlens.session import materialize
from depotlens.sinks.tables import merged_keep_new, write_clustered
from tests.helpers import booking, d, make_tables, order, position

FP = P.FeatureParams()
LABELS = ("label_invest_T7", "label_invest_T14")


@pytest.fixture(scope="module")
def labelled(spark):
    """A few depots over 70 days with two gaps in the calendar; some values are missing, some lie outside their range."""
    t = make_tables(
        spark, orders=[order("1", "2025-01-10"), order("1", "2025-02-20", cf=-2500.0), order("2", "2024-12-30", "Verkauf"), order("4", "2025-03-01")],
        balances=[("2", "2025-01-05", 2000.0), ("3", "2025-02-01", -50.0), ("1", "2025-01-01", 900.0)],
        positions=[position("1", "2025-01-20", "a", value=100.0, cost=300.0), position("3", "2025-02-01", "b", value=10.0)],
        bookings=[booking("1", "2025-01-15", 600.0), booking("2", "2025-02-10", 5000.0), booking("3", "2025-02-20", 80.0, "Entnahme")])
    days = [x for x in (d("2025-01-01") + dt.timedelta(i) for i in range(70)) if x.day not in (12, 13)]
    dates = spark.createDataFrame([(x,) for x in days], "as_of date")
    p = LB.invest_labels(FE.feature_periods(t, dates, FP), t.orders, t.bookings, horizons=(7, 14))
    return FE.Periods(materialize(p.rows), dates)


@pytest.fixture(scope="module")
def scored(labelled):
    held = FE.held_by_tests(labelled, RU.invest_score_bounds(FE.COUNTED_FROM), FP, *LABELS)
    return FE.Periods(materialize(held.rows.withColumn("InvestScore", RU.invest_score_expr())), held.dates)


def daily(periods):
    return FE.features_per_day(periods, FP, *LABELS).withColumn("InvestScore", RU.invest_score_expr())


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_scores_are_held_by_period(labelled, scored):
    columns = ["Depotnummer", "InvestScore", *LABELS]
    got = scored.select(*columns)
    assert got.rows.count() < daily(labelled).count() / 3  # the old form had a row per depot and date
    assert rows(got.per_day()) == rows(daily(labelled).select("Score_Datum", *columns))
    assert scored.weighted().agg(F.sum("n_days")).first()[0] == daily(labelled).count()
    assert len({r[0] for r in got.rows.select("InvestScore").distinct().collect()}) > 3


def test_checks_by_period(labelled, scored):
    old = daily(labelled)
    assert rows(QC.range_checks(labelled, FP)) == rows(QC.range_checks(old))
    wanted = ("ØOrdervolumen_90d", "Cashquote_true", "InvestScore")
    assert rows(QC.drift(scored.select("Depotnummer", *wanted))) == rows(QC.drift(materialize(old.select("Depotnummer", "Score_Datum", *wanted))))
    columns = ("Einzahlung_30d", "Depotwert", "HHI_Concentration", "InvestScore")  # the third has NULLs
    assert rows(QC.daily_table_monitor(scored, columns)) == rows(QC.daily_table_monitor(old, columns))


def test_metrics_by_period(labelled, scored):
    def long(df, key):
        return df.select(F.lit("x").alias("h"), "Depotnummer", key, F.col("InvestScore").cast("double").alias("score"),
                         F.col("label_invest_T7").alias("label"), *[c for c in ("n_days",) if c in df.columns])

    new, old = long(scored.weighted(), "e"), long(daily(labelled), "Score_Datum")
    for k in (0.01, 0.13, 0.4):
        assert rows(ME.precision_lift_at_k(new, "h", "score", "label", ["Depotnummer", "e"], (k,), weight="n_days")) == \
            rows(ME.precision_lift_at_k(old, "h", "score", "label", ["Depotnummer", "Score_Datum"], (k,)))
    assert rows(ME.eval_summary(new, "h", "score", "label", ["Depotnummer", "e"], weight="n_days")) == \
        rows(ME.eval_summary(old, "h", "score", "label", ["Depotnummer", "Score_Datum"]))
    counts = scored.sums_per_day(["InvestScore", *LABELS], {})
    split = [ML.time_split(x, "2025-02-20", 10, weight=w) for x, w in ((counts, "n"), (daily(labelled), None))]
    assert rows(split[0].groupBy("split").agg(F.sum("n").alias("n"))) == rows(split[1].groupBy("split").agg(F.count("*").alias("n")))
    assert rows(ML.class_weights(counts, LABELS[0], weight="n")) == rows(ML.class_weights(daily(labelled), LABELS[0]))


def test_ranks_by_period(labelled, scored):
    p = scored.select("Depotnummer", "InvestScore")
    old = ME.rank_in_run(daily(labelled).select("Depotnummer", "Score_Datum", (F.col("InvestScore") / 20).alias("p")), "Score_Datum", "p")
    shares = FE.Periods(p.rows.select("Depotnummer", "e", "until", (F.col("InvestScore") / 20).alias("p")), p.dates)
    assert rows(ME.rank_in_run(shares, "Score_Datum", "p")) == rows(old)
    assert rows(ranks_per_day(shares, "Score_Datum", "p", "Depotnummer", slice_periods=5).select("Score_Datum", "Depotnummer", "rn")) == \
        rows(old.select("Score_Datum", "Depotnummer", F.col("rank_in_run").alias("rn")))


def test_keep_new_with_dates(spark):
    old = spark.createDataFrame([(d("2025-01-01"), "1", "a"), (d("2025-01-02"), "1", "a"), (None, "1", "a"), (d("2025-01-02"), None, "a")], "day date, k string, v string")
    new = spark.createDataFrame([(d("2025-01-02"), "1", "b"), (d("2025-01-04"), "1", "b")], "day date, k string, v string")
    for part in (new, new.limit(0)):
        assert rows(merged_keep_new(old, part, ["day", "k"], "day")) == rows(merged_keep_new(old, part, ["day", "k"]))


def test_training_frame_by_period(labelled):
    def text(df):
        return df.withColumn("Cash_text", F.format_number("Cash_abs", 2)).withColumn("Gruppe", F.concat(F.lit("G"), "Depotnummer"))

    names = ("Letzter_Kauf", "Cash_text", "Gruppe", "Depotwert")
    held = FE.Periods(text(labelled.rows), labelled.dates).select("Depotnummer", *names)
    frame = ML.training_frame(held, labelled.select("Depotnummer", LABELS[0]), LABELS[0], "2025-01-20", "2025-03-01")
    typed = ML.typed_frame(frame)
    assert dict(typed.rows.dtypes)["Cash_text"] == "double" and dict(typed.rows.dtypes)["Gruppe"] == "string"
    old = text(daily(labelled))
    whole = ML.typed_frame(ML.training_frame(old.select("Depotnummer", "Score_Datum", *names), old.select("Depotnummer", F.col("Score_Datum").alias("stichtag"), LABELS[0]),
                                             LABELS[0], "2025-01-20", "2025-03-01"))
    assert rows(ML.days_since(typed.per_day())) == rows(whole)


def test_first_buy_features_by_period(spark, labelled):
    fb = P.FirstBuyParams(isin="T")
    t = make_tables(spark, orders=[order("1", "2025-01-10", cf=-1500.0, isin="T", tx="a"), order("1", "2025-01-30", cf=-1200.0, isin="U"), order("3", "2025-02-12", isin="T"),
                                   order("2", "2024-12-30", cf=-4000.0, isin="T", tx="b"), order("2", "2025-01-25", "Verkauf", tx="b", remark="Storno")])
    new, old = (LB.first_buy_features(x, t.orders, fb=fb) for x in (labelled, daily(labelled)))
    assert new.columns == old.columns and new.dtypes == old.dtypes
    assert rows(new) == rows(old)


def test_clustered_files_of_periods(spark, labelled, tmp_path):
    path = str(tmp_path / "clustered")
    write_clustered(labelled, path, ["Depotnummer", "Score_Datum"], rows_per_file=40, laid_out=lambda p: FE.features_per_day(p, FP))
    stored = spark.read.parquet(path)
    assert rows(stored) == rows(FE.features_per_day(labelled, FP))
    spans = sorted(tuple(r) for r in stored.groupBy(F.input_file_name()).agg(F.min(F.struct("Depotnummer", "Score_Datum")), F.max(F.struct("Depotnummer", "Score_Datum")))
                   .select("min(struct(Depotnummer, Score_Datum))", "max(struct(Depotnummer, Score_Datum))").collect())
    assert len(spans) > 3 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_correlations_by_period(labelled):
    columns = ["Last_Buy_Days", "Depotwert", "Streak_Inactive_Months", "ZeroPos", "HHI_Concentration", "Last_Cashflow_Days"]
    new, old = QC.correlation_matrix(labelled, columns, fp=FP), QC.correlation_matrix(daily(labelled), columns)
    assert rows(new) == rows(old)
    assert any(r["correlation"] is None for r in new.collect()) and any(r["correlation"] is not None for r in new.collect())
