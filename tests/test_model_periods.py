"""Models trained on and applied to periods against the same on a row per day; tables laid out by date."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.operators import features as FE
from depotlens.operators import labels as LB
from depotlens.operators import positions as POS
from depotlens.operators import state as ST
from depotlens.operators.timeline import Periods, _add_and_expire
from depotlens.plans import ml as ML
from depotlens.plans.boosting import BoostParams, bin_borders, fit_boosted
from depotlens.sinks.tables import replace_dates, stored_dates
from depotlens.sources.fixture import fixture_positions
from tests.helpers import make_tables, order, position

FP = P.FeatureParams()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    orders = [order(str(k % 12), f"2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d}", rng.choice(["Ankauf", "Verkauf"]), -float(rng.randrange(50, 4000)))
              for k in range(90)]
    balances = [(str(k), "2024-03-01", float(100 * k)) for k in range(0, 12, 2)]
    t = make_tables(spark, orders, balances, [position("3", "2024-02-01", "A")], [])
    dates = spark.sql("select explode(sequence(date'2024-04-01', date'2024-09-30')) as as_of")
    p = LB.invest_labels(FE.feature_periods(t, dates, FP), t.orders, t.bookings, horizons=(7,))
    return Periods(p.rows.cache(), dates.cache())


def test_rows_that_stand_for_several(spark):
    rng = np.random.default_rng(3)
    rows = [(float(rng.integers(6)), float(rng.normal()), int(rng.integers(2)), int(rng.integers(1, 5))) for _ in range(80)]
    once = spark.createDataFrame(rows, "a double, b double, y int, n long")
    each = once.select("a", "b", "y", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i"))
    p = BoostParams(trees=5, max_depth=3, step=0.3, row_share=1.0)
    borders = bin_borders(each, ["a", "b"], p.bins)
    x = np.array([r[:2] for r in rows]).T
    one, many = fit_boosted(once, ["a", "b"], "y", p=p, times="n", borders=borders), fit_boosted(each, ["a", "b"], "y", p=p)
    assert np.array_equal(one.margins(x), many.margins(x)) and one.trees[0].column[0] >= 0
    part = BoostParams(trees=5, max_depth=3, step=0.3, row_share=0.5)  # a share of each row's own number
    assert 0.3 < fit_boosted(once, ["a", "b"], "y", p=part, times="n", borders=borders).trees[0].cover[0] / one.trees[0].cover[0] < 0.7


def test_a_model_of_periods_is_that_of_their_days(spark, labelled):
    columns = ML.numeric_feature_columns(FE.features_per_day(labelled, FP), "label_invest_T7")
    p = BoostParams(trees=6, max_depth=3, step=0.3, bins=16, row_share=1.0)
    parts = labelled.between("2024-04-01", "2024-07-31"), labelled.between("2024-08-01", "2024-09-30")
    days = [FE.features_per_day(x, FP, "label_invest_T7") for x in parts]
    one = ML.fit_calibrated(*parts, columns, "label_invest_T7", p, FP)
    many = ML.fit_calibrated(*days, columns, "label_invest_T7", p)
    assert any(set(t.column.tolist()) & {columns.index(c) for c in ("Last_Trade_Days", "Last_Buy_Days")} for t in one.pipeline.trees)
    for a, b in zip(one.pipeline.trees, many.pipeline.trees, strict=True):
        assert np.array_equal(a.column, b.column) and np.array_equal(a.border, b.border) and np.allclose(a.value, b.value)

    def found(df):
        return {(r[0], r[1]): (pytest.approx(r[2], abs=1e-9), r[3]) for r in df.select("Depotnummer", "Score_Datum", "p", "label_invest_T7").collect()}

    got = ML.score_periods(one, parts[1], "p", FP)
    want = {(r[0], r[1]): (r[2], r[3]) for r in ML.score(many, days[1], "p").select("Depotnummer", "Score_Datum", "p", "label_invest_T7").collect()}
    assert found(got.per_day()) == want and len(want) > 500
    assert got.weighted().count() < len(want) / 2  # far fewer rows than days


def test_rows_by_date_are_those_by_key(spark, labelled):
    p = labelled.select("Depotnummer", "label_invest_T7")
    for kind in ({}, {"run_days": 3, "rows_per_task": 10}):
        by_date = p.per_day_by_date(**kind)
        assert by_date.columns == p.per_day().columns
        assert sorted(by_date.collect()) == sorted(p.per_day().collect())
    tasks = p.per_day_by_date(run_days=5).select("Score_Datum", F.spark_partition_id().alias("t")).distinct().groupBy("Score_Datum").count()
    assert tasks.agg(F.max("count")).first()[0] == 1
    assert p.between("2030-01-01", "2030-01-02").per_day_by_date().count() == 0


def test_dates_are_written_without_sorting(spark, labelled, tmp_path):
    path = str(tmp_path / "by_date")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    replace_dates(labelled.select("Depotnummer").per_day_by_date(), path, "Score_Datum")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert len(stored_dates(spark, path, "Score_Datum")) == 183 and stored_dates(spark, path + "x", "Score_Datum") == []
    assert spark.read.parquet(path).count() == labelled.per_day().count()


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_only_depots_with_new_rows_are_combined(spark):
    t = make_tables(spark, [order("1", "2025-01-02"), order("2", "2025-01-03"), order("3", "2024-01-03")], [("1", "2025-01-02", 5.0)], [], [])
    state = ST.advance(None, ST.rows_since(t, None, "2025-01-02"), "2025-01-02", FP)
    moved = ST.advance(state, ST.rows_since(t, "2025-01-02", "2025-01-03"), "2025-01-03", FP)
    assert "LeftAnti" in plan(moved, "optimizedPlan")
    whole = ST.advance(None, ST.rows_since(t, None, "2025-01-03"), "2025-01-03", FP)
    key = lambda df: sorted((r.asDict(True) for r in df.collect()), key=lambda r: r["Depotnummer"])
    assert key(moved) == key(whole)


def test_positions_are_shuffled_once(spark):
    t = make_tables(spark, [], [], [position("3", "2024-02-01", "A"), position("3", "2024-02-01", "A", value=50.0), position("3", "2024-02-01", None)], [])
    snaps = POS.position_snapshots(t.positions, FP.vocab)
    assert plan(snaps).count("Exchange hashpartitioning") == 1
    row = snaps.first()
    assert (row["p_cnt"], row["p_sum"], row["p_hhi"]) == (3, 2_500_000, 1.0)


def test_lines_are_narrow_before_they_are_joined(spark, tmp_path):
    day = "timestamp'1999-05-06 00:00:00'"
    for name, query in (("lineitem", f"select 1L l_orderkey, 7L l_partkey, n l_linenumber, 2D l_quantity, 100D l_extendedprice, 0.1D l_discount, f l_returnflag, 'F' l_linestatus, {day} l_shipdate "
                                     "from values (1, 'A'), (6, 'R'), (7, 'N') as v(n, f)"),
                        ("orders", "select 1L o_orderkey, 5L o_custkey"), ("part", "select 7L p_partkey, 'hot gear' p_name, 'PROMO' p_type, 3D p_retailprice")):
        spark.sql(query).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = fixture_positions(spark, str(tmp_path))
    tree = plan(got, "optimizedPlan")
    assert tree.index("Join Inner") < tree.index("CASE WHEN ((l_returnflag")
    rows = sorted((str(r["Wertpapierreferenz"]), str(r["Datum"]), r["Kurswert"], r["Einstandswerte"], r["Datei_ID"], r["Depotreferenz"]) for r in got.collect())
    assert rows == sorted([("7", "1999-01-01", 90.0, 12.0, 199901012, "5"), ("7", "1999-01-01", 0.0, 0.0, 199901012, "5"), ("None", "1999-01-01", 90.0, 12.0, 199901012, "5")])


def test_what_has_expired_by_the_first_date_has_no_rows(spark):
    spans = spark.createDataFrame([("1", 10, 20), ("1", 10, 21), ("2", None, 30)], "Depotnummer string, lo int, hi int")
    assert [r.collect() for r in _add_and_expire(spans, "lo", "hi", "c", F.lit(20))] == [[("1", 10, 1)], [("1", 21, -1)]]
    orders = [order("1", f"2024-{m:02d}-10") for m in range(1, 8)]
    t = make_tables(spark, orders, [], [], [])
    late = spark.sql("select date'2024-08-05' as as_of")
    assert FE.depot_features_multi(t, late, FP).collect() == FE.depot_features(t, "2024-08-05", FP).collect()
