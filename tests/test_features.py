"""Feature edge cases (single-date plan and multi-date window plan must agree)."""

import pytest
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.operators import features as FE
from tests.helpers import booking, d, make_tables, one, order, position

AS_OF = "2025-08-31"


def both(spark, t, as_of=AS_OF, fp=None):
    single = FE.depot_features(t, as_of, fp)
    dates = spark.createDataFrame([(d(as_of),)], "as_of date")
    multi = FE.depot_features_multi(t, dates, fp)
    return single, multi


def rows_by_key(df):
    return {r["Depotnummer"]: r.asDict() for r in df.collect()}


def assert_same(single, multi):
    a, b = rows_by_key(single), rows_by_key(multi)
    assert a.keys() == b.keys()
    for k in a:
        for c, v in a[k].items():
            w = b[k][c]
            if isinstance(v, float) and w is not None:
                assert v == pytest.approx(w, rel=1e-9, abs=1e-9), (k, c, v, w)
            else:
                assert v == w, (k, c, v, w)


def test_balance_only_depot(spark):  # E1
    t = make_tables(spark, balances=[("1", "2025-08-01", 500.0)])
    s, m = both(spark, t)
    assert_same(s, m)
    r = one(s)
    assert r["Cashquote_true"] == 0.0 and r["Depotwert"] == 500.0 and r["HHI_Concentration"] is None
    assert r["Last_Buy_Days"] == 0 and r["Streak_Inactive_Months"] == 13
    strict = FE.depot_features(t, AS_OF, P.FeatureParams(never_days=9999))
    assert one(strict)["Last_Buy_Days"] == 9999


def test_positions_only_depot(spark):  # E2
    t = make_tables(spark, positions=[position("1", "2025-08-01", "A", value=100.0)])
    r = one(FE.depot_features(t, AS_OF))
    assert r["Cash_abs"] == 0.0 and r["Cashquote"] == 0.0 and r["Cash_over_bestand"] is None


def test_window_bounds(spark):  # E3, E4
    t = make_tables(spark, orders=[
        order("1", "2025-08-01"),   # as_of - 30: counted in 30 d
        order("2", "2025-07-31"),   # as_of - 31: not counted
        order("3", "2025-08-31"),   # on as_of: counted
        order("3", "2025-09-01"),   # after as_of: ignored
    ])
    s, m = both(spark, t)
    assert_same(s, m)
    r = rows_by_key(s)
    assert r["1"]["Orderfrequenz_30d"] == 1
    assert r["2"]["Orderfrequenz_30d"] == 0 and r["2"]["Orderfrequenz_90d"] == 1
    assert r["3"]["Orderfrequenz_30d"] == 1 and r["3"]["Last_Trade_Days"] == 0


def test_six_month_bound_month_end(spark):  # E5
    t = make_tables(spark, orders=[order("1", "2025-02-28"), order("2", "2025-02-27")])
    s, m = both(spark, t)
    assert_same(s, m)
    r = rows_by_key(s)
    assert r["1"]["Activity_Months_6m"] == 1 and r["2"]["Activity_Months_6m"] == 0


@pytest.mark.parametrize("last,streak", [("2024-08-15", 12), ("2024-07-15", 13), ("2023-12-15", 13)])
def test_streak(spark, last, streak):  # E6
    t = make_tables(spark, orders=[order("1", last)])
    s, m = both(spark, t)
    assert_same(s, m)
    assert one(s)["Streak_Inactive_Months"] == streak


def test_winloss_only_winners_and_mixed(spark):  # E7, E8, E9
    t = make_tables(spark, positions=[
        position("1", "2025-08-01", "A", value=200.0, cost=100.0),
        position("2", "2025-08-01", "A", value=300.0, cost=100.0),
        position("2", "2025-08-01", "B", value=100.0, cost=400.0),
    ])
    s, m = both(spark, t)
    assert_same(s, m)
    r = rows_by_key(s)
    assert r["1"]["WinLoss_Skew"] == 0.0
    assert r["2"]["WinLoss_Skew"] == pytest.approx(0.5)
    assert r["2"]["HHI_Concentration"] == pytest.approx(0.625)
    assert r["2"]["DeepLossShare_50"] == pytest.approx(0.25)


def test_worthless(spark):  # E10
    t = make_tables(spark, positions=[position("1", "2025-08-01", "A", value=0.0)])
    r = one(FE.depot_features(t, AS_OF))
    assert r["Wertlos_Flag"] == 1 and r["ZeroPos"] == 1 and r["Cashquote"] == 0.0


def test_saving_plan_and_internal(spark):  # E11, E12, E15
    t = make_tables(spark, orders=[order("1", "2025-01-01"), order("2", "2025-01-01"), order("3", "2025-01-01")],
                    bookings=[
                        booking("1", "2025-06-03", 100.0), booking("1", "2025-07-03", 100.0),
                        booking("1", "2025-08-03", 100.0),
                        booking("2", "2025-08-20", 5000.0, remark="Interne Umbuchung"),
                        booking("3", "2025-08-20", 700.0, remark="DEPOTÜBERTRAG"),
                    ])
    s, m = both(spark, t)
    assert_same(s, m)
    r = rows_by_key(s)
    assert r["1"]["Sparplan_Klein"] == 1 and r["1"]["Einzahlung_30d_eff"] == 0.0
    assert r["1"]["Einzahlung_30d"] == pytest.approx(100.0)
    assert r["2"]["Einzahlung_30d"] == 0.0 and r["2"]["Last_Cashflow_Days"] == 11
    assert r["3"]["Einzahlung_30d"] == 0.0
    assert r["3"]["Sparplan_Strength_6m"] == 1  # strength counts every booking


def test_flow_classes_and_volatility(spark):  # E14, E16
    t = make_tables(spark, orders=[order("1", "2025-01-01"), order("2", "2025-01-01")], bookings=[
        booking("1", "2025-08-10", 50.0, typ="Übertrag"),  # "ertrag" inside -> yield_in, not a deposit
        booking("2", "2025-08-10", 300.0), booking("2", "2025-08-12", 200.0),
    ])
    s, m = both(spark, t)
    assert_same(s, m)
    r = rows_by_key(s)
    assert r["1"]["Einzahlung_30d"] == 0.0 and r["1"]["Auszahlung_30d"] == 0.0
    assert r["2"]["Deposit_Volatility_6m"] == 0.0  # one month only


def test_snapshots_latest_only(spark):  # E17
    t = make_tables(spark, balances=[("1", "2025-07-01", 100.0), ("1", "2025-08-01", 300.0),
                                     ("1", "2025-09-01", 900.0)],
                    positions=[position("1", "2025-07-01", "A", value=50.0),
                               position("1", "2025-08-01", "B", value=70.0),
                               position("1", "2025-08-01", "C", value=30.0)])
    s, m = both(spark, t)
    assert_same(s, m)
    r = one(s)
    assert r["Cash_abs"] == 300.0 and r["Bestandwert"] == 100.0 and r["Pos_Count"] == 2


def test_null_key_dropped(spark):  # E27
    t = make_tables(spark, orders=[order(None, "2025-08-01"), order("1", "2025-08-01")])
    assert [r["Depotnummer"] for r in FE.depot_features(t, AS_OF).collect()] == ["1"]


def test_backfill_equals_single_dates(spark):
    t = make_tables(spark, orders=[order("1", "2025-03-05"), order("1", "2025-06-10", cf=-2500.0),
                                   order("2", "2025-07-01", typ="Verkauf", cf=900.0)],
                    balances=[("1", "2025-05-01", 1000.0), ("2", "2025-07-15", 50.0)],
                    positions=[position("1", "2025-06-01", "A", value=500.0, cost=300.0)],
                    bookings=[booking("1", "2025-06-20", 400.0), booking("2", "2025-07-02", 80.0, typ="Zinsen")])
    days = ["2025-05-31", "2025-06-30", "2025-07-31", "2025-08-31"]
    multi = FE.depot_features_multi(t, spark.createDataFrame([(d(x),) for x in days], "as_of date"))
    for x in days:
        single = FE.depot_features(t, x)
        assert_same(single, multi.where(F.col("Score_Datum") == F.lit(x).cast("date")))
