"""Features and labels by period agree with the ones computed date by date."""

import datetime as dt

from pyspark.sql import functions as F

from depotlens.operators import features as FE
from depotlens.operators import labels as LB
from tests.helpers import d, make_tables, order


def test_labels_cut_periods_not_days(spark):
    t = make_tables(spark, orders=[order("1", "2025-01-10"), order("1", "2025-02-20")], balances=[("2", "2025-01-05", 1.0)])
    days = [d("2025-01-01") + dt.timedelta(i) for i in range(60)]
    dates = spark.createDataFrame([(x,) for x in days], "as_of date")
    periods = LB.invest_labels(FE.spine_periods(t, dates), t.orders, t.bookings, horizons=(7,))
    assert periods.rows.count() <= 5  # the old form had a row per depot and date
    new = {tuple(r) for r in periods.per_day("stichtag").collect()}
    spine = FE.depot_spine_multi(t, dates).withColumnRenamed("Score_Datum", "stichtag")
    old = {tuple(r) for r in LB.invest_labels(spine, t.orders, t.bookings, horizons=(7,)).collect()}
    assert new == old and any(r[2] == 1 for r in new)
    assert periods.per_day().where(F.col("Depotnummer") == "1").count() == sum(x >= d("2025-01-10") for x in days)
