"""The incremental state against the features computed from the whole history."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from depotlens.operators import features as FE
from depotlens.operators import state as ST
from depotlens.operators.files import complete_days
from depotlens.sources.catalog import SourceTables, day_load
from tests.helpers import booking, d, make_tables, order, position
from tests.test_book_safety import late_tables


def path():
    return os.path.join(tempfile.mkdtemp(prefix="depotlens-test-"), "state")


def alike(got, want):
    """Rows equal up to the last digits of doubles."""
    key = lambda rows: sorted((r.asDict() for r in rows), key=lambda r: r["Depotnummer"])
    got, want = key(got), key(want)
    assert [r["Depotnummer"] for r in got] == [r["Depotnummer"] for r in want]
    for a, b in zip(got, want):
        assert a.keys() == b.keys()
        for c in a:
            assert a[c] == (pytest.approx(b[c], rel=1e-9, abs=1e-9) if isinstance(b[c], float) else b[c]), (a["Depotnummer"], c)


def test_days_one_by_one_equal_the_whole_history(spark):
    rng = random.Random(8)
    first = d("2024-09-01")
    day = lambda: str(first + dt.timedelta(days=rng.randrange(330)))
    orders = [order(str(rng.randrange(9)), day(), rng.choice(["Ankauf", "Verkauf"]), -float(rng.randrange(50, 4000))) for _ in range(150)]
    bookings = [booking(str(rng.randrange(14)), day(), rng.choice([50.0, 400.0, 1500.0, -300.0, 0.0]), rng.choice(["Einlage", "Entnahme", "Zinsen", "Ertrag"]),
                        rng.choice([None, None, "Interne Umbuchung"])) for _ in range(300)]
    balances = [(str(rng.randrange(11)), day(), float(rng.randrange(9000))) for _ in range(60)]
    positions = [position(str(rng.randrange(10)), day(), str(k % 5), value=float(k), cost=float(rng.randrange(3) * 40)) for k in range(80)]
    t = make_tables(spark, orders, balances, positions, bookings)
    where = path()
    days = ["2025-01-05", "2025-01-06", "2025-01-31", "2025-02-01", "2025-03-30", "2025-07-20"]
    for a in days:
        alike(ST.step(spark, t, a, where).collect(), FE.depot_features(t, a).collect())
    alike(ST.step(spark, t, days[-1], where).collect(), FE.depot_features(t, days[-1]).collect())  # the last day again
    kept = spark.read.parquet(where).where(F.col("as_of") == days[-1]).agg(F.max(F.size("days")), F.max(F.size("books"))).first()
    assert max(kept) <= ST.KEPT_DAYS + 1
    without = SourceTables(t.orders, t.balances, t.positions, None)
    alike(ST.step(spark, without, days[0], path()).collect(), FE.depot_features(without, days[0]).collect())


def test_a_step_reads_only_the_new_rows(spark):
    t = make_tables(spark, [order("1", "2025-01-02"), order("2", "2025-01-03")], [("1", "2025-01-02", 5.0)], [], [])
    where = path()
    ST.step(spark, t, "2025-01-02", where).collect()
    later = make_tables(spark, [order("2", "2025-01-03")], [], [], [])  # the history is gone
    alike(ST.step(spark, later, "2025-01-03", where).collect(), FE.depot_features(t, "2025-01-03").collect())


def test_deliveries_one_by_one_equal_the_day_loads(spark):
    t, days = late_tables(spark, random.Random(5))
    calendar = complete_days(t.files).select(F.col("Datum").alias("as_of"), "DateiID_U", "DateiID_B")
    where = path()
    for a in (days[20], days[21], days[30], days[-1]):
        alike(ST.step(spark, t, a, where, days=calendar).collect(), FE.depot_features(day_load(t, a), a).collect())
