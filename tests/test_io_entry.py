"""Sinks, registry, streaming and the driver entry points."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from depotlens.operators import labels as LB
from depotlens.plans import ml as ML
from depotlens.sinks.tables import VersionedTable, merge_upsert, replace_dates
from tests.helpers import FILE_SCHEMA, d, make_tables, order


def tmpdir():
    return tempfile.mkdtemp(prefix="depotlens-test-")


def test_replace_dates_is_idempotent_and_clears_empty_dates(spark):
    out = os.path.join(tmpdir(), "t")
    day1 = spark.createDataFrame([("1", d("2025-01-01"), 1), ("2", d("2025-01-02"), 2)], "k string, dt date, v int")
    replace_dates(day1, out, "dt")
    replace_dates(day1.where(F.col("dt") == d("2025-01-01")), out, "dt")  # re-run of one date
    assert spark.read.parquet(out).count() == 2
    empty = day1.where(F.lit(False))
    replace_dates(empty, out, "dt", ["2025-01-02"])  # a re-run finding nothing clears the date
    assert [str(r["dt"]) for r in spark.read.parquet(out).collect()] == ["2025-01-01"]


def test_label_upsert_keeps_other_horizons(spark):
    t7 = spark.createDataFrame([("1", d("2025-01-01"), 1), ("2", d("2025-01-01"), 0)],
                               "Depotnummer string, stichtag date, label_invest_T7 int")
    t14 = spark.createDataFrame([("1", d("2025-01-01"), 0), ("3", d("2025-01-01"), 1)],
                                "Depotnummer string, stichtag date, label_invest_T14 int")
    table = VersionedTable(spark, os.path.join(tmpdir(), "labels"))
    merge_upsert(table, t7, ["Depotnummer", "stichtag"], LB.upsert_labels)
    merged = merge_upsert(table, t14, ["Depotnummer", "stichtag"], LB.upsert_labels)
    got = {r["Depotnummer"]: (r["label_invest_T7"], r["label_invest_T14"]) for r in merged.collect()}
    assert got == {"1": (1, 0), "2": (0, None), "3": (None, 1)}


def test_registry(spark):
    reg = spark.createDataFrame([], ML.REGISTRY_SCHEMA)
    n = ML.next_version_number(reg, "buy", 7).collect()[0][0]
    assert n == 1
    reg = ML.register_model(reg, {"model_name": "buy", "version": ML.version_string(7, n, 90), "horizon_days": 7})
    reg = ML.register_model(reg, {"model_name": "buy", "version": ML.version_string(7, 2, 90), "horizon_days": 7})
    reg = ML.register_model(reg, {"model_name": "buy", "version": "T14-v1-iso90d", "horizon_days": 14},
                            activate=False)
    assert ML.next_version_number(reg, "buy", 7).collect()[0][0] == 3
    picked = {r["horizon_days"]: r["version"] for r in ML.pick_model(reg, "buy").collect()}
    assert picked == {7: "T7-v2-iso90d", 14: "T14-v1-iso90d"}
    given = {r["horizon_days"]: r["version"] for r in ML.pick_model(reg, "buy", version="T7-v1-iso90d").collect()}
    assert given[7] == "T7-v1-iso90d"


def test_feature_stream_available_now(spark):
    from depotlens.streaming.daily_files import feature_stream
    root = tmpdir()
    t = make_tables(spark, orders=[order("1", "2025-01-02"), order("2", "2025-01-03")])
    cat = spark.createDataFrame([(11, d("2025-01-02"), "comdirect_U-11", 1), (12, d("2025-01-02"), "comdirect_B-11", 1),
                                 (21, d("2025-01-03"), "comdirect_U-21", 1)], FILE_SCHEMA)
    cat.write.parquet(os.path.join(root, "catalog"))
    # A fresh stream name: the stream's checkpoint (and so its progress) lives
    # under the session's shared checkpoint folder.
    q = feature_stream(spark, os.path.join(root, "catalog"), t, os.path.join(root, "out"),
                       name=f"t-stream-{os.path.basename(root)}")
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(root, "out", "features"))
    assert [str(r["Score_Datum"]) for r in out.select("Score_Datum").distinct().collect()] == ["2025-01-02"]


@pytest.mark.parametrize("name", ["depot_features", "general_score", "alerts", "label_invest", "first_target_buy"])
def test_queries_match_oracle_small(spark, name):
    import duckdb

    import __spark_entry__ as E
    from scripts.check_queries import rows_of
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("no test data")
    con = duckdb.connect()
    for tname in ["customer", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {tname} AS SELECT * FROM read_parquet('{sf}/{tname}.parquet')")
    df = E.queries()[name](spark, sf)
    rel = con.execute(E.oracle_sql()[name])
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    b = rows_of([c[0] for c in rel.description], rel.fetchall())
    assert a == b


def test_backfill_by_file_covers_every_complete_day(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("no test data")
    test_queries_match_oracle_small(spark, "depot_features_file_backfill")
    days = {r[0] for r in E.queries()["asof_dates_complete"](spark, sf).collect()}
    got = {r[0] for r in E.queries()["depot_features_file_backfill"](spark, sf).select("Score_Datum").distinct().collect()}
    assert got == days and len(days) > 200


def test_training_frame_covers_every_date_and_feature(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("no test data")
    test_queries_match_oracle_small(spark, "training_frame_backfill")
    got = E.queries()["training_frame_backfill"](spark, sf)
    features = E.queries()["depot_features_backfill"](spark, sf)
    days = {r[0] for r in E.queries()["asof_dates_complete"](spark, sf).collect()}
    assert {r[0] for r in got.select("Score_Datum").distinct().collect()} == days
    assert set(features.columns) <= set(got.columns)
    assert {t for n, t in got.dtypes if n in features.columns[3:]} == {"double"}


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "Depotnummer" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_daily_run_and_backfill_end_to_end(spark):
    from depotlens import params as P
    from depotlens.plans.daily import run_backfill, run_daily
    from depotlens.sources.fixture import fixture_tables
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("no test data")
    t = fixture_tables(spark, sf).typed()
    fp = P.FeatureParams(vocab=P.FIXTURE_VOCAB)
    out = os.path.join(tmpdir(), "book")
    run_daily(spark, t, "2001-07-31", out, fp)
    res = run_daily(spark, t, "2001-08-01", out, fp)
    n = res.features.count()
    for table in ("features", "scoring", "invest_readiness", "segments", "leads", "validation_log"):
        got = spark.read.parquet(f"{out}/{table}")
        assert got.count() > 0, table
    assert spark.read.parquet(f"{out}/leads").where(F.col("Score_Datum") == d("2001-08-01")).count() == n
    log = spark.read.parquet(f"{out}/validation_log").where(F.col("Log_Datum") == d("2001-08-01")).collect()[0]
    assert log["Rowcount_Prev"] is not None and log["Leads_Rows"] == n
    # Re-running a date replaces it (idempotent).
    run_daily(spark, t, "2001-08-01", out, fp)
    assert spark.read.parquet(f"{out}/features").where(F.col("Score_Datum") == d("2001-08-01")).count() == n
    dates = run_backfill(spark, t, os.path.join(tmpdir(), "bf"), start="2001-07-01", end="2001-08-01", fp=fp)
    assert dates.count() > 0
