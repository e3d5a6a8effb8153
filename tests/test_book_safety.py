"""Day loads, damaged inputs, failing writes, stored models, ties: what must never go wrong silently."""

import datetime as dt
import glob
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.text import tech_hit
from depotlens.operators import features as FE
from depotlens.operators import labels as LB
from depotlens.operators import metrics as ME
from depotlens.operators import quality as QC
from depotlens.operators.files import complete_days
from depotlens.operators.quantiles import exact_quantiles
from depotlens.plans import ml as ML
from depotlens.plans.boosting import BoostParams
from depotlens.plans.daily import run_backfill
from depotlens.sinks.tables import VersionedTable, append, replace_dates, replace_range, write_csv_report
from depotlens.sources.catalog import SourceTables, day_load, read_tables, typed_bookings
from tests.helpers import FILE_SCHEMA, booking, d, make_tables, one, order, position

DAY = "2025-08-29"


def tmpdir():
    return tempfile.mkdtemp(prefix="depotlens-test-")


def day_tables(spark, files):
    orders = spark.createDataFrame(
        [("1", d("2025-08-01"), "Ankauf", -500.0, "X", None, None, 11), ("2", d("2025-08-02"), "Ankauf", -500.0, "X", None, None, 12),
         ("3", d("2025-08-03"), "Ankauf", -500.0, "X", None, None, 99)],
        "Depotnummer string, Orderdatum date, Ordertyp string, Cashflow double, ISIN string, Transaktionsnummer string, Bemerkung string, Datei_ID long")
    balances = spark.createDataFrame([("1", d("2025-01-31"), 900.0, 20), ("2", d(DAY), 50.0, 21)], "Kontoreferenz string, Datum date, Saldosollwert double, Datei_ID long")
    positions = spark.createDataFrame(
        [("1", d("2025-01-31"), "A", "n", "AKTIE", 5000.0, 1.0, 20), ("2", d(DAY), "B", "n", "AKTIE", 70.0, 1.0, 21)],
        "Depotreferenz string, Datum date, Wertpapierreferenz string, Wertpapiername string, Wertpapiertyp string, Kurswert double, Einstandswerte double, Datei_ID long")
    return SourceTables(orders, balances, positions, None, spark.createDataFrame(files, FILE_SCHEMA)).typed()


def test_sold_out_depot_has_an_empty_portfolio_on_its_file_day(spark):
    t = day_tables(spark, [(12, d(DAY), "comdirect_U-1", 1), (21, d(DAY), "comdirect_B-1", 1), (22, d(DAY), "comdirect_B-2", 0)])
    got = {r["Depotnummer"]: r for r in FE.depot_features(day_load(t, DAY), DAY).collect()}
    assert set(got) == {"1", "2"}  # order 99 came with a later file
    assert (got["1"]["Bestandwert"], got["1"]["Pos_Count"], got["1"]["Depotwert"]) == (0.0, 0, 0.0)
    assert (got["2"]["Bestandwert"], got["2"]["Pos_Count"], got["2"]["Cash_abs"]) == (70.0, 1, 50.0)


def late_tables(spark, rng):
    """Orders of 14 months, some delivered days and some many months late, files every few days."""
    days = [d("2024-01-05") + dt.timedelta(days=k) for k in range(0, 420, 7)]
    files = [f for k, day in enumerate(days) for f in ((10 + 2 * k, day, f"comdirect_U-{k}", 1), (11 + 2 * k, day, f"comdirect_B-{k}", 1))]
    orders = []
    for i in range(260):
        day = d("2024-01-01") + dt.timedelta(days=rng.randrange(425))
        delivered = day + dt.timedelta(days=rng.choice([0, 0, 0, 3, 9, 40, 100, 190, 230]))
        file = next((10 + 2 * k for k, f in enumerate(days) if f >= delivered), 10_000)
        typ = rng.choice(["Ankauf", "Verkauf"])
        orders.append((str(i % 7), day, typ, -100.0 - i, "X", None, None, None if i % 50 == 0 else rng.choice([file, file, 2])))
    balances = [(str(k % 9), day, 100.0 * k, 11 + 2 * k) for k, day in enumerate(days)]
    positions = [(str(k % 5), day, "A", "n", "AKTIE", 50.0 * k, 1.0, 11 + 2 * k) for k, day in enumerate(days)]
    t = SourceTables(
        spark.createDataFrame(orders, "Depotnummer string, Orderdatum date, Ordertyp string, Cashflow double, ISIN string, Transaktionsnummer string, Bemerkung string, Datei_ID long"),
        spark.createDataFrame(balances, "Kontoreferenz string, Datum date, Saldosollwert double, Datei_ID long"),
        spark.createDataFrame(positions, "Depotreferenz string, Datum date, Wertpapierreferenz string, Wertpapiername string, Wertpapiertyp string, Kurswert double, Einstandswerte double, Datei_ID long"),
        None, spark.createDataFrame(files, FILE_SCHEMA))
    return t.typed(), days


def test_file_days_in_one_job_equal_the_day_loads(spark):
    t, days = late_tables(spark, random.Random(3))
    wanted = [days[0], *days[20:60:6], days[-1]]
    calendar = complete_days(t.files).select(F.col("Datum").alias("as_of"), "DateiID_U", "DateiID_B")
    key = lambda rows: sorted(map(str, rows))
    single = [r for day in wanted for r in FE.depot_features(day_load(t, day), day).collect()]
    every = FE.depot_features_file_days(t, calendar).where(F.col("Score_Datum").isin([F.lit(x) for x in wanted])).collect()
    assert key(every) == key(single)
    some = FE.depot_features_file_days(t, calendar.where(F.col("as_of").isin([F.lit(x) for x in wanted]))).collect()
    assert key(some) == key(single)  # the calendar's other days do not matter
    by_date = [r for day in wanted for r in FE.depot_features(t, day).collect()]
    assert key(by_date) != key(single)  # the late orders make a difference


def test_an_order_is_known_from_its_file_on(spark):
    t = day_tables(spark, [(12, d("2025-03-03"), "comdirect_U-1", 1), (13, d("2025-03-03"), "comdirect_B-1", 1),
                           (14, d("2025-03-05"), "comdirect_U-2", 1), (15, d("2025-03-05"), "comdirect_B-2", 1)])
    t.orders = spark.createDataFrame([("1", d("2025-03-01"), 12), ("1", d("2025-03-02"), 14)], "Depotnummer string, Orderdatum date, Datei_ID long")
    t = t.typed()
    got = FE.depot_features_file_days(t, complete_days(t.files).select(F.col("Datum").alias("as_of"), "DateiID_U", "DateiID_B"))
    assert {str(r["Score_Datum"]): r["Orderfrequenz_30d"] for r in got.collect()} == {"2025-03-03": 1, "2025-03-05": 2}


def test_falling_file_ids_are_an_error(spark):
    t = day_tables(spark, [(14, d("2025-03-03"), "comdirect_U-1", 1), (13, d("2025-03-03"), "comdirect_B-1", 1),
                           (12, d("2025-03-05"), "comdirect_U-2", 1), (15, d("2025-03-05"), "comdirect_B-2", 1)])
    t.orders = spark.createDataFrame([("1", d("2025-03-01"), 12)], "Depotnummer string, Orderdatum date, Datei_ID long")
    calendar = complete_days(t.files).select(F.col("Datum").alias("as_of"), "DateiID_U", "DateiID_B")
    with pytest.raises(Exception, match="do not rise"):
        FE.depot_features_file_days(t.typed(), calendar).collect()


def test_day_without_its_snapshot_file_loads_nothing(spark):
    t = day_tables(spark, [(12, d(DAY), "comdirect_U-1", 1), (21, d("2025-08-30"), "comdirect_B-1", 1)])
    loaded = day_load(t, DAY)
    assert loaded.orders.count() == loaded.balances.count() == loaded.positions.count() == 0
    assert FE.depot_features(loaded, DAY).count() == 0
    checked = day_tables(spark, [(12, d(DAY), "comdirect_U-1", 1), (21, d(DAY), "comdirect_B-1", 0)])
    assert day_load(checked, DAY, require_checked=True).positions.count() == 0


def test_nan_and_infinite_amounts_count_as_zero(spark):
    nan, inf = float("nan"), float("inf")
    bad = make_tables(spark, orders=[order("1", "2025-08-01", cf=nan), order("1", "2025-08-02", cf=-inf)],
                      balances=[("1", DAY, nan)], positions=[position("1", DAY, "A", value=nan), position("1", DAY, "B", value=inf)],
                      bookings=[booking("1", "2025-08-20", nan)])
    zero = make_tables(spark, orders=[order("1", "2025-08-01", cf=0.0), order("1", "2025-08-02", cf=0.0)],
                       balances=[("1", DAY, 0.0)], positions=[position("1", DAY, "A", value=0.0), position("1", DAY, "B", value=0.0)],
                       bookings=[booking("1", "2025-08-20", 0.0)])
    assert one(FE.depot_features(bad, DAY)) == one(FE.depot_features(zero, DAY))


def test_damaged_source_is_an_error_and_a_missing_one_is_not(spark):
    base = tmpdir()
    t = make_tables(spark, orders=[order("1", "2025-08-01")], bookings=[booking("1", "2025-08-20", 5000.0)])
    for name, df in (("cd_order", t.orders), ("cd_saldo", t.balances), ("cd_bestand", t.positions)):
        df.write.parquet(f"{base}/{name}")
    assert read_tables(spark, base).bookings is None
    t.bookings.coalesce(1).write.parquet(f"{base}/cd_buchung")
    assert read_tables(spark, base).bookings.count() == 1
    for f in glob.glob(f"{base}/cd_buchung/part-*"):
        with open(f, "wb") as out:
            out.write(b"damaged")
    with pytest.raises(Exception, match="(?i)parquet|footer|magic"):
        read_tables(spark, base).bookings.count()


def test_backfill_does_not_overwrite_an_unreadable_target(spark):
    t = make_tables(spark, orders=[order("1", "2025-08-01")], files=[(1, d(DAY), "comdirect_U-1", 1), (2, d(DAY), "comdirect_B-1", 1)])
    out = tmpdir()
    os.makedirs(f"{out}/features/Score_Datum={DAY}")
    with open(f"{out}/features/Score_Datum={DAY}/part-0.parquet", "wb") as f:
        f.write(b"damaged")
    with pytest.raises(Exception):
        run_backfill(spark, t, out)
    assert os.path.exists(f"{out}/features/Score_Datum={DAY}/part-0.parquet")


def test_failing_write_keeps_the_old_rows(spark):
    out = os.path.join(tmpdir(), "t")
    rows = spark.createDataFrame([("1", d("2025-01-01"), 1), ("2", d("2025-01-02"), 2)], "k string, dt date, v int")
    replace_dates(rows, out, "dt")
    failing = rows.withColumn("v", F.when(F.col("k") == "2", F.raise_error(F.lit("stop")).cast("int")).otherwise(9))
    with pytest.raises(Exception, match="stop"):
        replace_dates(failing, out, "dt", ["2025-01-01", "2025-01-02"])
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_replace_range_and_append(spark):
    out = os.path.join(tmpdir(), "t")
    rows = spark.createDataFrame([(str(i), d(f"2025-01-0{i}"), i) for i in range(1, 6)], "k string, dt date, v int")
    replace_range(rows, out, "dt", "2025-01-01", "2025-01-05")
    replace_range(rows.where("v IN (1, 3)").withColumn("v", F.col("v") * 10), out, "dt", "2025-01-02", "2025-01-04")
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == [1, 5, 30]
    log = os.path.join(tmpdir(), "eval")
    for _ in range(2):
        append(rows.limit(1), log)
    assert spark.read.parquet(log).count() == 2
    report = os.path.join(tmpdir(), "report")
    for _ in range(2):
        write_csv_report(rows.select("k", "v"), report)
    assert sorted((r["k"], r["v"]) for r in spark.read.csv(report, header=True).collect()) == [(str(i), str(i)) for i in range(1, 6)]
    ML.write_json(spark, {"ap": 0.5, "cols": ["a", "ü"]}, os.path.join(report, "metrics"))
    assert ML.read_json(spark, os.path.join(report, "metrics")) == {"ap": 0.5, "cols": ["a", "ü"]}


def test_lost_pointer_is_an_error(spark):
    root = os.path.join(tmpdir(), "labels")
    table = VersionedTable(spark, root)
    df = spark.createDataFrame([(1,)], "a int")
    table.commit(df)
    table.commit(df.union(df))
    assert table.read().count() == 2
    for f in glob.glob(f"{root}/_CURRENT.2"):
        os.rename(f, f"{root}/other")
    assert table.read().count() == 1  # a stop before the second pointer: the first version is the table
    os.rename(f"{root}/_CURRENT.1", f"{root}/another")
    with pytest.raises(RuntimeError):
        table.read()
    with pytest.raises(RuntimeError):
        table.commit(df)


@pytest.mark.parametrize("ties", [0.7, 0.0])
def test_quantiles_of_large_and_tied_groups(spark, ties):
    random.seed(3)
    n = 200_000
    df = spark.range(n).select((F.col("id") % 2).alias("g"), F.when(F.rand(1) < ties, 0.0).otherwise(F.rand(2) * 1000 - 300).alias("v"))
    df = df.union(spark.createDataFrame([(2, 5.0), (3, None), (3, float("nan")), (4, -0.0), (4, 0.0), (4, -7.5), (4, 1e300)], "g long, v double"))
    stored = os.path.join(tmpdir(), "v")
    df.write.parquet(stored)
    df = spark.read.parquet(stored)
    probs = {"p0": 0.0, "p5": 0.5, "p8": 0.8, "p1": 1.0}
    got = {r["g"]: [r[k] for k in probs] for r in exact_quantiles(df, "v", probs, "g").collect()}
    want = df.where(~F.isnan("v")).groupBy("g").agg(*[F.percentile("v", p).alias(k) for k, p in probs.items()]).where("p5 IS NOT NULL")
    want = {r["g"]: [r[k] for k in probs] for r in want.collect()}
    assert set(got) == set(want) == {0, 1, 2, 4}
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-9)
    assert exact_quantiles(df.where("g = 3"), "v", probs).count() == 0


def test_real_tech_and_fund_words(spark):
    import re
    names = ["APPLE INC.", "Pineapple", "SAP SE", "SAPPHIRE AG", "Meta Platforms Inc", "META\nPLATFORMS", "iShares ETF Cloud Computing",
             "ETFS Cloud", "Cloud Fund", "Robotik ETF", "AMD", "AMDOCS", "Intel-Corp", "ON SEMICONDUCTOR", "Halbleiter etf ü", None, ""]
    tech = re.compile(r"(?:^|\b)(?:" + "|".join(re.escape(n) for n in P.TECH_NAMES) + r")(?:\b|$)", re.I)
    etf, sector = re.compile(r"\betf\b", re.I), re.compile(r"\b(?:" + "|".join(P.ETF_SECTOR_WORDS) + r")\b", re.I)
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for r in df.select("n", tech_hit("n", P.Vocabulary()).alias("hit")).collect():
        n = r["n"] or ""
        assert r["hit"] == bool(tech.search(n) or (etf.search(n) and sector.search(n))), n


def test_older_booking_type_spelling_and_label_branches(spark):
    old = spark.createDataFrame([("1", d(DAY), 200.0, "Einlage")], "Kontoreferenz string, Valutadatum date, Betrag double, Buchungstyp string")
    assert typed_bookings(old).first()["Buchungtyp"] == "Einlage"
    orders = spark.createDataFrame([("1", d("2025-08-01"), "filled"), ("2", d("2025-08-01"), "open")], "Depotnummer string, Orderdatum date, Status string")
    bookings = spark.createDataFrame([("3", d("2025-08-02"), 150.0, "Gutschrift"), ("4", d("2025-08-02"), 150.0, "Entnahme")],
                                     "Kontoreferenz string, Buchungdatum date, Betrag double, Typ string")
    got = {r["Depotnummer"] for r in LB.investment_events(orders, bookings, order_status_col="Status", booking_type_col="Typ").collect()}
    assert got == {"1", "3"}


def test_time_split_falls_back_to_the_last_fifth(spark):
    df = spark.createDataFrame([(i, d(f"2025-01-{i + 1:02d}")) for i in range(10)], "i int, Score_Datum date")
    got = {r["i"]: r["split"] for r in ML.time_split(df, "2025-12-31").collect()}
    assert [got[i] for i in range(10)] == ["train"] * 8 + ["calib"] * 2


def test_longer_horizons_are_lifted_and_low_coverage_is_flagged(spark):
    p = spark.createDataFrame([("1", 0.5, 0.2, 0.3)], "Depotnummer string, p_buy_7d double, p_buy_14d double, p_buy_30d double")
    assert tuple(ME.monotone_horizons(p).first())[1:] == (0.5, 0.5, 0.5)
    feats = spark.createDataFrame([(str(i), d(DAY)) for i in range(50)], "Depotnummer string, Score_Datum date")
    leads = spark.createDataFrame([("1", d(DAY), "Call")], "Depotnummer string, Score_Datum date, Next_Action string")
    assert QC.lead_coverage(feats, leads).first()["Coverage_Flag"] == 1


def test_schema_audit(spark):
    have = [c for c in QC.EXPECTED_FEATURE_COLUMNS if c != "TechAffin"] + ["New"]
    df = spark.createDataFrame([], ", ".join(f"`{c}` int" for c in have))
    assert {tuple(r) for r in QC.schema_audit(spark, df).collect()} == {("TechAffin", "missing"), ("New", "extra")}


def test_stored_models_and_daily_scores(spark):
    random.seed(1)
    rows = []
    for i in range(240):
        x = random.random()
        rows.append((str(i), d("2025-01-01") if i < 160 else d("2025-02-01"), x, random.random(), int(x + random.random() * 0.4 > 0.7)))
    frame = spark.createDataFrame(rows, "Depotnummer string, Score_Datum date, a double, b double, label int")
    registry, bundles = spark.createDataFrame([], ML.REGISTRY_SCHEMA), {}
    root = tmpdir()
    for h in (7, 14, 30):
        fitted = ML.fit_calibrated(frame.where("Score_Datum < '2025-02-01'"), frame.where("Score_Datum >= '2025-02-01'"), ["a", "b"], "label",
                                   ML.GbtParams(max_depth=2, max_iter=2 + h // 7, seed=h) if h == 30 else BoostParams(trees=2 + h // 7, max_depth=2, step=0.3, seed=h))
        fitted.metrics = {"rows": 160}
        bundles[h], registry = ML.publish(registry, fitted, root, "buy", h)
    loaded = ML.active_bundle(spark, registry, "buy", 14)
    assert loaded.version == "T14-v1-iso90d" and loaded.metrics == {"rows": 160}
    key = lambda df: sorted((r["Depotnummer"], r["p"]) for r in df.collect())
    assert key(ML.score(loaded, frame.drop("b"), "p")) == key(ML.score(bundles[14], frame.drop("b"), "p"))  # a missing feature counts as 0
    daily = ML.score_daily(frame, loaded, "2025-02-01").collect()
    assert sorted(r["rank_in_run"] for r in daily) == list(range(1, 81)) and {r["model_version"] for r in daily} == {loaded.version}
    assert all(r["score"] == round(r["p_invest"] * 100) for r in daily if abs(r["p_invest"] * 200 % 2 - 1) > 1e-6)
    three = ML.score_horizons(frame, {h: ML.active_bundle(spark, registry, "buy", h) for h in (7, 14, 30)}, "2025-02-01").collect()
    assert all(r["p_buy_7d"] <= r["p_buy_14d"] <= r["p_buy_30d"] for r in three)
    assert {r["model_version"] for r in three} == {"T7-v1-iso90d;T14-v1-iso90d;T30-v1-iso90d"}
    with pytest.raises(ValueError):
        ML.pick_model(registry, "buy", version="T7-v9-iso90d")
    assert ML.top_importances(ML.feature_importances(spark, loaded), 1).first()["feature"] == "a"


def test_a_range_of_days_is_scored_by_the_versions_active_then(spark):
    random.seed(4)
    rows = []
    for i in range(300):
        x = random.random()
        rows.append((str(i % 60), d(f"2025-0{1 + i // 60}-01"), x, random.random() if i % 7 else None, int(x + random.random() * 0.4 > 0.7)))
    frame = spark.createDataFrame(rows, "Depotnummer string, Score_Datum date, a double, b double, label int")
    registry, root, log = spark.createDataFrame([], ML.REGISTRY_SCHEMA), tmpdir(), []
    for columns, start in ((["a", "b"], "2025-02-01"), (["a"], "2025-03-15"), (["b", "a"], "2025-03-15"), (["a"], "2025-09-01")):
        fitted = ML.fit_calibrated(frame.where("Score_Datum < '2025-02-01'"), frame.where("Score_Datum >= '2025-04-01'") if columns != ["b", "a"] else None,
                                   columns, "label", BoostParams(trees=3, max_depth=2, step=0.5, row_share=0.8))
        fitted, registry = ML.publish(registry, fitted, root, "buy", 7)
        log.append(("buy", 7, fitted.version, d(start)))
    activations = spark.createDataFrame([*log, ("buy", 14, "T14-v9-iso90d", d("2025-01-01")), ("other", 7, "T7-v9-iso90d", d("2025-01-01"))], ML.ACTIVATION_SCHEMA)
    days = {"2025-01-01": None, "2025-02-01": "T7-v1-iso90d", "2025-03-01": "T7-v1-iso90d", "2025-04-01": "T7-v3-iso90d", "2025-05-01": "T7-v3-iso90d"}
    dates = spark.createDataFrame([(d(x),) for x in days], "as_of date")
    got = ML.score_range(frame, registry, activations, dates, "buy", 7).collect()
    want = [r for day, v in days.items() if v for r in ML.score_daily(frame, ML.active_bundle(spark, registry, "buy", 7, v), day).collect()]
    key = lambda rows: sorted((r["run_date"], r["Depotnummer"], round(r["p_invest"], 9), r["score"], r["rank_in_run"], r["model_version"]) for r in rows)
    assert key(got) == key(want) and len(got) == 240


def test_typed_frame(spark):
    df = spark.createDataFrame([("1", d(DAY), "1.234,50", "x", "5", d("2025-08-19"), True), ("2", d(DAY), None, "7", "k", None, False)],
                               "Depotnummer string, Score_Datum date, named string, text string, half string, Letzter_Kauf date, flag boolean")
    out = ML.typed_frame(df, named=("named", "flag"))
    assert [f"{n}:{t}" for n, t in out.dtypes[2:]] == ["named:double", "text:string", "half:string", "Letzter_Kauf:date", "flag:double", "days_since_last_buy:double"]
    got = {r["Depotnummer"]: (r["named"], r["flag"], r["days_since_last_buy"]) for r in out.collect()}
    assert got == {"1": (1234.5, 1.0, 10.0), "2": (None, 0.0, None)}
