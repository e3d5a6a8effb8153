"""CSV deliveries: declared types, header, rejected rows."""

import os
import tempfile

import pytest

from depotlens.operators import features as FE
from depotlens.sources.catalog import read_tables
from depotlens.sources.csv_files import read_csv, read_csv_tables, rejected_counts


def delivery(**files):
    base = tempfile.mkdtemp(prefix="depotlens-test-")
    for name, lines in files.items():
        os.makedirs(f"{base}/{name}")
        for i, part in enumerate(lines):
            with open(f"{base}/{name}/part-{i}.csv", "w", encoding="utf-8") as f:
                f.write(part)
    return base


ORDERS = [
    "Orderdatum,Depotnummer,Cashflow,Ordertyp,Bemerkung\n2025-08-01,1,-500.5,Ankauf,\"a, b\"\n2025-08-02,2,,Verkauf,\n",
    "Orderdatum,Depotnummer,Cashflow,Ordertyp,Bemerkung\n2025-13-02,3,1.0,Ankauf,x\n2025-08-03,,1.0,Ankauf,x\n,4,1.0,Ankauf,x\n"
    "2025-08-04,5,abc,Ankauf,x\n2025-08-05,6,1.0\n2025-08-06,7,1.0,Ankauf,x,extra\n2025-08-07,0008,2.0,Ankauf,ok\n",
]
BALANCES = ["Kontoreferenz,Datum,Saldosollwert\n1,2025-08-01,100.0\n2,2025-08-01,zehn\n"]
POSITIONS = ["Depotreferenz,Datum,Wertpapierreferenz,Wertpapiername,Wertpapiertyp,Kurswert,Einstandswerte\n1,2025-08-01,A,n,AKTIE,50,1\n"]


def test_rows_that_do_not_fit_are_kept_apart(spark):
    base = delivery(cd_order=ORDERS)
    rows, rejected = read_csv(spark, f"{base}/cd_order", "cd_order")
    assert rows.count() == 3  # without any column: the same rows
    got = {r["Depotnummer"]: (str(r["Orderdatum"]), r["Cashflow"], r["Bemerkung"]) for r in rows.collect()}
    assert got == {"1": ("2025-08-01", -500.5, "a, b"), "2": ("2025-08-02", None, None), "0008": ("2025-08-07", 2.0, "ok")}
    assert dict(rows.dtypes)["Orderdatum"] == "date"
    assert {r["reason"]: r["n"] for r in rejected_counts(rejected).collect()} == {"malformed": 4, "no key": 1, "no date": 1}
    lines = {r["line"] for r in rejected.collect()}
    assert "2025-08-05,6,1.0" in lines and any(x.startswith("2025-13-02,3") for x in lines)


def test_tables_from_csv_give_the_same_features(spark):
    base = delivery(cd_order=ORDERS, cd_saldo=BALANCES, cd_bestand=POSITIONS)
    tables, rejected = read_csv_tables(spark, base)
    assert tables.bookings is None and rejected.where("table_name = 'cd_saldo'").count() == 1
    got = FE.depot_features(read_tables(spark, base, fmt="csv").typed(), "2025-08-29").collect()
    parquet = tempfile.mkdtemp(prefix="depotlens-test-")
    for name, df in (("cd_order", tables.orders), ("cd_saldo", tables.balances), ("cd_bestand", tables.positions)):
        df.write.parquet(f"{parquet}/{name}")
    assert sorted(map(str, got)) == sorted(map(str, FE.depot_features(read_tables(spark, parquet).typed(), "2025-08-29").collect()))
    assert {r["Depotnummer"] for r in got} == {"1", "2", "0008"}


def test_a_missing_column_and_a_differing_header_are_errors(spark):
    with pytest.raises(ValueError, match="Orderdatum"):
        read_csv(spark, delivery(cd_order=["Depotnummer,Datum\n1,2025-08-01\n"]) + "/cd_order", "cd_order")
    base = delivery(cd_saldo=[BALANCES[0], "Datum,Kontoreferenz,Saldosollwert\n2025-08-01,9,1.0\n"])
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, f"{base}/cd_saldo", "cd_saldo")[0].collect()
