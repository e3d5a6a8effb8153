"""The rejected rows of a CSV delivery by table and reason, against the damaged rows put in."""

import datetime as dt
import uuid
import zlib

from depotlens.plans import catalog as C
from depotlens.plans import catalog_stores as CS
from depotlens.sources.catalog import SourceTables


def damaged(rows, every):
    return sum(zlib.crc32("|".join("-" if v is None else str(v) for v in r).encode()) % every == 0 for r in rows)


def test_rejected_rows_are_counted_by_reason_against_those_put_in(spark, monkeypatch):
    day = dt.date(2001, 5, 1)
    orders = [(str(i), day, "Ankauf", i + 0.5, "SEC1", str(i), None if i % 2 else "x", i) for i in range(700)]
    balances = [(str(i), day, i + 0.25, i) for i in range(400)]
    bookings = [(str(i), day if i != 9 else None, day, i + 0.5, "Einlage", "DEPOTÜBERTRAG") for i in range(500)]
    t = SourceTables(
        spark.createDataFrame(orders, "Depotnummer string, Orderdatum date, Ordertyp string, Cashflow double, ISIN string, Transaktionsnummer string, Bemerkung string, Datei_ID bigint"),
        spark.createDataFrame(balances, "Kontoreferenz string, Datum date, Saldosollwert double, Datei_ID bigint"),
        spark.createDataFrame([("1", day, "A", "n", "AKTIE", 1.0, 1.0, 1)], "Depotreferenz string, Datum date, Wertpapierreferenz string, Wertpapiername string, "
                              "Wertpapiertyp string, Kurswert double, Einstandswerte double, Datei_ID bigint"),
        spark.createDataFrame(bookings, "Kontoreferenz string, Valutadatum date, Buchungdatum date, Betrag double, Buchungtyp string, Bemerkung string"),
        spark.createDataFrame([(1, day, "f", 1)], "DateiID bigint, Datum date, DateiName string, Pruefziffer int"))
    monkeypatch.setattr(C, "tables", lambda *_: t)
    got = {(r["table_name"], r["reason"]): tuple(r)[2:] for r in CS.q_csv_rejected(spark, uuid.uuid4().hex).collect()}
    o, b, k = damaged(orders, 50), damaged(balances, 40), damaged(bookings, 30)
    assert o > 1 and b > 1 and k > 1
    assert got == {
        ("cd_order", "malformed"): (700, 700, o, o, 1.0, 2, 1), ("cd_order", "no key"): (700, 700, o, o, 1.0, 2, 1),
        ("cd_saldo", "malformed"): (400, 400, b, b, 1.0, 1, 1),
        # one booking came without its date: it is rejected and was not put in
        ("cd_buchung", "malformed"): (499, 500, k, k, 1.0, 2, 2), ("cd_buchung", "no date"): (499, 500, k + 1, k, (k + 1) / k, 2, 2),
        ("cd_bestand", None): (1, 1, 0, 0, None, 0, 0), ("cd_datei", None): (1, 1, 0, 0, None, 0, 0)}
