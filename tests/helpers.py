"""Hand-made source tables for edge-case tests."""

from __future__ import annotations

import datetime as dt

from depotlens.sources.catalog import SourceTables

ORDER_SCHEMA = ("Depotnummer string, Orderdatum date, Ordertyp string, Cashflow double, ISIN string, "
                "Transaktionsnummer string, Bemerkung string, Datei_ID long")
SALDO_SCHEMA = "Kontoreferenz string, Datum date, Saldosollwert double"
BESTAND_SCHEMA = ("Depotreferenz string, Datum date, Wertpapierreferenz string, Wertpapiername string, "
                  "Wertpapiertyp string, Kurswert double, Einstandswerte double")
BUCHUNG_SCHEMA = ("Kontoreferenz string, Valutadatum date, Buchungdatum date, Betrag double, Buchungtyp string, "
                  "Bemerkung string")
FILE_SCHEMA = "DateiID long, Datum date, DateiName string, Pruefziffer int"


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def order(dep, day, typ="Ankauf", cf=-500.0, isin="X", tx=None, remark=None):
    return (dep, d(day), typ, cf, isin, tx, remark, None)


def booking(acc, day, amount, typ="Einlage", remark=None):
    return (acc, d(day), d(day), amount, typ, remark)


def position(dep, day, ref, name="x", typ="AKTIE", value=100.0, cost=None):
    return (dep, d(day), ref, name, typ, value, cost)


def make_tables(spark, orders=(), balances=(), positions=(), bookings=(), files=()):
    return SourceTables(
        orders=spark.createDataFrame(list(orders), ORDER_SCHEMA),
        balances=spark.createDataFrame([(a, d(b), c) for a, b, c in balances], SALDO_SCHEMA),
        positions=spark.createDataFrame(list(positions), BESTAND_SCHEMA),
        bookings=spark.createDataFrame(list(bookings), BUCHUNG_SCHEMA),
        files=spark.createDataFrame(list(files), FILE_SCHEMA),
    ).typed()


def one(df, key="Depotnummer", value=None):
    rows = df.collect()
    if value is not None:
        rows = [r for r in rows if r[key] == value]
    assert len(rows) == 1, rows
    return rows[0].asDict()
