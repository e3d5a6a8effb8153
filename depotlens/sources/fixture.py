"""Depot source tables derived from the driver's synthetic test tables.

The test data is a TPC-H-like star schema plus an ``events`` stream. Every
depot table is derived from it with a fixed rule, so each query's work grows
with the given tables:

* orders   <- ``orders``: customer = depot, status F/O/P = buy / savings-plan
  buy / sell, total price / 100 = cash flow, urgent filled orders carry a
  cancellation remark, low-priority filled orders have no transaction number.
* balances <- ``customer``: three snapshot dates (2000-10-01, 2001-07-01,
  2001-08-01) chosen by market segment, so some depots have no balance and
  some only an older one.
* positions<- ``lineitem`` x ``orders`` x ``part``: one yearly snapshot per
  ship year; returned-and-finished lines are worthless, every sixth line has
  no cost basis, line 7 has no security reference.
* bookings <- ``events``: one booking per event, spread over the six months
  before the cut-off; the event type decides the booking type, two hours of
  the day carry internal-transfer remarks.
* files    <- one order file per order day (a second, higher-checked one on the
  15th), one snapshot file per order day except Sundays (unchecked on the 1st).
* late orders <- the orders with the file id of a later day for some of them.

The same derivation is written in SQL in ``sqlcheck/fixture_sql.py`` for the
DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.sources.catalog import SourceTables

CUTOFF = "2001-08-01"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _file_of(day):
    """Id of the order file of a day."""
    return ((F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)) * 10 + 1).cast("bigint")


def fixture_late_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with some delivered late: every ninth by 1 to 13 days, every 31st by 120 to 249 days."""
    key = F.col("o_orderkey")
    wait = F.when(key % 31 == 0, 120 + key % 130).when(key % 9 == 0, 1 + key % 13).otherwise(0)
    return fixture_orders(spark, sf_dir, wait)


def fixture_orders(spark: SparkSession, sf_dir: str, wait=None) -> DataFrame:
    """``wait``: days after the order's own until the file that delivers it (0 if not given)."""
    o = _read(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    filled = status == "F"
    return o.select(
        F.col("o_custkey").cast("string").alias("Depotnummer"),
        d.alias("Orderdatum"),
        F.when(filled, "Ankauf").when(status == "O", "Sparplan-Ankauf").otherwise("Verkauf").alias("Ordertyp"),
        (F.when(status == "P", F.col("o_totalprice")).otherwise(-F.col("o_totalprice")) / 100).alias("Cashflow"),
        F.when(F.col("o_orderkey") % 20 == 0, F.lit(P.TARGET_ISIN))
         .otherwise(F.concat(F.lit("SEC"), (F.col("o_orderkey") % 20).cast("string"))).alias("ISIN"),
        F.when((F.col("o_orderpriority") == "5-LOW") & filled, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderkey").cast("string")).alias("Transaktionsnummer"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & filled, F.lit("Storno Kunde")).alias("Bemerkung"),
        _file_of(d if wait is None else F.date_add(d, wait.cast("int"))).alias("Datei_ID"),
    )


def fixture_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string").alias("Kontoreferenz")
    seg = F.col("c_mktsegment")
    def file_id(day: str):  # the snapshot file of that day
        return F.lit(int(day.replace("-", "")) * 10 + 2).cast("bigint").alias("Datei_ID")

    now = c.where(seg != "HOUSEHOLD").select(key, F.lit(CUTOFF).cast("date").alias("Datum"),
                                             F.col("c_acctbal").alias("Saldosollwert"), file_id(CUTOFF))
    month_before = c.where(seg.isin("BUILDING", "HOUSEHOLD")).select(
        key, F.lit("2001-07-01").cast("date").alias("Datum"), (F.col("c_acctbal") / 2).alias("Saldosollwert"),
        file_id("2001-07-01"))
    older = c.where(seg.isin("MACHINERY", "AUTOMOBILE")).select(
        key, F.lit("2000-10-01").cast("date").alias("Datum"), (F.col("c_acctbal") * 1.5).alias("Saldosollwert"),
        file_id("2000-10-01"))
    return now.unionByName(month_before).unionByName(older)


def fixture_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # What the line alone decides is computed before the joins, so that they shuffle narrow rows.
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.year("l_shipdate").alias("year"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit(0.0))
         .otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Kurswert"))
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("o_custkey").cast("string").alias("Depotreferenz"),
        F.make_date("year", F.lit(1), F.lit(1)).alias("Datum"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .otherwise(F.col("l_partkey").cast("string")).alias("Wertpapierreferenz"),
        F.col("p_name").alias("Wertpapiername"),
        F.when(F.col("p_type").isin("ECONOMY", "STANDARD", "PROMO"), "AKTIE").otherwise("FONDS").alias("Wertpapiertyp"),
        "Kurswert",
        F.when(F.col("l_linenumber") % 6 == 0, F.lit(0.0))
         .otherwise(F.col("l_quantity") * F.col("p_retailprice") * 2).alias("Einstandswerte"),
        ((F.col("year") * 10000 + 101) * 10 + 2).cast("bigint").alias("Datei_ID"),
    )


def fixture_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    valuta = F.date_sub(F.lit(CUTOFF).cast("date"), (6 * (31 - F.dayofmonth("ts"))).cast("int"))
    et = F.col("event_type")
    hour = F.hour("ts")
    return e.select(
        F.col("user_id").cast("string").alias("Kontoreferenz"),
        valuta.alias("Valutadatum"),
        valuta.alias("Buchungdatum"),
        (F.col("value") * 20).alias("Betrag"),
        F.when(et == "purchase", "Einlage").when(et == "click", "Entnahme").when(et == "view", "Zinsen")
         .when(et == "error", "Steuererstattung").otherwise("Ertrag").alias("Buchungtyp"),
        F.when(hour == 3, "Interne Umbuchung").when(hour == 4, "DEPOTÜBERTRAG eingehend").alias("Bemerkung"),
    )


def fixture_files(orders: DataFrame) -> DataFrame:
    days = orders.select("Datei_ID", "Orderdatum").distinct()
    day = F.dayofmonth("Orderdatum")
    u = days.select(F.col("Datei_ID").alias("DateiID"), F.col("Orderdatum").alias("Datum"),
                    F.concat(F.lit(P.FILE_PREFIX_ORDERS), F.col("Datei_ID").cast("string")).alias("DateiName"),
                    F.lit(1).alias("Pruefziffer"))
    u2 = days.where(day == 15).select(
        (F.col("Datei_ID") + 2).alias("DateiID"), F.col("Orderdatum").alias("Datum"),
        F.concat(F.lit(P.FILE_PREFIX_ORDERS), F.col("Datei_ID").cast("string"), F.lit("-2")).alias("DateiName"),
        F.lit(2).alias("Pruefziffer"))
    b = days.where(F.dayofweek("Orderdatum") != 1).select(
        (F.col("Datei_ID") + 1).alias("DateiID"), F.col("Orderdatum").alias("Datum"),
        F.concat(F.lit(P.FILE_PREFIX_SNAPSHOT), F.col("Datei_ID").cast("string")).alias("DateiName"),
        F.when(day == 1, 0).otherwise(1).alias("Pruefziffer"))
    return u.unionByName(u2).unionByName(b)


def fixture_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    orders = fixture_orders(spark, sf_dir)
    return SourceTables(
        orders=orders,
        balances=fixture_balances(spark, sf_dir),
        positions=fixture_positions(spark, sf_dir),
        bookings=fixture_bookings(spark, sf_dir),
        files=fixture_files(orders),
    )
