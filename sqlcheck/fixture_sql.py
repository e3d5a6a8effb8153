"""DuckDB SQL of the depot source tables derived from the test tables.

Same rules as ``depotlens/sources/fixture.py``, written independently in SQL
so the oracle does not reuse the Spark code.
"""

CUTOFF = "2001-08-01"

CD_ORDER = """
cd_order AS (
  SELECT CAST(o_custkey AS VARCHAR) AS Depotnummer,
         CAST(o_orderdate AS DATE) AS Orderdatum,
         CASE o_orderstatus WHEN 'F' THEN 'Ankauf' WHEN 'O' THEN 'Sparplan-Ankauf' ELSE 'Verkauf' END AS Ordertyp,
         (CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE -o_totalprice END) / 100 AS Cashflow,
         CASE WHEN o_orderkey % 20 = 0 THEN 'DE000A14UWW2' ELSE 'SEC' || CAST(o_orderkey % 20 AS VARCHAR) END AS ISIN,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS Transaktionsnummer,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'Storno Kunde' END AS Bemerkung,
         CAST((year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)) * 10 + 1 AS BIGINT) AS Datei_ID
  FROM orders)"""

# Some orders with the id of a later day's file.
_OWN_FILE = "CAST((year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)) * 10 + 1 AS BIGINT) AS Datei_ID"
_LATE_DAY = ("(CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 31 = 0 THEN 120 + o_orderkey % 130 "
             "WHEN o_orderkey % 9 = 0 THEN 1 + o_orderkey % 13 ELSE 0 END AS INTEGER))")
CD_LATE = CD_ORDER.replace("cd_order", "cd_late").replace(
    _OWN_FILE, f"CAST((year({_LATE_DAY}) * 10000 + month({_LATE_DAY}) * 100 + day({_LATE_DAY})) * 10 + 1 AS BIGINT) AS Datei_ID")

CD_SALDO = """
cd_saldo AS (
  SELECT CAST(c_custkey AS VARCHAR) AS Kontoreferenz, DATE '2001-08-01' AS Datum, c_acctbal AS Saldosollwert,
         CAST(200108012 AS BIGINT) AS Datei_ID
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), DATE '2001-07-01', c_acctbal / 2, 200107012
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), DATE '2000-10-01', c_acctbal * 1.5, 200010012
  FROM customer WHERE c_mktsegment IN ('MACHINERY', 'AUTOMOBILE'))"""

CD_BESTAND = """
cd_bestand AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS Depotreferenz,
         make_date(year(l.l_shipdate), 1, 1) AS Datum,
         CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_partkey AS VARCHAR) END AS Wertpapierreferenz,
         p.p_name AS Wertpapiername,
         CASE WHEN p.p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'AKTIE' ELSE 'FONDS' END AS Wertpapiertyp,
         CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 0.0
              ELSE l.l_extendedprice * (1 - l.l_discount) END AS Kurswert,
         CASE WHEN l.l_linenumber % 6 = 0 THEN 0.0 ELSE l.l_quantity * p.p_retailprice * 2 END AS Einstandswerte,
         CAST((year(l.l_shipdate) * 10000 + 101) * 10 + 2 AS BIGINT) AS Datei_ID
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""

CD_BUCHUNG = """
cd_buchung AS (
  SELECT CAST(user_id AS VARCHAR) AS Kontoreferenz,
         CAST(DATE '2001-08-01' - CAST(6 * (31 - day(ts)) AS INTEGER) AS DATE) AS Valutadatum,
         CAST(DATE '2001-08-01' - CAST(6 * (31 - day(ts)) AS INTEGER) AS DATE) AS Buchungdatum,
         value * 20 AS Betrag,
         CASE event_type WHEN 'purchase' THEN 'Einlage' WHEN 'click' THEN 'Entnahme' WHEN 'view' THEN 'Zinsen'
                         WHEN 'error' THEN 'Steuererstattung' ELSE 'Ertrag' END AS Buchungtyp,
         CASE WHEN hour(ts) = 3 THEN 'Interne Umbuchung' WHEN hour(ts) = 4 THEN 'DEPOTÜBERTRAG eingehend' END AS Bemerkung
  FROM events)"""

CD_DATEI = """
order_days AS (SELECT DISTINCT Datei_ID, Orderdatum FROM cd_order),
cd_datei AS (
  SELECT Datei_ID AS DateiID, Orderdatum AS Datum, 'comdirect_U-' || CAST(Datei_ID AS VARCHAR) AS DateiName, 1 AS Pruefziffer
  FROM order_days
  UNION ALL
  SELECT Datei_ID + 2, Orderdatum, 'comdirect_U-' || CAST(Datei_ID AS VARCHAR) || '-2', 2
  FROM order_days WHERE day(Orderdatum) = 15
  UNION ALL
  SELECT Datei_ID + 1, Orderdatum, 'comdirect_B-' || CAST(Datei_ID AS VARCHAR), CASE WHEN day(Orderdatum) = 1 THEN 0 ELSE 1 END
  FROM order_days WHERE isodow(Orderdatum) <> 7)"""

ALL_SOURCES = ",".join([CD_ORDER, CD_SALDO, CD_BESTAND, CD_BUCHUNG, CD_DATEI])


def file_day_sources(day: str) -> str:
    """The fixture views as loaded on a file day: orders up to the day's order
    file, balances and positions of its snapshot file, nothing if one is missing."""
    every = ALL_SOURCES
    for name in ("cd_order", "cd_saldo", "cd_bestand"):
        every = every.replace(name, name.replace("cd_", "all_"))
    return every + f""",
picked AS (
  SELECT arg_max(DateiID, (Pruefziffer, DateiID)) FILTER (WHERE DateiName LIKE 'comdirect_U-%') AS u,
         arg_max(DateiID, (Pruefziffer, DateiID)) FILTER (WHERE DateiName LIKE 'comdirect_B-%') AS b
  FROM cd_datei WHERE Datum = DATE '{day}'),
cd_order AS (SELECT o.* FROM all_order o JOIN picked p ON p.b IS NOT NULL AND o.Datei_ID <= p.u),
cd_saldo AS (SELECT s.* FROM all_saldo s JOIN picked p ON p.u IS NOT NULL AND s.Datei_ID = p.b),
cd_bestand AS (SELECT s.* FROM all_bestand s JOIN picked p ON p.u IS NOT NULL AND s.Datei_ID = p.b)"""


def with_sources(*ctes: str, select: str) -> str:
    """``WITH <fixture views>, <ctes> <select>``."""
    parts = [ALL_SOURCES] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n" + select
