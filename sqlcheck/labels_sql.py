"""DuckDB oracles of the file catalog and the label operators."""

from __future__ import annotations

from sqlcheck.features_sql import BACKFILL_DATES, features_sql
from sqlcheck.fixture_sql import with_sources

LATEST_FILES = """
ranked AS (
  SELECT Datum, DateiID, CASE WHEN DateiName LIKE 'comdirect_U-%' THEN 'U' ELSE 'B' END AS kind,
         ROW_NUMBER() OVER (PARTITION BY Datum, CASE WHEN DateiName LIKE 'comdirect_U-%' THEN 'U' ELSE 'B' END
                            ORDER BY Pruefziffer DESC, DateiID DESC) AS rn
  FROM cd_datei WHERE (DateiName LIKE 'comdirect_U-%' OR DateiName LIKE 'comdirect_B-%') {cond})"""

LATEST_SELECT = """
SELECT Datum, MAX(CASE WHEN kind = 'U' THEN DateiID END) AS DateiID_U,
       MAX(CASE WHEN kind = 'B' THEN DateiID END) AS DateiID_B
FROM ranked WHERE rn = 1 GROUP BY Datum"""

EVENTS = """
events AS (
  SELECT DISTINCT Depotnummer, Orderdatum AS event_date FROM cd_order WHERE Depotnummer IS NOT NULL
  UNION
  SELECT Kontoreferenz, Buchungdatum FROM cd_buchung
  WHERE Betrag > 0 AND Kontoreferenz IS NOT NULL AND Buchungdatum IS NOT NULL
  GROUP BY Kontoreferenz, Buchungdatum
  HAVING SUM(CAST(round(Betrag * 10000) AS BIGINT)) >= 1000000)"""


def _label_select(rows: str, horizons) -> str:
    cols = ", ".join(
        f"CAST(EXISTS (SELECT 1 FROM events e WHERE e.Depotnummer = r.Depotnummer "
        f"AND e.event_date BETWEEN r.stichtag + 1 AND r.stichtag + {h}) AS INTEGER) AS label_invest_T{h}"
        for h in horizons)
    return f"SELECT r.Depotnummer, r.stichtag, {cols} FROM ({rows}) r"


SPINE_ROWS = "SELECT Depotnummer, Score_Datum AS stichtag FROM spine"

EFFECTIVE_BUYS = """
storno AS (
  SELECT DISTINCT Transaktionsnummer AS tx FROM cd_order
  WHERE lower(Bemerkung) LIKE '%storn%' AND Transaktionsnummer IS NOT NULL {storno_cond}),
buys AS (
  SELECT b.Depotnummer, b.Orderdatum FROM cd_order b
  WHERE b.ISIN = 'DE000A14UWW2' AND b.Ordertyp = 'Ankauf' AND abs(coalesce(b.Cashflow, 0.0)) >= 1000 {buy_cond}
    AND NOT EXISTS (SELECT 1 FROM storno s WHERE s.tx = b.Transaktionsnummer))"""

WINDOW_BUYS = EFFECTIVE_BUYS.format(
    storno_cond="AND Orderdatum BETWEEN DATE '1999-08-01' - 60 AND DATE '2001-08-01' + 30 + 60",
    buy_cond="AND b.Orderdatum > DATE '1999-08-01' AND b.Orderdatum <= DATE '2001-08-01' + 30")
ALL_BUYS = EFFECTIVE_BUYS.format(storno_cond="", buy_cond="")


def label_oracles() -> dict[str, str]:
    extra = {"first_buy_features": first_buy_feature_oracle(),
             "first_buy_features_backfill": first_buy_backfill_oracle()}
    return {**extra, **_label_oracles()}


def _label_oracles() -> dict[str, str]:
    first_buy = ("SELECT Depotnummer, MIN(Orderdatum) AS first_buy_date FROM buys GROUP BY Depotnummer")
    return {
        "file_pick_latest": with_sources(LATEST_FILES.format(cond=""), select=LATEST_SELECT),
        "file_pick_checked": with_sources(LATEST_FILES.format(cond="AND Pruefziffer > 0"), select=LATEST_SELECT),
        "asof_dates_complete": features_sql(BACKFILL_DATES, select="SELECT as_of FROM dates"),
        "dates_missing_in_target": features_sql(
            BACKFILL_DATES, select="SELECT as_of FROM dates WHERE as_of NOT IN (SELECT DISTINCT Datum FROM cd_saldo)"),
        "investment_events": with_sources(EVENTS, select="SELECT Depotnummer, event_date FROM events"),
        "label_invest": features_sql(BACKFILL_DATES, extra_ctes=(EVENTS,),
                                     select=_label_select(SPINE_ROWS, (7, 14))),
        "upsert_labels": features_sql(
            BACKFILL_DATES, extra_ctes=(
                EVENTS,
                "ex AS (" + _label_select(SPINE_ROWS + " WHERE Score_Datum < DATE '2000-08-01'", (7,)) + ")",
                "nw AS (" + _label_select(SPINE_ROWS + " WHERE Score_Datum >= DATE '2000-02-01'", (14,)) + ")"),
            select="SELECT coalesce(ex.Depotnummer, nw.Depotnummer) AS Depotnummer, "
                   "coalesce(ex.stichtag, nw.stichtag) AS stichtag, ex.label_invest_T7, nw.label_invest_T14 "
                   "FROM ex FULL OUTER JOIN nw ON ex.Depotnummer = nw.Depotnummer AND ex.stichtag = nw.stichtag"),
        "first_target_buy": with_sources(WINDOW_BUYS, select=first_buy),
        "pre_first_target": features_sql(
            extra_ctes=(ALL_BUYS, "fb AS (SELECT Depotnummer, MIN(Orderdatum) AS First_Target_Buy FROM buys "
                                  "GROUP BY Depotnummer)"),
            select="SELECT s.Depotnummer, s.Score_Datum, fb.First_Target_Buy, "
                   "CAST(fb.First_Target_Buy IS NULL OR fb.First_Target_Buy > s.Score_Datum AS INTEGER) "
                   "AS Pre_First_Target FROM spine s LEFT JOIN fb ON fb.Depotnummer = s.Depotnummer"),
        "label_first_buy": features_sql(
            BACKFILL_DATES,
            extra_ctes=(ALL_BUYS,
                        "fb_all AS (SELECT Depotnummer, MIN(Orderdatum) AS ftb FROM buys GROUP BY Depotnummer)",
                        WINDOW_BUYS.replace("storno AS", "storno_w AS").replace("FROM storno s", "FROM storno_w s")
                        .replace("buys AS", "buys_w AS"),
                        "fbw AS (SELECT Depotnummer, MIN(Orderdatum) AS first_buy_date FROM buys_w GROUP BY Depotnummer)",
                        "lrows AS (SELECT s.Depotnummer, s.Score_Datum AS Stichtag FROM spine s "
                        "LEFT JOIN fb_all f ON f.Depotnummer = s.Depotnummer "
                        "WHERE (f.ftb IS NULL OR f.ftb > s.Score_Datum) "
                        "AND s.Score_Datum BETWEEN DATE '1999-08-01' AND DATE '2001-08-01')"),
            select="SELECT r.Depotnummer, r.Stichtag, w.first_buy_date, "
                   + ", ".join(f"CAST(w.first_buy_date IS NOT NULL AND w.first_buy_date > r.Stichtag AND "
                               f"w.first_buy_date <= r.Stichtag + {h} AS INTEGER) AS label_T{h}" for h in (7, 14, 30))
                   + " FROM lrows r LEFT JOIN fbw w ON w.Depotnummer = r.Depotnummer"),
    }


EFF_BUYS = """
storno_all AS (SELECT DISTINCT Transaktionsnummer AS tx FROM cd_order
               WHERE lower(Bemerkung) LIKE '%storn%' AND Transaktionsnummer IS NOT NULL),
eb AS (SELECT b.Depotnummer, b.Orderdatum, b.ISIN, abs(b.Cashflow) AS ticket FROM cd_order b
       WHERE b.Ordertyp = 'Ankauf' AND abs(coalesce(b.Cashflow, 0.0)) >= 1000 AND b.Orderdatum <= DATE '2001-08-01'
         AND NOT EXISTS (SELECT 1 FROM storno_all s WHERE s.tx = b.Transaktionsnummer)),
fbuys AS (SELECT Depotnummer, COUNT(*) FILTER (WHERE Orderdatum >= DATE '2001-08-01' - 7) AS b7,
            COUNT(*) FILTER (WHERE Orderdatum >= DATE '2001-08-01' - 30) AS b30, MAX(Orderdatum) AS lb,
            SUM(CASE WHEN Orderdatum >= DATE '2001-08-01' - 90 THEN CAST(round_even(ticket * 10000, 0) AS BIGINT) END) AS t90,
            COUNT(*) FILTER (WHERE Orderdatum >= DATE '2001-08-01' - 90) AS n90
          FROM eb GROUP BY Depotnummer),
frefs AS (SELECT Depotnummer, COUNT(*) FILTER (WHERE fst >= DATE '2001-08-01' - 90) AS nr
          FROM (SELECT Depotnummer, ISIN, MIN(Orderdatum) AS fst FROM eb GROUP BY Depotnummer, ISIN)
          GROUP BY Depotnummer),
fact AS (SELECT Depotnummer,
            SUM(CASE WHEN Orderdatum >= DATE '2001-08-01' - 90 THEN CAST(round_even(abs(Cashflow) * 10000, 0) AS BIGINT) END) AS v90,
            COUNT(*) FILTER (WHERE Orderdatum >= DATE '2001-08-01' - 30) AS o30,
            COUNT(*) FILTER (WHERE Orderdatum >= DATE '2001-08-01' - 30 AND coalesce(lower(Bemerkung) LIKE '%storn%', false)) AS c30
         FROM cd_order WHERE Orderdatum <= DATE '2001-08-01' GROUP BY Depotnummer),
ftb AS (SELECT Depotnummer, MIN(Orderdatum) AS First_Target_Buy FROM buys GROUP BY Depotnummer)"""

FIRST_BUY_FEATURES_SELECT = """
SELECT f.Depotnummer, f.Score_Datum, CAST(coalesce(b.b7, 0) AS BIGINT) AS Buys_7d, CAST(coalesce(b.b30, 0) AS BIGINT) AS Buys_30d,
  CAST(coalesce(date_diff('day', b.lb, f.Score_Datum), 0) AS BIGINT) AS Last_Buy_Days,
  CASE WHEN b.n90 > 0 THEN CAST(b.t90 AS DOUBLE) / b.n90 / 10000.0 ELSE 0.0 END AS Avg_Ticket_90d,
  round(f.Cash_abs, 6) AS Cash, round(f.Cashquote_true, 6) AS Cash_Ratio, round(f.Einzahlung_30d_eff, 6) AS Deposit_30d_eff,
  round(CASE WHEN f.Depotwert > 0 THEN CAST(coalesce(a.v90, 0) AS DOUBLE) / 10000.0 / f.Depotwert ELSE 0.0 END, 6) AS Turnover,
  f.Pos_Count, CAST(coalesce(r.nr, 0) AS BIGINT) AS NewRefs_90d,
  round(CASE WHEN a.o30 > 0 THEN a.c30 / a.o30 ELSE 0.0 END, 6) AS CancelRate_30d,
  CAST(t.First_Target_Buy IS NULL OR t.First_Target_Buy > f.Score_Datum AS INTEGER) AS Pre_First_Target,
  t.First_Target_Buy
FROM feat f LEFT JOIN fbuys b ON b.Depotnummer = f.Depotnummer LEFT JOIN frefs r ON r.Depotnummer = f.Depotnummer
LEFT JOIN fact a ON a.Depotnummer = f.Depotnummer LEFT JOIN ftb t ON t.Depotnummer = f.Depotnummer"""


def first_buy_feature_oracle() -> str:
    return features_sql(extra_ctes=(ALL_BUYS, EFF_BUYS), select=FIRST_BUY_FEATURES_SELECT)


def first_buy_backfill_oracle() -> str:
    """The same definitions for every (depot, date): each order is joined to the dates at or after it."""
    eff = """
storno_all AS (SELECT DISTINCT Transaktionsnummer AS tx FROM cd_order
               WHERE lower(Bemerkung) LIKE '%storn%' AND Transaktionsnummer IS NOT NULL),
eb AS (SELECT b.Depotnummer, b.Orderdatum, b.ISIN, abs(b.Cashflow) AS ticket FROM cd_order b
       WHERE b.Ordertyp = 'Ankauf' AND abs(coalesce(b.Cashflow, 0.0)) >= 1000
         AND NOT EXISTS (SELECT 1 FROM storno_all s WHERE s.tx = b.Transaktionsnummer)),
fbuys AS (SELECT e.Depotnummer, d.as_of, COUNT(*) FILTER (WHERE e.Orderdatum >= d.as_of - 7) AS b7,
            COUNT(*) FILTER (WHERE e.Orderdatum >= d.as_of - 30) AS b30, MAX(e.Orderdatum) AS lb,
            SUM(CASE WHEN e.Orderdatum >= d.as_of - 90 THEN CAST(round_even(ticket * 10000, 0) AS BIGINT) END) AS t90,
            COUNT(*) FILTER (WHERE e.Orderdatum >= d.as_of - 90) AS n90
          FROM eb e JOIN dates d ON e.Orderdatum <= d.as_of GROUP BY e.Depotnummer, d.as_of),
frefs AS (SELECT Depotnummer, d.as_of, COUNT(*) FILTER (WHERE fst >= d.as_of - 90) AS nr
          FROM (SELECT Depotnummer, ISIN, MIN(Orderdatum) AS fst FROM eb GROUP BY Depotnummer, ISIN) x
          JOIN dates d ON x.fst <= d.as_of GROUP BY Depotnummer, d.as_of),
fact AS (SELECT o.Depotnummer, d.as_of,
            SUM(CASE WHEN Orderdatum >= d.as_of - 90 THEN CAST(round_even(abs(Cashflow) * 10000, 0) AS BIGINT) END) AS v90,
            COUNT(*) FILTER (WHERE Orderdatum >= d.as_of - 30) AS o30,
            COUNT(*) FILTER (WHERE Orderdatum >= d.as_of - 30 AND coalesce(lower(Bemerkung) LIKE '%storn%', false)) AS c30
         FROM cd_order o JOIN dates d ON o.Orderdatum <= d.as_of GROUP BY o.Depotnummer, d.as_of),
ftb AS (SELECT Depotnummer, MIN(Orderdatum) AS First_Target_Buy FROM buys GROUP BY Depotnummer)"""
    select = FIRST_BUY_FEATURES_SELECT
    for t, alias in (("fbuys", "b"), ("frefs", "r"), ("fact", "a")):
        select = select.replace(f"LEFT JOIN {t} {alias} ON {alias}.Depotnummer = f.Depotnummer",
                                f"LEFT JOIN {t} {alias} ON {alias}.Depotnummer = f.Depotnummer AND {alias}.as_of = f.Score_Datum")
    return features_sql(BACKFILL_DATES, extra_ctes=(ALL_BUYS, eff), select=select)
