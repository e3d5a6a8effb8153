"""DuckDB oracles of the data-quality operators."""

from __future__ import annotations

from sqlcheck.features_sql import BACKFILL_DATES, features_sql
from sqlcheck.fixture_sql import with_sources
from sqlcheck.labels_sql import label_oracles
from sqlcheck.rules_sql import _rules_sql, READINESS_CTE

NUMERIC_FEATURES = (
    "Inaktiv_seit_Kauf", "Last_Buy_Days", "Last_Trade_Days", "Einzahlung_30d", "Einzahlung_90d", "Sparplan_Klein",
    "Einzahlung_30d_eff", "Auszahlung_30d", "Auszahlung_90d", "Nettoflow_30d", "Nettoflow_90d",
    "Sparplan_Strength_6m", "Deposit_Volatility_6m", "Last_Cashflow_Days", "Orderfrequenz", "Orderfrequenz_30d",
    "Orderfrequenz_90d", "ØOrdervolumen", "ØOrdervolumen_30d", "ØOrdervolumen_90d", "TechAffin",
    "Cash_over_bestand", "Cashquote_true", "Cash_abs", "Bestandwert", "Depotwert", "Pos_Count", "ZeroPos",
    "Wertlos_Flag", "HHI_Concentration", "DeepLossShare_50", "WinLoss_Skew", "TechWeight", "Cashquote",
    "Aktienquote", "Activity_Months_6m", "Streak_Inactive_Months", "DIY_FrequentSmall", "Inflow_Strength_30d")

DRIFT_SELECT = """
, per AS (
  SELECT f.Score_Datum, COUNT(*) AS Agg_Rows,
    quantile_cont("ØOrdervolumen_90d", 0.5) AS P50_Vol90d, quantile_cont("ØOrdervolumen_90d", 0.8) AS P80_Vol90d,
    quantile_cont(Cashquote_true, 0.5) AS P50_Cashquote, quantile_cont(Cashquote_true, 0.8) AS P80_Cashquote
  FROM feat f GROUP BY f.Score_Datum),
sc AS (SELECT Score_Datum, quantile_cont(InvestScore, 0.5) AS P50_InvestScore,
              quantile_cont(InvestScore, 0.8) AS P80_InvestScore FROM ready GROUP BY Score_Datum),
lagged AS (
  SELECT p.*, s.P50_InvestScore, s.P80_InvestScore,
    LAG(Agg_Rows) OVER w AS Rowcount_Prev,
    LAG(P50_Vol90d) OVER w AS P50_Vol90d_Prev, LAG(P80_Vol90d) OVER w AS P80_Vol90d_Prev,
    LAG(P50_Cashquote) OVER w AS P50_Cashquote_Prev, LAG(P80_Cashquote) OVER w AS P80_Cashquote_Prev,
    LAG(s.P50_InvestScore) OVER w AS P50_InvestScore_Prev, LAG(s.P80_InvestScore) OVER w AS P80_InvestScore_Prev
  FROM per p JOIN sc s ON s.Score_Datum = p.Score_Datum
  WINDOW w AS (ORDER BY p.Score_Datum)),
fl AS (
  SELECT *,
    CASE WHEN Rowcount_Prev > 0 THEN (Agg_Rows - Rowcount_Prev) / Rowcount_Prev * 100.0 END AS Rowcount_Delta_Pct,
    abs(P80_Vol90d - P80_Vol90d_Prev) / P80_Vol90d_Prev * 100.0 AS vol_pct,
    abs(P80_InvestScore - P80_InvestScore_Prev) / P80_InvestScore_Prev * 100.0 AS sc_pct,
    abs(P80_Cashquote - P80_Cashquote_Prev) AS cash_abs
  FROM lagged),
fl2 AS (
  SELECT *,
    coalesce(abs(Rowcount_Delta_Pct) > 2.0, false) AS f_rows,
    coalesce(P80_Vol90d_Prev <> 0 AND P80_Vol90d <> 0 AND P80_Vol90d_Prev > 0 AND vol_pct > 30.0, false) AS f_vol,
    coalesce(cash_abs > 0.1, false) AS f_cash,
    coalesce(P80_InvestScore_Prev <> 0 AND P80_InvestScore <> 0 AND P80_InvestScore_Prev > 0 AND sc_pct > 25.0, false) AS f_score
  FROM fl)
SELECT Score_Datum AS Log_Datum, Agg_Rows, Rowcount_Prev, round(Rowcount_Delta_Pct, 6) AS Rowcount_Delta_Pct,
  round(P50_Vol90d, 6) AS P50_Vol90d, round(P80_Vol90d, 6) AS P80_Vol90d,
  round(P50_Vol90d_Prev, 6) AS P50_Vol90d_Prev, round(P80_Vol90d_Prev, 6) AS P80_Vol90d_Prev,
  round(P50_Cashquote, 6) AS P50_Cashquote, round(P80_Cashquote, 6) AS P80_Cashquote,
  round(P50_Cashquote_Prev, 6) AS P50_Cashquote_Prev, round(P80_Cashquote_Prev, 6) AS P80_Cashquote_Prev,
  round(P50_InvestScore, 6) AS P50_InvestScore, round(P80_InvestScore, 6) AS P80_InvestScore,
  round(P50_InvestScore_Prev, 6) AS P50_InvestScore_Prev, round(P80_InvestScore_Prev, 6) AS P80_InvestScore_Prev,
  CAST(f_rows OR f_vol OR f_cash OR f_score AS INTEGER) AS Drift_Flag,
  nullif(concat_ws('; ',
    CASE WHEN f_rows THEN printf('Rowcount drift %.2f%% > 2.0%%', Rowcount_Delta_Pct) END,
    CASE WHEN f_vol THEN printf('P80 Vol90d drift %.1f%% > 30.0%%', vol_pct) END,
    CASE WHEN f_cash THEN printf('P80 Cashquote drift %.2f > 0.1', cash_abs) END,
    CASE WHEN f_score THEN printf('P80 InvestScore drift %.1f%% > 25.0%%', sc_pct) END), '') AS Notes
FROM fl2"""

FLOW_ALT = """CASE
    WHEN contains(t, 'einlage') OR contains(t, 'eingang') OR contains(t, 'überweisung') OR contains(t, 'ueberweisung') THEN 'in'
    WHEN contains(t, 'entnahme') OR contains(t, 'ausgang') OR contains(t, 'auszahlung') THEN 'out'
    WHEN contains(t, 'zins') OR contains(t, 'gebühr') OR contains(t, 'gebuehr') OR contains(t, 'entgelt') OR contains(t, 'spesen') THEN 'fee_out'
    WHEN contains(t, 'steuer') OR contains(t, 'steuerr') THEN 'tax_in'
    WHEN contains(t, 'ertrag') OR starts_with(t, 'div') THEN 'yield_in'
    ELSE 'ignore' END"""

RECONCILE = """
rb AS (SELECT Kontoreferenz, Valutadatum AS v, CAST(round(coalesce(Betrag, 0.0) * 10000) AS BIGINT) AS u,
              """ + FLOW_ALT.replace("(t,", "(lower(coalesce(Buchungtyp, '')),") + """ AS k
       FROM cd_buchung WHERE Valutadatum <= DATE '2001-08-01'),
rf AS (SELECT Kontoreferenz AS Depotnummer,
         SUM(CASE WHEN k = 'in' AND v >= DATE '2001-08-01' - 30 THEN u END) AS i30,
         SUM(CASE WHEN k IN ('out', 'fee_out') AND v >= DATE '2001-08-01' - 30 THEN u END) AS o30,
         SUM(CASE WHEN k = 'in' AND v >= DATE '2001-08-01' - 90 THEN u END) AS i90,
         SUM(CASE WHEN k IN ('out', 'fee_out') AND v >= DATE '2001-08-01' - 90 THEN u END) AS o90
       FROM rb GROUP BY Kontoreferenz),
rc AS (SELECT Kontoreferenz AS Depotnummer, SUM(CAST(round(Saldosollwert * 10000) AS BIGINT)) AS cu
       FROM cd_saldo WHERE Datum = DATE '2001-08-01' GROUP BY Kontoreferenz),
rv AS (SELECT Depotreferenz AS Depotnummer, SUM(CAST(round(coalesce(Kurswert, 0.0) * 10000) AS BIGINT)) AS vu
       FROM cd_bestand WHERE Datum = DATE '2001-08-01' GROUP BY Depotreferenz),
rr AS (
  SELECT f.Depotnummer, f.Score_Datum, f.Einzahlung_30d, f.Auszahlung_30d, f.Nettoflow_30d, f.Einzahlung_90d,
    f.Auszahlung_90d, f.Nettoflow_90d, f.Cashquote,
    coalesce(i30, 0) / 10000.0 AS inflow_30_sql, coalesce(o30, 0) / 10000.0 AS outflow_30_sql,
    (coalesce(i30, 0) - coalesce(o30, 0)) / 10000.0 AS netto_30_sql,
    coalesce(i90, 0) / 10000.0 AS inflow_90_sql, coalesce(o90, 0) / 10000.0 AS outflow_90_sql,
    (coalesce(i90, 0) - coalesce(o90, 0)) / 10000.0 AS netto_90_sql,
    coalesce(cu, 0) / 10000.0 AS cash_abs_sql,
    (coalesce(cu, 0) / 10000.0) / (coalesce(vu, 0) / 10000.0 + 1e-6) AS cashquote_sql
  FROM feat f LEFT JOIN rf USING (Depotnummer) LEFT JOIN rc USING (Depotnummer) LEFT JOIN rv USING (Depotnummer))"""


def _reconcile_select() -> str:
    base = ["Einzahlung_30d", "Auszahlung_30d", "Nettoflow_30d", "Einzahlung_90d", "Auszahlung_90d", "Nettoflow_90d",
            "Cashquote", "inflow_30_sql", "outflow_30_sql", "netto_30_sql", "inflow_90_sql", "outflow_90_sql",
            "netto_90_sql", "cash_abs_sql", "cashquote_sql"]
    pairs = [("inflow_30", "Einzahlung_30d"), ("outflow_30", "Auszahlung_30d"), ("netto_30", "Nettoflow_30d"),
             ("inflow_90", "Einzahlung_90d"), ("outflow_90", "Auszahlung_90d"), ("netto_90", "Nettoflow_90d"),
             ("cashquote", "Cashquote")]
    # The cash ratio over an empty portfolio is cash / 1e-6; those values
    # (and their differences) are compared unrounded (identical operations).
    cols = [f"round({c}, 4) AS {c}" if c != "cashquote_sql" else c for c in base]
    cols += [f'round({k}_sql - {c}, 4) AS "Δ_{k}"' if k != "cashquote" else f'{k}_sql - {c} AS "Δ_{k}"'
             for k, c in pairs]
    return "SELECT Depotnummer, Score_Datum, " + ", ".join(cols) + " FROM rr"


def _feature_audit() -> str:
    cols = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in NUMERIC_FEATURES)
    names = ", ".join(f'"{c}"' for c in NUMERIC_FEATURES)
    return f"""
, fa0 AS (SELECT {cols} FROM feat),
fa AS (SELECT * FROM fa0 UNPIVOT INCLUDE NULLS (v FOR column_name IN ({names}))),
st AS (SELECT column_name, COUNT(v) AS n, COUNT(*) FILTER (WHERE v IS NULL) AS nulls, MIN(v) AS mn, MAX(v) AS mx,
              AVG(v) AS mean, stddev_samp(v) AS std FROM fa GROUP BY column_name),
ot AS (SELECT a.column_name, COUNT(*) FILTER (WHERE abs(a.v - s.mean) > 3.0 * s.std) AS outliers_z3
       FROM fa a JOIN st s ON s.column_name = a.column_name GROUP BY a.column_name),
dup AS (SELECT COUNT(*) AS d FROM (SELECT Depotnummer, Score_Datum FROM feat GROUP BY 1, 2 HAVING COUNT(*) > 1))
SELECT s.column_name, s.n, s.nulls, round(s.mn, 6) AS min, round(s.mx, 6) AS max, round(s.mean, 4) AS mean,
  round(s.std, 4) AS std, o.outliers_z3, CAST(s.mn = s.mx AS INTEGER) AS is_constant, dup.d AS duplicate_keys
FROM st s JOIN ot o ON o.column_name = s.column_name JOIN dup ON TRUE"""


LOCAL_TEXT = ("loc AS (SELECT c_custkey, translate(format('{:,.2f}', c_acctbal), ',.', '.,') AS acctbal_text, "
              "c_name FROM customer)")


def _parse(x: str) -> str:
    return (f"TRY_CAST(replace(regexp_replace(regexp_replace(trim(CAST({x} AS VARCHAR)), '\\s+', '', 'g'), "
            f"'\\.', '', 'g'), ',', '.') AS DOUBLE)")


TWO_DAYS = "dates AS (SELECT DATE '2001-07-31' AS as_of UNION ALL SELECT DATE '2001-08-01')"


def _validation_log() -> str:
    drift = DRIFT_SELECT.replace("\n, per AS", ",\nper AS", 1)
    head, tail = drift.split("SELECT Score_Datum AS Log_Datum", 1)
    body = head + ", dr AS (SELECT Score_Datum AS Log_Datum" + tail + """),
n1 AS (SELECT Score_Datum, COUNT(*) AS n FROM ready GROUP BY 1), n2 AS (SELECT Score_Datum, COUNT(*) AS n FROM gscore GROUP BY 1),
n3 AS (SELECT Score_Datum, COUNT(*) AS n FROM seg GROUP BY 1),
nl AS (SELECT Score_Datum, COUNT(*) AS n, COUNT(*) FILTER (WHERE Next_Action = 'Call') AS c,
              COUNT(*) FILTER (WHERE Next_Action = 'Email') AS e FROM leads GROUP BY 1),
cv AS (SELECT d.*, coalesce(n1.n, 0) AS IB_Rows, coalesce(n2.n, 0) AS SC_Rows, coalesce(n3.n, 0) AS SEG_Rows,
              coalesce(nl.n, 0) AS Leads_Rows, coalesce(nl.c, 0) AS Leads_Call, coalesce(nl.e, 0) AS Leads_Email,
              coalesce(nl.n, 0) / d.Agg_Rows * 100.0 AS rate
       FROM dr d LEFT JOIN n1 ON n1.Score_Datum = d.Log_Datum LEFT JOIN n2 ON n2.Score_Datum = d.Log_Datum
       LEFT JOIN n3 ON n3.Score_Datum = d.Log_Datum LEFT JOIN nl ON nl.Score_Datum = d.Log_Datum)
SELECT * EXCLUDE (rate, Drift_Flag, Notes), round(rate, 6) AS Lead_Rate_Pct, CAST(rate < 5.0 AS INTEGER) AS Coverage_Flag,
  greatest(Drift_Flag, CAST(rate < 5.0 AS INTEGER)) AS Drift_Flag,
  nullif(concat_ws('; ', Notes, CASE WHEN rate < 5.0 THEN printf('Lead rate %.2f%% < 5.0%%', rate) END), '') AS Notes
FROM cv"""
    return _rules_sql("SELECT 1", TWO_DAYS).replace("\nSELECT 1", body)


def _table_monitor() -> str:
    cols = ("Einzahlung_30d", "Cashquote_true", "Depotwert", "HHI_Concentration")
    parts = [f"SELECT Score_Datum, '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM feat" for c in cols]
    parts.append("SELECT Score_Datum, 'InvestScore', CAST(InvestScore AS DOUBLE) FROM ready")
    return features_sql(BACKFILL_DATES, extra_ctes=(READINESS_CTE, "lg AS (" + " UNION ALL ".join(parts) + ")", """
m0 AS (SELECT Score_Datum, column_name, COUNT(*) AS n, AVG(v) AS mean, AVG(CAST(v IS NULL AS DOUBLE)) AS null_share
       FROM lg GROUP BY ALL),
m1 AS (SELECT *, median(mean) OVER (PARTITION BY column_name ORDER BY Score_Datum RANGE BETWEEN INTERVAL 14 DAYS PRECEDING
                                    AND INTERVAL 1 DAYS PRECEDING) AS median_prev FROM m0)"""), select="""
SELECT Score_Datum, column_name, n, round(mean, 4) AS mean, round(null_share, 4) AS null_share, round(median_prev, 4) AS median_prev,
  CAST(coalesce(median_prev <> 0 AND abs(mean - median_prev) > 0.5 * abs(median_prev), false) AS INTEGER) AS mean_flag,
  CAST(null_share > 0.98 AS INTEGER) AS null_flag
FROM m1""")


def _correlations() -> str:
    cols = ("Orderfrequenz", "Orderfrequenz_90d", "Depotwert", "Bestandwert", "Cash_abs", "Pos_Count", "Einzahlung_90d", "Sparplan_Klein")
    val = "coalesce(CAST({} AS DOUBLE), 0.0)".format
    return features_sql(select=" UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(nullif(c, 'nan'::DOUBLE), 6) AS correlation, "
        f"CAST(coalesce(abs(nullif(c, 'nan'::DOUBLE)) >= 0.9, false) AS INTEGER) AS high "
        f"FROM (SELECT corr({val(a)}, {val(b)}) AS c FROM feat)"
        for i, a in enumerate(cols) for b in cols[i + 1:]))


def quality_oracles() -> dict[str, str]:
    lfb = label_oracles()["label_first_buy"]
    return {
        "qc_ranges": features_sql(BACKFILL_DATES, select="""
SELECT Score_Datum,
  COUNT(*) FILTER (WHERE Cashquote_true < 0 OR Cashquote_true > 1) AS Cashquote_true_out_of_range,
  COUNT(*) FILTER (WHERE Cashquote < 0 OR Cashquote > 1) AS Cashquote_out_of_range,
  COUNT(*) FILTER (WHERE Last_Buy_Days < 0) AS Last_Buy_Days_negative,
  COUNT(*) FILTER (WHERE Last_Trade_Days < 0) AS Last_Trade_Days_negative,
  COUNT(*) FILTER (WHERE Last_Cashflow_Days < 0) AS Last_Cashflow_Days_negative
FROM feat GROUP BY Score_Datum"""),
        "qc_drift": features_sql(BACKFILL_DATES, extra_ctes=(READINESS_CTE,), select="SELECT 1")
        .replace("\nSELECT 1", DRIFT_SELECT.replace("\n, per AS", ",\nper AS", 1)),
        "qc_lead_coverage": _rules_sql("""
SELECT a.Score_Datum, a.Agg_Rows, coalesce(l.r, 0) AS Leads_Rows, coalesce(l.c, 0) AS Leads_Call,
  coalesce(l.e, 0) AS Leads_Email, round(coalesce(l.r, 0) / a.Agg_Rows * 100.0, 6) AS Lead_Rate_Pct,
  CASE WHEN a.Agg_Rows > 0 THEN CAST(coalesce(l.r, 0) / a.Agg_Rows * 100.0 < 5.0 AS INTEGER) ELSE 0 END AS Coverage_Flag
FROM (SELECT Score_Datum, COUNT(*) AS Agg_Rows FROM feat GROUP BY Score_Datum) a
LEFT JOIN (SELECT Score_Datum, COUNT(*) AS r, COUNT(*) FILTER (WHERE Next_Action = 'Call') AS c,
           COUNT(*) FILTER (WHERE Next_Action = 'Email') AS e FROM leads GROUP BY Score_Datum) l
  ON l.Score_Datum = a.Score_Datum"""),
        "qc_daily_monitor": "WITH lfb AS (" + lfb + """),
pd0 AS (SELECT Stichtag, COUNT(*) AS n, AVG(CAST(label_T7 AS DOUBLE)) AS pos_rate_T7,
          AVG(CAST(label_T14 AS DOUBLE)) AS pos_rate_T14, AVG(CAST(label_T30 AS DOUBLE)) AS pos_rate_T30,
          AVG(CAST(first_buy_date IS NULL AS DOUBLE)) AS null_share FROM lfb GROUP BY Stichtag),
pd1 AS (SELECT *, median(pos_rate_T30) OVER (ORDER BY Stichtag RANGE BETWEEN INTERVAL 14 DAYS PRECEDING
                                             AND INTERVAL 1 DAYS PRECEDING) AS median_prev FROM pd0)
SELECT Stichtag, n, round(pos_rate_T7, 6) AS pos_rate_T7, round(pos_rate_T14, 6) AS pos_rate_T14,
  round(pos_rate_T30, 6) AS pos_rate_T30, round(null_share, 6) AS null_share, round(median_prev, 6) AS median_prev,
  CAST(coalesce(median_prev > 0 AND abs(pos_rate_T30 - median_prev) / median_prev > 0.5, false) AS INTEGER) AS rate_flag,
  CAST(null_share > 0.98 AS INTEGER) AS null_flag
FROM pd1""",
        "validation_log": _validation_log(),
        "qc_table_monitor": _table_monitor(),
        "flow_reconcile": features_sql(extra_ctes=(RECONCILE,), select=_reconcile_select()),
        "feature_audit": features_sql(select="SELECT 1").replace("\nSELECT 1", _feature_audit()),
        "feature_correlations": _correlations(),
        "localized_numbers": with_sources(LOCAL_TEXT, select=(
            f"SELECT c_custkey, acctbal_text, {_parse('acctbal_text')} AS acctbal, "
            f"{_parse('c_name')} AS name_as_number FROM loc")),
        "numeric_column_coverage": with_sources(LOCAL_TEXT, select=(
            f"SELECT 'acctbal_text' AS column_name, round(AVG(CAST({_parse('acctbal_text')} IS NOT NULL AS DOUBLE)), 6) "
            f"AS parse_rate, CAST(AVG(CAST({_parse('acctbal_text')} IS NOT NULL AS DOUBLE)) >= 0.7 AS INTEGER) AS kept "
            f"FROM loc UNION ALL "
            f"SELECT 'c_name', round(AVG(CAST({_parse('c_name')} IS NOT NULL AS DOUBLE)), 6), "
            f"CAST(AVG(CAST({_parse('c_name')} IS NOT NULL AS DOUBLE)) >= 0.7 AS INTEGER) FROM loc")),
    }
