"""DuckDB oracles of the rule operators (score, readiness, alerts, segments, leads)."""

from __future__ import annotations

from sqlcheck.features_sql import SINGLE_DATE, features_sql, hu

GENERAL_SCORE_CTE = """
gs0 AS (
  SELECT Depotnummer, Score_Datum, months, coalesce(tech_cnt, 0) AS tech_cnt,
    CASE WHEN coalesce(n90, 0) > 0 THEN CAST(vol90 AS DOUBLE) / n90 / 10000.0 ELSE 0.0 END AS vol90d,
    least(greatest(coalesce(saldo / (saldo + psum + 1e-6), 0.0), 0.0), 1.0) AS cash,
    CASE WHEN aktie_exact IS NOT NULL AND psum <> 0 THEN aktie_exact / psum ELSE 0.0 END AS aktie,
    (coalesce(psum, 0.0) <= 1 AND coalesce(zero, 0) >= 1) AS wertlos,
    (coalesce(act6, 0) = 0) AS inactive,
    coalesce(n30, 0) AS f30, coalesce(n90, 0) AS f90
  FROM base),
gs1 AS (
  SELECT *, (CASE WHEN f30 >= 2 THEN 8 ELSE 0 END) + (CASE WHEN f90 >= 4 THEN 6 ELSE 0 END)
          + (CASE WHEN vol90d > 2000 THEN 2 ELSE 0 END)
          + (CASE WHEN cash >= 0.25 THEN 4 ELSE 0 END) + (CASE WHEN cash >= 0.50 THEN 2 ELSE 0 END)
          + (CASE WHEN tech_cnt > 0 THEN 4 ELSE 0 END)
          - (CASE WHEN wertlos THEN 5 ELSE 0 END) - (CASE WHEN inactive THEN 4 ELSE 0 END) AS raw
  FROM gs0),
gscore AS (
  SELECT Depotnummer, CAST(months AS BIGINT) AS Orderfrequenz,
    """ + hu("vol90d", 4) + """ AS "ØOrdervolumen",
    """ + hu("aktie", 6) + """ AS Aktienquote,
    """ + hu("cash", 6) + """ AS Cashquote,
    CAST(tech_cnt AS BIGINT) AS TechFokus,
    CAST(least(greatest(CASE WHEN wertlos AND inactive THEN least(raw, 12) ELSE raw END, 0), 100) AS BIGINT) AS Score,
    Score_Datum
  FROM gs1)"""

READINESS_CTE = """
ib0 AS (
  SELECT f.*,
    (CASE WHEN Cash_abs >= 1000 AND Cashquote_true >= 0.25 THEN 2 ELSE 0 END)
    + (CASE WHEN Cash_abs >= 3000 AND Cashquote_true >= 0.50 THEN 2 ELSE 0 END)
    + (CASE WHEN Einzahlung_30d_eff > 0 THEN 3 ELSE 0 END)
    + (CASE WHEN Inflow_Strength_30d >= 0.02 THEN 2 ELSE 0 END)
    + (CASE WHEN Last_Buy_Days <= 14 THEN 5 WHEN Last_Buy_Days <= 30 THEN 2 ELSE 0 END)
    + (CASE WHEN Orderfrequenz_30d >= 2 THEN 3 ELSE 0 END)
    + (CASE WHEN Orderfrequenz_90d >= 4 THEN 2 ELSE 0 END)
    + (CASE WHEN TechAffin >= 1 THEN 1 ELSE 0 END) AS pts,
    (CASE WHEN Activity_Months_6m = 0 AND Last_Trade_Days > 180 AND Einzahlung_90d = 0 AND Cash_abs < 100 THEN 6 ELSE 0 END)
    + (CASE WHEN Wertlos_Flag >= 1 THEN 5 ELSE 0 END)
    + (CASE WHEN DeepLossShare_50 >= 0.30 THEN 3 ELSE 0 END)
    + (CASE WHEN WinLoss_Skew <= -0.40 THEN 2 ELSE 0 END)
    + (CASE WHEN Activity_Months_6m = 0 AND Last_Cashflow_Days > 60 THEN 4 ELSE 0 END)
    + (CASE WHEN Nettoflow_30d < 0 THEN 2 ELSE 0 END) AS malus0
  FROM feat f),
ib1 AS (
  SELECT *, CASE WHEN Einzahlung_30d_eff >= 500 OR Last_Buy_Days <= 14 THEN greatest(0, malus0 - 3) ELSE malus0 END AS malus
  FROM ib0),
ib2 AS (
  SELECT *, CASE WHEN Wertlos_Flag >= 1 AND Activity_Months_6m = 0 THEN least(greatest(0, pts - malus), 12)
                 ELSE greatest(0, pts - malus) END AS s
  FROM ib1),
ready AS (
  SELECT Depotnummer,
    """ + hu("least(greatest(Cashquote_true, 0.0), 1.0)", 6) + """ AS Cashquote,
    """ + hu("Einzahlung_30d", 2) + """ AS Einzahlung_30d,
    Letzter_Kauf, Inaktiv_seit_Kauf, Orderfrequenz, TechAffin,
    """ + hu('"ØOrdervolumen"', 2) + """ AS "ØOrdervolumen",
    CAST(least(20, greatest(0, s)) AS BIGINT) AS InvestScore,
    Score_Datum
  FROM ib2)"""

ALERT_RULES = [
    ("INAKTIV_90T", "Keine Trades seit > 90 Tagen bei relevantem Depotvolumen", "WARN",
     "Last_Trade_Days > 90 AND Depotwert >= 1000"),
    ("CASH_40_NO_BUY_30D", "Hohe Cashquote (≥40%), aber keine Käufe in 30 Tagen", "INFO",
     "Cashquote_true >= 0.40 AND Last_Buy_Days > 30 AND Cash_abs >= 1000"),
    ("INFLOW_NO_BUY", "Hohe Einzahlung (≥5.000) ohne nachfolgenden Kauf", "WARN",
     "Einzahlung_30d_eff >= 5000 AND Last_Buy_Days > 20 AND Sparplan_Klein = 0"),
    ("INFLOW_NO_BUY_REL", "Einzahlung ≥5% des Depotwerts ohne nachfolgenden Kauf", "WARN",
     "(CASE WHEN Depotwert > 0 THEN Einzahlung_30d_eff / Depotwert ELSE 0.0 END) >= 0.05 AND Last_Buy_Days > 20 "
     "AND Sparplan_Klein = 0"),
    ("NETTO_ABFLUSS_30D", "Signifikanter Nettoabfluss in 30 Tagen", "WARN",
     "Nettoflow_30d <= -2000 OR (CASE WHEN Depotwert > 0 THEN Nettoflow_30d / Depotwert ELSE 0.0 END) <= -0.05"),
    ("WERTLOS_BEREINIGEN", "Wertlose Position(en) vorhanden; Cash verfügbar – Depot bereinigen?", "INFO",
     "Wertlos_Flag = 1 AND Cash_abs >= 500"),
    ("DEEPLOSS_ACTIVE", "Tiefe Verluste, aber zuletzt aktiv/Zufluss – gezielte Idee anbieten", "INFO",
     "DeepLossShare_50 >= 0.30 AND (Einzahlung_30d_eff > 0 OR Last_Buy_Days <= 14)"),
    ("REACTIVATED_CASHFLOW", "Nach Inaktivität wieder Cashflow in ≤7 Tagen", "INFO",
     "Activity_Months_6m = 0 AND Last_Cashflow_Days <= 7"),
    ("HOT_LEAD_SCORE", "Hohe Investitionsbereitschaft laut Score", "CRIT",
     "InvestScore >= 16 AND Cashquote_true >= 0.25"),
]


def _alerts_select() -> str:
    parts = []
    for code, text, sev, cond in ALERT_RULES:
        parts.append(f"SELECT Depotnummer, '{code}' AS Alert_Code, '{text}' AS Alert_Text, '{sev}' AS Severity, "
                     f"Score_Datum AS Alert_Datum, 'offen' AS Status FROM af WHERE {cond}")
    return "\nUNION\n".join(parts)


SEGMENT_CTE = """
cuts AS (
  SELECT Score_Datum,
    coalesce(quantile_cont("ØOrdervolumen_90d", 0.80) FILTER (WHERE "ØOrdervolumen_90d" > 0), 5000.0) AS vol_cut_90,
    greatest(coalesce(quantile_cont(Depotwert, 0.75) FILTER (WHERE Depotwert > 0), 25000.0), 25000.0) AS wealth_cut
  FROM feat GROUP BY Score_Datum),
sg0 AS (
  SELECT f.*, c.vol_cut_90, c.wealth_cut,
    least(greatest(coalesce(least(greatest(Cashquote_true, 0.0), 1.0),
                            CASE WHEN Depotwert > 0 THEN least(greatest(Cash_abs / Depotwert, 0.0), 1.0) END, 0.0), 0.0), 1.0) AS cq_eff,
    CASE WHEN Depotwert > 0 THEN Einzahlung_30d_eff / Depotwert ELSE 0.0 END AS rel_in
  FROM feat f JOIN cuts c ON c.Score_Datum = f.Score_Datum),
seg AS (
  SELECT Depotnummer, CASE
    WHEN Wertlos_Flag = 1 OR (Depotwert <= 1 AND Pos_Count > 0) THEN 'Bereinigen nötig'
    WHEN Streak_Inactive_Months >= 6 OR (Orderfrequenz_90d = 0 AND Orderfrequenz_30d = 0 AND Last_Trade_Days > 180
         AND Einzahlung_90d = 0) THEN 'Inaktiv'
    WHEN Activity_Months_6m <= 1 AND (Last_Cashflow_Days <= 7 OR Einzahlung_30d_eff > 0) THEN 'Reaktiviert'
    WHEN Depotwert >= wealth_cut AND (("ØOrdervolumen_90d" >= vol_cut_90 AND Last_Trade_Days <= 60)
         OR (Orderfrequenz_90d >= 4 AND Last_Trade_Days <= 60) OR Activity_Months_6m >= 3) THEN 'Vermögend aktiv'
    WHEN (cq_eff >= 0.40 AND Cash_abs >= 1000 AND Last_Buy_Days > 30) OR (rel_in >= 0.05 AND Last_Buy_Days > 20)
         THEN 'Cash-Ready'
    WHEN (Orderfrequenz_90d >= 10 OR Orderfrequenz_30d >= 8) AND Last_Trade_Days <= 60 THEN 'Trader'
    WHEN least(greatest(TechWeight, 0.0), 1.0) >= 0.30 AND Activity_Months_6m >= 2 THEN 'Tech-Affin'
    WHEN least(greatest(DeepLossShare_50, 0.0), 1.0) >= 0.30
         OR (cq_eff > 0.70 AND Orderfrequenz_30d = 0 AND Einzahlung_30d_eff > 0) THEN 'Vorsichtig'
    WHEN DIY_FrequentSmall = 1 OR Sparplan_Strength_6m >= 3 THEN 'DIY-Sparer'
    ELSE 'Standard' END AS Segment, Score_Datum
  FROM sg0)"""

LEADS_CTE = """
ld0 AS (
  SELECT f.Depotnummer, f.Score_Datum, f.Cash_abs, f.Last_Buy_Days, r.InvestScore, g.Score AS GeneralScore, s.Segment,
    CAST(coalesce(r.InvestScore, 0) AS DOUBLE) AS inv, CAST(coalesce(g.Score, 0) AS DOUBLE) AS gen,
    ((f.Cash_abs >= 1000 OR f.Einzahlung_30d_eff >= 300 OR f.Last_Buy_Days <= 21)
      AND (f.Activity_Months_6m > 0 OR f.Last_Trade_Days <= 270)) AS ready,
    coalesce(s.Segment, '') IN ('Vermoegend aktiv', 'Cash-Ready', 'Trader', 'Reaktiviert', 'Tech-Affin') AS allowed,
    f.Wertlos_Flag, f.Activity_Months_6m
  FROM feat f
  LEFT JOIN ready r ON r.Depotnummer = f.Depotnummer AND r.Score_Datum = f.Score_Datum
  LEFT JOIN gscore g ON g.Depotnummer = f.Depotnummer AND g.Score_Datum = f.Score_Datum
  LEFT JOIN seg s ON s.Depotnummer = f.Depotnummer AND s.Score_Datum = f.Score_Datum),
ld_rank AS (
  SELECT Score_Datum, inv, ROW_NUMBER() OVER (PARTITION BY Score_Datum ORDER BY inv DESC, Depotnummer) AS rn FROM ld0),
ld_thr AS (
  SELECT s.Score_Datum,
    CASE WHEN s.n >= 60 THEN least(s.q, k.kth) ELSE s.q END AS thr
  FROM (SELECT Score_Datum, COUNT(*) AS n, quantile_cont(inv, 0.99) AS q FROM ld0 GROUP BY Score_Datum) s
  LEFT JOIN (SELECT Score_Datum, MIN(inv) AS kth FROM ld_rank WHERE rn <= 60 GROUP BY Score_Datum) k
    ON k.Score_Datum = s.Score_Datum),
ld1 AS (
  SELECT l.*, (l.inv >= t.thr AND l.ready AND l.allowed) AS is_call
  FROM ld0 l JOIN ld_thr t ON t.Score_Datum = l.Score_Datum),
ld_calls AS (SELECT Score_Datum, COUNT(*) FILTER (WHERE is_call) AS calls FROM ld1 GROUP BY Score_Datum),
ld_promo AS (
  SELECT p.Depotnummer, p.Score_Datum FROM (
    SELECT Depotnummer, Score_Datum, ROW_NUMBER() OVER (PARTITION BY Score_Datum
      ORDER BY InvestScore DESC NULLS LAST, Cash_abs DESC NULLS LAST, Last_Buy_Days ASC NULLS LAST,
               GeneralScore DESC NULLS LAST, Depotnummer) AS prn
    FROM ld1 WHERE NOT is_call AND ready AND allowed) p
  JOIN ld_calls c ON c.Score_Datum = p.Score_Datum
  WHERE p.prn <= greatest(0, 60 - c.calls)),
leads AS (
  SELECT l.Depotnummer, l.Score_Datum, CAST(l.inv AS BIGINT) AS InvestScore, CAST(l.gen AS BIGINT) AS GeneralScore,
    l.inv * 0.6 + l.gen * 0.4 + (CASE WHEN l.Wertlos_Flag >= 1 THEN -5.0 ELSE 0.0 END)
      + (CASE WHEN l.Activity_Months_6m = 0 THEN -4.0 ELSE 0.0 END) AS CompositeScore,
    l.Segment,
    CASE WHEN l.is_call OR p.Depotnummer IS NOT NULL THEN 'Call' ELSE 'Email' END AS Next_Action,
    l.ready, l.Cash_abs
  FROM ld1 l LEFT JOIN ld_promo p ON p.Depotnummer = l.Depotnummer AND p.Score_Datum = l.Score_Datum)"""


def _rules_sql(select: str, dates: str = SINGLE_DATE) -> str:
    return features_sql(dates, select=select,
                        extra_ctes=(GENERAL_SCORE_CTE, READINESS_CTE,
                                    "af AS (SELECT f.*, r.InvestScore FROM feat f LEFT JOIN ready r "
                                    "ON r.Depotnummer = f.Depotnummer AND r.Score_Datum = f.Score_Datum)",
                                    SEGMENT_CTE, LEADS_CTE))


def rule_oracles() -> dict[str, str]:
    return {
        "general_score": _rules_sql("SELECT * FROM gscore"),
        "invest_readiness": _rules_sql("SELECT * FROM ready"),
        "alerts": _rules_sql(_alerts_select()),
        "segment_cutoffs": _rules_sql("SELECT Score_Datum, round(vol_cut_90, 6) AS vol_cut_90, "
                                      "round(wealth_cut, 6) AS wealth_cut FROM cuts"),
        "segments": _rules_sql("SELECT * FROM seg"),
        "segment_counts": _rules_sql("SELECT Score_Datum, Segment, COUNT(*) AS n FROM seg GROUP BY Score_Datum, Segment"),
        "leads": _rules_sql("SELECT Depotnummer, Score_Datum, InvestScore, GeneralScore, round(CompositeScore, 6) "
                            "AS CompositeScore, Segment, Next_Action FROM leads"),
        "leads_stored": _rules_sql("SELECT Depotnummer, Score_Datum, InvestScore, GeneralScore, round(CompositeScore, 6) "
                                   "AS CompositeScore, Segment, Next_Action FROM leads"),
        "lead_report": _rules_sql(
            "SELECT Score_Datum, COUNT(*) AS total, COUNT(*) FILTER (WHERE Next_Action = 'Call') AS calls, "
            "COUNT(*) FILTER (WHERE Next_Action <> 'Call') AS emails, "
            "round(coalesce(avg(CASE WHEN Next_Action = 'Call' THEN CAST(ready AS DOUBLE) END), 0.0), 6) AS ready_call_rate, "
            "round(coalesce(quantile_cont(Cash_abs, 0.5) FILTER (WHERE Next_Action = 'Call'), 0.0), 6) "
            "AS median_cash_calls FROM leads GROUP BY Score_Datum"),
    }

