"""DuckDB oracles of the model-preparation steps (split, class weights, prediction upsert)."""

from __future__ import annotations

from sqlcheck.metrics_sql import CALIB, _sql

SPLIT = """
sp AS (
  SELECT *, CASE WHEN Score_Datum > DATE '2001-02-01' THEN 'test'
                 WHEN Score_Datum <= DATE '2001-02-01' - 90 THEN 'train' ELSE 'calib' END AS split
  FROM eb)"""


COUNTS = ("Inaktiv_seit_Kauf", "Last_Buy_Days", "Last_Trade_Days", "Sparplan_Klein", "Sparplan_Strength_6m", "Last_Cashflow_Days", "Orderfrequenz",
          "Orderfrequenz_30d", "Orderfrequenz_90d", "TechAffin", "Pos_Count", "ZeroPos", "Wertlos_Flag", "Activity_Months_6m", "Streak_Inactive_Months",
          "DIY_FrequentSmall", "ØOrdervolumen", "ØOrdervolumen_30d", "ØOrdervolumen_90d")
TEXTS = ("Depotwert", "Bestandwert", "Cash_abs")
MEASURES = ("Einzahlung_30d", "Einzahlung_90d", "Einzahlung_30d_eff", "Auszahlung_30d", "Auszahlung_90d", "Nettoflow_30d", "Nettoflow_90d",
            "Cash_over_bestand", "Cashquote_true", "HHI_Concentration", "DeepLossShare_50", "WinLoss_Skew", "TechWeight", "Cashquote", "Aktienquote",
            "Inflow_Strength_30d")


def ml_oracles() -> dict[str, str]:
    weights = " UNION ALL ".join(
        f"SELECT 'T{h}' AS horizon, CAST(greatest(1, coalesce(SUM(label_invest_T{h}), 0)) AS BIGINT) AS pos, "
        f"CAST(greatest(1, COUNT(*) - greatest(1, coalesce(SUM(label_invest_T{h}), 0))) AS BIGINT) AS neg "
        f"FROM sp WHERE split = 'train'"
        for h in (7, 14, 30))
    typed = ", ".join([f'CAST(f."{c}" AS DOUBLE) AS "{c}"' for c in COUNTS] + [f"CAST(format('{{:.2f}}', f.{c}) AS DOUBLE) AS {c}" for c in TEXTS]
                      + [f"round(CAST(f.{c} AS DOUBLE), 6) AS {c}" for c in MEASURES])
    return {
        "training_frame_backfill": _sql((7,), (), f"""
SELECT f.Depotnummer, f.Score_Datum, f.Letzter_Kauf, {typed}, round(f.Deposit_Volatility_6m, 4) AS Deposit_Volatility_6m,
  'Gruppe ' || f.Depotnummer AS Gruppe, e.label_invest_T7, CAST(date_diff('day', f.Letzter_Kauf, f.Score_Datum) AS DOUBLE) AS days_since_last_buy
FROM feat f JOIN eb e ON e.Depotnummer = f.Depotnummer AND e.Score_Datum = f.Score_Datum
WHERE f.Score_Datum BETWEEN DATE '1999-08-01' AND DATE '2001-08-01'"""),
        "model_time_split": _sql((7,), (SPLIT,), "SELECT split, COUNT(*) AS n, CAST(SUM(label_invest_T7) AS BIGINT) "
                                                 "AS positives_T7, MIN(Score_Datum) AS first_date, "
                                                 "MAX(Score_Datum) AS last_date FROM sp GROUP BY split"),
        "training_frame": _sql((7,), (), """
SELECT f.Depotnummer, f.Score_Datum, f.Letzter_Kauf, CAST(f.TechAffin AS DOUBLE) AS TechAffin,
  round(CAST(format('{:.2f}', f.Depotwert) AS DOUBLE), 2) AS Depotwert, round(CAST(format('{:.2f}', f.Cash_abs) AS DOUBLE), 2) AS Cash_text,
  'Gruppe ' || f.Depotnummer AS Gruppe, e.label_invest_T7,
  CAST(date_diff('day', f.Letzter_Kauf, f.Score_Datum) AS DOUBLE) AS days_since_last_buy
FROM feat f JOIN eb e ON e.Depotnummer = f.Depotnummer AND e.Score_Datum = f.Score_Datum
WHERE f.Score_Datum BETWEEN DATE '2001-06-01' AND DATE '2001-07-31'"""),
        "class_weights": _sql((7,), (SPLIT,), f"SELECT horizon, pos, neg, round(neg / pos, 6) AS scale_pos_weight "
                                              f"FROM ({weights})"),
        "upsert_predictions": _sql((7,), (CALIB, """
run AS (SELECT Score_Datum AS run_date, Depotnummer, p7 AS p_invest, CAST(round_even(p7 * 100, 0) AS INTEGER) AS score,
               ROW_NUMBER() OVER (PARTITION BY Score_Datum ORDER BY p7 DESC, Depotnummer) AS rank_in_run FROM cal)"""),
                                   """
SELECT run_date, Depotnummer, round(p_invest, 6) AS p_invest, score, rank_in_run, 'v1' AS model_version FROM run
WHERE run_date < DATE '2001-04-01'
UNION ALL
SELECT run_date, Depotnummer, round(p_invest, 6), score, rank_in_run, 'v2' FROM run WHERE run_date >= DATE '2001-04-01'"""),
    }
