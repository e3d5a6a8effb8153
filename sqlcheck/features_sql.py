"""DuckDB oracle of the feature table: the brute-force per-date definition.

For every (depot, cut-off date) the sources are range-joined to the date and
aggregated directly, which is the literal meaning of each feature. The Spark
side computes the same values with windows (many dates) or with two-level
aggregation (one date).
"""

from __future__ import annotations

from sqlcheck.fixture_sql import ALL_SOURCES, CD_LATE, file_day_sources, with_sources

TECH_SQL = ("(regexp_matches(coalesce(Wertpapiername, ''), '(?i)(?:^|\\b)(?:GEAR|GIZMO)(?:\\b|$)') "
            "OR (regexp_matches(coalesce(Wertpapiername, ''), '(?i)\\bsmall\\b') "
            "AND regexp_matches(coalesce(Wertpapiername, ''), '(?i)\\b(?:ring)\\b')))")

FLOW_CLASS_SQL = """CASE
    WHEN contains(t, 'einlage') OR contains(t, 'eingang') OR contains(t, 'überweisung') OR contains(t, 'ueberweisung') THEN 'in'
    WHEN contains(t, 'entnahme') OR contains(t, 'ausgang') OR contains(t, 'auszahlung') THEN 'out'
    WHEN contains(t, 'steuer') THEN 'tax_in'
    WHEN contains(t, 'zins') OR contains(t, 'gebühr') OR contains(t, 'gebuehr') OR contains(t, 'entgelt') OR contains(t, 'spesen') THEN 'fee_out'
    WHEN contains(t, 'ertrag') OR contains(t, 'div') THEN 'yield_in'
    ELSE 'ignore' END"""

INTERNAL_SQL = "regexp_matches(coalesce(Bemerkung, ''), '(?i)umbuchung|intern|depot[ -]?übertrag|uebertrag|transfer')"

SINGLE_DATE = "dates AS (SELECT DATE '2001-08-01' AS as_of)"

# Cut-off dates of the backfill: days with an order file and a snapshot file,
# from 24 months before the last checked file day up to it.
BACKFILL_DATES = """
end_day AS (SELECT MAX(Datum) AS e FROM cd_datei WHERE Pruefziffer > 0),
complete_days AS (
  SELECT Datum FROM cd_datei GROUP BY Datum
  HAVING bool_or(DateiName LIKE 'comdirect_U-%') AND bool_or(DateiName LIKE 'comdirect_B-%')),
dates AS (
  SELECT c.Datum AS as_of FROM complete_days c JOIN end_day x
    ON c.Datum >= CAST(x.e - INTERVAL 24 MONTH AS DATE) AND c.Datum <= x.e)"""


# The same days with the ids of the day's order and snapshot file (highest check digit, then highest id).
BACKFILL_FILE_DAYS = """
end_day AS (SELECT MAX(Datum) AS e FROM cd_datei WHERE Pruefziffer > 0),
dates AS (
  SELECT Datum AS as_of, arg_max(DateiID, (Pruefziffer, DateiID)) FILTER (WHERE DateiName LIKE 'comdirect_U-%') AS u,
    arg_max(DateiID, (Pruefziffer, DateiID)) FILTER (WHERE DateiName LIKE 'comdirect_B-%') AS b
  FROM cd_datei, end_day WHERE Datum >= CAST(e - INTERVAL 24 MONTH AS DATE) AND Datum <= e GROUP BY Datum
  HAVING bool_or(DateiName LIKE 'comdirect_U-%') AND bool_or(DateiName LIKE 'comdirect_B-%'))"""


def feature_base_ctes() -> list[str]:
    return [
        """bk0 AS (SELECT *, lower(coalesce(Buchungtyp, '')) AS t FROM cd_buchung WHERE Kontoreferenz IS NOT NULL)""",
        """bk AS (
  SELECT Kontoreferenz, Valutadatum AS v, coalesce(Betrag, 0.0) AS amt, CAST(round(coalesce(Betrag, 0.0) * 10000) AS BIGINT) AS u,
         coalesce(Buchungtyp, '') AS typ,
         """ + FLOW_CLASS_SQL + """ AS klasse,
         """ + INTERNAL_SQL + """ AS internal
  FROM bk0)""",
        """first_seen AS (
  SELECT Depotnummer, MIN(d) AS first_d FROM (
    SELECT Depotnummer, Orderdatum AS d FROM cd_order
    UNION ALL SELECT Depotreferenz, Datum FROM cd_bestand
    UNION ALL SELECT Kontoreferenz, Datum FROM cd_saldo) u
  WHERE Depotnummer IS NOT NULL GROUP BY Depotnummer)""",
        """spine AS (
  SELECT f.Depotnummer, d.as_of AS Score_Datum FROM first_seen f JOIN dates d ON f.first_d <= d.as_of)""",
        """ord AS (
  SELECT d.as_of AS Score_Datum, o.Depotnummer,
    MAX(CASE WHEN contains(lower(coalesce(o.Ordertyp, '')), 'ankauf') THEN o.Orderdatum END) AS last_buy,
    MAX(o.Orderdatum) AS last_trade,
    COUNT(*) AS n, SUM(CAST(round(abs(coalesce(o.Cashflow, 0.0)) * 10000) AS BIGINT)) AS vol,
    COUNT(CASE WHEN o.Orderdatum >= d.as_of - 30 THEN 1 END) AS n30,
    SUM(CASE WHEN o.Orderdatum >= d.as_of - 30 THEN CAST(round(abs(coalesce(o.Cashflow, 0.0)) * 10000) AS BIGINT) END) AS vol30,
    COUNT(CASE WHEN o.Orderdatum >= d.as_of - 90 THEN 1 END) AS n90,
    SUM(CASE WHEN o.Orderdatum >= d.as_of - 90 THEN CAST(round(abs(coalesce(o.Cashflow, 0.0)) * 10000) AS BIGINT) END) AS vol90,
    COUNT(DISTINCT date_trunc('month', o.Orderdatum)) AS months,
    COUNT(DISTINCT CASE WHEN o.Orderdatum >= CAST(d.as_of - INTERVAL 6 MONTH AS DATE)
                        THEN date_trunc('month', o.Orderdatum) END) AS act6
  FROM cd_order o JOIN dates d ON o.Orderdatum <= d.as_of
  WHERE o.Depotnummer IS NOT NULL
  GROUP BY d.as_of, o.Depotnummer)""",
        """bks AS (
  SELECT d.as_of AS Score_Datum, b.Kontoreferenz AS Depotnummer,
    SUM(CASE WHEN NOT b.internal AND b.klasse = 'in' AND b.v >= d.as_of - 30 THEN b.u END) AS in30,
    SUM(CASE WHEN NOT b.internal AND b.klasse IN ('out', 'fee_out') AND b.v >= d.as_of - 30 THEN b.u END) AS out30,
    SUM(CASE WHEN NOT b.internal AND b.klasse = 'in' AND b.v >= d.as_of - 90 THEN b.u END) AS in90,
    SUM(CASE WHEN NOT b.internal AND b.klasse IN ('out', 'fee_out') AND b.v >= d.as_of - 90 THEN b.u END) AS out90,
    COUNT(DISTINCT CASE WHEN NOT b.internal AND b.klasse = 'in' AND b.v >= d.as_of - 180 AND b.amt > 0 AND b.amt < 1000
                         AND date_trunc('month', b.v) >= date_trunc('month', d.as_of) - INTERVAL 3 MONTH
                        THEN date_trunc('month', b.v) END) AS plan_months,
    COUNT(DISTINCT CASE WHEN b.amt > 0 AND b.amt < 1000 AND b.v >= CAST(d.as_of - INTERVAL 6 MONTH AS DATE)
                        THEN date_trunc('month', b.v) END) AS strength,
    MAX(CASE WHEN b.amt <> 0 THEN b.v END) AS last_cf
  FROM bk b JOIN dates d ON b.v <= d.as_of
  GROUP BY d.as_of, b.Kontoreferenz)""",
        """dep_m AS (
  SELECT d.as_of AS Score_Datum, b.Kontoreferenz AS Depotnummer, date_trunc('month', b.v) AS mon, SUM(b.u) / 10000.0 AS s
  FROM bk b JOIN dates d ON b.v <= d.as_of AND b.v >= d.as_of - 180
  WHERE NOT b.internal AND b.klasse = 'in'
  GROUP BY d.as_of, b.Kontoreferenz, date_trunc('month', b.v))""",
        """dep_v AS (SELECT Score_Datum, Depotnummer, stddev_samp(s) AS dep_vol FROM dep_m GROUP BY Score_Datum, Depotnummer)""",
        """snap_pick AS (
  SELECT d.as_of AS Score_Datum, b.Depotreferenz, MAX(b.Datum) AS Datum
  FROM (SELECT DISTINCT Depotreferenz, Datum FROM cd_bestand) b JOIN dates d ON b.Datum <= d.as_of
  GROUP BY d.as_of, b.Depotreferenz)""",
        """snap_rows AS (
  SELECT Depotreferenz, Datum, Wertpapierreferenz, coalesce(Kurswert, 0.0) AS k, CAST(round(coalesce(Kurswert, 0.0) * 10000) AS BIGINT) AS ku, Einstandswerte AS e,
         Wertpapiertyp, """ + TECH_SQL + """ AS tech
  FROM cd_bestand)""",
        """snap_agg AS (
  SELECT Depotreferenz, Datum, COUNT(*) AS cnt, COUNT(CASE WHEN k <= 0 THEN 1 END) AS zero, SUM(ku) / 10000.0 AS psum,
    COUNT(CASE WHEN tech THEN 1 END) AS tech_cnt, SUM(CASE WHEN tech THEN ku END) / 10000.0 AS tech_sum,
    SUM(CASE WHEN upper(coalesce(Wertpapiertyp, '')) = 'AKTIE' THEN ku END) / 10000.0 AS aktie_sum,
    SUM(CASE WHEN Wertpapiertyp = 'AKTIE' THEN ku END) / 10000.0 AS aktie_exact,
    SUM(CASE WHEN e > 0 THEN ku END) / 10000.0 AS tot_e,
    SUM(CASE WHEN e > 0 AND (k - e) / e <= -0.5 THEN ku END) / 10000.0 AS deep,
    SUM(CASE WHEN e > 0 AND k - e > 0 THEN ku END) / 10000.0 AS win,
    SUM(CASE WHEN e > 0 AND k - e <= 0 THEN ku END) / 10000.0 AS loss
  FROM snap_rows GROUP BY Depotreferenz, Datum)""",
        """sec_val AS (
  SELECT Depotreferenz, Datum, Wertpapierreferenz, SUM(ku) / 10000.0 AS v
  FROM snap_rows WHERE Wertpapierreferenz IS NOT NULL GROUP BY Depotreferenz, Datum, Wertpapierreferenz)""",
        """sec_w AS (
  SELECT Depotreferenz, Datum,
         CASE WHEN SUM(v) OVER (PARTITION BY Depotreferenz, Datum) > 0
              THEN v / SUM(v) OVER (PARTITION BY Depotreferenz, Datum) ELSE 0.0 END AS w
  FROM sec_val)""",
        """hhi AS (SELECT Depotreferenz, Datum, SUM(w * w) AS hhi FROM sec_w GROUP BY Depotreferenz, Datum)""",
        """pos AS (
  SELECT p.Score_Datum, p.Depotreferenz AS Depotnummer, a.*, h.hhi
  FROM snap_pick p JOIN snap_agg a ON a.Depotreferenz = p.Depotreferenz AND a.Datum = p.Datum
  LEFT JOIN hhi h ON h.Depotreferenz = p.Depotreferenz AND h.Datum = p.Datum)""",
        """sal AS (
  SELECT Score_Datum, Depotnummer, saldo FROM (
    SELECT d.as_of AS Score_Datum, s.Kontoreferenz AS Depotnummer, coalesce(s.Saldosollwert, 0.0) AS saldo,
           ROW_NUMBER() OVER (PARTITION BY d.as_of, s.Kontoreferenz ORDER BY s.Datum DESC, s.Saldosollwert DESC) AS rn
    FROM cd_saldo s JOIN dates d ON s.Datum <= d.as_of) x WHERE rn = 1)""",
        """base AS (
  SELECT s.Depotnummer, s.Score_Datum,
         o.last_buy, o.last_trade, o.n, o.vol, o.n30, o.vol30, o.n90, o.vol90, o.months, o.act6,
         b.in30, b.out30, b.in90, b.out90, b.plan_months, b.strength, b.last_cf, v.dep_vol,
         p.cnt, p.zero, p.psum, p.tech_cnt, p.tech_sum, p.aktie_sum, p.aktie_exact, p.tot_e, p.deep, p.win, p.loss, p.hhi,
         l.saldo
  FROM spine s
  LEFT JOIN ord o ON o.Depotnummer = s.Depotnummer AND o.Score_Datum = s.Score_Datum
  LEFT JOIN bks b ON b.Depotnummer = s.Depotnummer AND b.Score_Datum = s.Score_Datum
  LEFT JOIN dep_v v ON v.Depotnummer = s.Depotnummer AND v.Score_Datum = s.Score_Datum
  LEFT JOIN pos p ON p.Depotnummer = s.Depotnummer AND p.Score_Datum = s.Score_Datum
  LEFT JOIN sal l ON l.Depotnummer = s.Depotnummer AND l.Score_Datum = s.Score_Datum)""",
        """feat AS (
  SELECT Depotnummer, Score_Datum,
    last_buy AS Letzter_Kauf,
    CAST(coalesce(date_diff('day', last_buy, Score_Datum), 0) AS BIGINT) AS Inaktiv_seit_Kauf,
    CAST(coalesce(date_diff('day', last_buy, Score_Datum), 0) AS BIGINT) AS Last_Buy_Days,
    CAST(coalesce(date_diff('day', last_trade, Score_Datum), 0) AS BIGINT) AS Last_Trade_Days,
    coalesce(in30, 0) / 10000.0 AS Einzahlung_30d,
    coalesce(in90, 0) / 10000.0 AS Einzahlung_90d,
    CAST(CASE WHEN coalesce(plan_months, 0) >= 3 THEN 1 ELSE 0 END AS BIGINT) AS Sparplan_Klein,
    CASE WHEN coalesce(plan_months, 0) >= 3 AND coalesce(in30, 0) / 10000.0 < 1000 THEN 0.0 ELSE coalesce(in30, 0) / 10000.0 END
      AS Einzahlung_30d_eff,
    coalesce(out30, 0) / 10000.0 AS Auszahlung_30d,
    coalesce(out90, 0) / 10000.0 AS Auszahlung_90d,
    (coalesce(in30, 0) - coalesce(out30, 0)) / 10000.0 AS Nettoflow_30d,
    (coalesce(in90, 0) - coalesce(out90, 0)) / 10000.0 AS Nettoflow_90d,
    CAST(coalesce(strength, 0) AS BIGINT) AS Sparplan_Strength_6m,
    coalesce(dep_vol, 0.0) AS Deposit_Volatility_6m,
    CAST(coalesce(date_diff('day', last_cf, Score_Datum), 9999) AS BIGINT) AS Last_Cashflow_Days,
    CAST(coalesce(months, 0) AS BIGINT) AS Orderfrequenz,
    CAST(coalesce(n30, 0) AS BIGINT) AS Orderfrequenz_30d,
    CAST(coalesce(n90, 0) AS BIGINT) AS Orderfrequenz_90d,
    CASE WHEN n > 0 THEN CAST(vol AS DOUBLE) / n / 10000.0 ELSE 0.0 END AS "ØOrdervolumen",
    CASE WHEN n30 > 0 THEN CAST(vol30 AS DOUBLE) / n30 / 10000.0 ELSE 0.0 END AS "ØOrdervolumen_30d",
    CASE WHEN n90 > 0 THEN CAST(vol90 AS DOUBLE) / n90 / 10000.0 ELSE 0.0 END AS "ØOrdervolumen_90d",
    CAST(coalesce(tech_cnt, 0) AS BIGINT) AS TechAffin,
    CASE WHEN saldo IS NOT NULL AND psum > 0 THEN saldo / psum END AS Cash_over_bestand,
    least(greatest(coalesce(saldo / (saldo + psum + 1e-6), 0.0), 0.0), 1.0) AS Cashquote_true,
    coalesce(saldo, 0.0) AS Cash_abs,
    coalesce(psum, 0.0) AS Bestandwert,
    coalesce(saldo, 0.0) + coalesce(psum, 0.0) AS Depotwert,
    CAST(coalesce(cnt, 0) AS BIGINT) AS Pos_Count,
    CAST(coalesce(zero, 0) AS BIGINT) AS ZeroPos,
    CAST(CASE WHEN coalesce(psum, 0.0) <= 1 AND coalesce(zero, 0) >= 1 THEN 1 ELSE 0 END AS BIGINT) AS Wertlos_Flag,
    hhi AS HHI_Concentration,
    CASE WHEN tot_e <> 0 THEN coalesce(deep, 0.0) / tot_e ELSE 0.0 END AS DeepLossShare_50,
    CASE WHEN win IS NOT NULL AND loss IS NOT NULL AND tot_e <> 0 THEN (win - loss) / tot_e ELSE 0.0 END AS WinLoss_Skew,
    coalesce(tech_sum / (psum + 1e-6), 0.0) AS TechWeight,
    least(greatest(CASE WHEN saldo IS NOT NULL AND psum > 0 THEN saldo / psum ELSE 0.0 END, 0.0), 1.0) AS Cashquote,
    coalesce(aktie_sum / (psum + 1e-6), 0.0) AS Aktienquote,
    CAST(coalesce(act6, 0) AS BIGINT) AS Activity_Months_6m,
    CAST(least(13, coalesce((year(Score_Datum) * 12 + month(Score_Datum)) - (year(last_trade) * 12 + month(last_trade)), 13)) AS BIGINT)
      AS Streak_Inactive_Months,
    CAST(CASE WHEN coalesce(n90, 0) >= 6 AND (CASE WHEN n90 > 0 THEN CAST(vol90 AS DOUBLE) / n90 / 10000.0 ELSE 0.0 END) < 2000 THEN 1 ELSE 0 END AS BIGINT)
      AS DIY_FrequentSmall,
    CASE WHEN coalesce(saldo, 0.0) + coalesce(psum, 0.0) > 0
         THEN ((coalesce(in30, 0) - coalesce(out30, 0)) / 10000.0) / (coalesce(saldo, 0.0) + coalesce(psum, 0.0)) ELSE 0.0 END
      AS Inflow_Strength_30d
  FROM base)""",
    ]


FEATURE_OUTPUT = """
SELECT Depotnummer, Score_Datum, Letzter_Kauf, Inaktiv_seit_Kauf, Last_Buy_Days, Last_Trade_Days,
  round(Einzahlung_30d, 6) AS Einzahlung_30d, round(Einzahlung_90d, 6) AS Einzahlung_90d, Sparplan_Klein,
  round(Einzahlung_30d_eff, 6) AS Einzahlung_30d_eff, round(Auszahlung_30d, 6) AS Auszahlung_30d,
  round(Auszahlung_90d, 6) AS Auszahlung_90d, round(Nettoflow_30d, 6) AS Nettoflow_30d,
  round(Nettoflow_90d, 6) AS Nettoflow_90d, Sparplan_Strength_6m,
  round(Deposit_Volatility_6m, 4) AS Deposit_Volatility_6m, Last_Cashflow_Days,
  Orderfrequenz, Orderfrequenz_30d, Orderfrequenz_90d,
  "ØOrdervolumen", "ØOrdervolumen_30d", "ØOrdervolumen_90d", TechAffin,
  round(Cash_over_bestand, 6) AS Cash_over_bestand, round(Cashquote_true, 6) AS Cashquote_true,
  round(Cash_abs, 6) AS Cash_abs, round(Bestandwert, 6) AS Bestandwert, round(Depotwert, 6) AS Depotwert,
  Pos_Count, ZeroPos, Wertlos_Flag, round(HHI_Concentration, 6) AS HHI_Concentration,
  round(DeepLossShare_50, 6) AS DeepLossShare_50, round(WinLoss_Skew, 6) AS WinLoss_Skew,
  round(TechWeight, 6) AS TechWeight, round(Cashquote, 6) AS Cashquote, round(Aktienquote, 6) AS Aktienquote,
  Activity_Months_6m, Streak_Inactive_Months, DIY_FrequentSmall,
  round(Inflow_Strength_30d, 6) AS Inflow_Strength_30d
FROM feat"""


def hu(x: str, scale: int) -> str:
    """Half-up rounding on the shortest decimal representation (NULL/NaN/inf -> 0), as DOUBLE."""
    return (f"CASE WHEN ({x}) IS NULL OR isnan({x}) OR isinf({x}) THEN 0.0 "
            f"ELSE CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12)), {scale}) AS DOUBLE) END")


def features_sql(dates_cte: str = SINGLE_DATE, select: str = FEATURE_OUTPUT, extra_ctes=()) -> str:
    return with_sources(dates_cte, *feature_base_ctes(), *extra_ctes, select=select)


def file_backfill_sql(orders: str = "cd_order") -> str:
    """``features_sql`` over the backfill days: balances and positions of a day from its snapshot file only, orders up to its order file."""
    visible = f"{orders} o JOIN dates d ON o.Orderdatum <= d.as_of AND o.Datei_ID <= d.u"
    own = {
        "spine": f"""spine AS (
  SELECT o.Depotnummer, d.as_of AS Score_Datum FROM {visible} WHERE o.Depotnummer IS NOT NULL
  UNION SELECT s.Depotreferenz, d.as_of FROM cd_bestand s JOIN dates d ON s.Datei_ID = d.b WHERE s.Depotreferenz IS NOT NULL
  UNION SELECT s.Kontoreferenz, d.as_of FROM cd_saldo s JOIN dates d ON s.Datei_ID = d.b WHERE s.Kontoreferenz IS NOT NULL)""",
        "snap_pick": """snap_pick AS (
  SELECT DISTINCT d.as_of AS Score_Datum, s.Depotreferenz, s.Datum FROM cd_bestand s JOIN dates d ON s.Datei_ID = d.b)""",
        "sal": """sal AS (
  SELECT d.as_of AS Score_Datum, s.Kontoreferenz AS Depotnummer, MAX(coalesce(s.Saldosollwert, 0.0)) AS saldo
  FROM cd_saldo s JOIN dates d ON s.Datei_ID = d.b GROUP BY d.as_of, s.Kontoreferenz)""",
    }
    ctes = [own.get(c.split(" AS ", 1)[0], c) for c in feature_base_ctes()]
    ctes = [c.replace("cd_order o JOIN dates d ON o.Orderdatum <= d.as_of", visible) if c.startswith("ord AS") else c for c in ctes]
    return with_sources(CD_LATE, BACKFILL_FILE_DAYS, *ctes, select=FEATURE_OUTPUT)


def building_block_oracles() -> dict[str, str]:
    pos_cols = ("cnt AS p_cnt, zero AS p_zero, CAST(round(psum * 10000) AS BIGINT) AS p_sum, tech_cnt AS p_tech_cnt, "
                "CAST(round(tech_sum * 10000) AS BIGINT) AS p_tech_sum, CAST(round(aktie_sum * 10000) AS BIGINT) "
                "AS p_aktie_sum, CAST(round(aktie_exact * 10000) AS BIGINT) AS p_aktie_exact, round(hhi, 6) AS p_hhi, "
                "CAST(round(tot_e * 10000) AS BIGINT) AS p_tot_e, CAST(round(deep * 10000) AS BIGINT) AS p_deep, "
                "CAST(round(win * 10000) AS BIGINT) AS p_win, CAST(round(loss * 10000) AS BIGINT) AS p_loss")
    days = ("2001-01-01", "2001-08-01")
    file_day = " UNION ALL ".join(
        "SELECT * FROM (" + features_sql(f"dates AS (SELECT DATE '{d}' AS as_of)").replace(ALL_SOURCES, file_day_sources(d)) + ")"
        for d in days)
    load = " UNION ALL ".join(
        f"SELECT * FROM (WITH {file_day_sources(d)} SELECT DATE '{d}' AS file_day, '{name}' AS table_name, COUNT(*) AS n, "
        f"COUNT(DISTINCT {key}) AS depots, round(SUM({amount}), 2) AS amount FROM {view})"
        for d in days for name, view, key, amount in (
            ("orders", "cd_order", "Depotnummer", "Cashflow"), ("balances", "cd_saldo", "Kontoreferenz", "Saldosollwert"),
            ("positions", "cd_bestand", "Depotreferenz", "Kurswert")))
    return {
        "depot_features_file_day": file_day,
        "depot_features_file_days": file_day,
        "depot_features_file_backfill": file_backfill_sql(),
        "depot_features_late_files": file_backfill_sql("cd_late"),
        "day_load": load,
        "depot_spine": features_sql(select="SELECT Depotnummer, Score_Datum FROM spine"),
        "balance_last_snapshot": features_sql(select="SELECT Depotnummer, round(saldo, 6) AS s_saldo FROM sal"),
        "position_last_snapshot": features_sql(select=f"SELECT Depotnummer, {pos_cols} FROM pos"),
        "booking_classes": features_sql(select=(
            "SELECT typ AS Buchungtyp, klasse, internal, COUNT(*) AS n, round(SUM(amt), 4) AS amount "
            "FROM bk GROUP BY typ, klasse, internal")),
    }
