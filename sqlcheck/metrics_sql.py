"""DuckDB oracles of the ranking metrics (brute force: row ranks per group)."""

from __future__ import annotations

from sqlcheck.features_sql import BACKFILL_DATES, features_sql
from sqlcheck.labels_sql import EVENTS
from sqlcheck.rules_sql import READINESS_CTE


def _lab(h: int) -> str:
    return (f"CAST(EXISTS (SELECT 1 FROM events e WHERE e.Depotnummer = r.Depotnummer "
            f"AND e.event_date BETWEEN r.Score_Datum + 1 AND r.Score_Datum + {h}) AS INTEGER) AS label_invest_T{h}")


EVAL_CTES = (READINESS_CTE, EVENTS,
             "eb AS (SELECT r.Depotnummer, r.Score_Datum, r.InvestScore, " + ", ".join(_lab(h) for h in (7, 14, 30))
             + " FROM ready r)")


def _long(horizons) -> str:
    return "lg AS (" + " UNION ALL ".join(
        f"SELECT 'T{h}' AS horizon, Depotnummer, Score_Datum, CAST(InvestScore AS DOUBLE) AS score, "
        f"label_invest_T{h} AS label FROM eb" for h in horizons) + ")"


AP_CTES = """
sc AS (SELECT horizon, score, COUNT(*) AS n_s, SUM(label) AS pos_s FROM lg GROUP BY horizon, score),
scc AS (SELECT *, SUM(n_s) OVER (PARTITION BY horizon ORDER BY score DESC) AS n_ge,
               SUM(pos_s) OVER (PARTITION BY horizon ORDER BY score DESC) AS pos_ge,
               SUM(pos_s) OVER (PARTITION BY horizon) AS pos_tot FROM sc),
ap AS (SELECT horizon, SUM(CASE WHEN pos_tot > 0 THEN (pos_s / pos_tot) * (pos_ge / n_ge) ELSE 0.0 END)
       AS average_precision FROM scc GROUP BY horizon)"""


def _pk_ctes(ks) -> str:
    kv = ", ".join(f"(CAST({k} AS DOUBLE))" for k in ks)
    return f"""
ks AS (SELECT * FROM (VALUES {kv}) t(k)),
rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY horizon ORDER BY score DESC, Depotnummer, Score_Datum) AS rn,
              COUNT(*) OVER (PARTITION BY horizon) AS n, AVG(label) OVER (PARTITION BY horizon) AS base FROM lg),
tops AS (SELECT DISTINCT r.horizon, ks.k, CAST(greatest(1, ceil(r.n * ks.k)) AS BIGINT) AS top, r.base
         FROM rk r JOIN ks ON TRUE),
pk AS (SELECT t.horizon, t.k, t.top, AVG(CAST(r.label AS DOUBLE)) AS precision_at_k, t.base AS base_rate
       FROM tops t JOIN rk r ON r.horizon = t.horizon AND r.rn <= t.top GROUP BY t.horizon, t.k, t.top, t.base)"""


def _sql(horizons, ctes, select):
    return features_sql(BACKFILL_DATES, extra_ctes=(*EVAL_CTES, _long(horizons), *ctes), select=select)


CALIB = """
rates AS (SELECT InvestScore, AVG(CAST(label_invest_T7 AS DOUBLE)) AS p7, AVG(CAST(label_invest_T14 AS DOUBLE)) AS p14,
                 AVG(CAST(label_invest_T30 AS DOUBLE)) AS p30 FROM eb GROUP BY InvestScore),
cal AS (SELECT e.Depotnummer, e.Score_Datum, r.p7, r.p14, r.p30 FROM eb e JOIN rates r ON r.InvestScore = e.InvestScore)"""


def metric_oracles() -> dict[str, str]:
    pk_select = ("SELECT horizon, k, top, round(precision_at_k, 6) AS precision_at_k, "
                 "round(precision_at_k / CASE WHEN base_rate > 0 THEN base_rate ELSE 1e-9 END, 6) AS lift_at_k, "
                 "round(base_rate, 6) AS base_rate FROM pk")
    ks = (0.01, 0.03, 0.05)
    wide = ", ".join(
        f"round(MAX(CASE WHEN k = {k} THEN precision_at_k END), 6) AS p_at_{int(round(k * 100))}, "
        f"round(MAX(CASE WHEN k = {k} THEN precision_at_k / CASE WHEN base_rate > 0 THEN base_rate ELSE 1e-9 END END), 6)"
        f" AS lift_at_{int(round(k * 100))}" for k in ks)
    return {
        "average_precision": _sql((7, 14), (AP_CTES,), "SELECT horizon, round(average_precision, 6) AS average_precision FROM ap"),
        "precision_lift_at_k": _sql((7, 14), (_pk_ctes((0.01, 0.03, 0.05, 0.10)),), pk_select),
        "eval_horizons": _sql(
            (7, 14, 30), (AP_CTES, _pk_ctes(ks)),
            "SELECT b.horizon, b.n, round(b.pos_rate, 6) AS pos_rate, round(ap.average_precision, 6) AS average_precision, "
            + wide + " FROM (SELECT horizon, COUNT(*) AS n, AVG(CAST(label AS DOUBLE)) AS pos_rate FROM lg GROUP BY horizon) b "
            "JOIN ap ON ap.horizon = b.horizon JOIN pk ON pk.horizon = b.horizon "
            "GROUP BY b.horizon, b.n, b.pos_rate, ap.average_precision"),
        "horizon_monotone": _sql(
            (7,), (CALIB,),
            "SELECT Depotnummer, Score_Datum, round(p7, 6) AS p_invest_7d, round(greatest(p14, p7), 6) AS p_invest_14d, "
            "round(greatest(p30, greatest(p14, p7)), 6) AS p_invest_30d FROM cal"),
        "rank_in_run": _sql(
            (7,), (CALIB,),
            "SELECT Score_Datum AS run_date, Depotnummer, round(p7, 6) AS p_invest, CAST(round_even(p7 * 100, 0) AS INTEGER) "
            "AS score, ROW_NUMBER() OVER (PARTITION BY Score_Datum ORDER BY p7 DESC, Depotnummer) AS rank_in_run FROM cal"),
    }
