"""DuckDB oracles of the queries over stored tables, CSV deliveries, daily states and whole-backfill statistics."""

from __future__ import annotations

from itertools import combinations

from depotlens.operators.features import FEATURE_COLUMNS
from sqlcheck.features_sql import BACKFILL_DATES, features_sql
from sqlcheck.fixture_sql import with_sources
from sqlcheck.metrics_sql import _sql, metric_oracles


def _correlations() -> str:
    cols = [c for c in FEATURE_COLUMNS if c not in ("Depotnummer", "Score_Datum", "Letzter_Kauf")]
    pairs = list(combinations(cols, 2))
    values = "z AS MATERIALIZED (SELECT " + ", ".join(f'coalesce(CAST("{c}" AS DOUBLE), 0.0) AS v{i}' for i, c in enumerate(cols)) + " FROM feat)"
    place = {c: i for i, c in enumerate(cols)}
    once = "r AS (SELECT unnest([" + ", ".join(
        f"{{'a': '{a}', 'b': '{b}', 'c': CASE WHEN min(v{place[a]}) < max(v{place[a]}) AND min(v{place[b]}) < max(v{place[b]}) "
        f"THEN corr(v{place[a]}, v{place[b]}) END}}" for a, b in pairs) + "]) AS x FROM z)"
    return features_sql(BACKFILL_DATES, extra_ctes=(values, once), select=(
        "SELECT x.a AS column_a, x.b AS column_b, round(x.c, 6) AS correlation, CAST(coalesce(abs(x.c) >= 0.9, false) AS INTEGER) AS high FROM r"))


ISOTONIC = """
pts AS (
  SELECT horizon, x, SUM(y) AS s, COUNT(*) AS w, ROW_NUMBER() OVER (PARTITION BY horizon ORDER BY x) AS i FROM (
    SELECT 'T' || h AS horizon, CAST(f.Last_Trade_Days AS DOUBLE) AS x,
           CASE h WHEN 7 THEN e.label_invest_T7 WHEN 14 THEN e.label_invest_T14 ELSE e.label_invest_T30 END AS y
    FROM eb e JOIN feat f ON f.Depotnummer = e.Depotnummer AND f.Score_Datum = e.Score_Datum, (VALUES (7), (14), (30)) t(h)) u
  GROUP BY horizon, x),
run AS (SELECT *, SUM(s) OVER w AS cs, SUM(w) OVER w AS cw FROM pts WINDOW w AS (PARTITION BY horizon ORDER BY i)),
means AS (
  SELECT a.horizon, a.i AS i, b.i AS k, (b.cs - a.cs + a.s) / (b.cw - a.cw + a.w) AS m
  FROM run a JOIN run b ON b.horizon = a.horizon AND b.i >= a.i),
least_after AS (SELECT horizon, i, k, MIN(m) OVER (PARTITION BY horizon, i ORDER BY k DESC) AS m FROM means),
fitted AS (SELECT horizon, k, MAX(m) AS p FROM least_after GROUP BY horizon, k)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, byte by byte over the usual table."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ 0xEDB88320 * (c & 1)
        table.append(c)
    digit = "instr('0123456789ABCDEF', h[{}]) - 1"
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: (({digit.format(1)}) * 16 + {digit.format(2)})::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {octets}, lambda r, b: xor(r >> 8, [{', '.join(map(str, table))}][xor(r, b) % 256 + 1])), 4294967295)"


def _rejected() -> str:
    """What is damaged is rejected, and nothing else; a row is damaged by the CRC-32 of its fields (without a remark a booking has an empty one)."""
    damage = {
        "cd_order": (50, ("malformed", "no key"), ("Depotnummer", "Orderdatum", "Ordertyp", "Cashflow", "ISIN", "Transaktionsnummer", "Bemerkung", "Datei_ID")),
        "cd_saldo": (40, ("malformed",), ("Kontoreferenz", "Datum", "Saldosollwert", "Datei_ID")),
        "cd_buchung": (30, ("malformed", "no date"), ("Kontoreferenz", "Valutadatum", "Buchungdatum", "Betrag", "Buchungtyp", "coalesce(Bemerkung, '')"))}
    ctes, rows = [], []
    for t in ("cd_order", "cd_saldo", "cd_buchung", "cd_bestand", "cd_datei"):
        every, reasons, fields = damage.get(t, (1, (None,), ()))
        line = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in fields)
        ctes.append(f"n_{t} AS (SELECT COUNT(*) AS n, {f'COUNT(*) FILTER (WHERE {_crc32(line)} % {every} = 0)' if fields else '0'} AS d FROM {t})")
        rows += [f"SELECT '{t}' AS table_name, {f'{chr(39)}{reason}{chr(39)}' if reason else 'CAST(NULL AS VARCHAR)'} AS reason, n AS n_rows, n AS n_given, "
                 f"d AS n_rejected, d AS n_damaged, CASE WHEN d > 0 THEN 1.0::DOUBLE END AS share, "
                 f"CASE WHEN d > 0 THEN {len(reasons)} ELSE 0 END AS reasons, CASE WHEN d > 0 THEN 1 ELSE 0 END AS counts FROM n_{t}" for reason in reasons]
    return with_sources(",\n".join(ctes), select=" UNION ALL ".join(rows))


def store_oracles() -> dict[str, str]:
    from sqlcheck.labels_sql import label_oracles
    labels = label_oracles()
    spine = "SELECT Depotnummer, Score_Datum, CAST({run} AS INTEGER) AS run FROM spine WHERE {keep}"
    late, quarter = "Score_Datum >= DATE '2001-05-01'", "Score_Datum BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'"
    return {
        "sink_replace_dates": features_sql(BACKFILL_DATES, select=(
            spine.format(run=1, keep=f"NOT ({late})") + " UNION ALL "
            + spine.format(run=2, keep=f"{late} AND month(Score_Datum) <> 7 AND CAST(Depotnummer AS BIGINT) % 2 = 0"))),
        "sink_replace_range": features_sql(BACKFILL_DATES, select=(
            spine.format(run=1, keep=f"NOT ({quarter})") + " UNION ALL " + spine.format(run=3, keep=f"{quarter} AND day(Score_Datum) % 2 = 1"))),
        "upsert_labels_parts": labels["upsert_labels"],
        "sink_append_evaluations": metric_oracles()["eval_horizons"],
        "depot_range_lookup": features_sql(BACKFILL_DATES, select=(
            "SELECT Depotnummer, Score_Datum, round(Depotwert, 6) AS Depotwert, Orderfrequenz, Last_Trade_Days FROM feat "
            "WHERE Depotnummer BETWEEN '20' AND '39'")),
        "csv_labels": labels["label_invest"],
        "csv_rejected": _rejected(),
        "incremental_features": features_sql(BACKFILL_DATES.replace("dates AS (", "all_dates AS (")
                                             + ",\ndates AS (SELECT as_of FROM all_dates ORDER BY as_of DESC LIMIT 14)"),
        "feature_correlations_all": _correlations(),
        "isotonic_fit": _sql((7,), (ISOTONIC,), (
            "SELECT p.horizon, p.x, p.w AS n, round(f.p, 9) AS p FROM pts p JOIN fitted f ON f.horizon = p.horizon AND f.k = p.i")),
    }
