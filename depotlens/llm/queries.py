"""Registered queries of the subpackage: one thin query per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, bktree, decontaminate, extract, langid, merkle, minhash, mixing, quality, recompression, simhash, url_rules, warc
from .store import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = minhash.NearParams(shingle=3, similarity=85)
    return minhash.with_copies_marked(table(spark, sf_dir, "documents"), p)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_plan(docs, carry=["doc_id"]).select("doc.doc_id", "size", "source_size", "target", "copies", "taken")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_texts(table(spark, sf_dir, "pages"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged_pages(table(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.repeated_passages(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))


def op13_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bktree.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_near_dedup": op2_near_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_mixing": op4_mixing,
    "op5_language_id": op5_language_id,
    "op6_warc": op6_warc,
    "op7_html_extraction": op7_html_extraction,
    "op8_url_filters": op8_url_filters,
    "op9_fingerprints": op9_fingerprints,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_simhash_bktree": op13_simhash_bktree,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"



def _merkle_sql(levels: int = 8, crown: int = 4) -> str:
    """Trees of up to 8 ** levels leaves a language and 8 ** crown languages, level by level."""
    text = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    fields = " || ".join(text.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    crc = "list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda r, b: "
    crc += "list_reduce([xor(r, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))"
    parts = [
        f"l AS (SELECT doc_id, lang AS k, sha256({fields} || {text.format('text')}) AS leaf, sha256({fields} || {text.format(lowered)}) AS low, "
        f"xor({crc}, 4294967295) % 3 = 0 AS struck FROM documents)",
        "a0 AS (SELECT doc_id, k, leaf, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p0, CASE WHEN struck THEN low ELSE leaf END AS f0, '' AS s0 FROM l)",
        "t0 AS (SELECT k, p0 AS pos, leaf AS d FROM a0)",
    ]

    def tree(t: str, a: str, n: int) -> None:
        for i in range(n):
            run = "PARTITION BY k, pos // 8 ORDER BY pos ROWS BETWEEN"
            parts.append(
                f"{t}r{i} AS (SELECT k, pos, d, count(*) OVER (PARTITION BY k) AS n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {t}{i})"
            )
            parts.append(f"{t}{i + 1} AS (SELECT k, pos // 8 AS pos, CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d FROM {t}r{i} GROUP BY 1, 2)")
            parts.append(
                f"{a}{i + 1} AS (SELECT a.* EXCLUDE (p{i}, f{i}, s{i}), a.p{i} // 8 AS p{i + 1}, CASE WHEN n = 1 THEN f{i} ELSE sha256(l || f{i} || r) END AS f{i + 1}, s{i} || l || r AS s{i + 1} "
                f"FROM {a}{i} a JOIN {t}r{i} x ON x.k IS NOT DISTINCT FROM a.k AND x.pos = a.p{i})"
            )

    tree("t", "a", levels)
    parts.append(f"s AS (SELECT k AS name, d AS subroot, row_number() OVER (ORDER BY k NULLS FIRST) - 1 AS p0 FROM t{levels})")
    parts.append("u0 AS (SELECT 0 AS k, p0 AS pos, subroot AS d FROM s)")
    parts.append(
        f"b0 AS (SELECT a.doc_id, a.leaf, s.subroot, 0 AS k, s.p0 AS p0, a.f{levels} AS f0, a.s{levels} AS s0 FROM a{levels} a JOIN s ON s.name IS NOT DISTINCT FROM a.k)"
    )
    tree("u", "b", crown)
    parts.append(f"root AS (SELECT d AS root FROM u{crown})")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(s{crown}) AS proof_sha256, f{crown} AS folded_root, f{crown} = root AS verified "
        f"FROM b{crown} CROSS JOIN root"
    )


ORACLES: dict[str, str] = {
    "op11_merkle_manifest": _merkle_sql(),
    "op2_near_dedup": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN comp c ON c.x = d.doc_id
""",
    "op4_mixing": f"""
WITH d AS (SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, source_size::DOUBLE * 2::DOUBLE AS cap,
  [3::DOUBLE, 1::DOUBLE, 2::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM w),
t AS (SELECT source, source_size, least(cap, max(lvl) OVER () * weight) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0::DOUBLE END AS rate,
    ('0x' || substr(md5('mix' || coalesce(':' || d.source, '')), 1, 5))::BIGINT::DOUBLE / 1048576::DOUBLE AS u,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS LAST) AS n
  FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
c AS (SELECT *, (floor(u + rate * n) - floor(u + rate * (n - 1)))::BIGINT AS copies FROM r)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM c
""",
    "op8_url_filters": f"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS row
  FROM pages
), rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT row, arg_max(h || r.p, length(h || r.p)) AS rule, arg_max(v, length(h || r.p)) AS v
  FROM p JOIN rules r ON (host = h OR host LIKE '%.' || h) AND starts_with(p.path, r.p) GROUP BY row
)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches(host,
  '(^|[.-])(adult|ads|ads-track|casino|casino-win|cheap-pills|free-bets|poker|porn|spam|spam-farm|warez|xxx)([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit USING (row)
""",
}
