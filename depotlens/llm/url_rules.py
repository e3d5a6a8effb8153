"""URL rules indexed by their rarest literal token.

A rule is a regular expression over ``host || path`` together with the
literal tokens ([a-z0-9]+, lower case) that every match must contain. Among
those the rule is filed under the token that is rarest in the URLs at hand.
The distinct tokens of a URL fetch the rules filed under them, and only these
run their regular expression. DataFrame functions only.

A *prefix* rule (host, path) fits its host and all subdomains when the URL's
path starts with the rule's path; the longest fitting prefix rule decides.
Where none fits, *pattern* rules (unwanted hosts) decide: block if one
matches, else allow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: More rules than this are joined by a shuffle instead of a broadcast.
MAX_BROADCAST_RULES = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str  # allow or block
    regex: str
    tokens: tuple[str, ...]
    prefix: bool  # prefix rules outrank pattern rules, longer names outrank shorter ones


def prefix_rule(verdict: str, host: str, path: str) -> Rule:
    regex = r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(path)
    return Rule(host + path, verdict, regex, tuple(dict.fromkeys(re.findall("[a-z0-9]+", (host + path).lower()))), True)


def host_words(first: str, *more: str) -> Rule:
    """Blocks hosts with these words next to each other inside one label or between dots."""
    words = (first, *more)
    return Rule("*" + "-".join(words) + "*", "block", r"^(?:[^/]*[.-])?" + "-".join(words) + r"(?:[.-][^/]*)?(?:/|$)", words, False)


# The rules of the contract, then unwanted hosts.
PREFIX_RULES = (
    prefix_rule("allow", "com", "/"),
    prefix_rule("block", "example.com", "/en/"),
    prefix_rule("allow", "www.example.com", "/en/"),
    prefix_rule("block", "net", "/es/"),
    prefix_rule("block", "net", "/fr/"),
)
HOST_RULES = (
    host_words("adult"), host_words("ads"), host_words("ads", "track"), host_words("casino"), host_words("casino", "win"),
    host_words("cheap", "pills"), host_words("free", "bets"), host_words("poker"), host_words("porn"), host_words("spam"),
    host_words("spam", "farm"), host_words("warez"), host_words("xxx"),
)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _rows(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    items = [
        F.struct(F.lit(i).alias("rule_id"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"), F.lit(r.regex).alias("regex"), F.lit(r.prefix).alias("prefix"), F.array(*[F.lit(t) for t in r.tokens]).alias("tokens"))
        for i, r in enumerate(rules)
    ]
    return spark.range(1).select(F.explode(F.array(*items)).alias("r")).select("r.*")


def url_verdicts(urls: DataFrame, rules: tuple[Rule, ...] = PREFIX_RULES + HOST_RULES) -> DataFrame:
    """(url, rule, verdict) for each distinct url of ``urls(url)`` that a rule fits; rule is null where a pattern rule decided."""
    few = len(rules) <= MAX_BROADCAST_RULES
    small = F.broadcast if few else lambda x: x
    known = urls.where("url IS NOT NULL").select(F.col("url").cast("string").alias("url")).groupBy("url").agg(F.count("*").alias("pages"))
    target = F.concat(host_of(F.col("url")), path_of(F.col("url")))
    words = F.array_distinct(F.regexp_extract_all(F.lower("target"), F.lit("[a-z0-9]+"), F.lit(0)))
    tokens = known.withColumn("target", target).select("url", "pages", "target", F.explode(words).alias("token"))

    listed = _rows(urls.sparkSession, rules)
    literal = listed.select("rule_id", F.explode("tokens").alias("token"))
    use = tokens.join(small(literal.select("token").distinct()), "token").groupBy("token").agg(F.sum("pages").alias("uses"))
    filed = (
        literal.join(use, "token", "left")
        .groupBy("rule_id")
        .agg(F.min(F.struct(F.coalesce("uses", F.lit(0)), "token")).alias("rarest"))
        .select("rule_id", F.col("rarest.token").alias("token"))
        .join(listed.drop("tokens"), "rule_id")
    )
    hits = tokens.join(small(filed), "token").where(F.expr("target RLIKE regex"))
    best = F.max(F.struct("prefix", F.length("rule").alias("size"), "rule", "verdict")).alias("best")
    return hits.groupBy("url").agg(best).select(
        "url", F.when(F.col("best.prefix"), F.col("best.rule")).alias("rule"), F.col("best.verdict").alias("verdict")
    )


def judged_pages(pages: DataFrame, rules: tuple[Rule, ...] = PREFIX_RULES + HOST_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages(page_id, url)``.

    A null url or one without ``://`` has empty host and path, fits no rule
    and is allowed. Repeated rows and ids are judged alike, each by its url.
    """
    own = pages.select("page_id", F.col("url").cast("string").alias("url"))
    return own.join(url_verdicts(own.select("url"), rules), "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )
