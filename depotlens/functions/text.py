"""Text classifiers as column expressions: flow classes, internal transfers,
tech securities."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.columns import col, contains_any


def flow_class(type_col, rules=P.FLOW_CLASS_RULES) -> Column:
    """Lower-cased booking type -> in / out / tax_in / fee_out / yield_in / ignore.

    First matching rule wins, like a chain of ``if`` tests.
    """
    t = F.lower(F.coalesce(col(type_col), F.lit("")))
    expr = None
    for cls, words in rules:
        cond = contains_any(t, words)
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr.otherwise(F.lit("ignore"))


def flow_class_alt(type_col) -> Column:
    """Second classifier of the reconciliation check (fees before taxes,
    ``div`` only as prefix)."""
    t = F.lower(F.coalesce(col(type_col), F.lit("")))
    expr = None
    for cls, words in P.FLOW_CLASS_RULES_ALT:
        cond = contains_any(t, words)
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    yield_cond = contains_any(t, P.FLOW_CLASS_ALT_YIELD_CONTAINS) | t.startswith(P.FLOW_CLASS_ALT_YIELD_PREFIX)
    return expr.when(yield_cond, F.lit("yield_in")).otherwise(F.lit("ignore"))


def is_internal(remark_col, pattern: str = P.INTERNAL_REMARK_PATTERN) -> Column:
    """Remark marks an internal transfer (case-insensitive, umlaut-aware)."""
    return F.coalesce(col(remark_col), F.lit("")).rlike("(?iu)(?:" + pattern + ")")


def tech_name_regex(names) -> str:
    alts = "|".join(re.escape(n).replace("\\ ", " ") for n in names)
    return r"(?iU)(?:^|\b)(?:" + alts + r")(?:\b|$)"


def tech_hit(name_col, vocab: P.Vocabulary) -> Column:
    """Security name is a tech name, or an ETF with a tech sector word."""
    name = F.coalesce(col(name_col), F.lit(""))
    by_name = name.rlike(tech_name_regex(vocab.tech_names))
    etf = name.rlike(r"(?iU)\b" + re.escape(vocab.etf_word) + r"\b")
    sector = name.rlike(r"(?iU)\b(?:" + "|".join(re.escape(w) for w in vocab.etf_sector_words) + r")\b")
    return by_name | (etf & sector)
