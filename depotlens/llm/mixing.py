"""Mixing sources to target weights by systematic sampling.

Targets: sources in code point order (null last) take the weights in turn and
share ``share`` times all words; a target stops at ``cap`` times its source's
size and the excess is shared again by weight. That fixed point is a water
level: with sources ordered by cap / weight, the level is the highest of
(budget - caps before) / (weights from here on).

Sampling: within a source, documents stand in the order of (size, doc_id) and
each expects ``target / source size`` copies. The prefix sum of the expected
copies plus one random offset of the source (a hash of the seed and its name,
so reruns agree) crosses some integers; a document is taken once per integer
it crosses. As sizes rise along the order, the words taken follow the target
closely.

Positions along the order come from counts, not from one sort: counts by
(source, size) are summed up per source, counts by blocks of 65,536 doc_ids
within (source, size), and only such a block is numbered by a window, so a
source or a size that holds most rows is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored


@dataclass(frozen=True)
class MixParams:
    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    cap: float = 2.0
    seed: str = "mix"


def word_count(text: Column) -> Column:
    """Number of words ([^\\x20\\x09-\\x0D]+) of a text; null counts 0."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    ends = (F.element_at(parts, 1) == "").cast("long") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.size(parts).cast("long") - ends


def _offset(source: Column, p: MixParams) -> Column:
    """The source's random offset in [0, 1): a multiple of 2^-20, so sums with whole numbers are exact."""
    name = F.concat(F.lit(p.seed), F.coalesce(F.concat(F.lit(":"), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 5), 16, 10).cast("double") / float(1 << 20)


def source_targets(sizes: DataFrame, p: MixParams) -> DataFrame:
    """(source, source_size, target) from ``sizes(source, source_size)``, one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(p.weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in p.weights]), (turn + 1).cast("int"))
    filling = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = filling.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everywhere).cast("double") * p.share
    caps_before = F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    weights_left = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size").cast("double") * p.cap)
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("level_here", (budget - caps_before) / weights_left)
        .withColumn("level", F.max("level_here").over(everywhere))
        .select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))
    )


def mix_plan(docs: DataFrame, p: MixParams = MixParams(), carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: (doc, size, source_size, target, copies, taken).

    ``doc`` is a struct of the columns named in ``carry`` (all by default), so
    their names cannot clash; without the text, texts are read once and only
    sizes move. Null texts have size 0; a null source is a source of its own;
    rows with a null doc_id stand after the others of their size; rows that
    repeat a doc_id are counted each, in no defined order among themselves.
    """
    carry = docs.columns if carry is None else carry
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc")
    sized = docs.select(
        row,
        word_count(F.col("text").cast("string")).alias("size"),
        F.col("source").cast("string").alias("source"),
        F.shiftright(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), 16).alias("block"),
        F.col("doc_id").cast("long").alias("id"),
    )
    if "text" not in carry:
        sized = stored(sized, "sizes")
    counts = stored(sized.groupBy("source", "size", "block").agg(F.count("*").alias("n")), "mix_blocks")
    by_size = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(totals, p)

    def counted_before(*group: str, order: str) -> Column:
        earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(earlier), F.lit(0))

    by_size = by_size.select("source", "size", counted_before("source", order="size").alias("smaller"))
    blocks = counts.select("source", "size", "block", counted_before("source", "size", order="block").alias("before"))

    places = (
        blocks.alias("b")
        .join(by_size.alias("s"), F.expr("b.source <=> s.source AND b.size = s.size"))
        .join(targets.alias("t"), F.expr("b.source <=> t.source"))
        .select(
            F.col("b.source").alias("p_source"), F.col("b.size").alias("p_size"), F.col("b.block").alias("p_block"),
            (F.col("smaller") + F.col("before")).alias("before"), "source_size", "target",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0)).alias("rate"),
        )
        .withColumn("offset", _offset(F.col("p_source"), p))
    )
    places = stored(places, "mix_places")
    number = F.row_number().over(Window.partitionBy("source", "size", "block").orderBy(F.col("id").asc_nulls_last()))
    at = F.col("before") + F.col("number")
    copies = F.floor(F.col("offset") + F.col("rate") * at) - F.floor(F.col("offset") + F.col("rate") * (at - 1))
    return (
        sized.withColumn("number", number)
        .join(places.hint("merge"), F.expr("source <=> p_source AND size = p_size AND block = p_block"))
        .withColumn("copies", copies.cast("long"))
        .select("doc", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed(docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """The mix: every row of ``docs`` once per copy taken, with its columns and a struct ``mix`` (copy, size, target)."""
    plan = mix_plan(docs, p).where("copies > 0")
    emitted = plan.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    name = "mix" if "mix" not in docs.columns else "mix_taken"
    return emitted.select("doc.*", F.struct("copy", "size", "target").alias(name))
