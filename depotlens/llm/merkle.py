"""Merkle manifest of a document table, with an inclusion proof for every document.

Each row is a leaf. The leaves of a language form a tree in the order of their
ids, the languages' subroots form one more tree on top. Nodes carry
nested-interval labels: ``[lo, hi)`` is the range of leaf ranks a node covers.
A level's nodes fall into buckets of the level above (``lo`` divided by the
width of that level), and a join by bucket, with containment of the intervals,
attaches a run of siblings to its parent and all that the parent has from its
own ancestors. A node's siblings are the interval difference within the
parent: the left ones lie in ``[parent.lo, lo)``, the right ones in
``[hi, parent.hi)``.

Ranks come from a range-partitioned, sorted table: a row's place in its
partition plus the counts of the partitions before, so a language with most of
the rows is spread like any other. Levels shrink by the fan-out, so all levels
together hold little more than the leaves; a group never has more rows than
the fan-out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored, tidy

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class ManifestParams:
    fan_out: int = 8
    tampered_every: int = 3  # rows whose crc32(decimal doc_id) it divides


def hashed(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def _field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, p: ManifestParams) -> DataFrame:
    """(doc_id, tree, leaf, tampered): the leaf of each row, and the leaf of its tampered form."""
    # "" names the tree of a null language and "=x" that of x: the order of these names is that of the languages, null first
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    fields = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text").cast("string")
    leaf = hashed(*fields, _field(text))
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % p.tampered_every == 0
    lowered = hashed(*fields, _field(F.translate(text, UPPER, LOWER)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf.alias("leaf"), F.when(struck, lowered).otherwise(leaf).alias("tampered"))


def ranked(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``lo`` (rank within its tree, from 0) and ``n`` (rows of the tree)."""
    spread = rows.withColumn("_row", F.monotonically_increasing_id())  # parts rows that are equal in all the order's columns
    by = [tree, *order, "_row"]
    placed = stored(spread.repartitionByRange(*by).sortWithinPartitions(*by).drop("_row").withColumn("_at", F.monotonically_increasing_id()), name)
    task = F.shiftright("_at", 33).alias("_task")
    counts = placed.groupBy(tree, task).agg(F.count("*").alias("_count"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(tree)
    before = F.coalesce(F.sum("_count").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(tree, "_task", "_first", before.alias("_before"), F.sum("_count").over(whole).alias("n"))
    found = placed.withColumn("_task", task).join(offsets, [tree, "_task"])
    return found.withColumn("lo", F.col("_at") - F.col("_first") + F.col("_before")).select(*rows.columns, "lo", "n")


@dataclass
class Tree:
    """``runs[k]``: (tree, bucket, lo, hi, n, children) of level k's siblings; ``tops``: (tree, level, lo, hi, digest)."""

    runs: list[DataFrame]
    tops: DataFrame


def grown(nodes: DataFrame, carry: list[str], fan_out: int, name: str) -> Tree:
    """The trees over leaf nodes (tree, lo, n, digest, *carry)."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    nodes = nodes.withColumn("hi", F.col("lo") + 1)
    runs, tops = [], []
    width = 1  # leaves that a node of this level covers
    while True:
        done = nodes.where(F.col("n") <= width)
        tops.append(done.select("tree", F.lit(len(runs)).alias("level"), "lo", "hi", "digest"))
        if most <= width:
            return Tree(runs, reduce(DataFrame.unionByName, tops))
        child = F.struct("lo", "hi", "digest", *(carry if width == 1 else []))
        width *= fan_out
        bucket = F.floor(F.col("lo") / F.lit(width)).alias("bucket")
        run = nodes.where(F.col("n") > width // fan_out).groupBy("tree", "n", bucket).agg(F.array_sort(F.collect_list(child)).alias("children"))
        run = run.select("tree", "n", "bucket", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"), "children")
        runs.append(stored(run, f"{name}_runs"))
        digest = hashed(F.array_join(F.transform("children", lambda c: c["digest"]), ""))
        nodes = runs[-1].select("tree", "n", "lo", "hi", digest.alias("digest"))


def attached(tree: Tree, tops: DataFrame, carry: list[str], given: list[str], fan_out: int) -> DataFrame:
    """The leaf nodes (tree, lo, digest, *carry) with their path and what their top has in the columns ``given``.

    ``tops`` are the tree's tops with ``path`` and ``given``. A path lists, from
    the node upwards, the digests of its left and right siblings in each run.
    """
    columns = ["tree", "lo", "hi", "path", *given]
    above = None
    for level in range(len(tree.runs), 0, -1):
        here = tops.where(F.col("level") == level).select(*columns)
        parents = here if above is None else above.select(*columns).unionByName(here)
        width = fan_out**level
        parents = parents.withColumn("bucket", F.floor(F.col("lo") / F.lit(width)))
        inside = (F.col("p.tree") == F.col("r.tree")) & (F.col("p.bucket") == F.col("r.bucket")) & (F.col("p.lo") <= F.col("r.lo")) & (F.col("r.hi") <= F.col("p.hi"))
        runs = tree.runs[level - 1].alias("r").join(parents.alias("p"), inside)
        nodes = runs.select("r.tree", "children", "path", *given, F.explode("children").alias("c"))

        def side(keep) -> Column:
            return F.array_join(F.transform(F.filter("children", keep), lambda x: x["digest"]), "")

        step = F.struct(side(lambda x: x["hi"] <= F.col("c.lo")).alias("left"), side(lambda x: x["lo"] >= F.col("c.hi")).alias("right"))
        own = [F.col(f"c.{c}").alias(c) for c in carry] if level == 1 else []
        above = nodes.select("tree", F.col("c.lo").alias("lo"), F.col("c.hi").alias("hi"), F.col("c.digest").alias("digest"), F.concat(F.array(step), "path").alias("path"), *given, *own)
    return above


def _paths(leaf_nodes: DataFrame, tree: Tree, tops: DataFrame, carry: list[str], given: list[str], fan_out: int) -> DataFrame:
    """As ``attached``, together with the leaf nodes that are a top themselves."""
    lone = leaf_nodes.where("n = 1").select("tree", "lo", "digest", *carry)
    lone = lone.join(tops.where("level = 0").select("tree", "path", *given), "tree").select("tree", "lo", "digest", "path", *given, *carry)
    if not tree.runs:
        return lone
    return attached(tree, tops, carry, given, fan_out).select("tree", "lo", "digest", "path", *given, *carry).unionByName(lone)


_NO_PATH = "array<struct<left:string,right:string>>"


@tidy
def manifest(docs: DataFrame, p: ManifestParams = ManifestParams()) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of ``docs``.

    ``docs`` has doc_id, source, lang, n_chars and text; nulls in any of them
    are values of their own. Rows without a doc_id stand before the others of
    their language, rows that repeat a doc_id in the order of their leaves, and
    equal rows are leaves each. An empty table has no rows and no root.
    folded_root is what the proof gives for the tampered form where
    ``tampered_every`` divides the crc32 of the id (for the row itself
    elsewhere); verified tells whether that is the root.
    """
    rows = stored(leaves(docs, p), "leaves")
    carry = ["doc_id", "tampered"]
    nodes = ranked(rows.withColumnRenamed("leaf", "digest"), "tree", ["doc_id", "digest"], "leaf_places")
    tree = grown(nodes, carry, p.fan_out, "language")
    tops = stored(tree.tops, "subroots")

    named = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = ranked(named, "tree", ["name"], "subroot_places")
    crown = grown(subroots, ["name"], p.fan_out, "crown")
    top = crown.tops.select("tree", "level", "lo", "hi", F.array().cast(_NO_PATH).alias("path"), F.col("digest").alias("root"))
    known = stored(_paths(subroots, crown, top, ["name"], ["root"], p.fan_out), "subroot_paths")
    known = known.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path", "root")
    tops = tops.select("tree", "level", "lo", "hi").join(known, "tree")

    found = _paths(nodes, tree, tops, carry, ["subroot", "root"], p.fan_out)
    proof = hashed(F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), ""))
    folded = F.aggregate("path", F.col("tampered"), lambda node, x: F.sha2(F.concat(x["left"], node, x["right"]).cast("binary"), 256))
    found = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return stored(found.withColumn("verified", F.col("folded_root") == F.col("root")), "manifest")
