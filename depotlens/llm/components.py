"""Union-find grouping of links, distributed.

Every task first unions the links it holds; what is left of them is, for each
node, the smallest node of its tree in that task. The trees a node has in
different tasks belong together, so the smallest of their roots takes the node
and only links between roots remain. Those are few (a group has at most one
root a task), and large-star / small-star rounds join them until no link
moves; the number of rounds grows with the logarithm of the longest chain of
roots. Nothing is collected but two numbers a round.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import mapped, stored


def _local_roots(batches):
    """Union-find over the links of one task; yields (node, smallest node of its tree), roots included."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            a, c = find(u), find(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["u", "v"])


def _star_rounds(links: DataFrame) -> DataFrame:
    """(node, component) of every node in the distinct ``links(u, v)``."""
    now = stored(links, "links")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state or not seen[0]:
            break
        state = tuple(seen)
        both = now.union(now.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
        now = stored(small.select(F.col("x.u").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct(), "links")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links(u, v)``; component = smallest node reachable.

    Links with a null end and self links are ignored. Repeated links and no
    links at all are fine (the result is then empty).
    """
    links = links.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    trees = stored(mapped(links, _local_roots, "u long, v long"), "trees")
    # a node has at most one root a task, so the sets stay small
    held = stored(trees.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"), F.collect_set("v").alias("roots")), "roots")
    between = held.where(F.size("roots") > 1).select(F.explode("roots").alias("u"), F.col("root").alias("v")).where("u <> v").distinct()
    joined = _star_rounds(between).withColumnRenamed("node", "root")
    return held.join(joined, "root", "left").select("node", F.coalesce("component", "root").alias("component"))
