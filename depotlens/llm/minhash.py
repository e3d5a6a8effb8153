"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

SuperMinHash: every shingle draws one random permutation of the registers,
step by step; the register reached at step j gets the rank ``j + r`` (r in
[0, 1)) if that is its smallest yet. Ranks of one shingle are correlated, which
lowers the variance against independent hashes, and a text stops as soon as no
later step can lower a register. All shingles of a block take step j together
(numpy); the result is that of the shingle-by-shingle form.

Banding proposes, full sets decide: signatures are cut in bands, texts with an
equal band meet in a bucket, and each link is confirmed on the complete shingle
sets (as 64-bit shingle hashes). First each member of a bucket is compared with
the bucket's pivot, so a group of copies costs a few comparisons per member.
Where the confirmed links leave a bucket in several groups, every member
outside the largest group is compared with all the others, in blocks. No link
is lost within a bucket. With 32 bands of 4 registers a pair of similarity
0.80 misses every band with probability 5e-8, one of 0.85 with 5e-11.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import mapped, small_broadcasts, stored, tidy
from .words import U, blocks, list_column, mix, ngram_hashes, signed, words_of

#: Shingles of the documents that one task compares with another such block.
BLOCK_SHINGLES = 1 << 17


@dataclass(frozen=True)
class NearParams:
    shingle: int = 5
    similarity: int = 80  # percent: linked if 100 * intersection >= similarity * union
    bands: int = 32
    band_rows: int = 4

    @property
    def registers(self) -> int:
        return self.bands * self.band_rows


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes by text, sorted; offsets by text). A-Z count as a-z.

    A text of fewer words than ``width`` has its whole word sequence as its one
    shingle; without words (or null) its set is empty.
    """
    w = words_of(texts, lower=True)
    counts = w.counts
    grams = ngram_hashes(w.hashes, width)
    full = np.maximum(counts - width + 1, 0)
    size = np.where(counts == 0, 0, np.maximum(full, 1))
    off = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(off[-1], U)
    for i in np.flatnonzero(size):
        a, o = w.rows[i], off[i]
        if full[i]:
            part = out[o : o + full[i]]
            part[:] = grams[a : a + full[i]]
            part.sort()
        else:
            out[o] = ngram_hashes(w.hashes[a : w.rows[i + 1]], int(counts[i]))[0]
    if not len(out):
        return out, off
    first = np.empty(len(out), bool)
    first[0] = True
    first[1:] = out[1:] != out[:-1]
    first[off[:-1][size > 0]] = True
    kept = np.concatenate([[0], np.cumsum(first)])
    return out[first], kept[off]


def superminhash(elements: np.ndarray, offsets: np.ndarray, registers: int) -> np.ndarray:
    """Signatures (texts x registers) of the element sets; empty sets keep the highest value."""
    n = len(offsets) - 1
    low = np.full(n * registers, np.iinfo(np.uint64).max, U)
    row = np.repeat(np.arange(n), np.diff(offsets))
    live, steps = elements, []
    for j in range(registers):
        if not len(live):
            break
        draw = mix(live + U((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        swap = ((draw >> U(40)) * U(registers - j) >> U(24)).astype(np.int16) + np.int16(j)
        slot = swap.copy()
        for i in range(j - 1, -1, -1):  # where this slot's value stood before the earlier swaps
            slot[slot == steps[i]] = i
        np.minimum.at(low, row * registers + slot, U(j << 32) | (draw & U(0xFFFFFFFF)))
        steps.append(swap)
        if j % 4 == 3 or j < 4:
            on = low.reshape(n, registers).max(axis=1) >= U((j + 1) << 32)
            keep = on[row]
            if not keep.all():
                live, row, steps = live[keep], row[keep], [s[keep] for s in steps]
    return low.reshape(n, registers)


_NAME = ["n_shingles", "set_a", "set_b"]


def signatures(docs: DataFrame, p: NearParams) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands): set size, two 64-bit sums naming the set, band hashes (null for an empty set)."""

    def run(batches):
        for b in blocks(batches):
            sets, off = shingle_sets(b.column(1), p.shingle)
            size = np.diff(off)
            sig = superminhash(sets, off, p.registers).reshape(-1, p.bands, p.band_rows)
            band = np.broadcast_to(np.arange(1, p.bands + 1, dtype=U) * U(0xD1B54A32D192ED03), sig.shape[:2]).copy()
            for k in range(p.band_rows):
                band = mix(band ^ sig[:, :, k]) + U(k)
            filled = size > 0
            bands = list_column(signed(np.ascontiguousarray(band[filled]).reshape(-1)), np.where(filled, p.bands, 0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size), *_set_names(sets, off), bands],
                ["doc_id", *_NAME, "bands"],
            )

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def _set_names(sets: np.ndarray, off: np.ndarray) -> list[pa.Array]:
    """Two 64-bit sums over each set's hashes: with the set's size they name it."""
    names = []
    for salt in (0x51ED270B, 0xA24BAED4):
        run_sum = np.concatenate([np.zeros(1, U), np.cumsum(mix(sets ^ U(salt)))])
        names.append(signed(run_sum[off[1:]] - run_sum[off[:-1]]))
    return names


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, shingles): complete distinct shingle hashes of each document."""

    def run(batches):
        for b in blocks(batches):
            sets, off = shingle_sets(b.column(1), width)
            size = np.diff(off)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size), *_set_names(sets, off), list_column(signed(sets), size)], ["doc_id", *_NAME, "shingles"])

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, set_a long, set_b long, shingles array<long>")


def _confirmed(pairs: DataFrame, names: DataFrame, sets: DataFrame, p: NearParams) -> DataFrame:
    """The pairs (u, v) of nodes whose full sets reach the similarity. ``names`` tells the nodes' sets, ``sets`` holds these by name."""

    name = F.struct(*_NAME)
    for end in "uv":
        pairs = pairs.join(names.select(F.col("node").alias(end), name.alias(f"name_{end}")), end)
    for end in "uv":
        pairs = pairs.join(sets.select(name.alias(f"name_{end}"), F.col("n_shingles").alias(f"n_{end}"), F.col("shingles").alias(f"s_{end}")), f"name_{end}")
    same = F.size(F.array_intersect("s_u", "s_v"))
    return (
        pairs.withColumn("same", same)
        .where(F.col("same") * 100 >= p.similarity * (F.col("n_u") + F.col("n_v") - F.col("same")))
        .select("u", "v")
    )


def _links_between(table: pa.Table, similarity: int) -> pa.Table:
    """Links of the odd members of a block with its other members, one per odd member and group it links to."""
    odd = table.filter(pa.compute.field("odd"))
    rest = table.filter(~pa.compute.field("odd"))
    u, v = [], []
    if odd.num_rows and rest.num_rows:
        sizes = odd["n"].to_numpy()
        own = np.repeat(np.arange(len(sizes)), sizes)
        shingles = odd["shingles"].combine_chunks().flatten().to_numpy()
        order = np.argsort(shingles, kind="stable")
        own = own[order]
        known, first = np.unique(shingles[order], return_index=True)
        first = np.append(first, len(own))
        nodes, groups = odd["node"].to_numpy(), odd["component"].to_numpy()
        linked: set[tuple[int, int]] = set()
        lists = rest["shingles"].combine_chunks()
        for i, (node, group, n) in enumerate(zip(rest["node"].to_pylist(), rest["component"].to_pylist(), rest["n"].to_pylist(), strict=True)):
            mine = lists[i].values.to_numpy()
            at = np.searchsorted(known, mine)
            at[at == len(known)] = 0
            at = at[known[at] == mine]
            count = first[at + 1] - first[at]
            which = np.repeat(first[at], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            same = np.bincount(own[which], minlength=len(sizes))
            for k in np.flatnonzero((same * 100 >= similarity * (sizes + n - same)) & (groups != group)):
                if (int(k), group) not in linked:
                    linked.add((int(k), group))
                    u.append(int(nodes[k]))
                    v.append(node)
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _odd_links(members: DataFrame, groups: DataFrame, names: DataFrame, sets: DataFrame, p: NearParams) -> DataFrame:
    """Links that the pivots have not shown: in bands whose members are not one group yet, every member outside the
    largest group is compared with all members.

    Bands that share members make a cluster, so that no two documents are
    compared once per band. A cluster's members are dealt into blocks of about
    BLOCK_SHINGLES shingles and compared block against block; only links leave
    a task.
    """
    here = members.join(groups, "node")
    open_bands = here.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.min("node").alias("head")).where("a < b")
    here = stored(here.join(open_bands.select("band", "head"), "band"), "open")
    clusters = components(here.select(F.col("node").alias("u"), F.col("head").alias("v"))).withColumnRenamed("component", "cluster")
    inside = here.select("node", "n", "component").distinct().join(clusters, "node")
    sizes = inside.groupBy("cluster", "component").agg(F.count("*").alias("docs"), F.sum("n").alias("n"))
    largest = stored(
        sizes.groupBy("cluster").agg(F.max_by("component", F.struct("docs", "component")).alias("largest"), F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks")),
        "clusters",
    )
    inside = stored(inside.join(largest, "cluster").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "inside")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    against = inside.select("cluster", "node", "component", F.lit(False).alias("odd"), F.explode(every).alias("odd_block"), F.col("mine").alias("block"))
    odd = inside.where("component <> largest").select("cluster", "node", "component", F.lit(True).alias("odd"), F.col("mine").alias("odd_block"), F.explode(every).alias("block"))
    used = odd.select("cluster", "odd_block").distinct()
    dealt = against.join(used, ["cluster", "odd_block"], "left_semi").unionByName(odd)
    dealt = dealt.join(names.select("node", *_NAME), "node").join(sets, _NAME).withColumnRenamed("n_shingles", "n").drop("set_a", "set_b")
    return dealt.groupBy("cluster", "odd_block", "block").applyInArrow(lambda t: _links_between(t, p.similarity), "u long, v long")


@tidy
@small_broadcasts
def near_duplicates(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs(doc_id, text)``.

    component_id is the smallest doc_id reachable over links, the document
    itself included. Rows without words link with nothing. A null doc_id has a
    null component_id and links with nothing; a repeated doc_id yields one row
    for each of its rows, and those with words all carry that id's component:
    each of its texts is compared with the other documents, and texts of one id
    count as linked.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed_docs = stored(signatures(docs, p), "signatures")
    known = signed_docs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # equal sets are one class, and classes, not documents, are the nodes: a doc_id may have several texts
    classes = stored(known.groupBy(*_NAME).agg(F.min("doc_id").alias("doc_id")).withColumn("node", F.monotonically_increasing_id()), "classes")

    # one row per class and band; only bands that two classes share
    own = known.join(classes, [*_NAME, "doc_id"]).dropDuplicates(["node"])
    banded = own.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    shared = stored(banded.groupBy("band").agg(F.count("*").alias("members"), F.min(F.struct("node", "n")).alias("pivot")).where("members > 1"), "shared")
    members = stored(banded.join(shared.select("band", F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("pivot_n")), "band"), "members")
    nodes = stored(members.select("node").distinct(), "nodes")
    names = stored(classes.join(nodes, "node"), "names")
    ids = stored(names.select("doc_id").distinct().sortWithinPartitions("doc_id"), "ids")  # one narrow column: broadcast while it is small
    wanted = docs.join(ids, "doc_id", "left_semi")
    sets = stored(full_sets(wanted, p.shingle).drop("doc_id").dropDuplicates(_NAME), "sets")

    least, most = F.least("n", "pivot_n"), F.greatest("n", "pivot_n")
    stars = members.where((F.col("node") != F.col("pivot")) & (least * 100 >= most * p.similarity)).select(F.col("node").alias("u"), F.col("pivot").alias("v"))
    links = stored(_confirmed(stars.distinct(), names, sets, p), "confirmed")
    joined = components(links)
    groups = stored(nodes.join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "groups")
    more = stored(_odd_links(members.select("band", "node", "n"), groups, names, sets, p), "odd_links")
    joined = components(links.union(more).union(_texts_of_one_id(known, classes)))
    named = stored(classes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")), "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = named.join(least, "component").select(*_NAME, "component_id")
    rows = signed_docs.drop("bands").join(labels, _NAME, "left")
    mine = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("component_id"), F.col("doc_id")))
    return stored(rows.select("doc_id", "n_shingles", mine.alias("component_id")), "near")


def _texts_of_one_id(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (u, v) between the classes of a doc_id that has several."""
    name = F.struct(*_NAME)
    several = known.groupBy("doc_id").agg(F.min(name).alias("a"), F.max(name).alias("b")).where("a <> b").select("doc_id")
    held = known.join(several, "doc_id").join(classes.select(*_NAME, "node"), _NAME).select("doc_id", "node")
    first = held.groupBy("doc_id").agg(F.min("node").alias("first"))
    return held.join(first, "doc_id").select(F.col("node").alias("u"), F.col("first").alias("v"))


def with_copies_marked(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one document of each group is kept (the smallest id)."""
    found = near_duplicates(docs, p)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
