"""Near-duplicate documents by SimHash fingerprints searched in BK-trees.

A document's fingerprint has a bit set where over half of its word shingles'
XXH64 hashes (seed 42) have it. Fingerprints within ``radius`` bits are linked.

A BK-tree keeps each node's children by their integer Hamming distance to it;
by the triangle inequality a search at distance d of a node follows only the
edges d - radius .. d + radius. One tree of all fingerprints would grow with
the corpus, on the driver and in every task. So the distinct fingerprints are
dealt into shards: the 64 bits are cut in radius + 1 parts, and two
fingerprints within the radius agree in one part at least, so trees that hold
the fingerprints of one part's value find every link. A part's value that too
many fingerprints share is dealt once more by parts of its other bits; what is
still too large is cut into slices, each slice's tree is met by every later
slice. Trees and their queries travel to one task; no task holds more than two
slices or some small trees, and from a shard only a spanning forest of its
links leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import mapped, stored, tidy
from .words import _SPACE, U, blocks, signed, words_of


@dataclass(frozen=True)
class TreeParams:
    shingle: int = 3
    radius: int = 2
    slice_size: int = 4096  # fingerprints of one tree, and of the queries it meets at once


# ---------------------------------------------------------------- fingerprints

#: The constants of XXH64.
_P1, _P2, _P3 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
_P4, _P5 = U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)
SEED = 42
_LONG = 256  # longer strings are hashed one by one


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U(n)) | (x >> U(64 - n))


def _lane(x: np.ndarray) -> np.ndarray:
    return _turn(x * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 of ``data[starts[i]:ends[i]]``, all at once."""
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    size = ends - starts
    at = starts.copy()
    h = np.full(len(starts), _P5 + U(SEED), U)
    long = np.flatnonzero((size >= 32) & (size <= _LONG))
    if len(long):
        zero = np.zeros(len(long), U)
        lanes = [zero + U(SEED) + _P1 + _P2, zero + U(SEED) + _P2, zero + U(SEED), zero + U(SEED) - _P1]
        stripes, here = size[long] // 32, at[long]
        for step in range(int(stripes.max())):
            on = stripes > step
            for k in range(4):
                lanes[k][on] = _turn(lanes[k][on] + words[here[on] + (32 * step + 8 * k)] * _P2, 31) * _P1
        joined = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
        for k in range(4):
            joined = (joined ^ _lane(lanes[k])) * _P1 + _P4
        h[long] = joined
        at[long] += stripes * 32
    h += size.astype(U)
    short = size <= _LONG
    for _ in range(3):
        on = np.flatnonzero(short & (ends - at >= 8))
        h[on] = _turn(h[on] ^ _lane(words[at[on]]), 27) * _P1 + _P4
        at[on] += 8
    on = np.flatnonzero(short & (ends - at >= 4))
    h[on] = _turn(h[on] ^ ((words[at[on]] & U(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[on] += 4
    for _ in range(3):
        on = np.flatnonzero(short & (ends > at))
        h[on] = _turn(h[on] ^ (data[at[on]] * _P5), 11) * _P1
        at[on] += 1
    h ^= h >> U(33)
    h *= _P2
    h ^= h >> U(29)
    h *= _P3
    h ^= h >> U(32)
    for i in np.flatnonzero(~short):
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed=SEED)
    return h


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every word shingle, repeats included, its words joined by one space; offsets by text). A-Z count as a-z.

    A text of fewer words than ``width`` has its whole word sequence as its one
    shingle; without words (or null) it has none.
    """
    w = words_of(texts, lower=True, hashed=False)
    lengths = w.ends - w.starts
    total = int(lengths.sum())
    joined = np.full(total + len(lengths), 32, np.uint8)
    joined[np.arange(total) + np.repeat(np.arange(len(lengths)), lengths)] = w.data[~_SPACE[w.data]]
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    counts = w.counts
    size = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    off = np.concatenate([[0], np.cumsum(size)])
    first = np.repeat(w.rows[:-1], size) + np.arange(off[-1]) - np.repeat(off[:-1], size)
    last = first + np.repeat(np.minimum(counts, width), size) - 1
    return xxh64(joined, starts[first], ends[last]), off


def majority_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """By text, the bits set in over half of its hashes (0 without hashes)."""
    size = np.diff(offsets)
    out = np.zeros(len(size), U)
    filled = np.flatnonzero(size)
    if not len(filled):
        return out
    # eight one-byte counters to a word, so a run of at most 255 hashes is added up at once
    runs = -(-size[filled] // 255)
    text_runs = np.cumsum(runs) - runs
    begins = np.repeat(offsets[:-1][filled], runs) + 255 * (np.arange(runs.sum()) - np.repeat(text_runs, runs))
    half = size[filled]
    for k in range(8):
        added = np.add.reduceat((hashes >> U(k)) & U(0x0101010101010101), begins)
        by_byte = np.add.reduceat(added.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), text_runs, axis=0)
        for j in range(8):
            out[filled] |= (2 * by_byte[:, j] > half).astype(U) << U(8 * j + k)
    return out


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, fingerprint long) of ``docs(doc_id, text)``."""

    def run(batches):
        for b in blocks(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), signed(majority_bits(*shingle_hashes(b.column(1), width)))], ["doc_id", "fingerprint"])

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, fingerprint long")


# ---------------------------------------------------------------- BK-trees

def grow(values: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees over distinct values, one by bucket (sorted): (node of each value's root, child keys, child nodes).

    Children are found by the key ``parent * 65 + distance``; keys are sorted.
    All values walk down at once: where several stand at one edge, the first
    becomes the edge's child and the others go on from it.
    """
    n = len(values)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if n else np.zeros(0, np.int64)
    root = np.repeat(first, np.diff(np.append(first, n)))
    left = np.flatnonzero(root != np.arange(n))
    at = root[left]
    keys, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(left):
        key = at * 65 + np.bitwise_count(values[left] ^ values[at])
        key, place, edge = np.unique(key, return_index=True, return_inverse=True)
        keys.append(key)
        children.append(left[place])
        stay = np.ones(len(left), bool)
        stay[place] = False
        left, at = left[stay], left[place][edge[stay]]
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return root, key[order], child[order]


def search(values: np.ndarray, keys: np.ndarray, children: np.ndarray, asked: np.ndarray, roots: np.ndarray, radius: int, at_once: int = 2048):
    """Yields (positions in ``asked``, nodes) within the radius, query by query in groups of ``at_once``."""
    for begin in range(0, len(asked), at_once):
        who = np.arange(begin, min(begin + at_once, len(asked)))
        node = roots[who]
        while len(who):
            d = np.bitwise_count(asked[who] ^ values[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield who[hit], node[hit]
            low = np.searchsorted(keys, node * 65 + np.maximum(d - radius, 0))
            count = np.searchsorted(keys, node * 65 + np.minimum(d + radius, 64), side="right") - low
            place = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
            who, node = np.repeat(who, count), children[place]


def _spanning(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest position each of n positions reaches over the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == before).all():
            return label


def _shard_links(rows: pa.Table, radius: int) -> pa.Table:
    """A spanning forest of the links in a shard: of the queries with the trees of their buckets."""
    role, bucket = rows["role"].to_numpy(), rows["bucket"].to_numpy()
    values = rows["fingerprint"].to_numpy().view(U)
    order = np.argsort(bucket, kind="stable")
    role, bucket, values = role[order], bucket[order], values[order]
    member, asks = np.flatnonzero(role != _ASKS), np.flatnonzero(role != _STANDS)
    root, keys, children = grow(values[member], bucket[member])
    known, first = np.unique(bucket[member], return_index=True)
    place = np.searchsorted(known, bucket[asks])
    place[place == len(known)] = 0
    met = known[place] == bucket[asks] if len(known) else np.zeros(len(asks), bool)
    asks, starts = asks[met], first[place[met]]
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    held = 0
    label = np.arange(len(values))
    for who, node in search(values[member], keys, children, values[asks], starts, radius):
        u.append(asks[who])
        v.append(member[node])
        held += len(who)
        if held > 1 << 21:  # links are folded as they come, so a dense shard needs no list of all its pairs
            u, v, held = [np.arange(len(label)), *u], [label, *v], 0
            label = _spanning(len(values), np.concatenate(u), np.concatenate(v))
            u, v = [], []
    label = _spanning(len(values), np.concatenate([np.arange(len(label)), *u]), np.concatenate([label, *v]))
    apart = np.flatnonzero(values != values[label])
    return pa.table({"u": signed(values[apart]), "v": signed(values[label[apart]])})


# ---------------------------------------------------------------- shards

_BOTH, _STANDS, _ASKS = 0, 1, 2


def _parts(bits: list[int], n: int) -> list[int]:
    """n masks that share the given bit positions out evenly."""
    cuts = [len(bits) * k // n for k in range(n + 1)]
    return [sum(1 << b for b in bits[cuts[k] : cuts[k + 1]]) for k in range(n)]


def _mask(m: int) -> Column:
    return F.lit(m - (1 << 64) if m >> 63 else m).cast("long")


def _bucket(salt: Column, mask: int) -> Column:
    """A name for (salt, mask, masked bits); two buckets of one name only make a tree larger."""
    return F.xxhash64(salt, _mask(mask), F.col("fingerprint").bitwiseAND(_mask(mask)))


def _shared(keyed: DataFrame) -> DataFrame:
    """Rows whose bucket holds others too, with the bucket's size ``n``."""
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(sizes, "bucket")


def _dealt(classes: DataFrame, p: TreeParams) -> DataFrame:
    """(shard, bucket, fingerprint, role): every pair of fingerprints within the radius meets in a bucket of a shard."""
    masks = _parts(list(range(64)), p.radius + 1)
    first = F.explode(F.array(*[F.struct(F.lit(k).alias("part"), _bucket(F.lit(0).cast("long"), m).alias("bucket")) for k, m in enumerate(masks)]))
    members = stored(_shared(classes.select("fingerprint", first.alias("x")).select("fingerprint", "x.part", "x.bucket")), "buckets")
    finer = None
    for k, mask in enumerate(masks):
        rest = _parts([b for b in range(64) if not mask >> b & 1], p.radius + 1)
        column = F.array(*[_bucket(F.col("bucket"), m) for m in rest])
        finer = column if finer is None else F.when(F.col("part") == k, column).otherwise(finer)
    hot = members.where(F.col("n") > p.slice_size).select("fingerprint", F.explode(finer).alias("bucket"))
    hot = stored(_shared(hot), "hot_buckets")
    shards = -(-members.count() // p.slice_size) + 1
    whole = members.select("fingerprint", "bucket", "n").unionByName(hot.select("fingerprint", "bucket", "n")).where(F.col("n") <= p.slice_size)
    whole = whole.select(F.pmod(F.xxhash64("bucket"), F.lit(shards)).alias("shard"), "bucket", "fingerprint", F.lit(_BOTH).alias("role"))
    slices = F.ceil(F.col("n") / p.slice_size).cast("int")
    cut = hot.where(F.col("n") > p.slice_size).select("bucket", "fingerprint", slices.alias("slices"), F.pmod(F.xxhash64("fingerprint"), slices).cast("int").alias("mine"))
    met = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    cut = cut.select("bucket", "fingerprint", "mine", met)
    tree, query = F.least("mine", "other"), F.greatest("mine", "other")
    role = F.when(F.col("mine") == F.col("other"), F.lit(_BOTH)).when(F.col("mine") < F.col("other"), F.lit(_STANDS)).otherwise(F.lit(_ASKS))
    cut = cut.select(F.xxhash64("bucket", tree, query).alias("shard"), "bucket", "fingerprint", role.alias("role"))
    return whole.unionByName(cut)


@tidy
def near_duplicates(docs: DataFrame, p: TreeParams = TreeParams()) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs(doc_id, text)``.

    fingerprint is 16 lower-case hex digits; texts without words (or null) have
    zero, linked like any other. component_id is the smallest doc_id reachable
    over links, the document itself included. A row without a doc_id has its
    fingerprint but no component and links with nothing; a repeated doc_id
    yields one row for each of its rows, all in that id's component (texts of
    one id count as linked).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(fingerprints(docs, p.shingle), "fingerprints")
    known = rows.where("doc_id IS NOT NULL")
    classes = stored(known.groupBy("fingerprint").agg(F.min("doc_id").alias("node")), "fingerprint_classes")
    links = _dealt(classes, p).groupBy("shard").applyInArrow(lambda t: _shard_links(t, p.radius), "u long, v long")
    texts_of_id = known.groupBy("doc_id").agg(F.min("fingerprint").alias("v"), F.max("fingerprint").alias("w")).where("v < w")
    repeated = known.join(texts_of_id, "doc_id").select(F.col("fingerprint").alias("u"), "v")
    joined = components(links.union(repeated)).select(F.col("node").alias("fingerprint"), "component")
    named = classes.join(joined, "fingerprint", "left").select("fingerprint", "node", F.coalesce("component", "fingerprint").alias("component"))
    named = stored(named, "named_classes")
    least = named.groupBy("component").agg(F.min("node").alias("component_id"))
    labels = named.join(least, "component").select("fingerprint", "component_id")
    found = rows.join(labels, "fingerprint", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return stored(found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), own.alias("component_id")), "near_fingerprints")
