"""Second-order boosted trees for a 0/1 label, trained where the rows are.

Logistic loss with gradients g = w (p - y) and curvatures h = w p (1 - p); a
split's worth is the drop of -G^2 / (H + l2) / 2, a leaf's value -G / (H + l2)
times the step. Every tree sees a share of the rows and of the columns.

Columns are cut into at most ``bins`` bins at quantiles once, and the binned
rows are stored in blocks of one byte a value. A level of a tree is one pass:
each task adds up G and H by (node, column, bin) over its blocks, Spark adds the
tasks' sums up, and the driver gets one number per (node, column, bin), however
many rows there are. Of two sibling nodes only the lighter one is added up, the
other is the parent less it. Sums are whole numbers (units of 2^-20), so a model
depends neither on the partitioning nor on the order of the rows' sums.
A row may stand for several equal ones (``times``): they are added up at once,
and a tree's share of the rows takes as many of them as it would one by one.

A row's margin is stored with it every ``store_every`` trees and the trees since
are applied on the way, so passes read stored files only: a lost executor costs
its tasks, nothing else.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from depotlens.session import materialize, ship_code

UNIT = float(1 << 20)
FEW_BLOCKS = 16  # blocks to an Arrow batch
BLOCK_ROWS = 1 << 14
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@dataclass(frozen=True)
class BoostParams:
    trees: int = 400
    max_depth: int = 4
    step: float = 0.05
    l2: float = 2.0
    row_share: float = 0.9
    column_share: float = 0.9
    bins: int = 64  # at most 256
    least_weight: float = 1.0  # least sum of curvatures in a child
    store_every: int = 25
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2 i + 1 and 2 i + 2). ``column`` is -1 at leaves; rows with x <= border go left."""

    column: np.ndarray
    border: np.ndarray
    cut: np.ndarray  # the border as a bin: rows with bin <= cut go left
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray  # sum of curvatures

    @staticmethod
    def empty(depth: int) -> "Tree":
        n = (1 << (depth + 1)) - 1
        return Tree(np.full(n, -1, np.int64), np.zeros(n), np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n))

    def leaves(self, x: np.ndarray, border: np.ndarray) -> np.ndarray:
        """The node each row of ``x`` (columns first) ends in, with ``border`` either borders or bins."""
        node = np.zeros(x.shape[1], np.min_scalar_type(-len(self.column)))
        for i in np.flatnonzero(self.column >= 0).tolist():  # parents come before their children
            right = x[self.column[i]] > border[i]
            node += (node == i) * (right + node.dtype.type(i + 1))
        return node


@dataclass
class BoostedTrees:
    columns: list[str]
    trees: list[Tree]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees' values for rows of ``x`` (columns first)."""
        out = np.zeros(x.shape[1])
        for t in self.trees:
            out += t.value[t.leaves(x, t.border)]
        return out

    def probability(self, df: DataFrame) -> Column:
        """The probability of label 1, as a column over ``df`` (its columns are numbers without nulls)."""
        ship_code(df.sparkSession)
        model = df.sparkSession.sparkContext.broadcast(self)  # trees x nodes, whatever the rows

        @pandas_udf("double")
        def p(values: pd.DataFrame) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-model.value.margins(np.ascontiguousarray(values.to_numpy(float).T)))))

        return p(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(self.columns)]))

    def values(self, rows: pd.DataFrame) -> np.ndarray:
        """Probabilities of rows given by column name; a column that is missing counts as 0."""
        x = np.zeros((len(self.columns), len(rows)))
        for i, c in enumerate(self.columns):
            if c in rows:
                x[i] = rows[c].to_numpy(float)
        return 1 / (1 + np.exp(-self.margins(x)))

    def borders(self) -> dict[str, set[float]]:
        """The borders that the trees test each column against."""
        found: dict[str, set[float]] = {}
        for t in self.trees:
            for i in np.flatnonzero(t.column >= 0).tolist():
                found.setdefault(self.columns[t.column[i]], set()).add(float(t.border[i]))
        return found

    def importances(self) -> dict[str, float]:
        """Share of each column in the worth of all splits."""
        total = dict.fromkeys(self.columns, 0.0)
        for t in self.trees:
            for c, g in zip(t.column.tolist(), t.gain.tolist()):
                if c >= 0:
                    total[self.columns[c]] += g
        whole = sum(total.values())
        return {c: v / whole if whole else 0.0 for c, v in total.items()}

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row a node, for storing."""
        rows = [(k, i, self.columns[t.column[i]] if t.column[i] >= 0 else None, float(t.border[i]), float(t.value[i]), float(t.gain[i]), float(t.cover[i]))
                for k, t in enumerate(self.trees) for i in range(len(t.column)) if t.column[i] >= 0 or t.cover[i]]
        return spark.createDataFrame(rows, "tree int, node int, column string, border double, value double, gain double, cover double")

    @staticmethod
    def from_frame(df: DataFrame, columns: list[str]) -> "BoostedTrees":
        trees: dict[int, list] = {}
        for r in df.collect():  # trees x nodes
            trees.setdefault(r["tree"], []).append(r)
        place = {c: i for i, c in enumerate(columns)}
        out = []
        for _, nodes in sorted(trees.items()):
            size = max(n["node"] for n in nodes) + 1
            t = Tree.empty(0)
            t = Tree(*(np.concatenate([a, np.full(max(0, size - len(a)), -1 if a is t.column else 0, a.dtype)]) for a in (t.column, t.border, t.cut, t.value, t.gain, t.cover)))
            for n in nodes:
                i = n["node"]
                t.column[i] = -1 if n["column"] is None else place[n["column"]]
                t.border[i], t.value[i], t.gain[i], t.cover[i] = n["border"], n["value"], n["gain"], n["cover"]
            out.append(t)
        return BoostedTrees(list(columns), out)


# --------------------------------------------------------------------------
# Bins and blocks
# --------------------------------------------------------------------------

def bin_borders(df: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """Rising borders per column: its values at the ranks k / bins, without the largest (a border that parts nothing)."""
    shares = [k / bins for k in range(1, bins + 1)]
    found = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 20 * bins * bins).alias(str(i)) for i, c in enumerate(columns)],
                   *[F.max(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return [np.array(sorted({v for v in found[str(i)] or [] if v < found[f"m{i}"]})) for i in range(len(columns))]


_BLOCKS = "block long, n int, bins binary, label binary, weight binary, times binary, margin binary"


@contextmanager
def _arrow_rows(spark: SparkSession, rows: int):
    """So many rows to an Arrow batch while a job runs; the session's own setting is put back."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def bin_rows(df: DataFrame, columns: list[str], labels: dict[str, str], times: str | None, borders: list[np.ndarray]) -> dict[str, DataFrame]:
    """Stored blocks of the binned rows by label; ``labels`` names the weight of each. The rows are binned and stored once for all labels."""
    pairs = list(labels.items())
    first = 1 + 2 * len(pairs)
    names = ["block", "n", "bins", "times", "margin", *[f"{c}{i}" for i in range(len(pairs)) for c in ("label", "weight")]]

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                values = [c.to_numpy(zero_copy_only=False) for c in part.columns]
                bins = np.stack([np.searchsorted(e, v, side="left") for e, v in zip(borders, values[first:], strict=True)]).astype(np.uint8)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int64()), pa.array([n], pa.int32()), pa.array([bins.tobytes()], pa.binary()),
                    pa.array([values[0].astype(np.int64).tobytes()], pa.binary()), pa.array([np.zeros(n).tobytes()], pa.binary()),
                    *[pa.array([v.astype(np.float64).tobytes()], pa.binary()) for v in values[1:first]]], names)
                block += 1

    plain = df.select((F.lit(1) if times is None else F.col(f"`{times}`")).cast("bigint").alias("n"),
                      *[F.col(f"`{c}`").cast("double").alias(f"p{i}") for i, c in enumerate(c for pair in pairs for c in pair)],
                      *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    with _arrow_rows(df.sparkSession, BLOCK_ROWS):
        stored = materialize(plain.mapInArrow(run, "block long, n int" + "".join(f", {c} binary" for c in names[2:])))
    return {label: stored.select("block", "n", "bins", F.col(f"label{i}").alias("label"), F.col(f"weight{i}").alias("weight"), "times", "margin")
            for i, (label, _) in enumerate(pairs)}


def _unpacked(batches, columns: int):
    for b in batches:
        for block, n, bins, label, weight, times, margin in zip(*(c.to_pylist() for c in b.columns), strict=True):
            yield (block, np.frombuffer(bins, np.uint8).reshape(columns, n), np.frombuffer(label), np.frombuffer(weight), np.frombuffer(times, np.int64),
                   np.frombuffer(margin))


def _with_margins(blocks: DataFrame, trees: list[Tree], columns: int) -> DataFrame:
    """The blocks with the trees' values added to their margins, stored anew."""
    def run(batches):
        for block, x, y, w, times, margin in _unpacked(batches, columns):
            margin = margin.copy()
            for t in trees:
                margin += t.value[t.leaves(x, t.cut)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([len(y)], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in (x, y, w, times, margin))],
                ["block", "n", "bins", "label", "weight", "times", "margin"])

    with _arrow_rows(blocks.sparkSession, FEW_BLOCKS):
        return materialize(blocks.mapInArrow(run, _BLOCKS))


def _chosen_rows(block: int, times: np.ndarray, tree: int, p: BoostParams) -> np.ndarray:
    """How many of the rows that each row of a block stands for are in the tree's share."""
    if p.row_share >= 1:
        return times
    draw = np.random.default_rng([p.seed, tree, block & 0xFFFFFFFF, block >> 32])
    return (draw.random(len(times)) < p.row_share).astype(np.int64) if times.max() == 1 else draw.binomial(times, p.row_share)


def _sums(blocks: DataFrame, pending: list[Tree], tree: Tree, number: int, nodes: list[int], mine: np.ndarray, n_columns: int, p: BoostParams) -> np.ndarray:
    """(G, H) by node of ``nodes``, column of ``mine`` and bin."""
    slot = np.full(len(tree.column), -1, np.int64)
    slot[nodes] = np.arange(len(nodes))
    bins = p.bins + 1
    size = len(nodes) * len(mine) * bins

    def run(batches):
        total = np.zeros((2, len(nodes), len(mine), bins), np.int64)
        for block, x, y, w, times, margin in _unpacked(batches, n_columns):
            margin = margin.copy()
            for t in pending:
                margin += t.value[t.leaves(x, t.cut)]
            at = slot[tree.leaves(x, tree.cut)]
            taken = _chosen_rows(block, times, number, p)
            on = np.flatnonzero((at >= 0) & (taken > 0))
            if not len(on):
                continue
            prob = 1 / (1 + np.exp(-margin[on]))
            taken = taken[on]
            g, h = np.rint(w[on] * (prob - y[on]) * UNIT) * taken, np.rint(w[on] * prob * (1 - prob) * UNIT) * taken
            base = at[on] * bins
            for k, c in enumerate(mine.tolist()):
                key = base + x[c][on]
                for t, v in zip(total, (g, h)):
                    t[:, k] += np.bincount(key, v, len(nodes) * bins).astype(np.int64).reshape(-1, bins)  # whole numbers below 2^53: exact
        total = total.reshape(2, size)
        held = np.flatnonzero(total[0] | total[1])
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[0][held]), pa.array(total[1][held])], ["key", "g", "h"])

    with _arrow_rows(blocks.sparkSession, FEW_BLOCKS):
        got = blocks.mapInArrow(run, "key long, g long, h long").groupBy("key").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    out = np.zeros((2, size))
    for k in (0, 1):
        out[k][got["key"].to_numpy()] = got[("g", "h")[k]].to_numpy() / UNIT
    return out.reshape(2, len(nodes), len(mine), bins)


def best_split(g: np.ndarray, h: np.ndarray, p: BoostParams) -> tuple[float, int, int] | None:
    """(worth, column place, bin) of a node's best split from its sums by (column, bin); the first one among equals; None without one."""
    total_g, total_h = g[0].sum(), h[0].sum()
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    right_g, right_h = total_g - left_g, total_h - left_h
    worth = (left_g**2 / (left_h + p.l2) + right_g**2 / (right_h + p.l2) - total_g**2 / (total_h + p.l2)) / 2
    worth = np.where((left_h >= p.least_weight) & (right_h >= p.least_weight), worth, -np.inf)
    at = int(worth.argmax())
    c, b = divmod(at, worth.shape[1])
    return (float(worth[c, b]), c, b) if worth[c, b] > 1e-9 else None


def fit_boosted(train: DataFrame, columns, label: str, weight: str | None = None, p: BoostParams = BoostParams(),
                times: str | None = None, borders: list[np.ndarray] | None = None) -> BoostedTrees:
    """Trees for ``label`` (0/1) from the columns (numbers without nulls), rows weighted by ``weight``.

    ``times`` names a column that says for how many equal rows a row stands;
    the ``borders`` of the columns over all of these must then be given.
    """
    ship_code(train.sparkSession)
    columns = list(columns)
    if weight is None:
        weight = "_weight"
        train = train.withColumn(weight, F.lit(1.0))
    borders = bin_borders(train, columns, p.bins) if borders is None else borders
    return fit_blocks(bin_rows(train, columns, {label: weight}, times, borders)[label], columns, borders, p)


def fit_blocks(blocks: DataFrame, columns: list[str], borders: list[np.ndarray], p: BoostParams = BoostParams()) -> BoostedTrees:
    """``fit_boosted`` on the blocks of ``bin_rows``."""
    ship_code(blocks.sparkSession)
    done: list[Tree] = []
    pending: list[Tree] = []
    for number in range(p.trees):
        rng = np.random.default_rng([p.seed, number])
        mine = np.sort(rng.permutation(len(columns))[: max(1, round(p.column_share * len(columns)))])
        tree = Tree.empty(p.max_depth)
        sums: dict[int, np.ndarray] = {}
        wanted, pairs = [0], {}
        for level in range(p.max_depth):
            got = _sums(blocks, pending, tree, number, wanted, mine, len(columns), p)
            for k, node in enumerate(wanted):
                sums[node] = got[:, k]
                if node in pairs:  # the sibling is the parent less this one
                    sibling, parent = pairs[node]
                    sums[sibling] = sums[parent] - got[:, k]
            wanted, pairs = [], {}
            for node in range((1 << level) - 1, (1 << (level + 1)) - 1):
                if node not in sums:
                    continue
                g, h = sums[node]
                if level == 0:
                    tree.cover[0] = h[0].sum()
                    tree.value[0] = -g[0].sum() / (h[0].sum() + p.l2) * p.step
                found = best_split(g, h, p)
                if found is None:
                    continue
                worth, c, b = found
                left, right = 2 * node + 1, 2 * node + 2
                tree.column[node], tree.cut[node], tree.gain[node] = mine[c], b, worth
                tree.border[node] = borders[mine[c]][b]
                for child, part in ((left, slice(None, b + 1)), (right, slice(b + 1, None))):
                    child_g, child_h = g[c][part].sum(), h[c][part].sum()
                    tree.cover[child] = child_h
                    tree.value[child] = -child_g / (child_h + p.l2) * p.step
                lighter, other = (left, right) if tree.cover[left] <= tree.cover[right] else (right, left)
                wanted.append(lighter)
                pairs[lighter] = (other, node)
            if not wanted:
                break
        done.append(tree)
        pending.append(tree)
        if len(pending) == p.store_every and number + 1 < p.trees:
            blocks = _with_margins(blocks, pending, len(columns))
            pending = []
    return BoostedTrees(columns, done)
