"""Exact quantiles (linear interpolation) without gathering a group in one task.

One path for every size of group, three narrowing passes over the rows:

1. rows are counted in coarse monotone buckets (sign and binary logarithm, 16
   per doubling), map-side combined to a few hundred per group; running counts
   over a group's buckets show which of them hold the ranks floor(h) and
   ceil(h), h = (n - 1) * p - the same definition as pandas/NumPy "linear";
2. only the rows of those buckets are counted again in fine buckets (4,096 per
   doubling), which narrows the ranks down once more;
3. only the rows of those are counted by value and ordered, bucket by bucket.

The result equals ``percentile(value, p)``. What is shuffled are counts: of
all rows by coarse bucket, and of the rows around the wanted ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlens.operators.timeline import Periods
from depotlens.session import materialize

BUCKETS_PER_DOUBLING = 4096
COARSE = 16
_DOUBLINGS = 1953  # more than the largest |log2| of a double, in any unit of buckets


def monotone_bucket(v: Column, per_doubling: int = BUCKETS_PER_DOUBLING) -> Column:
    """A whole number that never falls when v rises."""
    size = F.floor(F.log2(F.abs(v)) * per_doubling) + _DOUBLINGS * per_doubling
    return F.when(v == 0, F.lit(0).cast("bigint")).otherwise(F.when(v > 0, size).otherwise(-size).cast("bigint"))


def _narrowed(counts: DataFrame, keys: list[str], by: str) -> DataFrame:
    """From counts ``n`` by (keys, by) that carry the wanted ``ranks`` of their keys: the ranks by (keys, by), counted from there on."""
    before = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.filter("ranks", lambda x: (x["r"] >= F.col("first")) & (x["r"] < F.col("first") + F.col("n")))
    moved = F.transform(inside, lambda x: x.withField("r", x["r"] - F.col("first")))
    return placed.select(*keys, by, moved.alias("ranks")).where(F.size("ranks") > 0)


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], group: str | None = None) -> DataFrame:
    """One row per group with a column per name in ``probs``; NULL and NaN values are left out.

    ``group=None`` computes one global row (none without values). The rows are
    read three times, so ``df`` should be stored, or cheap.
    """
    g = group or "_g"
    v = F.col("v") + 0.0
    rows = (df.select((F.col(group) if group else F.lit(0)).alias(g), F.col(value).cast("double").alias("v"))
            .where(F.col("v").isNotNull() & ~F.isnan("v"))
            .select(g, v.alias("v"), monotone_bucket(v, COARSE).alias("b1"), monotone_bucket(v).alias("b2")))
    count = F.count(F.lit(1)).alias("n")
    coarse = rows.groupBy(g, "b1").agg(count).withColumn("total", F.sum("n").over(Window.partitionBy(g)))
    wanted = _narrowed(coarse.withColumn("ranks", _ranks(probs)), [g], "b1")
    fine = rows.join(wanted, [g, "b1"]).groupBy(g, "b1", "b2").agg(count, F.first("ranks").alias("ranks"))
    wanted = _narrowed(fine, [g, "b1"], "b2").drop("b1")
    values = rows.join(wanted, [g, "b2"]).groupBy(g, "b2", "v").agg(count, F.first("ranks").alias("ranks"))
    out = _picked(_narrowed(values, [g, "b2"], "v"), [g], probs)
    return out if group else out.drop(g)


def quantiles_per_day(periods: Periods, columns: list[str], probs: dict[str, float], date_col: str = "Score_Datum") -> DataFrame:
    """``exact_quantiles`` of every calendar date over the periods' values: a row per date and column (``k``: its place in ``columns``).

    The same passes, with the counts of a bucket taken by date from the first
    and last days of its periods (``Periods.sums_per_day``). The periods are
    read four times, so they should be stored.
    """
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.col(f"`{c}`").cast("double") + 0.0).alias("v")) for k, c in enumerate(columns)]))
    v = F.col("x.v")
    rows = (periods.rows.select("e", "until", each.alias("x")).where(v.isNotNull() & ~F.isnan(v))
            .select("e", "until", "x.k", "x.v", monotone_bucket(v, COARSE).alias("b1"), monotone_bucket(v).alias("b2")))

    def counts(by: list[str], wanted: DataFrame | None = None) -> DataFrame:
        inside = rows
        if wanted is not None:
            on = [c for c in wanted.columns if c in by]
            inside = rows.join(F.broadcast(wanted.select(*on).distinct()), on, "left_semi")
        found = Periods(inside, periods.dates).sums_per_day(by, {}, date_col)
        return found if wanted is None else found.join(wanted, [date_col, *on])

    g = ["k", date_col]
    coarse = counts(["k", "b1"]).withColumn("total", F.sum("n").over(Window.partitionBy(*g)))
    wanted = materialize(_narrowed(coarse.withColumn("ranks", _ranks(probs)), g, "b1"))  # a few buckets a date
    wanted = materialize(_narrowed(counts(["k", "b1", "b2"], wanted), [*g, "b1"], "b2").drop("b1"))
    return _picked(_narrowed(counts(["k", "b2", "v"], wanted), [*g, "b2"], "v"), g, probs)


def values_at(counted: DataFrame, shares: list[float]) -> dict[int, list[float]]:
    """By ``k``, the values at the ranks ceil(share * total) of the rows ``counted`` (k, v, n: a value without NULL that stands
    for n equal ones), in the order of the ``shares``.

    Two passes: counts by fine bucket, then the values of the buckets that hold
    a wanted rank. The driver gets a value per k and share.
    """
    v = F.col("v") + 0.0
    rows = counted.select("k", v.alias("v"), monotone_bucket(v).alias("b"), F.col("n").cast("bigint").alias("n"))
    total = F.sum("n").over(Window.partitionBy("k"))
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(F.ceil(F.col("total") * F.lit(float(x))) - 1, F.lit(0)).cast("bigint").alias("r"))
                      for i, x in enumerate(shares)])
    buckets = rows.groupBy("k", "b").agg(F.sum("n").alias("n")).withColumn("total", total)
    wanted = materialize(_narrowed(buckets.withColumn("ranks", ranks), ["k"], "b"))  # a few buckets per k
    values = rows.join(F.broadcast(wanted), ["k", "b"]).groupBy("k", "b", "v").agg(F.sum("n").alias("n"), F.first("ranks").alias("ranks"))
    found: dict[int, list[float]] = {}
    for r in _narrowed(values, ["k", "b"], "v").select("k", "v", F.explode("ranks.i").alias("i")).collect():
        found.setdefault(r["k"], [0.0] * len(shares))[r["i"]] = r["v"]
    return found


def _ranks(probs: dict[str, float]) -> Column:
    """The wanted ranks among ``total`` values."""
    ranks = []
    for i, p in enumerate(probs.values()):
        h = (F.col("total") - 1) * F.lit(float(p))
        for side, r in ((0, F.floor(h)), (1, F.ceil(h))):
            ranks.append(F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), (h - F.floor(h)).alias("part"), r.cast("bigint").alias("r")))
    return F.array(*ranks)


def _picked(found: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """A column per probability from the values ``v`` that hold its ranks."""
    hits = found.select(*keys, "v", F.explode("ranks").alias("x")).select(*keys, "v", "x.i", "x.side", "x.part")

    def pick(i: int, side: int, c: str) -> Column:
        return F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col(c)))

    return hits.groupBy(*keys).agg(*[
        (pick(i, 0, "v") + pick(i, 0, "part") * (pick(i, 1, "v") - pick(i, 0, "v"))).alias(name) for i, name in enumerate(probs)])
