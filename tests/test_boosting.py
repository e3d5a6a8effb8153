"""Boosted trees against an exact greedy search in plain Python, tree by tree."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotlens.plans.boosting import BoostedTrees, BoostParams, fit_boosted


def exact(rows, labels, weights, p):
    """Trees as nested (column, border, left, right) or a leaf value; every distinct value is a candidate."""
    margin = [0.0] * len(rows)
    trees = []
    for _ in range(p.trees):
        prob = [1 / (1 + math.exp(-m)) for m in margin]
        g = [round(w * (q - y) * 2**20) / 2**20 for w, q, y in zip(weights, prob, labels)]
        h = [round(w * q * (1 - q) * 2**20) / 2**20 for w, q in zip(weights, prob)]

        def grow(mine, depth):
            sg, sh = sum(g[i] for i in mine), sum(h[i] for i in mine)
            leaf = -sg / (sh + p.l2) * p.step
            best = None
            if depth < p.max_depth:
                for c in range(len(rows[0])):
                    for border in sorted({rows[i][c] for i in range(len(rows))})[:-1]:
                        left = [i for i in mine if rows[i][c] <= border]
                        lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                        if lh < p.least_weight or sh - lh < p.least_weight:
                            continue
                        worth = (lg**2 / (lh + p.l2) + (sg - lg) ** 2 / (sh - lh + p.l2) - sg**2 / (sh + p.l2)) / 2
                        if best is None or worth > best[0] + 1e-12:
                            best = (worth, c, border)
            if best is None or best[0] <= 1e-9:
                for i in mine:
                    margin[i] += leaf
                return leaf
            _, c, border = best
            left, right = [i for i in mine if rows[i][c] <= border], [i for i in mine if rows[i][c] > border]
            return (c, border, grow(left, depth + 1), grow(right, depth + 1))

        trees.append(grow(range(len(rows)), 0))
    return trees, margin


def nested(t, node=0):
    if t.column[node] < 0:
        return float(t.value[node])
    return (int(t.column[node]), float(t.border[node]), nested(t, 2 * node + 1), nested(t, 2 * node + 2))


def alike(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return a == pytest.approx(b, abs=1e-6)
    return a[:2] == b[:2] and alike(a[2], b[2]) and alike(a[3], b[3])


@pytest.fixture(scope="module")
def table():
    rng = random.Random(2)
    rows = [(rng.random(), rng.gauss(0, 1), float(rng.randrange(5)), 7.0) for _ in range(60)]
    labels = [int(r[0] > 0.6 or (r[1] > 0.3 and r[2] > 2) or rng.random() < 0.1) for r in rows]
    weights = [2.5 if y else 1.0 for y in labels]
    return rows, labels, weights


def frame(spark, table):
    rows, labels, weights = table
    return spark.createDataFrame([(*r, y, w) for r, y, w in zip(rows, labels, weights)], "a double, b double, `c d` double, e double, y int, w double")


def test_trees_equal_the_exact_search(spark, table):
    p = BoostParams(trees=9, max_depth=3, step=0.3, row_share=1.0, column_share=1.0, store_every=4)
    model = fit_boosted(frame(spark, table).repartition(3), ["a", "b", "c d", "e"], "y", "w", p)
    want, margin = exact(*table, p)
    for got, tree in zip(model.trees, want, strict=True):
        assert alike(nested(got), tree)
    x = np.array(table[0]).T
    assert model.margins(x) == pytest.approx(margin, abs=1e-6)
    df = frame(spark, table)
    scored = df.select("a", model.probability(df).alias("p")).collect()
    by_a = {r[0]: m for r, m in zip(table[0], margin)}
    assert all(r["p"] == pytest.approx(1 / (1 + math.exp(-by_a[r["a"]])), abs=1e-6) for r in scored)
    share = model.importances()
    assert sum(share.values()) == pytest.approx(1) and share["e"] == 0 and share["a"] > 0.3
    again = BoostedTrees.from_frame(model.to_frame(spark), model.columns)
    assert again.margins(x) == pytest.approx(model.margins(x))


def test_samples_learn_and_rerun_alike(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 5))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.standard_normal(4000) * 0.3 > 0.5).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, e double, y int").repartition(4).cache()
    p = BoostParams(trees=30, max_depth=3, step=0.3, store_every=8, bins=32)
    one, two = (fit_boosted(df, list("abcde"), "y", p=p) for _ in range(2))
    assert np.array_equal(one.margins(x.T), two.margins(x.T))
    assert ((one.margins(x.T) > 0) == y).mean() > 0.9
    df.unpersist()


def test_nothing_to_learn(spark):
    one = spark.createDataFrame([(1.0, 1), (2.0, 1)], "a double, y int")
    model = fit_boosted(one, ["a"], "y", p=BoostParams(trees=2))
    assert all(t.column[0] == -1 for t in model.trees) and model.margins(np.array([[1.0]]))[0] > 0
    none = fit_boosted(one.where(F.lit(False)), ["a"], "y", p=BoostParams(trees=2))
    assert none.margins(np.array([[1.0]]))[0] == 0
