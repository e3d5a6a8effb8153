"""Inputs that once broke an operator: repeated patterns, comments, ids with several texts, huge counts, labels that disagree."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from depotlens.llm import decontaminate, extract, langid, minhash, quality
from depotlens.llm.htmlblocks import leaf_blocks
from depotlens.llm.store import in_share
from depotlens.llm.words import words_of

from . import brute


# ---------------------------------------------------------------- decontamination

def _spread_hits(points, off, segments, q):
    """Every shared q-gram, place by place."""
    out = set()
    for t in range(len(off) - 1):
        where = {}
        for x in range(off[t], off[t + 1] - q + 1):
            where.setdefault(tuple(points[x : x + q]), []).append(x)
        for i, n in enumerate(segments.length):
            begin = segments.begin[i]
            for y in range(n - q + 1):
                out |= {(x, t, i, y) for x in where.get(tuple(segments.points[begin + y : begin + y + q]), ())}
    return out


def _repetitive(rng):
    def part():
        r = rng.random()
        if r < 0.3:
            return brute.sentence(rng, rng.randrange(1, 10))
        return rng.choice(["a", "-", "ab", "=-", "abc", "- ", "abcd", "abcde", "abcdef"]) * rng.randrange(1, 40)

    return "".join(part() for _ in range(rng.randrange(1, 4)))


def test_runs_cover_exactly_the_shared_qgrams():
    rng = random.Random(3)
    p = decontaminate.LeakParams()
    least = min(p.windows) - p.q + 1
    for _ in range(60):
        items, texts = [(i, _repetitive(rng)) for i in range(3)], [_repetitive(rng) for _ in range(3)]
        segments = decontaminate.Segments(items, p)
        if not len(segments.points):
            continue
        points, off = decontaminate.normal_points(texts)
        (at, text, seg, place, size), whole = segments.hits(points, off)
        got = {(x + j, t, s, y + j) for x, t, s, y, n in zip(at.tolist(), text.tolist(), seg.tolist(), place.tolist(), size.tolist()) for j in range(n)}
        want = _spread_hits(points, off, segments, p.q)
        assert got <= want
        # what is not listed lies on diagonals with a whole passage, inside the passages
        passages = [(s, t, b, e) for s, t, b, e in zip(*(x.tolist() for x in whole[:4]))]
        for x, t, s, y in want - got:
            assert any(s == ps and t == pt and b <= x and x + p.q <= e for ps, pt, b, e in passages)
        for s, t, b, e in passages:
            assert e - b >= least + p.q - 1


def test_a_run_of_one_letter_costs_no_more_than_its_length():
    segments = decontaminate.Segments([(1, "a" * 5000), (2, "b" + "a" * 49), (3, "x" * 20 + "-" * 30 + " some words that stand here alone")], decontaminate.LeakParams())
    text = "a" * 1_000_000
    began = time.process_time()
    got = decontaminate.regions([text], segments)
    assert {g[1] for g in got} == {1, 2} and time.process_time() - began < 20
    (at, *_), whole = segments.hits(*decontaminate.normal_points([text]))
    assert len(at) < 1_100_000 and len(whole[0]) == 1
    lines = ("-" * 50 + " y\n") * 3000
    assert decontaminate.regions([lines], segments) == []
    assert [g[1] for g in decontaminate.regions([lines + "x" * 20 + "-" * 30 + " some words that stand here alone"], segments)] == [3]


# ---------------------------------------------------------------- html

def test_comments_end_where_html_ends_them():
    def texts(page):
        return [b.text for b in leaf_blocks(page)]

    for comment in ("<!-->", "<!--->", "<!---->", "<!-- x -->", "<!-- x --!>", "<!-- a > b -- c -> d -->", "<!--x--><!-->"):
        assert texts(f"<p>one</p>{comment}<p>two</p><p>three</p>") == ["one", "two", "three"]
        assert texts(f"<div><svg></div><p>one</p>{comment}<p>two</p>") == ["one", "two"]
    assert texts("<p>one</p><!-- open <p>two</p>") == ["one"]


def test_inline_elements_do_not_break_a_paragraph():
    def texts(page):
        return [b.text for b in leaf_blocks(page)]

    assert texts("<p>a <ins>b</ins> <del>x</del> c</p>") == ["a b x c"]
    assert texts("<p>see <my-term>this</my-term> word</p>") == ["see this word"]
    assert texts("<x-card><p>one</p>two <x-tag>three</x-tag> four</x-card>five") == ["one", "two three four", "five"]
    assert texts("<x-a><x-b><div>one</div></x-b></x-a>two") == ["one", "two"]
    assert texts("<p>a <x-a>b <x-a>c</x-a> d</x-a> e</p>") == ["a b c d e"]
    assert texts("<p>a <x-icon/> b</p>") == ["a b"]
    assert len(leaf_blocks("<x-a>" * 20_000 + "<p>x")) == 1


def test_labeller_forward_pass_block_by_block():
    """The bidirectional network against scalar loops."""
    rng = np.random.default_rng(3)
    width, h, steps = 5, 4, 7
    w = {"w": rng.standard_normal((2, width, 4 * h)), "u": rng.standard_normal((2, h, 4 * h)), "b": rng.standard_normal((2, 1, 4 * h))}
    x = rng.standard_normal((2, 3, steps, width))
    got = extract._run(x, w, False)[0]
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    gates = _gate_order(w, x, got, h)
    for d in range(2):
        for page in range(3):
            state, cell = [0.0] * h, [0.0] * h
            for t in range(steps):
                z = [sum(x[d, page, t, i] * w["w"][d, i, j] for i in range(width)) + sum(state[i] * w["u"][d, i, j] for i in range(h)) + w["b"][d, 0, j] for j in range(4 * h)]
                part = {g: z[k * h : (k + 1) * h] for k, g in enumerate(gates)}
                cell = [sigmoid(part["f"][i]) * cell[i] + sigmoid(part["i"][i]) * np.tanh(part["g"][i]) for i in range(h)]
                state = [sigmoid(part["o"][i]) * np.tanh(cell[i]) for i in range(h)]
                assert got[d, page, t] == pytest.approx(state, rel=1e-3, abs=1e-3)


def _gate_order(w, x, got, h):
    """Which quarter of the weights is which gate, told from the first step (no state yet: the forget gate plays no part)."""
    from itertools import permutations

    z = x[0, 0, 0] @ w["w"][0] + w["b"][0, 0]
    for order in permutations("ifgo"):
        p = {g: z[k * h : (k + 1) * h] for k, g in enumerate(order)}
        s = lambda v: 1 / (1 + np.exp(-v))
        if np.allclose(s(p["o"]) * np.tanh(s(p["i"]) * np.tanh(p["g"])), got[0, 0, 0], atol=1e-3):
            return order
    raise AssertionError("no long short-term memory cell")


# ---------------------------------------------------------------- near duplicates

def test_every_text_of_a_repeated_id_is_compared(spark):
    rng = random.Random(1)
    a, b, c = (brute.sentence(rng, 80, 9000) for _ in range(3))
    rows = [(5, a), (5, b), (7, a + " more"), (9, b + " more"), (11, c), (5, "")]
    got = sorted({(r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in minhash.near_duplicates(brute.documents(spark, rows)).collect()})
    assert got == [(5, False, 5), (5, True, 5), (7, True, 5), (9, True, 5), (11, True, 11)]


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = brute.sentence(rng, 120, 9000).split()
    rows = []
    for i in range(5000):
        w = list(base)
        w[rng.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(brute.documents(spark, rows + [(9000, brute.sentence(rng, 50))]).repartition(16)).collect()
    assert {r["component_id"] for r in got if r["doc_id"] < 5000} == {0} and len(got) == 5001


# ---------------------------------------------------------------- samples and labels

def test_samples_keep_their_size_at_any_count(spark):
    key = F.xxhash64("id", F.lit(3))
    n = 200_000
    for share in (1.0, 0.3, 1e-3):
        got = spark.range(n).where(in_share(key, share)).count()
        assert abs(got - n * share) <= 5 * (n * share) ** 0.5 * (share < 1)
    # a count of 10^12 rows: the hash bound still lies where the share says
    share = 2400 / 1e12
    bound = int(share * (1 << 53))
    rows = spark.createDataFrame([(v << 11,) for v in (0, bound - 1, bound + 1, bound * 2)] + [(-1,)], "k long")
    assert [r["k"] >> 11 for r in rows.where(in_share(F.col("k"), share)).collect()] == [0, bound - 1]
    assert bound / (1 << 53) == pytest.approx(share, rel=1e-6)


def test_labels_that_disagree_are_left_out(spark):
    docs = brute.documents(spark, [(i, f"word{i} text") for i in range(1, 9)])
    agree = [(i, i % 2) for i in range(1, 9)]
    p = quality.QualityParams()
    plain = quality.train_quality(docs, spark.createDataFrame(agree[2:], "doc_id long, quality int"), p)
    mixed = spark.createDataFrame(agree + agree + [(1, 0), (2, 1), (1, None), (None, 1)], "doc_id long, quality int")
    got = quality.train_quality(docs, mixed, p)
    assert np.array_equal(plain.weights, got.weights) and plain.bias == got.bias


def test_ftrl_step_by_step():
    """Follow-the-regularised-leader and the sparse dot product against plain Python loops."""
    rng = random.Random(7)
    p = quality.QualityParams(epochs=2)
    texts = [brute.sentence(rng, rng.randrange(1, 12), 25) for _ in range(30)]
    labels = np.array([float("w1" in t) for t in texts])
    rows = quality.text_vectors(words_of(pa.array(texts)), p.bits)
    model = quality.fit_ftrl([(s.astype(np.int64), v.astype(np.float64)) for s, v in rows], labels, p)
    z, n, bias = {}, {}, 1 << p.bits

    def weight(i):
        if abs(z.get(i, 0.0)) <= p.l1:
            return 0.0
        return -(z[i] - (p.l1 if z[i] > 0 else -p.l1)) / ((p.beta + n.get(i, 0.0) ** 0.5) / p.alpha + p.l2)

    order = np.random.default_rng(p.seed)
    for _ in range(p.epochs):
        for r in order.permutation(len(rows)):
            x = dict(zip(rows[r][0].tolist(), rows[r][1].tolist())) | {bias: 0.5}
            w = {i: weight(i) for i in x}
            error = 1 / (1 + np.exp(-min(30, max(-30, sum(w[i] * v for i, v in x.items()))))) - labels[r]
            for i, v in x.items():
                g = error * v
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - before**0.5) / p.alpha * w[i]
    scores = model.scores(pa.array(texts))
    for (slots, values), score in zip(rows, scores):
        margin = sum(weight(i) * v for i, v in zip(slots.tolist(), values.tolist())) + 0.5 * weight(bias)
        assert score == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-4)


def test_language_vote_text_by_text():
    """Hierarchical prediction against a loop over texts, families and pairs."""
    rng = random.Random(9)
    letters = {"de": "abcdenrst", "en": "aeghiostw", "es": "aelmnoqrsu", "fr": "aeilnptux"}
    rows = [(k, " ".join("".join(rng.choice(letters[k]) for _ in range(rng.randrange(2, 8))) for _ in range(30))) for k in letters for _ in range(25)]
    p = langid.LangParams()
    texts = pa.array([t for _, t in rows])
    x = langid.frequencies(texts, p.bits)
    model = langid.fit_languages(x.astype(np.float32).copy(), [k for k, _ in rows], p)
    got, _ = model.predict(texts)
    n_families = len(model.families)
    right = 0
    for i, (lang, _) in enumerate(rows):
        margins = [float(sum(a * b for a, b in zip(x[i].tolist(), model.weights[:, c].tolist()) if a)) + float(model.bias[c]) for c in range(model.weights.shape[1])]
        family = max(range(n_families), key=lambda f: margins[f])
        inside = [j for j, v in enumerate(model.langs) if langid.family_of(v) == model.families[family]]
        votes = {j: 0.0 for j in inside}
        for c, (a, b) in enumerate(model.pairs):
            if a in votes:
                votes[a if margins[n_families + c] > 0 else b] += 1
        top = max(votes.values())
        assert votes[model.langs.index(got[i])] == top
        right += got[i] == lang
    assert right > 0.9 * len(rows)
