"""Merkle manifest, tokenizer alignment and BK-tree near-duplicates against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from depotlens.llm import alignment, bktree, merkle
from depotlens.llm.components import components

from . import brute


# ---------------------------------------------------------------- Merkle manifest

def _manifest(spark, rows):
    df = spark.createDataFrame([(*r, *brute.NO_EXTRA) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + brute.EXTRA).repartition(5)
    got = {}
    for r in merkle.manifest(df).collect():
        got.setdefault((r["doc_id"], r["leaf"]), []).append((r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]))
    return got


def test_manifest(spark):
    rng = random.Random(4)
    rows = [(i * 7 % 1009, f"Text {i} ÄÖ" if i % 5 else f"lower {i}", rng.choice(["de", "en", "en", "en", "", "é"]), rng.choice(["s", None]), i) for i in range(700)]
    rows += [(5000, "ALONE", "zz", "s", 5), (5001, None, None, None, None), (5002, "", None, "", 0), (None, "No Id", "de", "s", 3), (None, None, "de", None, None)]
    rows += [(7, "again", "en", "s", 1), rows[3], rows[3], (5003, "long " * 20_000, "en", "s", 1)]
    got, want = _manifest(spark, rows), brute.manifest(rows)
    # equal rows are leaves of different places: their proofs are compared as a multiset
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    checks = [v[4] for rows_of in got.values() for v in rows_of]
    assert not all(checks) and sum(checks) > len(checks) / 2


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65])
def test_manifest_of_small_tables(spark, n):
    rows = [(i, f"T{i}", "en", "s", 2) for i in range(n)]
    assert _manifest(spark, rows) == brute.manifest(rows)


def test_manifest_of_many_languages(spark):
    rows = [(i, "X", f"l{i % 70:02}", "s", 1) for i in range(150)]
    assert _manifest(spark, rows) == brute.manifest(rows)


# ---------------------------------------------------------------- tokenizer alignment

@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabularies(*alignment.vocabulary_files(alignment.AlignParams()))


def _align_brute(v, texts):
    return brute.alignment(
        texts, lambda t: v.any_a.encode(" " + t, add_special_tokens=False).ids, v.b.encode, lambda i: v.a_bytes[i], lambda i: v.b_bytes[i]
    )


def _texts():
    rng = random.Random(9)
    texts = [None, "", " ", "a", "  two  spaces\n\n\ttabs ", "<|endoftext|> is text, as is <s> </s> <0x41>", "low▁line", "naïve Ünïcode — “quotes”", "日本語のテキスト and English", "🙂🙂 a‍b", "\x00\x01", "x" * 3000]
    texts += [brute.sentence(rng, rng.randrange(1, 60)) for _ in range(80)]
    texts += [" ".join("".join(rng.choice("aeinorst") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 50))) for _ in range(80)]
    return texts + ["The same text twice, Here.", "The same text twice, Here.", "hello world " * 5000]


def test_alignment(spark, vocabularies):
    texts = _texts()
    rows = list(enumerate(texts)) + [(3, "repeated id"), (None, "no id")]
    df = brute.documents(spark, rows)
    want = dict(zip([(i, t) for i, t in rows], _align_brute(vocabularies, [t for _, t in rows])))
    for p in (alignment.AlignParams(), alignment.AlignParams(block_bytes=400, step_bytes=150)):
        got = [tuple(r) for r in alignment.aligned(df, p).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
        assert sorted(got, key=str) == sorted([(i, *x) for (i, _), x in want.items()], key=str)
    assert sum(x[0] == 0 for x in want.values()) == 3 and any(x[3] > x[4] > 0 for x in want.values())


def test_alignment_of_nothing(spark):
    df = brute.documents(spark, [])
    assert alignment.aligned(df).count() == 0
    assert [tuple(r) for r in alignment.aligned(brute.documents(spark, [(1, None)])).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_parts_of_a_long_text_encode_as_the_whole(vocabularies, monkeypatch):
    texts = [t for t in _texts() if t]
    whole = [vocabularies.encode(t) for t in texts]
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 10)
    assert [vocabularies.encode(t) for t in texts] == whole
    assert max(len(alignment._parts(t)) for t in texts) > 100


def test_both_engines_of_the_byte_vocabulary_agree(vocabularies):
    rng = random.Random(6)
    letters = [chr(c) for c in range(1, ord(alignment._LATIN_END) + 1)]
    for c in letters:
        for t in (f"a{c}b", f" {c}", f"{c}{c}1", f"1{c} \n {c}", f"'{c}s  {c}"):
            assert vocabularies.latin_a.encode_ordinary(t) == vocabularies.any_a.encode(t, add_special_tokens=False).ids
    for _ in range(2000):
        t = "".join(rng.choice(letters) if rng.random() < 0.4 else rng.choice("abcdeinrst  \n'1") for _ in range(30))
        assert vocabularies.latin_a.encode_ordinary(t) == vocabularies.any_a.encode(t, add_special_tokens=False).ids


# ---------------------------------------------------------------- fingerprints in BK-trees

def test_fingerprints():
    rng = random.Random(8)
    texts = [None, "", " \n", "One", "ONE two", "w" * 700 + " y z", "é ü ß\tß\x0bx", "same same same same"]
    texts += [" ".join("q" * rng.randrange(1, 40) for _ in range(rng.randrange(1, 12))) for _ in range(200)] + [brute.sentence(rng, 5000)]
    got = bktree.majority_bits(*bktree.shingle_hashes(pa.array(texts), 3))
    assert got.tolist() == [brute.simhash(t) for t in texts]


def _cluster(rng, n, flips):
    """Values around a few centres, some in chains."""
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = list(centres)
    while len(values) < n:
        x = rng.choice(centres[:2] if rng.random() < 0.7 else values)
        for _ in range(rng.randrange(1, flips + 1)):
            x ^= 1 << rng.randrange(64)
        values.append(x)
    return list(dict.fromkeys(values))


@pytest.mark.parametrize("slice_size", [4096, 40])
def test_trees_find_every_link(spark, slice_size):
    rng = random.Random(slice_size)
    values = _cluster(rng, 600, 2) + [rng.getrandbits(64) for _ in range(200)] + [0, 1, 3, 7]
    classes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long").repartition(4)
    p = bktree.TreeParams(slice_size=slice_size)
    links = bktree._dealt(classes, p).groupBy("shard").applyInArrow(lambda t: bktree._shard_links(t, p.radius), "u long, v long")
    joined = {r["node"] % (1 << 64): r["component"] % (1 << 64) for r in components(links).collect()}
    want = brute.groups_within([(v, v) for v in values], 2)
    members = {}
    for v in values:
        members.setdefault(joined.get(v, v), set()).add(v)
    wanted = {}
    for v in values:
        wanted.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, members.values())) == sorted(map(sorted, wanted.values()))
    assert max(map(len, members.values())) > 50


def test_search_follows_the_right_edges():
    rng = random.Random(1)
    values = np.array(_cluster(rng, 400, 4), np.uint64)
    root, keys, children = bktree.grow(values, np.zeros(len(values), np.int64))
    asked = np.array(_cluster(rng, 100, 4) + values[:50].tolist(), np.uint64)
    for radius in (0, 2, 5):
        got = set()
        for who, node in bktree.search(values, keys, children, asked, np.zeros(len(asked), np.int64), radius, at_once=64):
            got |= set(zip(who.tolist(), node.tolist()))
        assert got == {(i, j) for i, x in enumerate(asked.tolist()) for j, y in enumerate(values.tolist()) if (x ^ y).bit_count() <= radius}


def test_near_fingerprints(spark):
    rng = random.Random(12)
    rows = [(i, brute.sentence(rng, rng.choice([1, 3, 40, 200]))) for i in range(60)]
    for k in range(40):
        w = rows[k % 10 + 20][1].split()
        if k % 2 and len(w) > 100:
            w[rng.randrange(len(w))] = "new"
        rows.append((100 + k, " ".join(w).upper()))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "long " * 30_000)]
    repeated = [*rows, (5, rows[30][1]), (5, "another text of five"), (None, rows[30][1])]
    got = bktree.near_duplicates(brute.documents(spark, repeated)).collect()
    prints = [(i, brute.simhash(t)) for i, t in repeated]
    want = brute.groups_within([(i, x) for i, x in prints if i is not None], 2)
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in got) == sorted((str(i), f"{x:016x}") for i, x in prints)
    assert {r["doc_id"]: r["component_id"] for r in got} == {**want, None: None}
    assert len(set(want.values())) < len(want) - 20
    assert bktree.near_duplicates(brute.documents(spark, [])).count() == 0
