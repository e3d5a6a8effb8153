"""Operators on documents against brute force, with nulls, empty and long texts, repeated rows, ties and clashing columns."""

import hashlib
import random
import zlib

import pytest

from depotlens.llm import decontaminate, langid, minhash, mixing, quality, recompression, simhash, store
from depotlens.llm.components import components

from . import brute


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    base = [brute.sentence(rng, rng.choice([1, 2, 5, 30, 60, 120])) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    n = len(rows)
    for k in range(30):  # near copies, exact copies, shared passages
        w = base[k % 8 + 20].split()
        if k % 3 == 0 and len(w) > 8:
            w[rng.randrange(len(w))] = "new"
        if k % 3 == 1:
            w = brute.sentence(rng, 25).split() + w + brute.sentence(rng, 30).split()
        rows.append((n + k, " ".join(w)))
    return rows + [(200, None), (201, ""), (202, "   \n"), (203, "ONE two"), (204, "one TWO"), (205, brute.sentence(rng, 60_000, 50_000))]


def test_near_duplicates(spark, corpus):
    p = minhash.NearParams(shingle=3, similarity=85)
    repeated = [*corpus, corpus[25], (None, corpus[25][1]), (None, None)]
    got = minhash.with_copies_marked(brute.documents(spark, repeated), p).collect()
    want = brute.near_groups(corpus, 3, 85)
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(i for i, _ in repeated if i is not None)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert len({c for _, c in want.values()}) < len(want) - 10


def test_near_duplicates_of_many_edits_lose_no_link(spark):
    """One hot group: copies with few to many edits, so the pivot does not link to all of them."""
    rng = random.Random(5)
    base = brute.sentence(rng, 150, 5000).split()
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(brute.documents(spark, rows), minhash.NearParams(shingle=3, similarity=85)).collect()}
    assert got == {i: c for i, (_, c) in brute.near_groups(rows, 3, 85).items()}


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 60), (300, 299), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 0, 299: 299, 300: 299}


def test_repeated_passages(spark, corpus):
    got = {r["doc_id"]: r for r in recompression.repeated_passages(brute.documents(spark, corpus), carry=["source", "size"]).collect()}
    want = brute.repeats_cut(corpus)
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == want
    assert sum(w[1] > 0 for w in want.values()) > 10
    texts = dict(corpus)
    for i, r in got.items():
        assert hashlib.sha256(b" ".join(r["kept_text"].encode().split())).hexdigest() == r["kept_sha256"]
        if not r["n_removed"]:
            assert r["kept_text"] == (texts[i] or "")


def test_repeated_passages_of_repeated_and_nameless_rows(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, "z " + text), (None, text), (3, "a " * 70)]
    got = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in recompression.repeated_passages(brute.documents(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, 40, 0), (1, 40, 0), (2, 41, 40), (None, 40, 0), (3, 70, brute.repeats_cut([(3, "a " * 70)])[3][1])], key=str)


def test_leaks(spark, corpus):
    rng = random.Random(2)
    items = [(i, brute.sentence(rng, 40)) for i in range(5)] + [(50, None), (51, ""), (52, "tiny"), (1, items_text := brute.sentence(rng, 40))]
    held = [(300, "start " + items[0][1].upper() + " end"), (301, items_text.replace(" ", "\n\n")), (302, items[2][1][: len(items[2][1]) // 4])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = brute.documents(spark, [*corpus, *held, held[0], (None, items[3][1])])
    for p in (decontaminate.LeakParams(), decontaminate.LeakParams(block_chars=300)):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark, p).collect()}
        assert got == {(300, 0), (301, 1), (None, 3)}
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


def test_mixing_targets_and_copies(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(1, 60), None, rng.choice(["a", "b", "b", "b", "é", None])) for i in range(400)]
    rows += [(1000, None, None, "a"), (1001, "", None, "z"), (5, "again it", None, "b"), (None, "x y z", None, "b")]
    docs = brute.documents(spark, rows)
    plan = mixing.mix_plan(docs).select("doc.doc_id", "doc.source", "size", "source_size", "target", "copies", "taken").collect()
    assert len(plan) == len(rows)
    assert sorted(r["size"] for r in plan) == sorted(len(brute.words(t)) for _, t, _, _ in rows)
    sizes, taken, targets = {}, {}, {}
    for r in plan:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        targets[r["source"]] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
    assert all(r["source_size"] == sizes[r["source"]] for r in plan)
    names = sorted(s for s in sizes if s is not None) + [None]
    left, want, open_ = 1.5 * sum(sizes.values()), {}, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    while True:  # share by weight, cap, share the excess again
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in share if share[s] > 2 * sizes[s]]
        if not over:
            want.update(share)
            break
        for s in over:
            want[s] = 2 * sizes[s]
            left -= want[s]
            del open_[s]
    for s in names:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - targets[s]) <= 130
    again = mixing.mix_plan(docs.repartition(7), carry=["doc_id"]).select("doc.doc_id", "copies").where("doc_id <> 5").collect()
    assert sorted((r["doc_id"] for r in again for _ in range(r["copies"]) if r["doc_id"] is not None)) == sorted(r["doc_id"] for r in plan if r["doc_id"] not in (5, None) for _ in range(r["copies"]))
    mix = mixing.mixed(docs)
    assert mix.columns == [*docs.columns, "mix"] and mix.count() == sum(r["copies"] for r in plan)


def test_fingerprints(spark, corpus):
    rows = sorted((i, t or "") for i, t in corpus)
    got = {r["doc_id"]: r for r in simhash.edited_fingerprints(brute.documents(spark, corpus)).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[1][:cut]
        r, n = got[i], got[nxt[0]]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        both = [int(x, 16) for x in (r["fingerprint"], r["edited_fingerprint"], n["fingerprint"])]
        assert r["near_edited"] == 1 - bin(both[0] ^ both[1]).count("1") / 64
        assert r["near_next"] == 1 - bin(both[0] ^ both[2]).count("1") / 64
    prints = {i: int(r["fingerprint"], 16) for i, r in got.items()}
    for i, r in got.items():
        assert r["n_near"] == sum(bin(prints[i] ^ x).count("1") <= 3 for x in prints.values()) - 1
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, set()).add(prints[i])
    assert all(len(v) == 1 for v in by_text.values())
    # votes, term by term
    def vote(text):
        w = [x.decode() for x in text.lower().encode().split()]
        terms = spark.createDataFrame([(w[k], w[k + 1] if k + 1 < len(w) else None) for k in range(len(w))], "a string, b string").selectExpr("a", "b", "xxhash64(a, b) AS h").collect()
        total = [0] * 64
        for r in terms:
            weight = min(16, len(r["a"]) + len(r["b"] or ""))
            for bit in range(64):
                total[bit] += weight if r["h"] >> bit & 1 else -weight
        return sum(1 << bit for bit in range(64) if total[bit] > 0)

    for i in (20, 203):
        assert vote(dict(rows)[i]) == prints[i]


def test_fingerprints_of_one_and_nameless_rows(spark):
    got = simhash.edited_fingerprints(brute.documents(spark, [(7, "abcdefgh ij")])).collect()
    assert [(r["doc_id"], r["n_chars"], r["n_near"]) for r in got] == [(7, 11, 0)]
    got = simhash.edited_fingerprints(brute.documents(spark, [(None, "ab cd"), (None, None), (3, "x y z"), (3, "x y z")])).collect()
    assert sorted((r["doc_id"] or -1, r["n_chars"]) for r in got) == [(-1, 0), (-1, 5), (3, 5), (3, 5)]


def test_quality_scores(spark):
    rows = [(i, ("the hills of the land are green and calm." if i % 4 else "BUY!! IT!! NOW!! 99 | | |") + f" n{i}") for i in range(300)]
    labels = spark.createDataFrame([(i, int(bool(i % 4)), 0, "x") for i in range(280)] + [(3, 1, None, None), (None, 1, 0, None), (281, None, 0, None)], "doc_id long, quality int, toxic int, text string")
    docs = brute.documents(spark, [*rows, (900, None), (901, ""), (None, "calm land"), rows[0]])
    got = quality.scored(docs, labels).collect()
    assert len(got) == 304
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 300]
    assert all(r["predicted"] == int(bool(r["doc_id"] % 4)) for r in held)
    assert {r["score"] for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}


def test_languages(spark):
    v = {"en": "the of and ing tion there", "de": "der und sch ung nicht ein", "fr": "les des eau une qui étaient"}
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choice(v[la].split()) for _ in range(25)), None if i % 7 == 0 else la) for i, la in enumerate(["en", "de", "fr"] * 60)]
    docs = brute.documents(spark, [*rows, (900, None, "en"), (901, "12 !!", "en"), (None, "the there of", "en")])
    got = {r["doc_id"]: r for r in langid.identified(docs).collect()}
    assert all(got[i]["lang_pred"] == ["en", "de", "fr"][i % 3] for i, _, _ in rows)
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and not got[None]["held_out"]
    assert all(r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(got) - {900, 901}


def test_empty_tables(spark):
    none = brute.documents(spark, [(1, "x")]).limit(0)
    assert minhash.near_duplicates(none).count() == 0
    assert recompression.repeated_passages(none, carry=["source"]).count() == 0
    assert mixing.mix_plan(none).count() == 0 and mixing.mixed(none).count() == 0
    assert simhash.edited_fingerprints(none).count() == 0
    assert quality.scored(none, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    assert langid.identified(none).count() == 0
    assert decontaminate.leaks(none, spark.createDataFrame([(1, "a" * 99)], "item_id long, text string")).count() == 0


def test_only_the_result_table_stays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "shared_dir", lambda _: f"file://{tmp_path}")
    got = minhash.near_duplicates(brute.documents(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")]))
    assert len([p for p in tmp_path.iterdir() if p.name[0] != "."]) == 1
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == [(1, 1), (2, 1), (3, 3)]


def test_shared_folder(spark):
    assert store.shared_dir(spark).startswith("file:///")


def test_cluster_without_shared_folder_is_an_error():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError):
        store.shared_dir(Session())
