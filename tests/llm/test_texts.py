"""Word access, shingles, signatures and names: numpy parts against plain Python."""

import random

import numpy as np
import pyarrow as pa

from depotlens.llm import decontaminate, langid, minhash, quality, recompression
from depotlens.llm.words import U, blocks, mix, texts_of, words_of

TEXTS = ["a b  c\n", "", None, " x", "tail", "ééé A\tB\x0bC\x0cD\rE", "  ", "z", "x\u00a0y \u2003 q"]


def test_words_and_hashes():
    for texts in (pa.array(TEXTS), pa.array(["skip", *TEXTS])[1:], pa.array(TEXTS, pa.large_string())):
        w = words_of(texts)
        got = [[bytes(w.data[w.starts[k] : w.ends[k]]) for k in range(w.rows[i], w.rows[i + 1])] for i in range(len(TEXTS))]
        assert got == [(t or "").encode().split() for t in TEXTS]
        by_word = {}
        for row in range(len(TEXTS)):
            for k in range(w.rows[row], w.rows[row + 1]):
                by_word.setdefault(bytes(w.data[w.starts[k] : w.ends[k]]), set()).add(int(w.hashes[k]))
        assert all(len(v) == 1 for v in by_word.values()) and len({next(iter(v)) for v in by_word.values()}) == len(by_word)
    one, two = words_of(pa.array(["q a b"])), words_of(pa.array(["long text before", "a b"]))
    assert (one.hashes[1:] == two.hashes[3:]).all()
    assert (words_of(pa.array(["AB c"]), lower=True).hashes == words_of(pa.array(["ab c"])).hashes).all()


def test_bytes_that_are_no_utf8():
    bad = pa.array([b"ok", b"a\xff b", None], pa.binary()).view(pa.string())
    assert texts_of(bad) == ["ok", "a\ufffd b", ""] and words_of(bad).counts.tolist() == [1, 2, 0]


def test_blocks_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["x" * (i * 7 % 40) for i in range(50)])], ["doc_id", "text"])
    got = [r for b in blocks(iter([batch, batch.slice(0, 0)]), limit=60) for r in b.column(0).to_pylist()]
    assert got == list(range(50))


def test_long_text_crosses_the_power_tables():
    text = "ab cd " * 600_000
    w = words_of(pa.array([text, "ab"]))
    assert len(w.hashes) == 1_200_001 and len(np.unique(w.hashes)) == 2 and w.hashes[0] == w.hashes[-1]


def test_superminhash_equals_the_element_by_element_form():
    def reference(elements, m):
        low = [(1 << 64) - 1] * m
        for e in elements:
            p = list(range(m))
            for j in range(m):
                draw = int(mix(np.array([e], U) + U((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))[0])
                k = j + ((draw >> 40) * (m - j) >> 24)
                p[j], p[k] = p[k], p[j]
                low[p[j]] = min(low[p[j]], (j << 32) | (draw & 0xFFFFFFFF))
        return low

    rng = np.random.default_rng(0)
    elements = rng.integers(0, 1 << 63, 400).astype(U)
    offsets = np.array([0, 1, 1, 4, 60, 400])
    got = minhash.superminhash(elements, offsets, 24)
    for i in range(5):
        assert [int(x) for x in got[i]] == reference(elements[offsets[i] : offsets[i + 1]], 24)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 1000).astype(U)
    other = np.concatenate([base[:900], rng.integers(0, 1 << 63, 100).astype(U)])
    s = minhash.superminhash(np.concatenate([base, other]), np.array([0, 1000, 2000]), 512)
    assert abs((s[0] == s[1]).mean() - 900 / 1100) < 0.06


def test_equal_windows_get_equal_names():
    rng = random.Random(1)
    letters = ["a", "b", "c", "dd", "e"]
    texts = [" ".join(rng.choice(letters[: 2 + i % 3]) for _ in range(rng.randint(0, 150))) for i in range(60)]
    texts += ["a " * 100, "b a " * 30, "a b " * 25, "x " + "a " * 50 + "y", texts[5] + " " + texts[9]]
    w = words_of(pa.array(texts))
    names = {}
    total = 0
    for text, start, n, name in zip(*recompression.window_keys(w)):
        own = texts[text].split()
        for a in range(start, start + n):
            total += 1
            names.setdefault(tuple(own[a : a + 20]), set()).add(int(name))
    assert total == sum(max(0, len(t.split()) - 19) for t in texts)
    assert all(len(v) == 1 for v in names.values())


def test_shingle_sets():
    sets, off = minhash.shingle_sets(pa.array(["A b c d", "a B", None, "", "a b c a b c", "x y z"]), 3)
    assert np.diff(off).tolist() == [2, 1, 0, 0, 3, 1]


def test_qgram_regions_against_edit_distance():
    rng = random.Random(3)
    p = decontaminate.LeakParams()
    items = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(rng.choice([6, 20, 50])))) for i in range(6)]
    segments = decontaminate.Segments(items, p)
    texts, want = [], []
    for n in range(60):
        item, text = items[n % 6]
        changed = list(text)
        for _ in range(int(len(text) * rng.choice([0, 0.03, 0.06, 0.3]))):
            k = rng.randrange(len(changed))
            changed[k : k + 1] = rng.choice([[], ["q"], [changed[k], "z"]])
        texts.append("before it " + "".join(changed).upper().replace(" ", " \n ") + " after it")
        normal = " ".join(texts[-1].lower().split())
        for s in range(len(segments.item)):
            cut = "".join(chr(c) for c in segments.points[segments.begin[s] : segments.begin[s + 1]])
            if edit_within(cut, normal) <= segments.k[s]:
                want.append((n, int(segments.item[s])))
    got = {(r[0], r[1]) for r in decontaminate.regions(texts, segments)}
    assert got == set(want) and 10 < len(got) < 60


def test_any_sixty_characters_of_an_item():
    """Every position of a 60-character quote, also with edits; below that nothing; short items verbatim as words."""
    rng = random.Random(5)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(44))[:233]
    segments = decontaminate.Segments([(7, item), (8, "blue whale"), (9, "x=1"), (10, "光合作用")], decontaminate.LeakParams())
    around = "0123456789 " * 4
    got = decontaminate.regions([around + item[a : a + 60] + around[::-1] for a in range(174)], segments)
    whole = [a for a in range(174) if item[a] != " " and item[a + 59] != " "]
    assert set(whole) <= {g[0] for g in got if g[1] == 7 and g[3] == 0}
    edited, want = [], set()
    for n in range(80):
        a = rng.randrange(174)
        quote = list(item[a : a + 60])
        for _ in range(n % 8):
            k = rng.randrange(len(quote))
            quote[k : k + 1] = rng.choice([[], ["9"], [quote[k], "9"]])
        edited.append("9" * 8 + "".join(quote) + "9" * 8)
        if any(edit_within(item[s : s + 60], edited[-1]) <= 4 for s in range(max(0, a - 4), min(174, a + 5))):
            want.add(n)
    assert {g[0] for g in decontaminate.regions(edited, segments)} == want and 20 < len(want) < 80
    assert decontaminate.regions([item[90:130]], segments) == []
    texts = ["A  Blue\nwhale.", "blue whales", "if x=1: y", "x=12", "我们说光合作用很重要", ""]
    assert sorted((g[0], g[1]) for g in decontaminate.regions(texts, segments)) == [(0, 8), (2, 9), (4, 10)]


def edit_within(needle, text):
    from tests.llm.brute import edit_distance_within

    return edit_distance_within(needle, text)


def test_ftrl_separates_and_handles_no_rows():
    p = quality.QualityParams(bits=12)
    good = [f"the quick word{i} runs over hills." for i in range(40)]
    bad = [f"BUY!! NOW{i}!! CHEAP!! PILLS!!" for i in range(40)]
    rows = quality.text_vectors(words_of(pa.array(good + bad)), p.bits)
    model = quality.fit_ftrl(rows, np.array([1.0] * 40 + [0.0] * 40), p)
    score = model.scores(pa.array(["the quick horse runs over fields.", "SELL!! CHEAP!! THINGS!!", None, ""]))
    assert score[0] > 0.8 and score[1] < 0.2 and score[2] == score[3]
    assert quality.fit_ftrl([], np.zeros(0), p).scores(pa.array(["x"])).tolist() == [0.5]
    # the sparse dot product of a text equals that of its vector
    w = words_of(pa.array(good))
    by_vector = [float(model.weights[s] @ f) for s, f in rows[:40]]
    assert np.allclose(quality.text_margins(w, model.weights, p.bits), by_vector, atol=1e-5)


def test_language_machines():
    p = langid.LangParams(bits=10, epochs=20)
    rng = random.Random(0)
    vocabulary = {"en": "the of and ing tion there", "de": "der und sch ung nicht ein", "fr": "les des eau une qui étaient", "es": "los que ción una ñado para", "ja": "これ は です ます それ"}
    texts, langs = [], []
    for lang, v in vocabulary.items():
        for _ in range(40):
            texts.append(" ".join(rng.choice(v.split()) for _ in range(30)))
            langs.append(lang)
    model = langid.fit_languages(langid.frequencies(pa.array(texts), p.bits), langs, p)
    assert len(model.pairs) == 2 and len(model.families) == 3
    lang, score = model.predict(pa.array([*texts, None, "", "12 34 !!", "١٢", "é"]))
    assert lang[:-5] == langs and lang[-5:-1] == ["und"] * 4 and lang[-1] != "und"
    assert ((score >= 0) & (score <= 1)).all()
    # what stands next to a text in its block does not change its score
    alone = [model.predict(pa.array([t]))[1][0] for t in texts[:5]]
    assert np.allclose(alone, score[:5], atol=1e-6)
    only = langid.fit_languages(langid.frequencies(pa.array(texts[:3]), p.bits), langs[:3], p)
    assert only.predict(pa.array(["abc"]))[0] == ["en"]
    none = langid.fit_languages(np.zeros((0, 2 << p.bits), np.float32), [], p)
    assert none.predict(pa.array(["abc", None]))[0] == ["und", "und"]
