"""Brute-force versions and small tables for the operator tests."""

from __future__ import annotations

import hashlib
import random
import zlib

import xxhash

EXTRA = "size long, name string, band long, node long, copies long, component_id long, score double, digest string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
PAGES = "page_id long, url string, html string, " + EXTRA
NO_EXTRA = (None,) * 8


def documents(spark, rows):
    """Documents with nulls and column names that operators use inside. rows: (doc_id, text[, lang[, source]])."""
    full = [(*r, *(None,) * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(i, t, la, so, None if t is None else len(t), *NO_EXTRA) for i, t, la, so in full], DOCS).repartition(3)


def pages(spark, rows):
    return spark.createDataFrame([(*r, *NO_EXTRA) for r in rows], PAGES).repartition(3)


def words(text):
    return (text or "").encode().split()


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def near_groups(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            same = len(sets[i] & sets[j])
            if 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def repeats_cut(rows, window=20):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = words(t)
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            key = tuple(w[a : a + window])
            if key in seen:
                gone[a : a + window] = [True] * window
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def edit_distance_within(needle: str, text: str) -> int:
    """Smallest edit distance of ``needle`` to any substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(needle, 1):
        before, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j - 1] + (c != d), before[j] + 1, row[j - 1] + 1))
    return min(row)


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows, fan_out=8):
    """rows: (doc_id, text, lang, source, n_chars); the manifest's row by (doc_id, leaf), equal rows in a list."""

    def leaf(i, text, lang, source, n):
        return _h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, source, lang, n, text)))

    def tree(digests):
        """(top, path of each leaf as (left, right) by level)."""
        paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
        while len(level) > 1:
            for path, k in zip(paths, at):
                a = k // fan_out * fan_out
                path.append(("".join(level[a:k]), "".join(level[k + 1 : a + fan_out])))
            at = [k // fan_out for k in at]
            level = [_h(*level[a : a + fan_out]) for a in range(0, len(level), fan_out)]
        return level[0], paths

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    found, tops = [], []
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(*_in_order(r)), r) for r in rows if r[2] == lang), key=lambda x: x[:3])
        top, paths = tree([x[2] for x in own])
        tops.append(top)
        found += [(x[3], x[2], len(tops) - 1, path) for x, path in zip(own, paths)]
    if not rows:
        return {}
    root, above = tree(tops)
    out = {}
    for r, digest, k, path in found:
        path = path + above[k]
        i, text = r[0], r[1]
        struck = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        node = leaf(i, text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text), *r[2:]) if struck else digest
        for left, right in path:
            node = _h(left, node, right)
        out.setdefault((i, digest), []).append((tops[k], root, _h(*(a + b for a, b in path)), node, node == root))
    return out


def _in_order(r):
    return r[0], r[1], r[2], r[3], r[4]


def alignment(texts, a, b, a_bytes, b_bytes):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), token by token. a, b: encoders; x_bytes: bytes of an id."""
    held, counts = [], {}
    for text in texts:
        whole = b" " + (text or "").encode()
        ia, ib = (a(text), b(text)) if text else ([], [])
        if not text or b"".join(map(a_bytes, ia)) != whole or b"".join(map(b_bytes, ib)) != whole:
            held.append(None)
            continue
        groups, i, j = [], 0, 0
        while i < len(ia):
            ga, gb, ea, eb = [ia[i]], [ib[j]], len(a_bytes(ia[i])), len(b_bytes(ib[j]))
            i, j = i + 1, j + 1
            while ea != eb:
                if ea < eb:
                    ga.append(ia[i])
                    ea += len(a_bytes(ia[i]))
                    i += 1
                else:
                    gb.append(ib[j])
                    eb += len(b_bytes(ib[j]))
                    j += 1
            groups.append((ga, gb))
        held.append((ia, ib, groups))
        for pair in {(x, y) for ga, gb in groups for x in ga for y in gb}:
            counts[pair] = counts.get(pair, 0) + 1
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for one in held:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ia, ib, groups = one
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        form = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(ia), len(ib), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(form.encode()).hexdigest()))
    return out


def simhash(text, width=3):
    """Majority bits of the shingles' XXH64 (seed 42), repeats included."""
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups_within(prints, radius):
    """Smallest id reachable for each (id, fingerprint); fingerprints of one id count as linked."""
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, x) in enumerate(prints):
        for j, y in prints[:n]:
            if (x ^ y).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}
