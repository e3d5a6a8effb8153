"""Benchmark passages in documents: q-gram lemma filter, then banded alignment.

Texts are compared lower-cased with every stretch of white space as one space.
A document holds a passage of an item if it holds, within the edits that
``LeakParams.budget`` allows for the length (insertions, deletions,
substitutions), the whole item or any ``windows`` (60, 70) consecutive
characters of it, wherever in the item they start. Items too short for any
q-gram bound (under 17 characters) must stand verbatim as whole words.

Filter (q-gram lemma): within k edits a stretch of m characters shares at
least m - q + 1 - k * q of its q-grams with the passage, all on diagonals
(document position minus item position) at most k apart. The q-grams of whole
items are indexed once. Shared q-grams are counted in diagonal bands that
overlap by half, each at least 2 * k + 1 wide, so one band holds all of them;
within the bands that reach the bound, only the windows that reach it go on.
Verification: an unbroken run of shared q-grams on one diagonal is a verbatim
passage; all else is aligned to the document within the band (free ends in
the document) and stays if its edit distance is at most k.

Shared q-grams are kept as runs along diagonals. Where a text and an item both
repeat a pattern of up to ``PERIODS`` characters (rules of dashes, runs of one
letter), every place of the one meets every place of the other; such a pair of
stretches gives one run a diagonal, and if both are as long as a passage, one
passage for the text's stretch and the runs at its corners.

The benchmark is read in blocks of at most ``block_chars`` characters; every
block is searched for in all documents. Documents are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import mapped, stored, tidy
from .words import U, _power_tables, blocks, mix, texts_of

_SPACE_POINTS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@dataclass(frozen=True)
class LeakParams:
    q: int = 10
    windows: tuple[int, ...] = (60, 70)  # any so many consecutive characters of an item are a passage; ascending
    edit_share: float = 0.08
    least_hits: int = 8  # every stretch must show at least so many q-grams; short ones are allowed fewer edits for it
    block_chars: int = 8_000_000

    def budget(self, m: int) -> int:
        return min(int(m * self.edit_share), (m - self.q + 1 - self.least_hits) // self.q)


def normal_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets by text) of the lower-cased texts with single spaces."""
    lowered = [t.lower() for t in texts]
    off = np.zeros(len(lowered) + 1, np.int64)
    np.cumsum([len(t) for t in lowered], out=off[1:])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (points <= 32) | (points >= 0x85)
    look = np.flatnonzero(space)
    space[look] = np.isin(points[look], _SPACE_POINTS)
    points = np.where(space, np.uint32(32), points)
    keep = np.ones(len(points), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    begins = off[:-1][off[:-1] < off[1:]]
    keep[begins] = ~space[begins]  # leading space goes; a run that crosses a text border is cut there
    kept = np.concatenate([[0], np.cumsum(keep)])
    return points[keep], kept[off]


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    """32-bit hash of every q consecutive code points."""
    n = len(points) - q + 1
    out = np.zeros(max(n, 0), np.uint32)
    factor = 1
    for k in range(q):
        factor = factor * 0x9E3779B1 % (1 << 32)
        if n > 0:
            out += points[k : k + n] * np.uint32(factor)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA6B)
    out ^= out >> np.uint32(13)
    return out


PERIODS = 5


def _patterns(points: np.ndarray, at: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, name, phase) of the q code points at each place: the smallest period up to PERIODS (0 if there is none), a
    name that all rotations of the repeated pattern share, and the place modulo the period where the named rotation begins."""
    period, name, phase = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for begin in range(0, len(at), 1 << 16):
        part = slice(begin, begin + (1 << 16))
        window = points[at[part, None] + np.arange(q)]
        of = np.zeros(len(window), np.int64)
        for p in range(PERIODS, 0, -1):
            of[(window[:, p:] == window[:, :-p]).all(axis=1)] = p
        period[part] = of
        for p in range(1, PERIODS + 1):
            mine = np.flatnonzero(of == p)
            if len(mine):
                spelled = np.zeros((len(mine), p), np.uint64)
                for k in range(p):
                    for j in range(p):
                        spelled[:, k] = spelled[:, k] * np.uint64(0x9E3779B97F4A7C15) + window[mine, k + j].astype(np.uint64) + np.uint64(p)
                first = spelled.argmin(axis=1)
                name[begin + mine] = spelled[np.arange(len(mine)), first].view(np.int64)
                phase[begin + mine] = (at[part][mine] + first) % p
    return period, name, phase


@dataclass
class Stretches:
    """Maximal stretches of q-grams of one repeated pattern: the row (text or item) they stand in, first place, number of q-grams, and the pattern."""

    row: np.ndarray
    place: np.ndarray
    size: np.ndarray
    period: np.ndarray
    name: np.ndarray
    phase: np.ndarray

    @staticmethod
    def of(row, place, period, name, phase) -> "Stretches":
        """From q-grams with a pattern, ordered by row and place."""
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1) | (name[1:] != name[:-1]) | (period[1:] != period[:-1])
        first = np.flatnonzero(new)
        return Stretches(row[first], place[first], np.diff(np.append(first, len(row))), period[first], name[first], phase[first])

    def taken(self, which: np.ndarray) -> "Stretches":
        return Stretches(*(x[which] for x in (self.row, self.place, self.size, self.period, self.name, self.phase)))


def _spread(first: np.ndarray, count: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the progressions first, first + step, ... of ``count`` values each."""
    row = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, first[row] + nth * step[row]


def _stretch_runs(t: Stretches, i: Stretches, least: int, q: int):
    """Pairs of text and item stretches of one pattern: (pair, place in the text, place in the item, size) of the runs
    along diagonals, and (pair, begin, end) of the passages of at least ``least`` q-grams.

    Where both stretches are that long, the diagonals in the middle make one
    passage; as runs only those at the corners are listed, and the two that
    begin or end together, which other q-grams may prolong.
    """
    low, high = t.place - i.place - i.size + 1, t.place + t.size - 1 - i.place  # the pair's diagonals
    toward = t.phase - i.phase  # a diagonal shows equal q-grams if it is this modulo the period
    long = (t.size >= least) & (i.size >= least)
    at_start, at_end = t.place - i.place, t.place + t.size - i.place - i.size
    inner_low, inner_high = low + least - 1, high - least + 1

    def within(d: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        which = np.flatnonzero(mask & (d >= inner_low) & (d <= inner_high))
        return which, d[which], d[which]

    every, corner = np.flatnonzero(~long), np.flatnonzero(long)
    ranges = [(every, low[every], high[every]), (corner, low[corner], inner_low[corner] - 1), (corner, np.maximum(inner_high, inner_low - 1)[corner] + 1, high[corner]),
              within(at_start, long), within(at_end, long & (at_end != at_start))]
    pair, lo, hi = (np.concatenate(x) for x in zip(*ranges))
    lo = lo + (toward[pair] - lo) % t.period[pair]
    count = np.maximum((hi - lo) // t.period[pair] + 1, 0)
    row, d = _spread(lo, count, t.period[pair])
    pair = pair[row]
    begin = np.maximum(i.place[pair], t.place[pair] - d)
    size = np.minimum(i.place[pair] + i.size[pair], t.place[pair] + t.size[pair] - d) - begin
    runs = (pair, begin + d, begin, size)

    first = inner_low + (toward - inner_low) % t.period
    last = inner_high - (inner_high - toward) % t.period
    whole = np.flatnonzero(long & (first <= last))
    t, i, first, last = t.taken(whole), i.taken(whole), first[whole], last[whole]
    ends = np.minimum(t.place + t.size, i.place + i.size + last) - 1 + q
    return runs, (whole, np.maximum(t.place, i.place + first), ends)


def _brief(items: list[tuple[int, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, item ids, code points by row) of short items, one entry per length, ascending hashes."""
    out = []
    for n in sorted({len(t) for _, t in items}):
        rows = [(item, t) for item, t in items if len(t) == n]
        points = np.stack([t for _, t in rows])
        hashes = np.concatenate([_grams(t, n) for t in points])
        order = np.argsort(hashes, kind="stable")
        out.append((hashes[order], np.array([item for item, _ in rows], np.int64)[order], points[order]))
    return out


class Segments:
    """The items of a block, whole, and the index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], p: LeakParams):
        self.p = p
        points, off = normal_points([t for _, t in items])
        texts = [(item, points[off[i] : off[i + 1]]) for i, (item, _) in enumerate(items)]
        self.brief = _brief([(item, t) for item, t in texts if len(t) and p.budget(len(t)) < 0])
        texts = [(item, t) for item, t in texts if p.budget(len(t)) >= 0]
        parts = [t for _, t in texts]
        self.item = np.array([item for item, _ in texts], np.int64)
        self.length = np.array([len(t) for t in parts], np.int64)
        self.k = np.array([p.budget(len(t)) for t in parts], np.int64)
        self.need = self.length - p.q + 1 - self.k * p.q
        self.begin = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.points = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        hashes = [_grams(c, p.q) for c in parts]
        grams = np.concatenate(hashes) if hashes else np.zeros(0, np.uint32)
        sizes = np.array([len(h) for h in hashes], np.int64)
        segment = np.repeat(np.arange(len(parts)), sizes).astype(np.int64)
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
        bits = max(16, int(np.ceil(np.log2(max(1, 32 * len(np.unique(grams)))))))
        self.shift = np.uint32(32 - min(bits, 28))
        self.known = np.zeros(1 << min(bits, 28), bool)
        self.known[grams >> self.shift] = True
        period, name, phase = _patterns(self.points, self.begin[segment] + place, p.q)
        # phases count from the item's first place, as the places do
        phase = np.where(period > 0, (phase - self.begin[segment]) % np.maximum(period, 1), 0)
        again = np.flatnonzero(period > 0)
        repeated = Stretches.of(segment[again], place[again], period[again], name[again], phase[again])
        self.repeated = repeated.taken(np.argsort(repeated.name, kind="stable"))
        plain = np.flatnonzero(period == 0)
        plain = plain[np.argsort(grams[plain], kind="stable")]
        self.grams, first = np.unique(grams[plain], return_index=True)
        self.first = np.append(first, len(plain))
        self.segment, self.place = segment[plain], place[plain]

    def hits(self, points: np.ndarray, off: np.ndarray):
        """Shared q-grams as runs (position, text, segment, place in the segment, size) along diagonals, and the passages
        [segment, text, begin, end, 0 edits] within stretches of one pattern."""
        q = self.p.q
        grams = _grams(points, q)
        at = np.flatnonzero(self.known[grams >> self.shift])
        text = np.searchsorted(off, at, side="right") - 1
        inside = at + q <= off[text + 1]
        at, text = at[inside], text[inside]
        period, name, phase = _patterns(points, at, q)
        again = np.flatnonzero(period > 0)
        t = Stretches.of(text[again], at[again], period[again], name[again], phase[again])
        low, high = (np.searchsorted(self.repeated.name, t.name, side=x) for x in ("left", "right"))
        of, which = _spread(low, high - low, np.ones(len(low), np.int64))
        same = t.period[of] == self.repeated.period[which]
        t, i = t.taken(of[same]), self.repeated.taken(which[same])
        (pair, x, y, size), (whole, begin, end) = _stretch_runs(t, i, min(self.p.windows) - q + 1, q)

        plain = period == 0
        at, text = at[plain], text[plain]
        if len(self.grams) and len(at):
            found = np.searchsorted(self.grams, grams[at])
            found[found == len(self.grams)] = 0
            sure = self.grams[found] == grams[at]
            at, text, found = at[sure], text[sure], found[sure]
            which, place = _spread(self.first[found], self.first[found + 1] - self.first[found], np.ones(len(found), np.int64))
            at, text, seg, place = at[which], text[which], self.segment[place], self.place[place]
        else:
            at, text, seg, place = (np.zeros(0, np.int64) for _ in range(4))
        runs = [np.concatenate(c) for c in ((at, x), (text, t.row[pair]), (seg, i.row[pair]), (place, y), (np.ones(len(at), np.int64), size))]
        return runs, [i.row[whole], t.row[whole], begin, end, np.zeros(len(whole), np.int64)]


def _aligned(points: np.ndarray, begin: np.ndarray, end: np.ndarray, low: np.ndarray, width: int, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edit distance, end position) of each row of ``stretch`` against its document band.

    Row i of the table holds the cells (stretch position i, document position
    i + low + c), c < width; alignments start and end anywhere in the document.
    """
    c = np.arange(width, dtype=np.int32)
    cost = np.zeros((len(low), width), np.int32)  # before the first character
    m = stretch.shape[1]
    at = low[:, None] + np.arange(width + m)
    known = np.where((at >= begin[:, None]) & (at < end[:, None]), points[np.clip(at, 0, len(points) - 1)].astype(np.int64), -1)
    for i in range(m):
        step = cost + (known[:, i : i + width] != stretch[:, i : i + 1])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - c, axis=1) + c
    best = cost.argmin(axis=1)
    return cost[np.arange(len(low)), best], low + m + best


def _verbatim(seg, text, at, place, size, least: int, q: int):
    """(item number, text, begin, end, 0 edits) of at least ``least`` q-grams in a row on a diagonal, and which runs lie in none."""
    order = np.lexsort((place, at - place, text, seg))
    s, t, a, x, n = seg[order], text[order], at[order], place[order], size[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1]) | (x[1:] != x[:-1] + n[:-1]) | (a[1:] != a[:-1] + n[:-1])
    start = np.flatnonzero(new)
    size = np.add.reduceat(n, start) if len(start) else n
    long = size >= least
    rest = np.ones(len(s), bool)
    rest[order] = ~np.repeat(long, np.diff(np.append(start, len(s))))
    start, size = start[long], size[long]
    return [s[start], t[start], a[start], a[start] + size - 1 + q, np.zeros(len(start), np.int64)], rest


def _bands(seg, text, diagonal, size, half, n_texts: int, need):
    """(key by run and band, kept keys, and their item number, text and band); band b covers the diagonals b * half .. (b + 2) * half - 1."""
    pairs, pair = np.unique(seg * n_texts + text, return_inverse=True)
    band = diagonal // half + (1 << 31)
    key = np.concatenate([(pair << 32) + band, (pair << 32) + band - 1])
    keys, of = np.unique(key, return_inverse=True)
    count = np.bincount(of, weights=np.tile(size, 2), minlength=len(keys))
    s, t = np.divmod(pairs[keys >> 32], n_texts)
    kept = count >= (need[s] if isinstance(need, np.ndarray) else need)
    return key, keys[kept], s[kept], t[kept], (keys[kept] & ((1 << 32) - 1)) - (1 << 31)


def _hit_places(number: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (number, place) that runs cover; runs that overlap are joined before they are spelled out."""
    if not len(number):
        return number, place
    order = np.lexsort((place, number))
    begin = (number[order] << 32) + place[order]
    end = np.maximum.accumulate(begin + size[order])  # a run never reaches into the next number
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    first = np.flatnonzero(new)
    begin, last = begin[first], np.append(first[1:], len(new)) - 1
    _, hit = _spread(begin, end[last] - begin, np.ones(len(begin), np.int64))
    return hit >> 32, hit & ((1 << 32) - 1)


def _windows(key, keys, place, size, segment_length, m: int, need: int, q: int):
    """(kept key number, start) of the windows of m characters with at least ``need`` hit places in one band."""
    number = np.searchsorted(keys, key)
    number[number == len(keys)] = 0
    ours = keys[number] == key if len(keys) else np.zeros(len(key), bool)
    number, place = _hit_places(number[ours], place[ours], size[ours])
    a, b = np.arange(max(0, len(place) - need + 1)), np.arange(need - 1, max(need - 1, len(place)))
    fits = (number[a] == number[b]) & (place[b] - place[a] <= m - q)
    a, b = a[fits], b[fits]
    low = np.maximum(place[b] - (m - q), 0)
    high = np.minimum(place[a], segment_length[number[a]] - m)
    if len(a):  # starts that the range before has had are left out
        same = number[a[1:]] == number[a[:-1]]
        low[1:] = np.where(same, np.maximum(low[1:], high[:-1] + 1), low[1:])
    n = np.maximum(high - low + 1, 0)
    return np.repeat(number[a], n), np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _checked(points, sums, off, segments: Segments, s, t, low, start, m: int, k: int, half: int):
    """(item number, text, begin, end, edits) of the stretches of m characters from ``start`` that stand in their band within k edits.

    A stretch that meets the same characters in many places (lines that a text
    repeats) is aligned with them once; ``sums`` are ``_sums(points)``.
    """
    out = [[np.zeros(0, np.int64)] * 5]
    width = 2 * half + 2 * k
    rows = max(1, 400_000 // (width + m))  # bounds the alignment table
    up, down = sums
    for part in range(0, len(s), 1 << 20):
        sl = slice(part, part + (1 << 20))
        item, text, at, first = s[sl], t[sl], low[sl] - k, start[sl]
        lo = np.clip(at, off[text], off[text + 1])
        hi = np.clip(at + width + m, off[text], off[text + 1])
        key = mix((up[hi] - up[lo]) * down[lo])
        for x in (item, first, lo - at, hi - lo):
            key = mix(key ^ (x.astype(U) + U(0x9E3779B97F4A7C15)))
        _, one, of = np.unique(key, return_index=True, return_inverse=True)
        edits, reach = np.empty(len(one), np.int64), np.empty(len(one), np.int64)
        for chunk in range(0, len(one), rows):
            c = slice(chunk, chunk + rows)
            i = one[c]
            stretch = segments.points[(segments.begin[item[i]] + first[i])[:, None] + np.arange(m)].astype(np.int64)
            cost, end = _aligned(points, off[text[i]], off[text[i] + 1], at[i], width, stretch)
            edits[c], reach[c] = cost, end - at[i]
        edits, end = edits[of], at + reach[of]
        good = edits <= k
        out.append([item[good], text[good], end[good] - m, end[good], edits[good]])
    return [np.concatenate(c) for c in zip(*out)]


def _sums(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums that name any stretch of the points, and the factors that bring stretches to one place."""
    up, down = _power_tables(len(points) + 1)
    run = np.zeros(len(points) + 1, U)
    np.cumsum(mix(points.astype(U) + U(1)) * up[: len(points)], out=run[1:])
    return run, down


def _passages(found: list[np.ndarray]) -> list[np.ndarray]:
    """Overlapping passages of one (item number, text) as one: the smallest edits, the last end."""
    order = np.lexsort((found[2], found[1], found[0]))
    s, t, begin, end, edits = (c[order] for c in found)
    if not len(s):
        return [s, t, begin, end, edits]
    pair = np.ones(len(s), bool)
    pair[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    rank = np.cumsum(pair) << 40
    reach = np.maximum.accumulate(rank + end) - rank
    new = pair.copy()
    new[1:] |= begin[1:] >= reach[:-1]
    first = np.flatnonzero(new)
    return [s[first], t[first], begin[first], np.maximum.reduceat(end, first), np.minimum.reduceat(edits, first)]


def _brief_regions(points: np.ndarray, off: np.ndarray, segments: Segments) -> list[tuple[int, int, int, int]]:
    """(text, item, end, 0 edits) of short items that stand verbatim; letters and digits next to them must not continue a word."""
    out = []
    for hashes, items, rows in segments.brief:
        n = rows.shape[1]
        grams = _grams(points, n)
        at = np.flatnonzero(np.isin(grams, hashes))
        text = np.searchsorted(off, at, side="right") - 1
        inside = at + n <= off[text + 1]
        for a, t in zip(at[inside].tolist(), text[inside].tolist()):
            before = a > off[t] and _one_word(points[a - 1], points[a])
            after = a + n < off[t + 1] and _one_word(points[a + n - 1], points[a + n])
            if not before and not after:
                for r in range(np.searchsorted(hashes, grams[a]), np.searchsorted(hashes, grams[a], side="right")):
                    if np.array_equal(rows[r], points[a : a + n]):
                        out.append((t, int(items[r]), a + n - int(off[t]), 0))
    return out


def _one_word(a: int, b: int) -> bool:
    """Two neighbours that belong to one word, in scripts that part words by spaces (below U+2E80)."""
    return max(a, b) < 0x2E80 and chr(a).isalnum() and chr(b).isalnum()


def regions(texts: list[str], segments: Segments) -> list[tuple[int, int, int, int]]:
    """(text, item, end, edits) of each passage; longer windows and whole items are looked at where shorter ones show nothing."""
    p = segments.p
    points, off = normal_points(texts)
    brief = _brief_regions(points, off, segments)
    if not len(segments.points):
        return brief
    (at, text, seg, place, size), whole = segments.hits(points, off)
    if not len(at) and not len(whole[0]):
        return brief
    n = len(texts)
    found, rest = _verbatim(seg, text, at, place, size, min(p.windows) - p.q + 1, p.q)
    found = [np.concatenate(c) for c in zip(found, whole)]
    sums = _sums(points)
    diagonal = at - off[text] - place  # may reach below the text's first position
    half = 2 * max(map(p.budget, p.windows)) + 1
    for m in p.windows:
        k = p.budget(m)
        mine = rest & (segments.length[seg] >= m)
        if m > min(p.windows):
            mine &= ~np.isin(seg * n + text, found[0] * n + found[1])
        key, keys, s, t, band = _bands(seg[mine], text[mine], diagonal[mine], size[mine], half, n, m - p.q + 1 - k * p.q)
        number, start = _windows(key, keys, np.tile(place[mine], 2), np.tile(size[mine], 2), segments.length[s], m, m - p.q + 1 - k * p.q, p.q)
        more = _checked(points, sums, off, segments, s[number], t[number], off[t[number]] + band[number] * half + start, start, m, k, half)
        found = [np.concatenate(c) for c in zip(found, more)]
    mine = ~np.isin(seg * n + text, found[0] * n + found[1])
    _, _, s, t, band = _bands(seg[mine], text[mine], diagonal[mine], size[mine], 2 * segments.k[seg[mine]] + 1, n, segments.need)
    for m in np.unique(segments.length[s]).tolist():
        of, k = segments.length[s] == m, p.budget(m)
        more = _checked(points, sums, off, segments, s[of], t[of], off[t[of]] + band[of] * (2 * k + 1), np.zeros(of.sum(), np.int64), m, k, 2 * k + 1)
        found = [np.concatenate(c) for c in zip(found, more)]
    s, t, _, end, edits = _passages(found)
    return brief + list(zip(t.tolist(), segments.item[s].tolist(), (end - off[t]).tolist(), edits.tolist()))


@tidy
def leaks(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    """(doc_id, item_id, n_segments, edits, ends_at) for each document and benchmark item it holds a passage of.

    n_segments is the number of distinct passages found, edits the smallest
    edit distance among them, ends_at the end of the first one in the
    normalised text; passages that overlap count as one. Null or empty texts
    on either side match nothing; items too short to show ``least_hits``
    q-grams (under 17 characters) are found where they stand verbatim as whole
    words. Repeated items and documents are found each; rows that repeat a doc_id
    or item_id are reported once for the id.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL AND item_id IS NOT NULL")
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n_blocks = 1 + int(chars) // p.block_chars
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, ends_at int, edits int"
    found = []
    for block in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()  # about block_chars characters
        index = spark.sparkContext.broadcast(Segments(sorted((r[0], r[1]) for r in mine), p))

        def run(batches, index=index):
            for b in blocks(batches):
                got = regions(texts_of(b.column(1)), index.value)
                ids = b.column(0).take(pa.array([g[0] for g in got], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([g[1] for g in got], pa.int64()), *(pa.array([g[n] for g in got], pa.int32()) for n in (2, 3))],
                    ["doc_id", "item_id", "ends_at", "edits"],
                )

        found.append(stored(mapped(docs, run, schema), "leaks"))
    every = reduce(DataFrame.union, found)
    found = every.groupBy("doc_id", "item_id").agg(
        F.count_distinct("ends_at").alias("n_segments"), F.min("edits").alias("edits"), F.min("ends_at").alias("ends_at")
    )
    return stored(found, "leaks")
