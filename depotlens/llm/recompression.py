"""Repeated passages by recompression: locally consistent names, then exact confirmation.

A window is ``window`` consecutive words of one document. Every word covered
by a window whose word sequence also starts earlier (smaller doc_id, or the
same document and an earlier start) is removed; windows are judged on the
input.

Names. A document is a sequence of word names. First maximal token runs a^k
get one name, then rounds replace pairs: a global rule (a hash of the name and
the round) puts every name in the left or the right class, and each adjacent
left-right pair becomes one new name. Names are 64-bit fingerprints of what
they replace, so equal pairs get equal names in every task of the cluster
without a dictionary being exchanged (a dictionary exchange would move the
whole corpus once a round). With each symbol goes the *extent* of words that
decided it; inside equal substrings all symbols whose extent fits are equal.

Spark rounds.
1. The last round names each chain of neighbouring top-level symbols. Every
   window is represented by the smallest name (the leftmost) among the chains whose extent
   lies within it (where none fits, as inside long runs, among its word
   chains). This depends on the words of the window only, so equal windows
   choose equal names. Runs of windows with the same chain make one row, about
   one for seven words; names that occur once in the corpus cannot belong to
   a repeat and leave.
2. The windows of the remaining rows are confirmed exactly, on 128-bit
   fingerprints of their word sequences: per fingerprint the first document.
3. Every document gets the fingerprints it is the first to hold; all its other
   candidate windows start earlier elsewhere and their words go.

Names and fingerprints are grouped with map-side combining; the join on hot
names is dealt by Spark's skew handling. Per-document lists are bounded by the
document's own length.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import mapped, stored, tidy
from .words import U, Words, blocks, mix, ngram_hashes, signed, words_of

WINDOW = 20
ROUNDS = 2  # pair rounds after the run round: symbols of 1 to 4 words or runs
CHAIN = 3  # neighbouring symbols named together
WORD_CHAIN = 8  # words named together where no chain of symbols fits (inside long runs)


def _levels(w: Words, rounds: int):
    """Symbols of every level, level 0 (words) first: (names, lowest slot, highest slot of the extent).

    Slots number the words with one separator before each text and one at the
    end; a separator is never merged and never inside a window.
    """
    texts = len(w.rows) - 1
    size = len(w.hashes) + texts + 1
    names = np.zeros(size, U)
    word_slots = np.arange(len(w.hashes)) + w.row_of() + 1
    names[word_slots] = w.hashes
    border = np.ones(size, bool)
    border[word_slots] = False
    slot = np.arange(size, dtype=np.int32)
    levels = [(names, slot, slot)]

    # token runs: a run is maximal, so its two neighbours decide it too
    begins = np.ones(size, bool)
    begins[1:] = border[1:] | (names[1:] != names[:-1])
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, size))
    out = names[at]
    many = length > 1
    out[many] = mix(out[many] ^ mix(length[many].astype(U)))
    border = border[at]
    lo = np.where(border, at, at - 1).astype(np.int32)
    hi = np.where(border, at, at + length).astype(np.int32)
    names = out
    levels.append((names, lo, hi))

    for r in range(rounds):
        right = (mix(names + U((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> U(63)).astype(bool)
        left = ~right & ~border
        right &= ~border
        pair = np.zeros(len(names), bool)
        pair[:-1] = left[:-1] & right[1:]
        keep = np.ones(len(names), bool)
        keep[1:] = ~pair[:-1]
        at = np.flatnonzero(keep)
        out = names[at]
        paired = np.flatnonzero(pair[at])
        i = at[paired]
        out[paired] = mix(names[i] * U(0xD6E8FEB86659FD93) + mix(names[i + 1] + U(r + 1)))
        next_at, prev_at = np.minimum(at + 1, len(names) - 1), np.maximum(at - 1, 0)
        hi = np.where(left[at], hi[next_at], hi[at])
        lo = np.where(right[at], lo[prev_at], lo[at])
        names, border = out, border[at]
        levels.append((names, lo, hi))
    return levels


def _leftmost_least(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Index of the leftmost minimum of values[first : first + count] for each pair, count >= 1 (doubling table)."""
    out = np.empty(len(first), np.int64)
    power = np.log2(count).astype(np.int64)
    best = np.arange(len(values))
    for k in range(int(power.max(initial=0)) + 1):
        if k:
            half = 1 << (k - 1)
            one, two = best[:-half], best[half:]
            best = np.where(values[two] < values[one], two, one)
        mine = np.flatnonzero(power == k)
        one, two = best[first[mine]], best[first[mine] + count[mine] - (1 << k)]
        out[mine] = np.where(values[two] < values[one], two, one)
    return out


def window_keys(w: Words, window: int = WINDOW):
    """Rows (text, first start, number of starts, name): runs of windows represented by the same chain."""
    counts = w.counts
    per_text = np.maximum(counts - window + 1, 0)
    total = int(per_text.sum())
    if not total:
        e = np.zeros(0, np.int64)
        return e, e, e, np.zeros(0, U)
    text = np.repeat(np.arange(len(counts)), per_text)
    start = np.arange(total) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    slot = start + w.rows[text] + text + 1
    key = np.zeros(total, U)
    place = np.zeros(total, np.int64)  # the chain itself: a second place of the same name is another row
    open_ = np.arange(total)
    size = len(w.hashes) + len(counts) + 1
    levels = _levels(w, ROUNDS)
    for (names, lo, hi), chain in ((levels[-1], CHAIN), (levels[0], min(WORD_CHAIN, window))):
        chained = ngram_hashes(names, chain)
        lo, hi = lo[: len(chained)], hi[chain - 1 :]
        able = np.flatnonzero(hi - lo < window)
        chained, lo, hi = chained[able], lo[able], hi[able]
        starts_below = np.cumsum(np.bincount(lo, minlength=size))
        ends_up_to = np.cumsum(np.bincount(hi, minlength=size))
        a = slot[open_]
        first = starts_below[a - 1]
        inside = ends_up_to[a + (window - 1)] - first
        fits = inside > 0
        chosen = _leftmost_least(chained, first[fits], inside[fits])
        key[open_[fits]] = chained[chosen]
        place[open_[fits]] = able[chosen] * 2 + (chain == CHAIN)
        open_ = open_[~fits]
        if not len(open_):
            break
    begins = np.ones(total, bool)
    begins[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(begins)
    return text[at], start[at], np.diff(np.append(at, total)), key[at]


def window_fingerprints(w: Words, at: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of the windows that begin at the words ``at`` of the block."""
    n = len(w.hashes)
    base, inverse = 0x9FB21C651E98DF25, pow(0x9FB21C651E98DF25, -1, 1 << 64)
    up, down = np.full(n + 1, base, U), np.full(n + 1, inverse, U)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    out = []
    for words in (w.hashes, mix(w.hashes ^ U(0x5851F42D4C957F2D))):
        run = np.zeros(n + 1, U)
        np.cumsum(words * up[:n], out=run[1:])
        out.append(mix((run[at + window] - run[at]) * down[at]))
    return out[0], out[1]


def _spread(row: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of every start in the runs first .. first + count - 1."""
    total = int(count.sum())
    inner = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(row, count), np.repeat(first, count) + inner


def _candidates(w: Words, column: pa.Array):
    """(text, start) of the candidate windows of a block, in order, each once; ``column`` is list<struct<start, n>>."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    first, count = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in column.flatten().flatten())
    row, start = _spread(np.repeat(np.arange(len(lengths)), lengths), first, count)
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1])  # rows that repeat a doc_id bring its places twice
    return row[new], start[new]


def _first_in_text(row: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Mask of the windows whose fingerprint has not occurred before in the same text."""
    order = np.lexsort((np.arange(len(row)), prints, row))
    first = np.ones(len(row), bool)
    r, p = row[order], prints[order]
    first[order[1:]] = (r[1:] != r[:-1]) | (p[1:] != p[:-1])
    return first


@tidy
def repeated_passages(docs: DataFrame, window: int = WINDOW, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs(doc_id, text)``; with ``carry`` also kept_text and doc.

    kept_sha256 is over the kept words joined by one space. kept_text is the
    text itself where nothing goes, else its kept stretches joined by a line
    break; doc is a struct of the columns named in ``carry``. A null text has no words. Rows with a null doc_id are left whole
    and remove nothing; rows that repeat a doc_id are one document's and do
    not remove each other's words.
    """
    with_text = carry is not None
    row = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc")] if carry else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *row)
    known = docs.where("doc_id IS NOT NULL")

    def keys(batches):
        for b in blocks(batches):
            text, start, n, name = window_keys(words_of(b.column(1)), window)
            yield pa.RecordBatch.from_arrays(
                [signed(name), b.column(0).take(pa.array(text)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                ["name", "doc_id", "start", "n"],
            )

    named = stored(mapped(known.select("doc_id", "text"), keys, "name long, doc_id long, start int, n int"), "names")
    repeated = stored(named.groupBy("name").agg(F.count("*").alias("times")).where("times > 1").select("name"), "repeated")
    places = named.join(repeated, "name").groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("places"))
    places = stored(places, "places")

    def fingerprints(batches):
        for b in blocks(batches):
            w = words_of(b.column(1))
            row, start = _candidates(w, b.column(2))
            one, two = window_fingerprints(w, w.rows[row] + start, window)
            first = _first_in_text(row, one)
            yield pa.RecordBatch.from_arrays([signed(one[first]), signed(two[first]), b.column(0).take(pa.array(row[first]))], ["one", "two", "doc_id"])

    # the same columns as below, so that both joins read one exchange of the documents
    windows = mapped(known.join(places, "doc_id").select("doc_id", "text", "places", *known.columns[2:]), fingerprints, "one long, two long, doc_id long")
    firsts = windows.groupBy("one", "two").agg(F.min("doc_id").alias("doc_id")).groupBy("doc_id").agg(F.collect_list("one").alias("firsts"))

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    if carry:
        schema += f", doc {docs.schema['doc'].dataType.simpleString()}"

    def cut(batches):
        for b in blocks(batches):
            w = words_of(b.column(1))
            count = w.counts
            gone = np.zeros(len(w.hashes) + 1, np.int64)
            row, start = _candidates(w, b.column(2))
            if len(row):
                at = w.rows[row] + start
                one, _ = window_fingerprints(w, at, window)
                own = b.column(3)
                own_rows = np.repeat(np.arange(len(own)), own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                own_prints = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U)
                # a (text, fingerprint) pair as one number: its row's salt mixed in
                salt = mix(np.arange(1, len(own) + 1, dtype=U))
                stays = np.isin(mix(one ^ salt[row]), mix(own_prints ^ salt[own_rows])) & _first_in_text(row, one)
                np.add.at(gone, at[~stays], 1)
                np.add.at(gone, at[~stays] + window, -1)
            gone = np.cumsum(gone[:-1]) > 0
            removed = np.zeros(len(count), np.int64)
            np.add.at(removed, w.row_of(), gone)
            shas, kept_texts = [], []
            raw = w.data.tobytes()
            for i in range(len(count)):
                text = raw[w.offsets[i] : w.offsets[i + 1]]
                words = text.split()
                if removed[i]:
                    mine = ~gone[w.rows[i] : w.rows[i + 1]]
                    if with_text:
                        edge = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
                        a, z = edge[::2] + w.rows[i], edge[1::2] + w.rows[i] - 1
                        text = b"\n".join(raw[w.starts[p] : w.ends[q]] for p, q in zip(a, z, strict=True))
                    words = list(compress(words, mine.tolist()))
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
                kept_texts.append(text.decode("utf-8", "replace") if with_text else "")
            columns = [b.column(0), pa.array(count), pa.array(removed), pa.array(shas)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array(kept_texts, pa.string()))
                names.append("kept_text")
            if carry:
                columns.append(b.column(4))
                names.append("doc")
            yield pa.RecordBatch.from_arrays(columns, names)

    none = "CAST(NULL AS array<struct<start: int, n: int>>) AS places", "CAST(NULL AS array<bigint>) AS firsts"
    marked = known.join(places, "doc_id", "left").join(firsts, "doc_id", "left").select("doc_id", "text", "places", "firsts", *docs.columns[2:])
    nameless = docs.where("doc_id IS NULL").selectExpr("doc_id", "text", *none, *docs.columns[2:])
    return stored(mapped(marked, cut, schema).union(mapped(nameless, cut, schema)), "passages")
