"""Quality classifier: hashed word n-gram logistic regression trained by FTRL.

Features of a text are the relative frequencies of its hashed n-grams: words,
word pairs, and 1 to 3 consecutive word shapes (letter case, digits, length
class and closing characters), so that words never seen in training still
show what kind of text they stand in. Training follows the regularised leader
(FTRL-proximal: per-coordinate learning rates, L1 and L2) over a bounded
sample of labelled rows; it runs on the driver on vectors whose number and
size are parameters. Scoring is a sparse dot product per text inside the
tasks: the weights of all n-grams are looked up and summed.

labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import in_share, mapped, small_batches, stored, tidy
from .words import U, Words, blocks, mix, ngram_hashes, words_of


@dataclass(frozen=True)
class QualityParams:
    bits: int = 18  # n-grams are hashed to 2^bits weights
    sample_rows: int = 4000  # labelled rows the model is fitted on, about
    epochs: int = 4
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-3
    threshold: float = 0.3
    seed: int = 7


_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int32)
_DIGIT[48:58] = 1
_LETTER = np.zeros(256, np.int32)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1


def _per_word(flags: np.ndarray, w: Words) -> np.ndarray:
    run = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=run[1:])
    return run[w.ends] - run[w.starts]


def word_shapes(w: Words) -> np.ndarray:
    """One number per word for its case, digits, length class and closing characters."""
    if not len(w.starts):
        return np.zeros(0, U)
    upper, digits, letters = (_per_word(t[w.data], w) for t in (_UPPER, _DIGIT, _LETTER))
    size = w.ends - w.starts
    last = w.data[w.ends - 1]
    closing = np.where(_LETTER[last] + _DIGIT[last] > 0, 0, last).astype(np.int64)
    before = w.data[np.maximum(w.ends - 2, w.starts)]
    doubled = (closing > 0) & (before == last) & (size > 1)
    first_upper = _UPPER[w.data[w.starts]]
    case = np.where(upper >= 2, 2, first_upper)
    length = np.minimum(size // 4, 7)
    shape = closing * 2 + doubled
    for part, room in ((case, 3), (np.minimum(digits, 2), 3), (np.minimum(size - letters - digits, 3), 4), (length, 8)):
        shape = shape * room + part
    return mix(shape.astype(U) + U(1))


def feature_slots(w: Words, bits: int):
    """(n-gram slots, first word of each) per feature kind, n-grams that cross a text border left out."""
    shapes = word_shapes(w)
    row = w.row_of()
    for kind, (base, n) in enumerate(((w.hashes, 1), (w.hashes, 2), (shapes, 1), (shapes, 2), (shapes, 3))):
        grams = ngram_hashes(base, n) ^ U(0x632BE59BD9B4E019 * (kind + 1) % (1 << 64))
        at = np.arange(len(grams))
        if n > 1 and len(grams):
            at = at[row[: len(grams)] == row[n - 1 :]]
        yield (mix(grams[at]) >> U(64 - bits)).astype(np.int64), at


def text_margins(w: Words, weights: np.ndarray, bits: int) -> np.ndarray:
    """Dot product of each text's n-gram frequencies with the weights."""
    texts = len(w.rows) - 1
    total = np.zeros(texts)
    row = w.row_of()
    for slots, at in feature_slots(w, bits):
        total += np.bincount(row[at], weights=weights[slots], minlength=texts)
    return total / np.maximum(w.counts, 1)


def text_vectors(w: Words, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slots, frequencies) of each text."""
    row = w.row_of()
    keys = np.concatenate([(row[at] << bits) | slots for slots, at in feature_slots(w, bits)])
    keys, count = np.unique(keys, return_counts=True)
    text, slot = keys >> bits, keys & ((1 << bits) - 1)
    cut = np.searchsorted(text, np.arange(len(w.rows)))
    words = np.maximum(w.counts, 1)
    return [(slot[a:z], count[a:z] / words[i]) for i, (a, z) in enumerate(zip(cut[:-1], cut[1:], strict=True))]


@dataclass
class QualityModel:
    weights: np.ndarray  # 2^bits
    bias: float
    bits: int

    def scores(self, texts: pa.Array) -> np.ndarray:
        w = words_of(texts)
        return 1 / (1 + np.exp(-(text_margins(w, self.weights, self.bits) + self.bias)))


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, p: QualityParams) -> QualityModel:
    """FTRL-proximal over the rows, in an order fixed by the seed. Without rows the model scores 0.5."""
    size = 1 << p.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last place is the bias

    def weights_at(i):
        zi = z[i]
        out = -(zi - np.sign(zi) * p.l1) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2)
        return np.where(np.abs(zi) <= p.l1, 0.0, out)

    rng = np.random.default_rng(p.seed)
    for _ in range(p.epochs):
        for r in rng.permutation(len(rows)):
            slot, value = rows[r]
            slot, value = np.append(slot, size), np.append(value, 0.5)
            w = weights_at(slot)
            error = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30))) - labels[r]
            g = error * value
            grown = n[slot] + g * g
            z[slot] += g - (np.sqrt(grown) - np.sqrt(n[slot])) / p.alpha * w
            n[slot] = grown
    w = weights_at(np.arange(size + 1))
    return QualityModel(w[:-1].astype(np.float32), float(w[-1] * 0.5), p.bits)


def held_out(doc_id, modulus: int, rest: int):
    """crc32 of the doc_id as text, modulo ``modulus``, is ``rest``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def train_quality(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams()) -> QualityModel:
    """Fit on about ``sample_rows`` labelled documents outside the held-out fold (chosen by a hash of their id).

    A doc_id that is labelled both 0 and 1 is left out; one labelled alike several times counts once.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), 5, 0) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")
    share = min(1.0, p.sample_rows / max(1, marked.count()))
    chosen = marked.where(in_share(F.xxhash64("doc_id", F.lit(p.seed)), share))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen), "doc_id")  # about sample_rows rows

    def vectors(batches):
        for b in blocks(batches):
            rows = text_vectors(words_of(b.column(1)), p.bits)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0].astype(np.int32).tobytes() for r in rows]), pa.array([r[1].astype(np.float32).tobytes() for r in rows]), b.column(2)],
                ["doc_id", "slots", "frequencies", "quality"],
            )

    with small_batches(docs.sparkSession):
        rows = mapped(texts.select("doc_id", "text", "quality"), vectors, "doc_id long, slots binary, frequencies binary, quality int").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["slots"])))
    vectors_ = [(np.frombuffer(r["slots"], np.int32).astype(np.int64), np.frombuffer(r["frequencies"], np.float32).astype(np.float64)) for r in rows]
    return fit_ftrl(vectors_, np.array([r["quality"] for r in rows], np.float64), p)


@tidy
def scored(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text)``.

    Null and empty texts have no n-grams and score by the bias alone. A null
    doc_id is scored like any other and is not held out.
    """
    model = docs.sparkSession.sparkContext.broadcast(train_quality(docs, labels, p))  # 2^bits floats

    def run(batches):
        for b in blocks(batches):
            score = model.value.scores(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(mapped(texts, run, "doc_id long, score double"), "quality")
    return found.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted")
    )
