"""Language identification in two steps: the family, then the language within it.

A text's features are the relative frequencies of its hashed byte pairs and
triples (letters in lower case, everything else ASCII as a blank). Linear
support vector machines, one per family, decide the language family; within
it, one machine for each pair of its languages votes (one against one). All
are trained by stochastic subgradient descent on a bounded, balanced sample
of labelled rows. Since the features are linear in the counts, a text is
scored by summing per-position weights; only the sums leave the numpy loop.

lang, source and doc_id are no inputs of a prediction.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import held_out
from .store import in_share, mapped, small_batches, stored, tidy
from .words import LOWER, blocks, text_bytes

UNDETERMINED = "und"
#: With more distinct lang values than this the sample's shares are joined by a shuffle.
MAX_BROADCAST_LANGS = 10_000

# Language codes by family; a code not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("an", "ast", "ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro", "rm", "sc", "scn"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "hsb", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "ug", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "sa", "si", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("am", "ar", "he", "mt", "ti"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "austronesian": ("fil", "id", "jv", "mg", "mi", "ms", "su", "tl"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"only {lang}")


@dataclass(frozen=True)
class LangParams:
    bits: int = 12  # slots per n-gram order
    sample_rows: int = 2400  # labelled rows the machines are fitted on, about; shared evenly by the languages
    epochs: int = 40
    batch: int = 32
    regular: float = 1e-4
    steepness: float = 4.0  # of the logistic curve that turns a margin into a score
    seed: int = 11


_PLAIN = LOWER.copy()
_PLAIN[:128][~(((np.arange(128) >= 97) & (np.arange(128) <= 122)) | ((np.arange(128) >= 65) & (np.arange(128) <= 90)))] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[97:123] = True


def plain_bytes(data: np.ndarray) -> np.ndarray:
    """Letters in lower case (ASCII and the Latin-1 range), other ASCII as blanks."""
    out = _PLAIN[data]
    if len(out) > 1:
        capital = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][capital] += 32
    return out


def slots_of(plain: np.ndarray, bits: int) -> list[np.ndarray]:
    """Slot of the pair and of the triple that begin at each byte (the last ones read blanks behind the end)."""
    x = np.concatenate([plain, np.full(2, 32, np.uint8)]).astype(np.uint32)
    two = x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA6B)
    three = two[:-1] * np.uint32(0xC2B2AE35) + x[2:] * np.uint32(0x27D4EB2F)
    out = []
    for h, start in ((two[:-1], 0), (three, 1 << bits)):
        h = h ^ (h >> np.uint32(15))
        h *= np.uint32(0x2C1B3C6D)
        out.append((h >> np.uint32(32 - bits)).astype(np.int32) + np.int32(start))
    return out


def frequencies(texts: pa.Array, bits: int) -> np.ndarray:
    """(texts x 2^(bits + 1)) relative frequencies."""
    data, off = text_bytes(texts)
    out = np.zeros((len(off) - 1, 2 << bits), np.float32)
    for i in range(len(out)):
        if off[i + 1] > off[i]:
            own = plain_bytes(data[off[i] : off[i + 1]])
            for slots in slots_of(own, bits):
                out[i] += np.bincount(slots, minlength=2 << bits)
            out[i] /= len(own)
    return out


def fit_svm(x: np.ndarray, rows: np.ndarray, y: np.ndarray, scale: np.float32, p: LangParams) -> tuple[np.ndarray, float]:
    """Linear machine on ``scale * x[rows]`` for y in {-1, 1}: hinge loss, both sides weighted alike, averaged weights of the last half."""
    rng = np.random.default_rng(p.seed)
    side = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    mean, mean_b, steps, t = np.zeros(x.shape[1], np.float64), 0.0, 0, 0
    rounds = p.epochs * (1 + len(y) // p.batch)
    for _ in range(p.epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), p.batch):
            i = order[at : at + p.batch]
            rate = 0.5 / (1 + 5 * t / rounds)
            some = x[rows[i]] * scale
            off = (y[i] * (some @ w + b) < 1) * side[i] * y[i] / len(i)
            w += np.float32(rate) * (some.T @ off.astype(np.float32) - np.float32(p.regular) * w)
            b += rate * float(off.sum())
            t += 1
            if t > rounds // 2:
                mean += w
                mean_b += b
                steps += 1
    return (mean / max(steps, 1)).astype(np.float32), mean_b / max(steps, 1)


@dataclass
class LangModel:
    langs: list[str]
    families: list[str]
    weights: np.ndarray  # slots x machines: one per family, then one per pair
    bias: np.ndarray
    pairs: list[tuple[int, int]] = field(default_factory=list)  # languages of the pair machines
    p: LangParams = LangParams()

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        data, off = text_bytes(texts)
        n, machines = len(off) - 1, len(self.bias)
        size = np.diff(off)
        margin = np.zeros((n, machines))
        full = np.flatnonzero(size)
        lettered = np.zeros(n, bool)
        if len(full) and machines:
            plain = plain_bytes(data)
            first = off[:-1][full]
            # n-grams do not read across a text border: blank what follows a text's last byte
            slots = slots_of(plain, self.p.bits)
            for i in full[off[1:][full] < len(data)]:
                end = off[i + 1]
                tail = slots_of(plain[max(off[i], end - 2) : end], self.p.bits)
                for s, t in zip(slots, tail, strict=True):
                    s[end - len(t) : end] = t
            for m in range(machines):
                column = np.ascontiguousarray(self.weights[:, m])
                value = column[slots[0]] + column[slots[1]]
                margin[full, m] = np.add.reduceat(value, first, dtype=np.float64) / size[full]
            margin[full] += self.bias
            lettered[full] = np.add.reduceat(_ASCII_LETTER[plain], first, dtype=np.int64) > 0
        for i in full[~lettered[full]]:
            lettered[i] = any(c.isalpha() for c in bytes(data[off[i] : off[i + 1]]).decode("utf-8", "replace"))
        return self._decide(margin, lettered)

    def _decide(self, margin: np.ndarray, lettered: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(margin)
        score = np.zeros(n)
        if not self.langs:
            return [UNDETERMINED] * n, score
        family_margin = margin[:, : len(self.families)]
        best = family_margin.argmax(axis=1)
        if len(self.families) > 1:
            ranked = np.sort(family_margin, axis=1)
            lead = (ranked[:, -1] - ranked[:, -2]) / 2
        else:
            lead = np.full(n, 1.0)
        votes = np.full((n, len(self.langs)), -np.inf)
        for k, lang in enumerate(self.langs):
            votes[best == self.families.index(family_of(lang)), k] = 0
        weakest = np.full((n, len(self.langs)), np.inf)
        for m, (a, b) in enumerate(self.pairs):
            value = margin[:, len(self.families) + m]
            for lang, own in ((a, value), (b, -value)):
                votes[:, lang] += (own > 0) + np.tanh(own) * 1e-3  # ties go by the margins
                weakest[:, lang] = np.minimum(weakest[:, lang], own)
        chosen = votes.argmax(axis=1)
        within = weakest[np.arange(n), chosen]
        score = 1 / (1 + np.exp(-self.p.steepness * np.clip(lead, -20, 20)))
        score = score * np.where(np.isinf(within), 1.0, 1 / (1 + np.exp(-self.p.steepness * np.clip(within, -20, 20))))
        out = [self.langs[k] if ok else UNDETERMINED for k, ok in zip(chosen, lettered, strict=True)]
        return out, np.where(lettered, score, 0.0)


def fit_languages(x: np.ndarray, langs: list[str], p: LangParams) -> LangModel:
    """Machines for the sample ``x`` (frequencies; scaled in place) with its languages."""
    if not langs:
        return LangModel([], [], np.zeros((x.shape[1], 0), np.float32), np.zeros(0), [], p)
    known = sorted(set(langs))
    label = np.array([known.index(v) for v in langs], np.int64)
    families = sorted({family_of(v) for v in known})
    family = np.array([families.index(family_of(v)) for v in known], np.int64)
    mean = x.mean(axis=0, dtype=np.float64)
    spread = np.sqrt(np.maximum(np.einsum("ij,ij->j", x, x) / len(x) - mean**2, 0)) + 1e-4  # rare slots are not blown up
    x /= spread.astype(np.float32)
    norms = np.einsum("ij,ij->i", x, x)
    columns, bias, pairs = [], [], []

    def add(rows: np.ndarray, y: np.ndarray) -> None:
        scale = np.float32(1 / np.sqrt(norms[rows].mean() + 1e-9))
        w, b = fit_svm(x, rows, y, scale, p)
        columns.append(w * scale / spread)
        bias.append(b)

    everything = np.arange(len(label))
    for f in range(len(families)):
        if len(families) > 1:
            add(everything, np.where(family[label] == f, 1.0, -1.0))
        else:
            columns.append(np.zeros(x.shape[1], np.float32))
            bias.append(0.0)
    for f in range(len(families)):
        for a, b in combinations(np.flatnonzero(family == f), 2):
            rows = np.flatnonzero((label == a) | (label == b))
            add(rows, np.where(label[rows] == a, 1.0, -1.0))
            pairs.append((int(a), int(b)))
    weights = np.stack(columns, axis=1).astype(np.float32) if columns else np.zeros((x.shape[1], 0), np.float32)
    return LangModel(known, families, weights, np.array(bias), pairs, p)


def train_languages(docs: DataFrame, p: LangParams = LangParams()) -> LangModel:
    """Fit on about ``sample_rows`` labelled texts outside the held-out fold, evenly by language."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (F.col("text") != "") & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 3, 1))
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    langs = counts.count()
    per_lang = F.lit(p.sample_rows / max(1, langs))
    shares = counts.select("lang", F.least(F.lit(1.0), per_lang / F.col("n")).alias("share"))
    if langs <= MAX_BROADCAST_LANGS:  # one row a language: the texts stay where they are
        shares = F.broadcast(shares)
    chosen = rows.join(shares, "lang").where(in_share(F.xxhash64("doc_id", F.lit(p.seed)), F.col("share")))

    def vectors(batches):
        for b in blocks(batches):
            x = (frequencies(b.column(1), p.bits) * 1000).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x]), b.column(2)], ["doc_id", "x", "lang"])

    with small_batches(docs.sparkSession):
        got = mapped(chosen.select("doc_id", "text", "lang"), vectors, "doc_id long, x binary, lang string").collect()
    got.sort(key=lambda r: (r["doc_id"], r["lang"], bytes(r["x"])))
    x = np.empty((len(got), 2 << p.bits), np.float32)
    langs = [r["lang"] for r in got]
    for i in range(len(got)):
        x[i] = np.frombuffer(got[i]["x"], np.float16)
        got[i] = None  # each row is held once
    x /= 1000
    return fit_languages(x, langs, p)


@tidy
def identified(docs: DataFrame, p: LangParams = LangParams()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs(doc_id, text, lang)``.

    A null text or one without any letter is ``und`` with score 0, as is
    everything when no row is labelled. A null doc_id is not held out.
    """
    model = docs.sparkSession.sparkContext.broadcast(train_languages(docs, p))

    def run(batches):
        for b in blocks(batches):
            lang, score = model.value.predict(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(mapped(texts, run, "doc_id long, lang_pred string, score double"), "languages")
    return found.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")


@tidy
def accepted(docs: DataFrame, least_score: float = 0.4, p: LangParams = LangParams()) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text has a language that is told with at least ``least_score``.

    Texts without letters (``und``) and texts between languages go. Rows are
    judged where they are read; nothing is shuffled.
    """
    model = docs.sparkSession.sparkContext.broadcast(train_languages(docs, p))
    names = docs.columns

    def run(batches):
        for b in blocks(batches):
            texts = b.column(names.index("text"))
            lang, score = model.value.predict(texts)
            keep = [x != UNDETERMINED and s >= least_score for x, s in zip(lang, score, strict=True)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return stored(mapped(docs, run, docs.schema), "accepted")
