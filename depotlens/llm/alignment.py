"""Alignment of two tokenizers over a corpus: which ids of A and B stand for the same bytes, and how often.

A is a byte-level BPE (a ``tokenizers`` JSON file), B a piece BPE with byte
fallback (a ``sentencepiece`` model). A encodes " " + text, B the text (B puts
the space itself), so both cover the same bytes. Byte offsets where a token of
both ends cut the two sequences into groups; every A token of a group is linked
with every B token of it.

The identity-map fast path: an array gives for each A id the B id of the same
bytes. Most groups hold one such pair; they are counted in a vector as long as
A's vocabulary (a pair counts once a document) that each task adds up alone.
Only the pairs of the other groups are shuffled, once per block of documents
and not per document: a block's dictionary lists its distinct pairs, documents
refer to places in it. Corpus counts are joined to the dictionaries, and a
block's documents meet its dictionary's counts in one group whose size is set
by ``block_bytes``. What the driver sees is two vectors of A's vocabulary.

Texts are cut for encoding only between two ASCII letters parted by one space
(neither tokenizer has a token across such a place), so a very long text needs
no memory beyond its ids.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import mapped, small_batches, stored, tidy
from .words import blocks, list_column, texts_of

#: Fixed value: the pattern that splits text before A's merges.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class AlignParams:
    byte_bpe: str = "/opt/tokenizers/byte_bpe_50k.json"
    piece_bpe: str = "/opt/tokenizers/piece_bpe_32k.model"
    block_bytes: int = 8 << 20  # text of the documents that share a dictionary (one longer text makes a block of its own)
    step_bytes: int = 1 << 20  # text aligned at once


CHUNK_CHARS = 1 << 20
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Up to here both engines of A's vocabulary agree on what is a letter, a digit or a space.
_LATIN_END = "ɏ"


def _byte_of_char() -> dict[str, int]:
    """A's printable stand-ins of bytes: visible Latin-1 characters are themselves, the others follow from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers, the bytes of their ids and the identity map."""

    def __init__(self, byte_json: str, piece_model: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given this task its core
        self.any_a = Tokenizer.from_str(byte_json)
        self.any_a.encode_special_tokens = True  # their strings inside texts are plain text
        spec = json.loads(byte_json)
        byte = _byte_of_char()
        special = {t["content"] for t in spec["added_tokens"]}
        ids = {k: i for k, i in spec["model"]["vocab"].items() if k not in special}
        self.a_bytes = [b""] * (1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in ids.items():
            self.a_bytes[i] = bytes(byte[c] for c in token)
        self.latin_a = tiktoken.Encoding("a", pat_str=SPLIT_PATTERN, mergeable_ranks={self.a_bytes[i]: i for i in ids.values()}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        n_b = self.b.get_piece_size()
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(n_b)
        ]
        own = {self.b_bytes[i]: i for i in range(n_b) if self.b.is_byte(i)}
        own |= {self.b_bytes[i]: i for i in range(n_b) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        self.identity = np.array([own.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        # written forms: inside its part of a group, and at the part's end
        self.written = [f"{i}," for i in range(len(self.a_bytes))] + [f"{i}|" for i in range(len(self.a_bytes))]
        self.written += [f"{i}," for i in range(n_b)] + [f"{i};" for i in range(n_b)]

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of A and B, or None if a token sequence does not give back the bytes of " " + text."""
        whole = b" " + text.encode()
        a, b = [], []
        for part in _parts(text):
            if part.isascii() or max(part) <= _LATIN_END:
                a += self.latin_a.encode_ordinary(" " + part)
            else:
                a += self.any_a.encode(" " + part, add_special_tokens=False).ids
            b += self.b.encode(part)
        if b"".join([self.a_bytes[i] for i in a]) != whole or b"".join([self.b_bytes[i] for i in b]) != whole:
            return None
        return a, b


def _parts(text: str) -> list[str]:
    """The text cut at single spaces between ASCII letters, every CHUNK_CHARS characters or more; those spaces are left out (both encoders put one before a part)."""
    out, at = [], 0
    while len(text) - at > CHUNK_CHARS and (cut := _CUT.search(text, at + CHUNK_CHARS)):
        out.append(text[at : cut.start()])
        at = cut.end()
    out.append(text[at:])
    return out


@dataclass
class Aligned:
    """Per text: n_a, n_b, n_groups, n_links, digest of the groups; and (text, pair code, links) of its distinct pairs, by text."""

    numbers: np.ndarray
    digests: list[str]
    owner: np.ndarray
    pair: np.ndarray
    links: np.ndarray


def align(v: Vocabularies, texts: list[str]) -> Aligned:
    """Groups, links and distinct pairs (code a * len(B) + b) of some texts."""
    n = len(texts)
    numbers, digests = np.zeros((4, n), np.int64), [""] * n
    ids_a, ids_b, here = [], [], []
    for k, text in enumerate(texts):
        if text and (got := v.encode(text)):
            here.append(k)
            ids_a.append(np.array(got[0], np.int64))
            ids_b.append(np.array(got[1], np.int64))
    none = np.zeros(0, np.int64)
    if not here:
        return Aligned(numbers, digests, none, none, none)
    count_a, count_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
    a, b = np.concatenate(ids_a), np.concatenate(ids_b)
    end_a, end_b = np.cumsum(v.a_length[a]), np.cumsum(v.b_length[b])
    # a group ends where both sequences end a token; texts end so too, so no group spans two texts
    last_a = np.zeros(len(a), bool)
    last_b = np.zeros(len(b), bool)
    _, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
    last_a[at_a] = last_b[at_b] = True
    groups = len(at_a)
    size_a, size_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    first_a, first_b = at_a - size_a + 1, at_b - size_b + 1
    group_a, group_b = np.repeat(np.arange(groups), size_a), np.repeat(np.arange(groups), size_b)
    text_ends = np.cumsum(count_a) - 1
    groups_to = np.searchsorted(at_a, text_ends) + 1  # groups up to the end of each text
    text_of_group = np.repeat(np.arange(len(here)), np.diff(groups_to, prepend=0))
    numbers[0, here], numbers[1, here] = count_a, count_b
    numbers[2, here] = np.diff(groups_to, prepend=0)
    numbers[3, here] = np.bincount(text_of_group, weights=size_a * size_b, minlength=len(here)).astype(np.int64)

    # the written form: A's part of a group, then B's
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + first_b[group_a]] = a + len(v.a_bytes) * last_a
    order[np.arange(len(b)) + at_a[group_b] + 1] = 2 * len(v.a_bytes) + b + len(v.b_bytes) * last_b
    ends = np.cumsum(count_a + count_b)
    for k, (i, j) in enumerate(zip((ends - count_a - count_b).tolist(), ends.tolist(), strict=True)):
        form = "".join([v.written[x] for x in order[i:j].tolist()])
        digests[here[k]] = hashlib.sha256(form[:-1].encode()).hexdigest()

    # all links of A's tokens with B's tokens of the same group; most groups are one identity pair and need no expansion
    width = len(v.b_bytes)
    per_token = size_b[group_a]
    ids = np.repeat(a, per_token)
    within = np.arange(len(ids)) - np.repeat(np.cumsum(per_token) - per_token, per_token)
    code = ids * width + b[np.repeat(first_b[group_a], per_token) + within]
    owner = np.repeat(text_of_group[group_a], per_token)
    key = (owner.astype(np.uint64) << np.uint64(40)) | code.astype(np.uint64)
    key, links = np.unique(key, return_counts=True)
    owner = (key >> np.uint64(40)).astype(np.int64)
    return Aligned(numbers, digests, np.array(here)[owner], (key & np.uint64((1 << 40) - 1)).astype(np.int64), links)


def _gathered(batches, p: AlignParams):
    """Lists of (document ids, texts): steps of about ``step_bytes``, and None where a block of about ``block_bytes`` ends."""
    held = 0
    for b in blocks(batches, "text", p.step_bytes):
        texts = texts_of(b.column(1))
        yield b.column(0), texts
        held += sum(len(t) for t in texts)
        if held >= p.block_bytes:
            held = 0
            yield None
    yield None


_SCHEMA = (
    "kind int, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "place array<int>, links array<long>, pair_a array<int>, pair_b array<int>, docs array<long>"
)
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]
_DOC, _DICTIONARY, _VECTOR = 0, 1, 2


def _rows(kind: int, n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    types = {"kind": pa.int32(), "groups_sha256": pa.string()}
    lists = {"place": pa.int32(), "links": pa.int64(), "pair_a": pa.int32(), "pair_b": pa.int32(), "docs": pa.int64()}
    made = {"kind": pa.array(np.full(n, kind, np.int32))} | columns
    return pa.RecordBatch.from_arrays([made[c] if c in made else pa.nulls(n, pa.list_(lists[c]) if c in lists else types.get(c, pa.int64())) for c in _NAMES], _NAMES)


def _whole_list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return list_column(pa.array(values, kind), np.array([len(values)]))


def vocabulary_files(p: AlignParams) -> tuple[str, bytes]:
    with open(p.byte_bpe, encoding="utf-8") as f, open(p.piece_bpe, "rb") as g:
        return f.read(), g.read()


_loaded: dict[str, Vocabularies] = {}  # of this process


def _vocabularies(files) -> Vocabularies:
    name, byte_json, piece_model = files.value
    if name not in _loaded:
        _loaded[name] = Vocabularies(byte_json, piece_model)
    return _loaded[name]


def _first_pass(docs: DataFrame, files, p: AlignParams) -> DataFrame:
    """Documents with places in their block's dictionary, the dictionaries, and each task's vector of identity pairs."""

    def run(batches):
        v = _vocabularies(files)
        width = len(v.b_bytes)
        vector = np.zeros(len(v.a_bytes), np.int64)
        block, steps = TaskContext.get().partitionId() << 32, []
        for step in _gathered(batches, p):
            if step is not None:
                steps.append((step[0], align(v, step[1])))
                continue
            if not steps:
                continue
            pairs = np.concatenate([s.pair for _, s in steps])
            a, b = pairs // width, pairs % width
            same = v.identity[a] == b
            vector += np.bincount(a[same], minlength=len(vector))
            place = -1 - a  # identity pairs stand for themselves
            known, place[~same], n_docs = np.unique(pairs[~same], return_inverse=True, return_counts=True)
            at = 0
            for ids, s in steps:
                to = at + len(s.pair)
                per_doc = np.bincount(s.owner, minlength=len(ids))
                yield _rows(_DOC, len(ids), {
                    "block": pa.array(np.full(len(ids), block)), "doc_id": ids,
                    **{c: pa.array(s.numbers[k]) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                    "groups_sha256": pa.array(s.digests, pa.string()),
                    "place": list_column(pa.array(place[at:to], pa.int32()), per_doc), "links": list_column(pa.array(s.links), per_doc),
                })
                at = to
            yield _rows(_DICTIONARY, 1, {
                "block": pa.array([block], pa.int64()), "pair_a": _whole_list(known // width, pa.int32()),
                "pair_b": _whole_list(known % width, pa.int32()), "docs": _whole_list(n_docs, pa.int64()),
            })
            block, steps = block + 1, []
        held = np.flatnonzero(vector)
        yield _rows(_VECTOR, 1, {"pair_a": _whole_list(held, pa.int32()), "docs": _whole_list(vector[held], pa.int64())})

    return mapped(docs, run, _SCHEMA)


def _by_a_id(rows: DataFrame, size: int) -> np.ndarray:
    """A vector of A's vocabulary from rows (a, n), one row an id at most."""
    got = rows.toArrow()
    out = np.zeros(size, np.int64)
    out[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return out


@tidy
def aligned(docs: DataFrame, p: AlignParams = AlignParams()) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs(doc_id, text)``.

    An id pair's count is the number of documents (rows) that hold it linked;
    n_best counts the links whose pair has the highest count of its A id (ties
    included), count_sum adds the counts up over all links. Texts that are
    null, empty, or that one of the tokenizers does not give back byte for byte
    have no tokens: zeros and ''. Rows that repeat a doc_id, or have none, are
    documents of their own. Bytes that are no UTF-8 read as U+FFFD.
    """
    spark = docs.sparkSession
    byte_json, piece_model = vocabulary_files(p)
    name = hashlib.sha256(byte_json.encode() + piece_model).hexdigest()
    if len(byte_json) + len(piece_model) > 256 << 20:
        raise ValueError("vocabulary files over 256 MB are not sent to the tasks")
    files = spark.sparkContext.broadcast((name, byte_json, piece_model))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = stored(_first_pass(docs, files, p), "aligned")

    zipped = F.arrays_zip("pair_a", "pair_b", "docs")
    pairs = first.where(F.col("kind") == _DICTIONARY).select("block", F.posexplode(zipped).alias("place", "x"))
    pairs = pairs.select("block", "place", F.col("x.pair_a").alias("a"), F.col("x.pair_b").alias("b"), F.col("x.docs").alias("n"))
    counts = stored(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair_counts")
    vector = first.where(F.col("kind") == _VECTOR).select(F.explode(F.arrays_zip("pair_a", "docs")).alias("x"))
    vector = vector.groupBy(F.col("x.pair_a").alias("a")).agg(F.sum("x.docs").alias("n"))
    size = 1 << 20  # ids of A, at most; the arrays are cut to the highest id below
    identity = _by_a_id(vector, size)
    best = np.maximum(identity, _by_a_id(counts.groupBy("a").agg(F.max("count").alias("n")), size))
    top = int(np.flatnonzero(best)[-1]) + 1 if best.any() else 1
    shared = spark.sparkContext.broadcast((identity[:top], best[:top]))

    answers = pairs.select("block", "place", "a", "b").join(counts, ["a", "b"]).select(F.col("block").alias("of_block"), "place", "a", "count")
    texts = first.where(F.col("kind") == _DOC).select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "links")

    def meet(rows: pa.Table, known: pa.Table) -> pa.Table:
        identity, best = shared.value
        n = known.num_rows
        count, is_best = np.zeros(n, np.int64), np.zeros(n, bool)
        at = known["place"].to_numpy()
        count[at] = known["count"].to_numpy()
        is_best[at] = known["count"].to_numpy() == best[known["a"].to_numpy()]
        lists = rows["place"].combine_chunks()
        place, links = lists.flatten().to_numpy(), rows["links"].combine_chunks().flatten().to_numpy()
        same = place < 0
        a = -1 - place[same]
        per_pair, top_pair = np.empty(len(place), np.int64), np.empty(len(place), bool)
        per_pair[same], per_pair[~same] = identity[a], count[place[~same]]
        top_pair[same], top_pair[~same] = identity[a] == best[a], is_best[place[~same]]

        to = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])

        def added(x: np.ndarray) -> pa.Array:
            run = np.concatenate([np.zeros(1, np.int64), np.cumsum(x)])
            return pa.array(run[to[1:]] - run[to[:-1]])

        columns = [rows[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table([*columns, added(links * top_pair), added(links * per_pair), rows["groups_sha256"]], names=_RESULT_NAMES)

    with small_batches(spark):
        result = texts.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(meet, _RESULT)
        return stored(result, "alignment")


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_RESULT_NAMES = [x.split()[0] for x in _RESULT.split(", ")]
