"""Vectorised word access for Arrow text batches (numpy, no per-word Python).

Words are the maximal runs of bytes outside 0x20 and 0x09-0x0D of the UTF-8
text, i.e. ``[^\\x20\\x09-\\x0D]+``. A word's 64-bit hash depends on its bytes
only (never on the process, the batch or the machine), so hashes computed by
different tasks can be compared. Null texts read as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BLOCK_BYTES = 1 << 20  # text bytes handled at once by a task (one longer text makes a block of its own)
WORD_REGEX = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = {"n": 0}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (new array)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=U) * U(_BASE))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n + 1:
        size = max(n + 1, BLOCK_BYTES + 1)
        up, down = np.full(size, _BASE, U), np.full(size, _BASE_INVERSE, U)
        up[0] = down[0] = 1
        tables = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > 8 * BLOCK_BYTES:  # one very long text: do not hold its tables for the rest of the task
            return tables
        _powers.update(n=size, up=tables[0], down=tables[1])
    return _powers["up"], _powers["down"]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string array; null rows are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, width)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def texts_of(texts: pa.Array) -> list[str]:
    """The texts as Python strings, null as empty; bytes that are no UTF-8 read as U+FFFD."""
    try:
        return [t or "" for t in texts.to_pylist()]
    except UnicodeDecodeError:
        return [(t or b"").decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist()]


@dataclass
class Words:
    """Words of a block of texts: byte ``starts``/``ends``, 64-bit ``hashes``, and ``rows[i]:rows[i + 1]`` as the words of text i."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), self.counts)


def words_of(texts: pa.Array, lower: bool = False, hashed: bool = True) -> Words:
    data, off = text_bytes(texts)
    if lower:
        data = LOWER[data]
    n = len(data)
    if n == 0:
        e = np.zeros(0, np.int64)
        return Words(data, off, e, e, np.zeros(len(off), np.int64), np.zeros(0, U))
    space = _SPACE[data]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    filled = off[:-1][off[:-1] < off[1:]]
    before[filled] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = before[1:]
    solid = ~space
    starts = np.flatnonzero(solid & before)
    # a word ends where the next byte is a space or begins another text
    after[:-1] = space[1:]
    after[filled[1:] - 1] = True
    ends = np.flatnonzero(solid & after) + 1
    rows = np.searchsorted(starts, off)
    if not hashed:
        return Words(data, off, starts, ends, rows, np.zeros(0, U))
    up, down = _power_tables(n)
    run = np.empty(n + 1, U)
    run[0] = 0
    np.cumsum(_BYTE_CODE[data] * up[:n], out=run[1:])
    return Words(data, off, starts, ends, rows, mix((run[ends] - run[starts]) * down[starts]))


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``limit`` bytes (at least one row each)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, off = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < n:
            to = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
            to = min(n, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words (by position; the caller masks text borders)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, U)
    out = np.full(size, U(n))
    for k in range(n):
        out *= U(0xD6E8FEB86659FD93)
        out += hashes[k : k + size]
        out ^= out >> U(32)
    return mix(out)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def list_column(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), values)
