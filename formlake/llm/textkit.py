"""Vectorised text helpers used inside Spark tasks (numpy over Arrow buffers).

Texts arrive as Arrow string columns; the helpers work on the column's byte buffer, so
the cost per byte is a handful of numpy passes and no Python object is made per word.
Every helper reads whole texts. Memory is bounded by handling documents in chunks of
about ``CHUNK_BYTES`` (a longer document forms a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# one fixed pseudo-random 64-bit value per byte, an odd base and its inverse modulo 2**64
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as the signed longs Spark stores."""
    return x.view(np.int64)


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        column = column.fill_null(empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = int(offsets[0]) if len(offsets) else 0
    return data[start : int(offsets[-1]) if len(offsets) else 0], offsets - start


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Document ranges [i, j) holding about ``limit`` bytes each, never none."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``, so what a task makes of a
    batch stays small however many long texts follow each other."""
    for batch in batches:
        for i, j in chunks(column_bytes(batch.column(column))[1], limit):
            yield batch.slice(i, j - i)


def word_spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each document plus the total) of the runs of bytes not marked in
    ``outside``; by default of words ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~outside[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


class Rolling:
    """Hashes of any byte ranges of one buffer, equal for equal bytes wherever they stand."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.full(n, _BASE, dtype=np.uint64)
        power[:1] = 1
        np.cumprod(power, out=power)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data] * power, out=self.sums[1:])
        self.back = np.full(n + 1, _INVERSE, dtype=np.uint64)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word."""
    return Rolling(data)(starts, ends) if len(starts) else np.zeros(0, np.uint64)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash per shingle of ``size`` lower-cased words, offsets by document).

    A document with fewer words gives its whole sequence as one shingle; one without
    words gives none.
    """
    data = _LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    counts = np.diff(first)
    n = len(words)
    if n >= size:
        code = words[: n - size + 1].copy()
        for k in range(1, size):
            code = code * _U(_BASE) + words[k : n - size + 1 + k]
        code = mix(code)
    else:
        code = np.zeros(0, np.uint64)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_offsets = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(out_offsets[-1], dtype=np.uint64)
    last = first[1:] - size  # last word index at which a full shingle of the document starts
    doc_of = np.repeat(np.arange(len(counts)), counts)[: len(code)]
    keep = np.arange(len(code)) <= last[doc_of] if len(code) else np.zeros(0, bool)
    full = np.repeat(counts >= size, made)
    out[full] = code[keep]
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        value = _U(0x5851F42D4C957F2D) + _U(counts[d])
        with np.errstate(over="ignore"):
            for w in words[first[d] : first[d + 1]]:
                value = value * _U(_BASE) + w
        out[out_offsets[d]] = mix(np.array([value], dtype=np.uint64))[0]
    return out, out_offsets


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(document index, sorted distinct shingle hashes) for every document."""
    for i, j in chunks(offsets):
        own = offsets[i : j + 1] - offsets[i]
        hashes, where = shingle_hashes(data[offsets[i] : offsets[j]], own, size)
        for d in range(j - i):
            part = np.sort(hashes[where[d] : where[d + 1]])
            if len(part) > 1:
                part = part[np.concatenate([[True], part[1:] != part[:-1]])]
            yield i + d, part
