"""Array helpers over Arrow text columns, shared by the operators; they run inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=U64) | U64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# White space, control characters and ASCII punctuation: what separates words of letters and digits.
IS_MARK = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Every byte but the continuation bytes of UTF-8 starts a character.
STARTS_CHAR = np.array([b & 0xC0 != 0x80 for b in range(256)])

_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


class RangeHash:
    """64-bit hashes of any byte ranges of one buffer, from prefix sums."""

    def __init__(self, buf: np.ndarray):
        self.power, self.inverse = powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, U64)
        np.cumsum(BYTE_CODE[buf] * self.power[:len(buf)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and n + 1 offsets. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or not column.buffers()[2]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    buf = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return buf, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into row ranges of about max_bytes of text (one text at least), so that a task's arrays stay small."""
    for batch in batches:
        sizes = np.diff(text_buffer(batch.column(column))[1])
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text (or runs without other separators): byte ranges, the number
    of the text, and counts per text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray = IS_SPACE):
        self.buf, self.offsets = buf, offsets
        inside = ~separators[buf]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = offsets[:-1][offsets[:-1] < len(buf)]
        first[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends = offsets[1:][offsets[1:] > 0] - 1
        last[ends] = inside[ends]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside each text and their n + 1 bounds.

    A text with fewer words gives its whole sequence as one shingle; a text without words gives none.
    """
    counts = np.diff(bounds)
    n = len(hashes)
    out = np.zeros(n, U64)
    length = np.minimum(size, np.repeat(bounds[1:], counts) - np.arange(n))
    for k in range(size):
        live = np.flatnonzero(length > k)
        out[live] = out[live] * U64(0x9FB21C651E98DF25) + hashes[live + k]
    out = mix(out + length.astype(U64))
    full = np.maximum(counts - size + 1, np.minimum(counts, 1))
    place = np.arange(n) - np.repeat(bounds[:-1], counts)
    keep = place < np.repeat(full, counts)
    return out[keep], np.concatenate([[0], np.cumsum(full)])


def doc_reduce(ufunc: np.ufunc, values: np.ndarray, bounds: np.ndarray, empty) -> np.ndarray:
    """ufunc over the values of each text; ``empty`` where a text has none."""
    out = np.full(len(bounds) - 1, empty, values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = ufunc.reduceat(values, bounds[:-1][full])
    return out


def binary_column(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())
