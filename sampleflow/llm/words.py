"""Words of a batch of texts as numpy arrays: places, counts and 64-bit hashes, without a loop over rows.

A word is a run of ``[^\\x20\\x09-\\x0D]``. Those separators are single bytes in UTF-8,
so words are cut on bytes. Hashes are equal for equal words in every task and run.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Texts are handled in pieces of about so many bytes, so that the arrays of a piece stay small.
PIECE_BYTES = 1 << 19
MAX_PIECE_ROWS = 60_000

_random = np.random.default_rng(20240229)
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(base: int, n: int, inverse: bool = False) -> np.ndarray:
    have = _powers.get((base, inverse))
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length()) if n > 1 else 1 << 16
        value = pow(base, -1, 2**64) if inverse else base
        have = np.full(size, value, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 8 << 20:
            _powers[base, inverse] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """A hash of each ``values[start:end]``, by prefix sums of a polynomial modulo 2^64."""
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * _power(base, len(values)), out=sums[1:])
    found = (sums[ends] - sums[starts]) * _power(base, len(values) + 1, True)[starts]
    return mix(found + (ends - starts).astype(U) * U(base))


def window_hashes(values: np.ndarray, size: int, base: int = BASES[0]) -> np.ndarray:
    """A hash of each run of ``size`` neighbours (also across documents; see ``window_starts``)."""
    if len(values) < size:
        return np.zeros(0, U)
    starts = np.arange(len(values) - size + 1)
    return span_hashes(values, starts, starts + size, base)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets of each (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of some texts, in order: ``starts``, ``ends`` (bytes in ``data``), ``doc`` (row), ``counts`` and ``first`` (by row)."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        data, self.offsets = bytes_of(texts)
        self.data = LOWER[data] if lower else data
        rows = len(self.offsets) - 1
        inside = IS_WORD[self.data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        full = self.offsets[:-1] < self.offsets[1:]
        heads, tails = self.offsets[:-1][full], self.offsets[1:][full] - 1
        opens[heads] = inside[heads]
        closes[tails] = inside[tails]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.doc = np.searchsorted(self.offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=rows)[:rows] if rows else np.zeros(0, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))

    def hashes(self) -> np.ndarray:
        return span_hashes(BYTE_VALUES[self.data], self.starts, self.ends)

    def window_starts(self, size: int) -> np.ndarray:
        """Words at which a window of ``size`` words of one document starts."""
        at = np.arange(max(0, len(self.doc) - size + 1))
        return at[self.doc[at] == self.doc[at + size - 1]]


def give_back() -> None:
    """Returns memory that a worker has freed or can make again: it lives on after its task, next to others."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut at rows, into pieces of about ``size`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = bytes_of(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            end = min(max(end, start + 1), start + MAX_PIECE_ROWS, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    give_back()


def sort_by_row(row: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The order by row, then value; rows below 65,536."""
    order = np.argsort(values)
    return order[np.argsort(row[order].astype(np.uint16), kind="stable")]


def digests(high: np.ndarray, low: np.ndarray) -> pa.Array:
    """Two 64-bit numbers as 16 bytes each row."""
    joined = np.empty((len(high), 2), ">u8")
    joined[:, 0], joined[:, 1] = high, low
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(high), [None, pa.py_buffer(joined.tobytes())])
    return fixed.cast(pa.binary())


def long_lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of ``values`` as an array of lists."""
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(values).view(np.int64)))
