"""Byte-level BPE on numpy matrices: pieces of about equal length are merged together, a pair a round in each."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sampleflow.llm.words import bytes_of, pieces

NONE = np.int32(2**31 - 1)
#: Pieces above so many bytes are merged one by one, with a heap.
LONGEST_ROW = 256
MATRIX_CELLS = 1 << 19
#: Pieces that a worker remembers; then it starts anew.
REMEMBERED = 150_000


class PairTable:
    """Ranks of token pairs in an open-addressed hash table."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, tokens: int):
        """``keys`` are first id times ``tokens`` plus second id, all distinct."""
        self.tokens = np.int64(tokens)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        self.listed: dict[tuple[int, int], int] = {}
        slots, self.probes = self._slot(keys), 0
        while len(keys):
            self.probes += 1
            free = self.keys[slots] < 0
            _, first = np.unique(slots, return_index=True)
            taken = np.zeros(len(keys), bool)
            taken[first] = True
            taken &= free
            self.keys[slots[taken]], self.ranks[slots[taken]] = keys[taken], ranks[taken]
            keys, ranks, slots = keys[~taken], ranks[~taken], (slots[~taken] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def as_dict(self) -> dict[tuple[int, int], int]:
        """The pairs for one at a time; built when a worker first needs it."""
        if not self.listed:
            held = self.keys >= 0
            a, b = np.divmod(self.keys[held], self.tokens)
            self.listed = dict(zip(zip(a.tolist(), b.tolist()), self.ranks[held].tolist()))
        return self.listed

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where it is no token; negative tokens are padding."""
        keys = a.astype(np.int64) * self.tokens + b
        keys[(a < 0) | (b < 0)] = -2
        found = np.full(keys.shape, NONE, np.int32)
        todo = np.flatnonzero(keys.ravel() >= 0)
        flat, out = keys.ravel(), found.ravel()
        slots = self._slot(flat[todo])
        for _ in range(self.probes):
            if not len(todo):
                break
            held = self.keys[slots]
            hit = held == flat[todo]
            out[todo[hit]] = self.ranks[slots[hit]]
            on = ~hit & (held >= 0)
            todo, slots = todo[on], (slots[on] + 1) & (len(self.keys) - 1)
        return out.reshape(keys.shape)


class Encoder:
    """Encodes and decodes with the ranks of a tiktoken file and a pattern that splits text into pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            rows = [line.split() for line in file if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        self.size = max(ranks.values()) + 1
        self.split = regex.compile(pattern).findall
        self.bytes_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # Flat arrays from the start: several workers of a host build this at once.
        keys, found = array("q"), array("i")
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                first, second = ranks.get(token[:i]), ranks.get(token[i:])
                if first is not None and second is not None:
                    keys.append(first * self.size + second)
                    found.append(rank)
        self.table = PairTable(np.array(keys, np.int64), np.array(found, np.int32), self.size)
        tokens = [b""] * self.size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_ends = np.cumsum([len(t) for t in tokens])
        self.token_lengths = np.array([len(t) for t in tokens])
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts, self.lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    # One piece or many

    def _merge_rows(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merges each row (ids, padded by -1); yields row numbers and their ids as rows are done."""
        number = np.arange(len(rows))
        ranks = self.table.find(rows[:, :-1], rows[:, 1:])
        while len(rows):
            if not ranks.shape[1]:
                yield number, rows
                return
            at = ranks.argmin(axis=1)  # the leftmost of equal ranks
            best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                yield number[done], rows[done]
                number, rows, ranks, at, best = (x[~done] for x in (number, rows, ranks, at, best))
                if not len(rows):
                    return
            line, width = np.arange(len(rows)), rows.shape[1]
            rows[line, at] = best
            column = np.arange(width - 1)
            rows = np.take_along_axis(rows, column + (column > at[:, None]), axis=1)
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
            for place in (at - 1, at):
                here = np.flatnonzero((place >= 0) & (place < width - 2))
                p = place[here]
                ranks[here, p] = self.table.find(rows[here, p], rows[here, p + 1])

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for one long piece: the least rank, leftmost, from a heap."""
        n, pairs = len(ids), self.table.as_dict()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (more := pairs.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (more, a))
        return [x for x in ids if x >= 0]

    def _encode_pieces(self, found: list[str]) -> None:
        """Adds pieces to those known."""
        raw = [p.encode() for p in found]
        sizes = np.array([len(r) for r in raw])
        results: list[np.ndarray | None] = [None] * len(raw)
        for i in np.flatnonzero(sizes > LONGEST_ROW):
            results[i] = np.array(self._merge_long(self.bytes_ids[np.frombuffer(raw[i], np.uint8)].tolist()), np.int32)
        # Buckets: lengths up to 8 each for itself, then steps of a quarter.
        step = np.maximum(1, 1 << np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1))).astype(int) - 3))
        bucket = -(-sizes // step) * step
        for width in np.unique(bucket[sizes <= LONGEST_ROW]):
            members = np.flatnonzero((bucket == width) & (sizes <= LONGEST_ROW))
            for part in np.array_split(members, max(1, len(members) * int(width) // MATRIX_CELLS)):
                rows = np.full((len(part), width), -1, np.int32)
                inside = np.arange(width) < sizes[part][:, None]
                rows[inside] = self.bytes_ids[np.frombuffer(b"".join(raw[i] for i in part), np.uint8)]
                for number, ids in self._merge_rows(rows):
                    lengths = (ids >= 0).sum(axis=1).tolist()
                    for i, row, n in zip(part[number].tolist(), ids, lengths):
                        results[i] = row[:n]
        start = len(self.known)
        if len(self.starts) < start + len(found):
            more = max(len(self.starts), len(found))
            self.starts, self.lengths = (np.concatenate((x, np.zeros(more, np.int64))) for x in (self.starts, self.lengths))
        flat = np.concatenate(results)
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate((self.ids, np.zeros(len(self.ids), np.int32)))
        lengths = np.array([len(r) for r in results])
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[start : start + len(found)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[start : start + len(found)] = lengths
        self.used += len(flat)
        self.known.update(zip(found, range(start, start + len(found))))

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and how many each text has."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self._forget()
        found = [p for s in split for p in s]
        new = list(set(found).difference(self.known))
        if new:
            self._encode_pieces(sorted(new))
        which = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        ids = spans(self.ids, self.starts[which], self.lengths[which])
        ends = np.concatenate(([0], np.cumsum(self.lengths[which])))
        cuts = ends[np.concatenate(([0], np.cumsum([len(s) for s in split]))).astype(np.int64)]
        return ids, np.diff(cuts)

    def decode_batch(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in one array, and where each text's end."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError(f"ids must be from 0 to {self.size - 1}")
        lengths = self.token_lengths[ids]
        raw = spans(self.token_bytes, self.token_ends[ids] - lengths, lengths)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        return raw, ends[np.cumsum(counts)]


def spans(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[start:start + length]`` of all, one after another."""
    ends = np.cumsum(lengths)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """An encoder, built once in each worker."""
    return Encoder(path, pattern)


def binaries(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of bytes as an array of binaries."""
    offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64).tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, offsets, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (binary, little-endian unsigned 32-bit numbers) of every row's whole text.

    Each match of ``pattern`` is encoded by itself, as tiktoken's ``encode_ordinary`` does:
    in a piece the leftmost pair of least rank is merged until no pair is a token. Special
    tokens are text like any other. A null or empty text has no ids. Repeated rows and
    null doc_ids come out as they are. Other columns are not used. ``path`` must be
    readable on the executors.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for piece in pieces(batches):
            ids, counts = own.encode_batch([t or "" for t in piece.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), binaries(ids.astype("<u4"), 4 * np.cumsum(counts))], names=["doc_id", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of every row: ``encode_texts`` and ``decode_ids`` by one worker a core, with one table."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for piece in pieces(batches):
            ids, counts = own.encode_batch([t or "" for t in piece.column("text").to_pylist()])
            raw, ends = own.decode_batch(ids.astype(np.int64), counts)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), binaries(ids.astype("<u4"), 4 * np.cumsum(counts)), binaries(raw, ends)],
                names=["doc_id", "ids", "decoded"],
            )

    return docs.select("doc_id", "text").mapInArrow(both, "doc_id long, ids binary, decoded binary")


def decode_ids(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` (the bytes that the ids stand for; null: none) of every row."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for piece in pieces(batches, "ids"):
            raw, offsets = bytes_of(piece.column("ids"))
            found, ends = own.decode_batch(raw.view("<u4").astype(np.int64), np.diff(offsets) // 4)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("ids"), binaries(found, ends)], names=["doc_id", "ids", "decoded"]
            )

    return rows.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids binary, decoded binary")
