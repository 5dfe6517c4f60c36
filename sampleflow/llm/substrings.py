"""Removal of repeated word passages, by a compacted De Bruijn graph over sampled word k-mers.

Of each window of ``size`` words the smallest hash among its k-mers is its *anchor*
(equal windows have equal anchors at equal places). Anchors are the graph's nodes; the
span of words from one anchor to the next one of its document is an edge. Only anchors
that occur twice or more matter. Where an anchor always has the same next edge, and that
edge's end always the same previous one, the path does not branch: such paths compact
into runs, whose occurrences move in step, so that one comparison settles all windows
inside. Windows that stick out of a run at a branch are compared one by one. The places
of runs and windows then tell which occurrence is the first.

Documents are dealt into blocks of about equal bytes. A block sends one row for each of its
anchors, runs and windows, however often it holds them, and gets the answers back; texts
move once, and the three passes over them share that shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.llm.words import BASES, Words, digests, pieces, span_hashes, window_hashes

U = np.uint64
BLOCK_BYTES = 8 << 20
LAST = (1 << 63) - 1


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least of each ``width`` neighbours."""
    least, place, done = values, np.arange(len(values)), 1
    while done < width:
        step = min(done, width - done)
        if len(least) <= step:
            return np.zeros(0, np.int64)
        right = least[step:] < least[:-step]
        least, place = np.where(right, least[step:], least[:-step]), np.where(right, place[step:], place[:-step])
        done += step
    return place


class Passages:
    """Anchors of the texts of a piece, in order: ``at`` (word), ``doc``, ``low`` and ``high`` (its windows), ``code``; ``edges``: of an anchor and the next, 0 at a document's end."""

    def __init__(self, texts: pa.Array, size: int, k: int):
        self.words = Words(texts)
        self.hashes = self.words.hashes()
        self.windows = self.words.window_starts(size)
        codes = window_hashes(self.hashes, k)
        place = _smallest(codes, size - k + 1)[self.windows] if len(self.windows) else np.zeros(0, np.int64)
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        heads = np.flatnonzero(new)
        self.anchor = np.cumsum(new) - 1  # of each window
        self.at = place[heads]
        self.doc = self.words.doc[self.at] if len(heads) else np.zeros(0, np.int64)
        self.code = codes[self.at] if len(heads) else np.zeros(0, U)
        self.edges = np.zeros(len(heads), U)
        if len(heads) > 1:
            next_ = np.flatnonzero(self.doc[1:] == self.doc[:-1])
            self.edges[next_] = span_hashes(self.hashes, self.at[next_], self.at[next_ + 1] + k)

    def before(self) -> np.ndarray:
        """The edge that leads to each anchor."""
        return np.concatenate((np.zeros(1, U), self.edges[:-1]))[: len(self.edges)]


def _sorted(table: pa.Table) -> pa.Table:
    """A block's rows in an order that does not depend on how they came."""
    return table.sort_by([("place", "ascending"), ("text", "ascending")]).combine_chunks()


def _read(table: pa.Table, size: int, k: int) -> Iterator[tuple[int, pa.RecordBatch, Passages]]:
    row = 0
    for piece in pieces(iter(_sorted(table).to_batches())):
        yield row, piece, Passages(piece.column("text"), size, k)
        row += piece.num_rows


def _one_value(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The value of each group if it has but one, else 0."""
    low, high = np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)
    return np.where(low == high, low, U(0))


def _anchors(size: int, k: int):
    def anchors(table: pa.Table) -> pa.Table:
        found = [(p.code, p.edges, p.before()) for _, _, p in _read(table, size, k)]
        codes, after, before = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(codes)
        codes, after, before = codes[order], after[order], before[order]
        starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(codes)), bool), codes[1:] != codes[:-1])))
        counts = np.diff(np.append(starts, len(codes)))
        if len(starts):
            codes, after, before = codes[starts], _one_value(after, starts), _one_value(before, starts)
        block = table.column("block")[0].as_py()
        return pa.table(
            {
                "block": pa.array(np.full(len(codes), block, np.int32)),
                "code": pa.array(codes.view(np.int64)),
                "n": pa.array(counts.astype(np.int64)),
                "after": pa.array(after.view(np.int64)),
                "before": pa.array(before.view(np.int64)),
            }
        )

    return anchors


ITEMS = "block int, high long, low long, known boolean, place long, row int, start int, end int"


def _items(size: int, k: int):
    """Runs and windows of a block: the first of equal ones to be compared with other blocks' (known: false), the others as words to remove."""

    def items(table: pa.Table, answers: pa.Table) -> pa.Table:
        codes = answers.column("code").to_numpy().view(U)
        order = np.argsort(codes)
        codes = codes[order]
        after, before = (answers.column(c).to_numpy().view(U)[order] for c in ("after", "before"))
        found = []
        for row, _, p in _read(table, size, k):
            if not len(p.at) or not len(codes):
                continue
            at = np.minimum(np.searchsorted(codes, p.code), len(codes) - 1)
            repeated = codes[at] == p.code
            edge, out = p.edges[:-1], np.zeros(len(p.at), bool)
            out[:-1] = (edge != 0) & repeated[:-1] & repeated[1:] & (after[at[:-1]] == edge) & (before[at[1:]] == edge)
            heads = np.flatnonzero(np.concatenate((np.ones(1, bool), ~out[:-1])))
            tails = np.append(heads[1:], len(out)) - 1
            run = np.repeat(np.arange(len(heads)), tails - heads + 1)
            begin, end = p.at[heads], p.at[tails] + k
            runs = np.flatnonzero(repeated[heads] & (end - begin >= size))
            outside = repeated[p.anchor] & ((p.windows < begin[run[p.anchor]]) | (p.windows + size > end[run[p.anchor]]))
            starts = np.concatenate((begin[runs], p.windows[outside]))
            ends = np.concatenate((end[runs], p.windows[outside] + size))
            doc = p.words.doc[starts]
            found.append(
                (*(span_hashes(p.hashes, starts, ends, b) for b in BASES), doc + row, starts - p.words.first[doc], ends - p.words.first[doc])
            )
        if not found:
            found = [(np.zeros(0, U), np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(3)))]
        high, low, doc, starts, ends = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((starts, doc, low, high))
        high, low, doc, starts, ends = (x[order] for x in (high, low, doc, starts, ends))
        first = np.ones(len(high), bool)
        first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        # What is not the first even here is removed; such spans are joined where they touch.
        more, from_, to = _united(doc[~first], starts[~first], ends[~first])
        places = _sorted(table).column("place").to_numpy()
        known = np.concatenate((np.zeros(first.sum(), bool), np.ones(len(more), bool)))
        rows = np.concatenate((doc[first], more))
        block = table.column("block")[0].as_py()
        pad = np.zeros(len(more), np.int64)
        return pa.table(
            {
                "block": pa.array(np.full(len(rows), block, np.int32)),
                "high": pa.array(np.concatenate((high[first].view(np.int64), pad + block))),
                "low": pa.array(np.concatenate((low[first].view(np.int64), pad))),
                "known": pa.array(known),
                "place": pa.array(places[rows] if len(rows) else np.zeros(0, np.int64)),
                "row": pa.array(rows.astype(np.int32)),
                "start": pa.array(np.concatenate((starts[first], from_)).astype(np.int32)),
                "end": pa.array(np.concatenate((ends[first], to)).astype(np.int32)),
            }
        )

    return items


def _united(doc: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each document joined where they overlap or touch."""
    if not len(doc):
        return doc, starts, ends
    order = np.lexsort((starts, doc))
    doc, starts, ends = doc[order], starts[order], ends[order]
    shift = doc * np.int64(1 << 32)  # keeps documents apart in one running maximum
    reach = np.maximum.accumulate(ends + shift)
    new = np.ones(len(doc), bool)
    new[1:] = (starts + shift)[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(doc)) - 1
    return doc[heads], starts[heads], (reach - shift)[tails]


def _cut(columns: list[str]):
    def cut(table: pa.Table, spans: pa.Table) -> pa.Table:
        row_of, starts, ends = (spans.column(c).to_numpy().astype(np.int64) for c in ("row", "start", "end"))
        order = np.argsort(row_of, kind="stable")
        row_of, starts, ends = row_of[order], starts[order], ends[order]
        out, row = [], 0
        for piece in pieces(iter(_sorted(table).to_batches())):
            words = Words(piece.column("text"))
            a, b = np.searchsorted(row_of, [row, row + piece.num_rows])
            base = words.first[row_of[a:b] - row]
            depth = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(depth, base + starts[a:b], 1)
            np.add.at(depth, base + ends[a:b], -1)
            keep = np.cumsum(depth[:-1]) == 0
            kept = np.bincount(words.doc[keep], minlength=piece.num_rows)
            texts = kept_texts(words, keep, kept)
            out.append(
                pa.table(
                    {
                        "doc_id": piece.column("doc_id"),
                        "n_words": pa.array(words.counts.astype(np.int64)),
                        "n_removed": pa.array((words.counts - kept).astype(np.int64)),
                        **({"kept_text": pa.array(texts, pa.binary()).cast(pa.string())} if "kept_text" in columns else {}),
                        "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    }
                )
            )
            row += piece.num_rows
        return pa.concat_tables(out)

    return cut


def kept_texts(words: Words, keep: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """For each row its kept words, joined by one space."""
    starts, lengths = words.starts[keep], (words.ends - words.starts)[keep] + 1
    ends = np.cumsum(lengths)
    source = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    buffer = np.append(words.data, np.uint8(0x20))[source]
    buffer[ends - 1] = 0x20
    raw = buffer.tobytes()
    cuts = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))].tolist()
    return [raw[a : max(a, b - 1)] for a, b in zip(cuts, cuts[1:])]


def remove_repeats(
    docs: DataFrame, size: int = 50, k: int = 8, block_bytes: int = BLOCK_BYTES, with_text: bool = True
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (if asked for) and ``kept_sha256`` for every row of ``docs``.

    A word is removed if a window of ``size`` words over it also starts earlier: in a
    document of smaller doc_id, or before it in its own. Windows are judged on the input.
    The kept words are joined by one space. A null or empty text has no words; a text
    below ``size`` words loses none. A null doc_id counts as the largest; rows with equal
    doc_id follow each other in a fixed order, so of repeated rows only one keeps its
    passages. Other columns are not used. Windows are compared by 128-bit hashes.
    """
    k = min(k, size)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    texts = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
        "doc_id",
        F.coalesce("doc_id", F.lit(LAST)).alias("place"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    anchors = texts.groupBy("block").applyInArrow(_anchors(size, k), "block int, code long, n long, after long, before long")
    # At most one row of a block for each code.
    code = Window.partitionBy("code")
    same = lambda c: F.when(F.min(c).over(code) == F.max(c).over(code), F.col(c)).otherwise(F.lit(0).cast("long"))
    repeated = anchors.select(
        "block", "code", F.sum("n").over(code).alias("n"), same("after").alias("after"), same("before").alias("before")
    ).where("n > 1").drop("n")
    items = texts.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_items(size, k), ITEMS)
    place = F.struct("place", "block", "row", "start")
    first = F.min(place).over(Window.partitionBy("high", "low", "known"))
    spans = items.select("block", "row", "start", "end", (F.col("known") | (place != first)).alias("later")).where("later")
    columns = ["kept_text"] if with_text else []
    return texts.groupBy("block").cogroup(spans.drop("later").groupBy("block")).applyInArrow(
        _cut(columns),
        "doc_id long, n_words long, n_removed long, " + "kept_text string, " * with_text + "kept_sha256 string",
    )
