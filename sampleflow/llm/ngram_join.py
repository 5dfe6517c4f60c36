"""Self-join of texts by the Jaccard similarity of their word n-gram sets, with prefix trees.

All n-grams have one global order: rare before common, by counts in hashed buckets.
A text is dealt out by its first n-grams only: two sets that are similar enough share one
of them. Texts that share such an n-gram meet at the smallest of them, in a *cluster*,
once, however many n-grams they share. Counts of each set's n-grams by 64 hashed cells
bound the difference of two sets from below; members whose counts differ too much from
all others' leave, and clusters part where no two members fit, before whole sets are
read. Then each cluster stores its whole sets in a compressed
trie, common n-grams first, so that near copies share long paths; a set walks the trie
with the overlap counted so far, and leaves a subtree when the n-grams that remain cannot
bring the overlap up, or when no pair in it is wanted.

Where components are all that is asked for, pairs that are linked already are not wanted.
Large clusters are dealt out in blocks: first each member is compared with the cluster's
smallest one; then blocks are joined pairwise, but never two whose members are all linked
already. Where links are counted, every pair is wanted in the first cluster that holds both
sets, and all blocks are joined pairwise; a task gives each set's number of links, never the
pairs. Equal sets are one *class* throughout and are never compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.llm.graph import components, kept, small
from sampleflow.llm.words import BASES, Words, digests, give_back, long_lists, mix, pieces, sort_by_row, span_hashes, window_hashes

U = np.uint64
BUCKET_BITS = 18
CHUNK = 4096
#: A cluster above either goes in blocks.
BLOCK_GRAMS = 1 << 20
BLOCK_SETS = 2000
#: Rows that are taken out of a batch together: a row can hold a long text's n-grams.
ROWS_AT_ONCE = 64
#: Cells by which sets are compared before they are read: the number for sets from each size on.
#: Different sets of n differ by about the square root of n x cells, which must be above a tenth of n.
CELLS = ((0, 64), (2_000, 1_024), (64_000, 16_384), (2_000_000, 262_144))
#: A set with more others of fitting size in its cluster is not compared by cells: it stays.
MOST_PARTNERS = 5000


def gram_sets(texts: pa.Array, size: int, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of all texts, ascending within each, and how many each has.

    Words are lower-cased (A-Z). A text with fewer than ``size`` words is one n-gram, one
    without words has none. With ``order`` (a rank for each bucket of hashes) an n-gram's
    number is its place in the global order; without, its hash.
    """
    words = Words(texts, lower=True)
    hashes = words.hashes()
    at = words.window_starts(size)
    grams, row = window_hashes(hashes, size)[at], words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        whole = span_hashes(hashes, words.first[short], words.first[short] + words.counts[short], BASES[1])
        grams, row = np.concatenate((grams, whole)), np.concatenate((row, short))
    if order is not None:
        shift, low = U(64 - BUCKET_BITS), U((1 << (64 - BUCKET_BITS)) - 1)
        grams = (order[grams >> shift] << shift) | (grams & low)
    sort = sort_by_row(row, grams)
    grams, row = grams[sort], row[sort]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[new], row[new]
    return grams, np.bincount(row, minlength=len(words.counts))[: len(words.counts)]


def _bucket_counts(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for piece in pieces(batches):
            grams, _ = gram_sets(piece.column("text"), size)
            total += np.bincount((grams >> U(64 - BUCKET_BITS)).astype(np.int64), minlength=len(total))
        yield from _chunks({i: c for i, c in enumerate(total.reshape(-1, CHUNK)) if c.any()})

    return count


def _chunks(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array([c.tobytes() for c in found.values()], pa.binary())],
            names=["chunk", "counts"],
        )


def _sum_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            found[chunk] = found.get(chunk, 0) + np.frombuffer(counts, np.int64)
    yield from _chunks(found)


def gram_order(docs: DataFrame, size: int) -> np.ndarray:
    """A rank for each of 2^18 buckets of n-gram hashes, fewest n-grams first: the global order.

    2 MB, whatever the input: it is what the driver gets and sends out.
    """
    kind = "chunk int, counts binary"
    parts = docs.select("text").mapInArrow(_bucket_counts(size), kind).repartition("chunk")
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in parts.mapInArrow(_sum_chunks, kind).collect():
        total[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(r.counts, np.int64)
    order = np.empty(len(total), U)
    order[np.argsort(total, kind="stable")] = np.arange(len(total), dtype=U)
    return order


def prefix_lengths(n: np.ndarray, percent: int) -> np.ndarray:
    """How many first n-grams of a set every different set that is similar enough must meet (0: there can be none)."""
    length = n - (percent * n + 99) // 100 + 1
    return np.where(100 * n >= percent * (n + 1), length, 0)


def _signatures(grams: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(lengths)
    return tuple(span_hashes(mix(grams ^ U(base)), ends - lengths, ends, base) for base in BASES)


def _packed(counts: np.ndarray) -> bytes:
    """Counts as a byte each, or as four where one is too large for that."""
    return counts.astype("u1" if counts.max() < 256 else "<u4").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "u1" if len(raw) in {cells for _, cells in CELLS} else "<u4").astype(np.int64)


def _cells(grams: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """How many of a set's n-grams fall into each of its cells."""
    place, row = mix(grams), np.repeat(np.arange(len(lengths)), lengths)
    (_, few), (first_step, _) = CELLS[:2]
    short = np.where(lengths < first_step, lengths, 0)
    inside = short[row] > 0
    counts = np.bincount(row[inside] * few + (place[inside] >> U(58)).astype(np.int64), minlength=len(lengths) * few)
    out = [_packed(c) for c in counts.reshape(-1, few)]
    ends = np.cumsum(lengths)
    for i in np.flatnonzero(lengths >= first_step):
        cells = max(c for least, c in CELLS if lengths[i] >= least)
        own = place[ends[i] - lengths[i] : ends[i]] >> U(65 - cells.bit_length())
        out[i] = _packed(np.bincount(own.astype(np.int64), minlength=cells))
    return out


def _read_cells(raw: list[bytes]) -> dict[int, tuple[int, np.ndarray]]:
    """For each number of cells in use: the first row with as many (rows ascend by size), and all rows from there on, folded to it."""
    own = [_unpacked(r) for r in raw]
    out = {}
    for cells in {len(o) for o in own}:
        start = next(i for i, o in enumerate(own) if len(o) == cells)
        out[cells] = start, np.array([o.reshape(cells, -1).sum(axis=1) for o in own[start:]])
    return out


def _sketch(size: int, percent: int, order):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            grams, lengths = gram_sets(piece.column("text"), size, order.value)
            high, low = _signatures(grams, lengths)
            prefix = prefix_lengths(lengths, percent)
            place = np.arange(len(grams)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("row_key"),
                    piece.column("doc_id"),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(high.view(np.int64)),
                    digests(high, low),
                    pa.array(_cells(grams, lengths), pa.binary()),
                    long_lists(grams[place < np.repeat(prefix, lengths)], prefix),
                ],
                names=["row_key", "doc_id", "n", "short", "node", "cells", "prefix"],
            )

    return sketch


def _whole_sets(size: int, order):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            grams, lengths = gram_sets(piece.column("text"), size, order.value)
            high, low = _signatures(grams, lengths)
            raw, ends = grams.tobytes(), np.cumsum(lengths) * 8
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(high.view(np.int64)),
                    digests(high, low),
                    pa.array([raw[e - 8 * n : e] for e, n in zip(ends, lengths)], pa.binary()),
                ],
                names=["short", "node", "grams"],
            )

    return sets


class Trie:
    """A compressed trie of number sequences, all ascending; leaves are numbered in sorted order."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        lengths = np.array([len(s) for s in sets])
        common = np.zeros(len(sets) + 1, np.int64)
        for i in range(1, len(sets)):
            a, b = sets[i - 1], sets[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            common[i] = differ[0] if len(differ) else m
        # A node: (first leaf, end of leaves, depth above its edge, depth below, shortest, longest set, children).
        self.root = self._node(0, len(sets), 0, common, lengths)
        todo = [self.root]
        while todo:
            node = todo.pop()
            lo, hi, _, depth, _, _, children = node
            if hi - lo > 1:
                cuts = [lo, *(lo + 1 + np.flatnonzero(common[lo + 1 : hi] == depth)).tolist(), hi]
                for a, b in zip(cuts, cuts[1:]):
                    children.append(self._node(a, b, depth, common, lengths))
                todo += children

    def _node(self, lo, hi, above, common, lengths):
        depth = int(common[lo + 1 : hi].min()) if hi - lo > 1 else len(self.sets[lo])
        return lo, hi, above, depth, int(lengths[lo:hi].min()), int(lengths[lo:hi].max()), []

    def similar(self, q: int, inside: np.ndarray, percent: int, skip: np.ndarray) -> list[int]:
        """Leaves after ``q`` similar to it; ``inside`` marks q's numbers, ``skip`` the leaves that are not wanted."""
        own = self.sets[q]
        n, found = len(own), []
        least, most = -(-percent * n // 100), 100 * n // percent
        todo = [(self.root, 0)]
        while todo:
            (lo, hi, above, depth, low, high, children), overlap = todo.pop()
            if hi <= q + 1 or high < least or low > most:
                continue
            if skip[max(lo, q + 1) : hi].all():
                continue
            path = self.sets[lo]
            if depth > above:
                overlap += int(np.count_nonzero(inside[path[above:depth]]))
            if not children:
                if 100 * overlap >= percent * (n + len(path) - overlap):
                    found.append(lo)
                continue
            rest = n - int(np.searchsorted(own, path[depth - 1], "right")) if depth else n
            low, high = max(low, least), min(high, most)
            if (100 + percent) * (overlap + min(rest, high - depth)) >= percent * (n + low):
                todo += [(child, overlap) for child in children]
        return found


def _sorted_trie(sets: list[np.ndarray]) -> tuple[Trie, list[int], int]:
    """The sets' trie, the set of each leaf, and how many numbers there are."""
    flat, place = np.unique(np.concatenate(sets), return_inverse=True)
    place = len(flat) - 1 - place  # common n-grams first
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    turned = [part[::-1] for part in np.split(place, cuts)]
    order = sorted(range(len(sets)), key=lambda i: turned[i].astype(">u4").tobytes())
    return Trie([turned[i] for i in order]), order, len(flat)


def join_sets(sets: list[np.ndarray], percent: int, joined: np.ndarray | None = None) -> np.ndarray:
    """A label for each set: equal where links lead from one to the other. Sets marked ``joined`` count as linked."""
    if len(sets) < 2:
        return np.arange(len(sets))
    trie, order, numbers = _sorted_trie(sets)
    labels = np.arange(len(sets))
    if joined is not None and joined.any():
        marked = joined[order]
        labels[marked] = np.flatnonzero(marked)[0]
    inside = np.zeros(numbers, bool)
    for q in range(len(sets) - 1):
        skip = labels == labels[q]
        if skip[q + 1 :].all():
            continue
        inside[trie.sets[q]] = True
        for other in trie.similar(q, inside, percent, skip):
            a, b = labels[q], labels[other]
            if a != b:
                labels[labels == max(a, b)] = min(a, b)
        inside[trie.sets[q]] = False
    out = np.empty(len(sets), np.int64)
    out[order] = labels
    return out


def count_links(
    sets: list[np.ndarray], percent: int, copies: np.ndarray, before: list[list[int]], sides: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """A label for each set, equal where links counted here lead from one to the other, and the copies of all sets it is linked with.

    Two sets whose ``before`` share a number are counted elsewhere; with ``sides``, so are two sets of one side.
    """
    labels, links = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    if len(sets) < 2:
        return labels, links
    trie, order, numbers = _sorted_trie(sets)
    copies, before = copies[order], [before[i] for i in order]
    sides = None if sides is None else sides[order]
    holders: dict[int, list[int]] = {}
    for leaf, own in enumerate(before):
        for k in own:
            holders.setdefault(k, []).append(leaf)
    shared = {k: np.array(v) for k, v in holders.items() if len(v) > 1}
    inside = np.zeros(numbers, bool)
    for q in range(len(sets) - 1):
        skip = np.zeros(len(sets), bool) if sides is None else sides == sides[q]
        for k in before[q]:
            if k in shared:
                skip[shared[k]] = True
        if skip[q + 1 :].all():
            continue
        inside[trie.sets[q]] = True
        found = trie.similar(q, inside, percent, skip)
        inside[trie.sets[q]] = False
        if found:
            links[q] += copies[found].sum()
            links[found] += copies[q]
            both = np.append(labels[found], labels[q])
            if (both != both[0]).any():
                labels[np.isin(labels, both)] = both.min()
    out, counts = np.empty(len(sets), np.int64), np.empty(len(sets), np.int64)
    out[order], counts[order] = labels, links
    return out, counts


def _groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], most: int | None = None
) -> Iterator[tuple[list[dict], bool]]:
    """Rows of sorted batches, a list for each run of equal keys, and whether it is the whole run (with over ``most`` rows it comes in parts)."""
    now, rows, whole = None, [], True
    parts = (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE))
    for row in (row for part in parts for row in part.to_pylist()):
        key = tuple(row[k] for k in keys)
        if key != now:
            if rows:
                yield rows, whole
            now, rows, whole = key, [], True
        elif most and len(rows) >= most:
            whole = False
            yield rows, whole
            rows = []
        rows.append(row)
    if rows:
        yield rows, whole
    rows = []
    give_back()


def _may_link(n: np.ndarray, raw: list[bytes], percent: int, most_partners: int) -> np.ndarray:
    """A label for each set (ascending by size): equal where sets could be linked by size and cells, -1 for a set alone.

    A set with more than ``most_partners`` others of fitting size counts as one that could be linked with all of them.
    """
    labels, alone = np.arange(len(n)), np.ones(len(n), bool)
    ends = np.searchsorted(n, 100 * n // percent, "right").tolist()
    folded = _read_cells(raw)
    steps = sorted((start, cells) for cells, (start, _) in folded.items())
    for i, end in enumerate(ends):
        if end <= i + 1:
            continue
        near = np.arange(i + 1, end)
        if len(near) <= most_partners:
            start, cells = max(s for s in steps if s[0] <= i)
            rows = folded[cells][1]
            differ = np.abs(rows[i + 1 - start : end - start] - rows[i - start]).sum(axis=1)
            near = near[differ <= (100 - percent) * (n[i] + n[i + 1 : end]) // (100 + percent)]
        if len(near):
            alone[i] = alone[near] = False
            if (labels[near] != labels[i]).any():
                both = np.append(labels[near], labels[i])
                labels[np.isin(labels, both)] = both.min()
    return np.where(alone, -1, labels)


def _prune(percent: int, most_partners: int):
    """Drops members of a cluster that no other one can be similar to, and parts it where no two can; rows come by key and size.

    Each part is named by its smallest set, so that parts which meet in many clusters become one.
    A cluster too long for a worker's memory goes through in pieces, whole.
    """

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, shorts = [], []
        for rows, whole in _groups(batches, ["key"], 4 * most_partners):
            own = [r["short"] for r in rows]
            if whole:
                labels = _may_link(np.array([r["n"] for r in rows]), [r["cells"] for r in rows], percent, most_partners).tolist()
                least: dict[int, int] = {}
                for label, short in zip(labels, own):
                    least[label] = min(short, least.get(label, short))
                found = [(least[label], short) for label, short in zip(labels, own) if label >= 0]
            else:
                found = [(rows[0]["key"], short) for short in own]
            keys += [k for k, _ in found]
            shorts += [s for _, s in found]
            if len(keys) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(shorts, pa.int64())], names=["key", "short"])
                keys, shorts = [], []
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(shorts, pa.int64())], names=["key", "short"])

    return prune


def _links(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["u", "v"]
    )


def _join_clusters(percent: int):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, bytes]] = []
        for rows, _ in _groups(batches, ["key", "i", "j"]):
            labels = join_sets([np.frombuffer(r["grams"], U) for r in rows], percent, np.array([r["joined"] for r in rows]))
            first: dict[int, bytes] = {}
            for r, label in zip(rows, labels.tolist()):
                root = first.setdefault(label, r["node"])
                if root != r["node"]:
                    out.append((root, r["node"]))
            if len(out) > 10_000:
                yield _links(out)
                out = []
        yield _links(out)

    return join


def _count_clusters(percent: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part() -> pa.RecordBatch:
            found = [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())]
            return pa.RecordBatch.from_arrays([*found, pa.array([o[2] for o in out], pa.int64())], names=["u", "v", "links"])

        out: list[tuple[bytes, bytes, int]] = []
        for rows, _ in _groups(batches, ["key", "i", "j"]):
            rows = list({r["node"]: r for r in rows}.values())  # a row of docs that is repeated gives its set again
            labels, links = count_links(
                [np.frombuffer(r["grams"], U) for r in rows],
                percent,
                np.array([r["copies"] for r in rows]),
                [r["before"] for r in rows],
                np.array([r["own"] for r in rows]) if rows[0]["i"] != rows[0]["j"] else None,
            )
            first: dict[int, bytes] = {}
            for r, label, n in zip(rows, labels.tolist(), links.tolist()):
                if n:
                    out.append((first.setdefault(label, r["node"]), r["node"], n))
            if len(out) > 10_000:
                yield part()
                out = []
        yield part()

    return count


def _compare(percent: int):
    """Whether a set is similar to its cluster's smallest one."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for a, b in zip(batch.column("grams"), batch.column("least_grams")):
                a, b = np.frombuffer(a.as_py(), U), np.frombuffer(b.as_py(), U)
                both = len(np.intersect1d(a, b, assume_unique=True))
                flags.append(100 * both >= percent * (len(a) + len(b) - both))
            kept_columns = [c for c in batch.schema.names if c != "least_grams"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept_columns), pa.array(flags, pa.bool_())], names=[*kept_columns, "joined"]
            )

    return compare


def _row_key(doc_id: Column, text: Column) -> Column:
    """128 bits for a row's doc_id and text; null counts as a text of its own, never as an id."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), text)))


def _classes(
    docs: DataFrame, size: int, percent: int, block_grams: int, block_sets: int, most_partners: int, counted: bool = False
) -> DataFrame:
    """``row_key``, ``doc_id``, ``n`` of every row; its component's smallest ``component_id``, and the ``lead_key`` of that row.

    If ``counted``, also ``n_links``: how many other rows have a similar text.
    """
    spark = docs.sparkSession
    docs = docs.select(_row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "doc_id", "text")
    order = spark.sparkContext.broadcast(gram_order(docs, size))
    sketch = kept(
        docs.mapInArrow(
            _sketch(size, percent, order),
            "row_key binary, doc_id long, n long, short long, node binary, cells binary, prefix array<long>",
        ),
        "sketch",
    )
    classes = sketch.where("n > 0").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("lead"), F.first("n").alias("n"), F.count("*").alias("copies"),
        F.first("short").alias("short"), F.first("cells").alias("cells"), F.first("prefix").alias("prefix"),
    )
    grams = classes.select("short", "n", F.explode("prefix").alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("sets"), F.min("short").alias("key")).where("sets > 1")
    members = grams.join(shared, "gram").select("key", "short", "n").distinct()
    # Members with no other one of fitting size leave before cells move.
    by_size = Window.partitionBy("key").orderBy("n")
    smaller, larger = F.lag("n").over(by_size), F.lead("n").over(by_size)
    fits = (100 * smaller >= percent * F.col("n")) | (100 * F.col("n") >= percent * larger)
    members = members.select("key", "short", "n", fits.alias("fits")).where("fits").drop("fits")
    members = members.join(classes.select("short", "cells"), "short").repartition("key").sortWithinPartitions("key", "n")
    members = kept(members.mapInArrow(_prune(percent, most_partners), "key long, short long").distinct(), "members")

    wanted = members.select("short").distinct().join(classes.select("short", "lead.row_key"), "short")
    wanted = small(kept(wanted.select("row_key").distinct(), "wanted"))
    texts = docs.join(wanted, "row_key").select("text")
    sets = texts.mapInArrow(_whole_sets(size, order), "short long, node binary, grams binary")
    sizes = classes.select("short", "node", "n").join(members, "short").groupBy("key").agg(
        F.min("node").alias("least"), F.greatest(F.count("*") / block_sets, F.sum("n") / block_grams).alias("blocks")
    )
    sizes = kept(sizes.select("key", "least", F.ceil("blocks").cast("int").alias("blocks")), "sizes")
    members = kept(members.join(sizes, "key"), "members")

    if counted:
        links = kept(_counted_links(sets, members, classes.select("short", "node", "copies"), percent), "links_of_sets")
        found = components(links)
        counts = links.groupBy(F.col("v").alias("node")).agg(F.sum("links").alias("links"))
    else:
        found = components(_component_links(sets, members, sizes, percent))

    by_class = classes.select("node", "lead", "copies").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = by_class.groupBy("component").agg(F.min("lead").alias("lead"))
    wide = ["node"]
    if counted:
        others = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
        by_class = by_class.join(counts, "node", "left").withColumn("n_links", others)
        wide.append("n_links")
    by_class = by_class.select("component", *wide).join(least, "component")
    by_class = by_class.select(
        F.col("node").alias("class"), F.col("lead.doc_id").alias("component_id"), F.col("lead.row_key").alias("lead_key"), *wide[1:]
    )
    out = sketch.select("row_key", "doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("class"))
    return out.join(by_class, "class", "left").drop("class")


def _component_links(sets: DataFrame, members: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Links enough to join the similar sets of every cluster."""
    single = sets.join(small(members.where("blocks <= 1").select("key", "short")), "short").select(
        "key", "node", "grams", F.lit(False).alias("joined"), F.lit(0).alias("i"), F.lit(0).alias("j")
    )
    links = _joined(single, percent)
    if sizes.where("blocks > 1").limit(1).count():
        links = links.union(_large_clusters(sets, members.where("blocks > 1"), percent))
    return links


def _counted_links(sets: DataFrame, members: DataFrame, copies: DataFrame, percent: int) -> DataFrame:
    """``u``, ``v``, ``links``: for each set ``v`` with links counted in a cluster's blocks how many, and one ``u`` that links lead to."""
    # Two sets are counted in the cluster with the smallest key of those that hold both.
    several = members.groupBy("short").agg(F.collect_set("key").alias("keys")).where(F.size("keys") > 1)
    earlier = F.filter("keys", lambda k: k < F.col("key"))
    placed = members.select("key", "short", "blocks").join(several, "short", "left").join(copies, "short").select(
        "key", "short", "node", "blocks", "copies", F.coalesce(earlier, F.array().cast("array<long>")).alias("before")
    )
    placed = sets.join(small(kept(placed, "placed")), ["short", "node"])
    blocks = F.greatest(F.col("blocks"), F.lit(1))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "key", "node", "grams", "copies", "before", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    dealt = pairs.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_count_clusters(percent), "u binary, v binary, links long")


def ngram_classes(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    block_grams: int = BLOCK_GRAMS,
    block_sets: int = BLOCK_SETS,
    most_partners: int = MOST_PARTNERS,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs``.

    Texts link when the Jaccard similarity of their sets of ``size``-word n-grams is
    ``percent`` / 100 or more (exactly, in whole numbers); ``component_id`` is the smallest
    doc_id that links lead to. Texts that are null, empty or without words have no n-grams
    and stay alone. Repeated rows, also of one doc_id, all come out. A null doc_id is
    never the smallest; a component of nothing else gets null. Other columns are not used.
    N-grams are compared by 64-bit, whole sets and rows by 128-bit hashes: sets that share
    their first 64 bits only meet in more clusters. The last three options
    bound what a task holds and do not change the result.
    """
    found = _classes(docs, size, percent, block_grams, block_sets, most_partners)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def ngram_links(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    block_grams: int = BLOCK_GRAMS,
    block_sets: int = BLOCK_SETS,
    most_partners: int = MOST_PARTNERS,
) -> DataFrame:
    """``ngram_classes`` with ``n_links``: how many other rows a row is linked with, those of an equal text too.

    A text without words has none. Links are counted in the tasks that find them, so
    a group of near copies takes work with the square of its distinct texts, but no more rows
    than their number for each pair of blocks.
    """
    found = _classes(docs, size, percent, block_grams, block_sets, most_partners, counted=True)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    links = F.when(F.col("n") > 0, F.col("n_links")).otherwise(0)
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), links.alias("n_links"))


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` of each component: that of the smallest doc_id (null last), with all its columns. Texts without words all stay."""
    found = kept(_classes(docs, size, percent, BLOCK_GRAMS, BLOCK_SETS, MOST_PARTNERS), "classes")
    rows = docs.select(_row_key(F.col("doc_id"), F.col("text")).alias("key"), F.struct("*").alias("row"))
    dropped = found.where("n > 0 AND row_key <> lead_key").select(F.col("row_key").alias("key")).distinct()
    rows = rows.join(small(kept(dropped, "dropped")), "key", "left_anti")
    twins = found.where("n > 0").groupBy("row_key").count().where("count > 1").select(F.col("row_key").alias("key"))
    twins = kept(twins, "twins")
    if twins.limit(1).count():  # rows that repeat a doc_id and its text
        again = rows.join(twins, "key", "left_semi").withColumn("text", F.to_json("row"))
        one = again.groupBy("key").agg(F.min_by("row", "text").alias("row"))
        rows = rows.join(twins, "key", "left_anti").unionByName(one)
    return rows.select("row.*")


def _joined(blocks: DataFrame, percent: int) -> DataFrame:
    dealt = blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_join_clusters(percent), "u binary, v binary")


def _large_clusters(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links within clusters of several blocks."""
    least = sets.select(F.col("node").alias("least"), F.col("grams").alias("least_grams"))
    dealt = sets.join(members, "short").join(least, "least").select(
        "key", "short", "node", "grams", "blocks", F.col("least").alias("least_node"), "least_grams"
    )
    marked = dealt.mapInArrow(
        _compare(percent), "key long, short long, node binary, grams binary, blocks int, least_node binary, joined boolean"
    )
    marked = kept(marked, "marked")
    links = marked.where("joined AND node <> least_node").select(F.col("least_node").alias("u"), F.col("node").alias("v"))
    # Blocks 0 .. blocks - 1 hold what is linked with the smallest set, the next ones the others.
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    own = F.when(F.col("joined"), block).otherwise(block + F.col("blocks"))
    others = marked.where("NOT joined").groupBy("key").agg(F.collect_set(block + F.col("blocks")).alias("rest"))
    partners = F.when(F.col("joined"), F.col("rest")).otherwise(
        F.concat("rest", F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    pairs = marked.join(others, "key").withColumn("own", own).withColumn("other", F.explode(partners)).select(
        "key", "node", "grams", "joined", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    return links.union(_joined(pairs, percent))
