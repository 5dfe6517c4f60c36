"""Prefix trie of conversations: node tables on minimal perfect hashes, counts summed up through parent slots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.llm.graph import kept, small
from sampleflow.llm.words import U, bytes_of, give_back, mix

#: Nodes that one table holds; larger subtrees are cut below their top.
SHARD_NODES = 1 << 17
ROOT = b"\0" * 16
#: Ids of so wide a range are written together before a node's ids are digested in order.
ID_BITS = 12
MOST_BORROWED = 9
FAMILY = 5


class NodeTable:
    """A slot from 0 to n-1 for each of n distinct 128-bit keys, each slot verified by its key.

    Each level takes the keys that are alone at their place in a bit array twice their number,
    the rest go on to the next level; a slot is the rank of the bit (Limasset et al., 2017).
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.high, self.low = np.zeros(len(high), U), np.zeros(len(low), U)
        left, used = np.arange(len(high)), 0
        self.slots = np.full(len(high), -1, np.int64)
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("keys must be distinct")
            size = 2 * len(left) + 1
            place = self._place(high[left], low[left], size)
            alone = np.bincount(place, minlength=size) == 1
            ranks = used + np.cumsum(alone) - alone
            self.levels.append((alone, ranks))
            here = alone[place]
            self.slots[left[here]] = ranks[place[here]]
            used += int(alone.sum())
            left = left[~here]
        self.high[self.slots], self.low[self.slots] = high, low

    def _place(self, high: np.ndarray, low: np.ndarray, size: int) -> np.ndarray:
        level = U(len(self.levels) * 0x9E3779B9 + 1)
        return (mix(high + mix(low + level)) % U(size)).astype(np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it has none."""
        found = np.full(len(high), -1, np.int64)
        left, levels, self.levels = np.arange(len(high)), self.levels, []
        for alone, ranks in levels:
            place = self._place(high[left], low[left], len(alone))
            hit = alone[place]
            slot = ranks[place[hit]]
            same = (self.high[slot] == high[left[hit]]) & (self.low[slot] == low[left[hit]])
            found[left[hit][same]] = slot[same]
            left = left[~hit]
            self.levels.append((alone, ranks))
        return found


def _halves(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    both = bytes_of(column)[0].view(">u8").reshape(-1, 2).astype(U)
    return both[:, 0].copy(), both[:, 1].copy()


SHARD_KIND = (
    "node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, outer boolean"
)


def sum_up(table: pa.Table) -> pa.RecordBatch:
    """Whole subtrees of the trie: what each node's subtree adds up to, as ``SHARD_KIND``.

    ``n_children``, ``n_leaves`` and ``saved_tokens`` of a row are what parts of the trie
    below these subtrees have added up to already.
    """
    column = {name: table.column(name).combine_chunks() for name in table.column_names}
    number = {name: column[name].to_numpy() for name in ("conv_id", "depth", "bytes", "n_convs", "n_children", "n_leaves", "saved_tokens")}
    nodes = NodeTable(*_halves(column["node"]))
    # Rows to slots: all that follows are flat arrays by slot.
    row_of = np.empty(len(nodes.slots), np.int64)
    row_of[nodes.slots] = np.arange(len(nodes.slots))
    conv, depth, size, n, children, leaves, saved = (values[row_of] for values in number.values())
    parent = column["parent"].fill_null(ROOT)
    parent_slot = nodes.find(*_halves(parent))[row_of]
    parent_slot[depth == 0] = -1
    inner = parent_slot >= 0
    children = children + np.bincount(parent_slot[inner], minlength=len(row_of))
    leaves = leaves + (children == 0)
    saved = saved + (n - 1) * size
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        level = level[inner[level]]
        np.add.at(leaves, parent_slot[level], leaves[level])
        np.add.at(saved, parent_slot[level], saved[level])
    parents = pa.array(conv[parent_slot], pa.int64(), mask=~inner) if len(conv) else pa.array([], pa.int64())
    rows = pa.array(row_of)
    return pa.RecordBatch.from_arrays(
        [column["node"].take(rows), column["parent"].take(rows), *map(pa.array, (conv, depth)), parents]
        + [pa.array(x) for x in (n, children, leaves, saved, ~inner)],
        names=["node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "outer"],
    )


def _shards(limit: int):
    """Rows sorted by ``anchor`` in tables of whole anchors, about ``limit`` nodes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            anchors = np.stack(_halves(batch.column("anchor"))) if batch.num_rows else np.zeros((2, 0), U)
            last = 0
            for start in np.flatnonzero(np.concatenate(([True], (anchors[:, 1:] != anchors[:, :-1]).any(axis=0)))) if batch.num_rows else []:
                full = sum(b.num_rows for b in held) + start - last >= limit
                new = start > 0 or not held or held[-1].column("anchor")[-1] != batch.column("anchor")[0]
                if full and new:
                    held.append(batch.slice(last, start - last))
                    yield sum_up(pa.Table.from_batches(held))
                    held, last = [], start
            held.append(batch.slice(last))
        if sum(b.num_rows for b in held):
            yield sum_up(pa.Table.from_batches(held))
        give_back()

    return run


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rebuilt turns, each conversation's in order, to one row a prefix; ``part`` -1 says that a conversation exists."""
    now, state, pending = None, None, None
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        names = ["conv_id", "depth", "node", "parent", "bytes", "ends"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 6, kinds)], names=names)
        out.clear()
        return rows

    for rows in batches:
        for conv, part, turn, size in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "part", "turn", "bytes"))):
            if conv != now:
                if pending:
                    out.append((*pending, True))
                now, state, pending = conv, None, None
            if part < 0:
                state = ROOT
                pending = (conv, 0, ROOT, None, 0)
            elif state is not None:
                out.append((*pending, False))
                node = hashlib.blake2b(state + turn, digest_size=16).digest()
                pending = (conv, pending[1] + 1, node, state, size)
                state = node
        if len(out) > 20_000:
            yield batch()
    if pending:
        out.append((*pending, True))
    yield batch()


def conversation_prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, ``node``, ``parent``, ``bytes``, ``ends``: each prefix of each rebuilt conversation, from the root on.

    ``node`` is a 128-bit digest of the prefix, ``bytes`` the size of its last text, ``ends``
    says that the conversation ends there. Only digests of the turns are shuffled; a
    conversation's run through one task in order, without being held.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where("conv_id IS NOT NULL").select(
        "conv_id",
        F.col("turn").alias("at"),
        role.alias("role"),
        F.substring(text, 1, 200).alias("head"),
        F.unhex(F.md5(said)).alias("turn"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("at"), "role", "head", "turn")
    rows = rows.select("conv_id", "turn", "bytes", F.row_number().over(order).cast("long").alias("place"))
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_BORROWED
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = rows.where(F.col("place") > borrowed).select("conv_id", F.lit(1).alias("part"), "place", "turn", "bytes")
    exists = rows.where("place = 1").select("conv_id", F.lit(-1).alias("part"), "place", "turn", "bytes")
    near = F.array(*(F.try_add("conv_id", F.lit(k).cast("long")) for k in range(1 - FAMILY, FAMILY)))
    first = rows.where((F.col("place") < MOST_BORROWED) & (F.col("conv_id") % FAMILY == 0))
    first = first.select(F.col("conv_id").alias("of"), F.explode(near).alias("conv_id"), "place", "turn", "bytes")
    first = first.where((base == F.col("of")) & (F.col("place") <= borrowed))
    first = first.select("conv_id", F.lit(0).alias("part"), "place", "turn", "bytes")
    dealt = own.union(exists).union(first).repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return dealt.select("conv_id", "part", "turn", "bytes").mapInArrow(
        _prefixes, "conv_id long, depth long, node binary, parent binary, bytes long, ends boolean"
    )


def _digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, state, done = None, None, []

    def out() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["of", "ends_sha256"]
        )
        done.clear()
        return rows

    for batch in batches:
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node != now:
                if state:
                    done.append((now, state.hexdigest()))
                now, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if len(done) > 5000:
            yield out()
    if state:
        done.append((now, state.hexdigest()))
    yield out()


def ends_digests(paths: DataFrame) -> DataFrame:
    """``of`` (node) and ``ends_sha256`` for nodes at which conversations end.

    Ids are joined in ranges of 4,096 first, so that a node at which many end is a few rows;
    those run through one task in order, into a running digest.
    """
    ids = paths.where("ends").groupBy("node", F.shiftright("conv_id", ID_BITS).alias("range"))
    ids = ids.agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    ids = ids.select("node", "range", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    dealt = ids.repartition("node").sortWithinPartitions("node", "range").select("node", "ids")
    return dealt.mapInArrow(_digest_ids, "of binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The trie of rebuilt conversations, a row for each node, as the columns below.

    A conversation c is the first h turns of conversation c - c % 5 (``%`` has the sign of c),
    h = crc32(c) % 9, then its own turns after its first h. A node is a distinct sequence of
    roles and texts that a conversation starts with, the root the empty one. ``conv_id`` is its
    smallest member, ``depth`` its turns, ``parent_conv_id`` that of its parent (root: null),
    ``n_convs`` its members, ``n_children``, ``n_leaves`` (nodes without children in its
    subtree, itself included), ``saved_tokens`` (over its subtree, members less one times the
    bytes of the last text), ``ends_sha256`` of the ids that end there, ascending, with commas.

    Turns are in order of ``turn``, null first, ties by role and text; repeated rows are turns
    of their own. Null roles and texts are empty. Rows without a conv_id belong to no
    conversation and are left out. Other columns are not used; an empty table has no nodes.

    Subtrees of up to ``shard_nodes`` nodes are added up in tables in memory, many small
    ones together; what is above them, the crown, is a smaller trie that starts with their
    sums, and is cut the same way until one table holds it. So a frequent first turn is
    spread over the subtrees below it.
    """
    paths = kept(conversation_prefixes(turns), "prefixes")
    nodes = paths.groupBy("node", "parent", "depth", "bytes").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    zero = F.lit(0).cast("long")
    nodes = kept(nodes.select("*", *(zero.alias(c) for c in ("n_children", "n_leaves", "saved_tokens"))), "nodes")
    levels = []
    while True:
        more = nodes.limit(shard_nodes + 1).count() > shard_nodes
        if more:
            # Nodes with the same smallest member are the lower end of its path: all count once.
            chains = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), F.max("depth").alias("bottom"))
            own = paths.join(chains, "conv_id").where("depth <= bottom").select("conv_id", "depth", "node", "top", "bottom")
            below = F.sum(F.col("bottom") - F.greatest("depth", "top") + 1)
            crown = small(kept(own.groupBy("node").agg(below.alias("n")).where(F.col("n") > shard_nodes).select("node"), "crown"))
            anchors = own.join(crown, "node", "left_anti").groupBy("conv_id").agg(
                F.min(F.struct("depth", "node")).alias("anchor")
            )
            placed = nodes.join(anchors, "conv_id", "left")
            placed = kept(placed.withColumn("anchor", F.expr("if(depth >= anchor.depth, anchor.node, null)")), "placed")
        else:
            placed = nodes.withColumn("anchor", F.lit(ROOT))
        shards = placed.where("anchor IS NOT NULL").repartition("anchor").sortWithinPartitions("anchor")
        done = kept(shards.mapInArrow(_shards(shard_nodes), SHARD_KIND), "shards")
        if not more:
            levels.append(done)
            break
        nodes = placed.where("anchor IS NULL").drop("anchor")
        # Subtrees hand their sums and number to the parent, and learn its smallest member.
        sums = done.where("outer").groupBy(F.col("parent").alias("of")).agg(
            F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")
        )
        nodes = nodes.join(sums, F.col("node") == F.col("of"), "left")
        added = {"n_children": "c", "n_leaves": "l", "saved_tokens": "s"}
        nodes = kept(
            nodes.withColumns({name: F.col(name) + F.coalesce(F.col(x), zero) for name, x in added.items()}).drop("of", "c", "l", "s"),
            "nodes",
        )
        names = small(kept(nodes.select(F.col("node").alias("of"), F.col("conv_id").alias("named")), "names"))
        done = done.join(names, F.col("outer") & (F.col("parent") == F.col("of")), "left")
        levels.append(done.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "named")).drop("of", "named"))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    every = every.join(ends_digests(paths), F.col("node") == F.col("of"), "left")
    return every.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
