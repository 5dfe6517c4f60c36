"""The conversation trie against one of Python dicts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sampleflow.llm.prefix_trie import NodeTable, prefix_trie

KIND = "conv_id long, turn long, role string, text string, node binary, depth long, n_convs long"


def plain(rows):
    said = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv is not None:
            said.setdefault(conv, []).append((role or "", text or ""))
    built = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(said.get(base, [])[:h] + said[c][h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        sums[node] = (sum(sums[b][0] for b in below) or 1, saved + sum(sums[b][1] for b in below))
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), *sums[node],
            hashlib.sha256(",".join(map(str, sorted(c for c in m if built[c] == node))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def got(df):
    return sorted(tuple(r) for r in df.collect())


def made_up(seed=1, n=160, most=7):
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(-40, 300), n):
        same = pick.random() < 0.5
        for t in range(pick.randint(1, most)):
            rows.append((c, t, pick.choice(["user", "assistant"]) if not same else "user", f"hello {t}" if same else pick.choice(["é", "b", "cc", "日本"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, b"x", 1, 2) for r in rows], KIND).repartition(3)


@pytest.mark.parametrize("nodes", [4, 60, 1 << 17])
def test_plain(spark, nodes):
    rows = made_up()
    assert got(prefix_trie(frame(spark, rows), nodes)) == plain(rows)


def test_edges(spark):
    rows = [
        (0, 1, "user", "b"), (0, None, "user", "a"), (0, None, None, None), (0, 0, "user", None), (0, 0, "user", None),
        (1, 3, "", ""), (1, 3, "b", "x"), (1, 3, "a", "x"), (1, 3, "a", "x"), (2, 0, "user:", "x"), (3, 0, "user", ":x"),
        (None, 0, "user", "no conversation"), (7, 0, "user", "base is absent"), (10**15, 0, "r", "t"), (-3, 2, "r", "t"),
        (2**63 - 1, 0, "r", "t"), (-(2**63), 0, "r", "t"), (4, 0, "user", "long " * 100_000),
    ] + [(20, t, "user", f"{t}") for t in range(300)] + [(21, t, "user", f"{t}") for t in range(300)]
    for nodes in (120, 1 << 17):
        assert got(prefix_trie(frame(spark, rows), nodes)) == plain(rows)
    assert prefix_trie(frame(spark, rows).where("false")).collect() == []
    assert got(prefix_trie(frame(spark, [(6, 0, "r", "t")]))) == plain([(6, 0, "r", "t")])


@settings(max_examples=60, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 3)), max_size=300))
def test_slots(keys):
    high, low = (np.array([k[i] for k in sorted(keys)], np.uint64) for i in (0, 1))
    table = NodeTable(high, low)
    assert sorted(table.slots.tolist()) == list(range(len(keys)))
    assert (table.find(high, low) == table.slots).all()
    assert (table.find(high, low + np.uint64(4)) == -1).all()
