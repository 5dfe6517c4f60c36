import zlib
from collections import Counter, defaultdict

import pytest
from tests.llm.cases import edge_docs, edge_rows, no_docs

from sampleflow.llm.sharding import balanced_shards


def checked(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - (min(counts.values()) if len(counts) == shards else 0) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edges(spark):
    got = balanced_shards(edge_docs(spark), shards=7).collect()
    checked(got, 7)
    want = sorted((repr(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in edge_rows())
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in got) == want
    assert balanced_shards(no_docs(spark)).collect() == []


@pytest.mark.parametrize("copies", [2, 5])
def test_equal_texts_meet(spark, copies):
    rows = [(i, f"text {i // copies}" if i < 600 else f"alone {i}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = balanced_shards(docs, shards=10).collect()
    checked(got, 10)
    shards = defaultdict(set)
    for r in got:
        shards[rows[r.doc_id][1]].add(r.shard)
    together = sum(len(s) == 1 for t, s in shards.items() if t.startswith("text"))
    assert together >= 0.95 * (600 // copies)
    again = balanced_shards(docs.repartition(9), shards=10).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_all_rows_linked_and_one_large_group(spark):
    rows = [(i, "all the same" if i < 300 else f"pair {i // 2}") for i in range(900)]
    got = balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=9).collect()
    checked(got, 9)
    shards = defaultdict(Counter)
    for r in got:
        shards[rows[r.doc_id][1]][r.shard] += 1
    pairs = [s for t, s in shards.items() if t.startswith("pair")]
    assert sum(len(s) == 1 for s in pairs) > 0.6 * len(pairs)  # by chance it would be a ninth
    # With no room to spare moves only swap; still most pairs within the group become uncut, compared with an even spread.
    assert sum(n * n for n in shards["all the same"].values()) > 1.05 * 300**2 / 9
