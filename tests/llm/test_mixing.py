from collections import defaultdict
from functools import reduce
from itertools import product

import pytest
from pyspark.sql import functions as F
from tests.llm.cases import edge_docs, edge_rows, no_docs, words

from sampleflow.llm.mixing import mix_sources, repeated, water_fill


def fill(sizes, weights, cap):
    """Clamp and reshare until no share is above its cap."""
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_ = sum(weights[s] for s in sizes if s not in full)
        share = {s: cap * sizes[s] if s in full else left * weights[s] / open_ for s in sizes}
        over = {s for s in sizes if s not in full and share[s] > cap * sizes[s]}
        if not over:
            return share
        full |= over


def test_targets_and_rows(spark):
    rows = [(r[0], r[1], r[3]) for r in edge_rows()] + [(1000 + i, "tiny word", "a") for i in range(3)] + [(2000, "", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words(text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: 1 + i % 3 for i, s in enumerate(order)}
    want = fill(sizes, weights, 3)
    got = mix_sources(docs).collect()
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.repeats <= 3
        taken[r.source] += r.size * r.repeats
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mix_sources(docs.repartition(7)).collect()
    key = lambda r: repr(r)
    assert sorted(got, key=key) == sorted(again, key=key)


def test_rows_come_as_often(spark):
    docs = edge_docs(spark)
    out = repeated(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.repeats for r in mix_sources(docs).collect())


def test_empty(spark):
    assert mix_sources(no_docs(spark)).collect() == [] and repeated(no_docs(spark)).collect() == []
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.repeats) for r in mix_sources(docs).collect()] == [(0.0, 0), (0.0, 0)]


def test_ties(spark):
    """Every small table of sources, a null one among them, against the plain loop."""
    cases = [sizes for n in (2, 3, 4) for sizes in product(range(4), repeat=n) if any(sizes)][::8]
    frames, wants = [], []
    for sizes in cases:
        names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
        weights = {s: 1 + i % 3 for i, s in enumerate(names)}
        wants.append(fill(dict(zip(names, sizes)), weights, 3))
        frames.append([(s, size, weights[s]) for s, size in zip(names, sizes)])
    for few in range(0, len(cases), 40):
        parts = [
            water_fill(spark.createDataFrame(rows, "source string, source_size long, weight long").coalesce(1)).withColumn("case", F.lit(few + i))
            for i, rows in enumerate(frames[few : few + 40])
        ]
        for r in reduce(lambda a, b: a.union(b), parts).collect():
            assert abs(r.target - wants[r.case][r.source]) < 1e-9, (cases[r.case], r)


@pytest.mark.parametrize("texts", [lambda i: "one two three four five six seven eight nine ten", lambda i: f"w{i} " * 10])
def test_one_id(spark, texts):
    """A source that is to give 2/3 of 100 rows, all of one id, gives them to within a row."""
    rows = [(5, texts(i), "a") for i in range(100)] + [(i, "w " * 10, "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mix_sources(docs).collect()
    assert len(got) == 200 and {r.repeats for r in got if r.source == "a"} == {0, 1}
    assert abs(sum(r.size * r.repeats for r in got if r.source == "a") - 2000 / 3) <= 10
    assert repeated(docs).where("source = 'a'").count() == sum(r.repeats for r in got if r.source == "a")
