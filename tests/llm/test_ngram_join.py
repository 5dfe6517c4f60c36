import pytest
from tests.llm.cases import edge_docs, edge_rows, lower, no_docs, words

from sampleflow.llm.ngram_join import _cells, _may_link, _row_key, near_dedup, ngram_classes, ngram_links, prefix_lengths

import numpy as np


def grams(text, size):
    w = words(lower(text))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}


def brute(rows, size, percent):
    """Rows of (doc_id, set size, component_id), all pairs compared; how many components there are."""
    sets = [grams(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    found = ((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))
    return sorted(found, key=repr), len({root(i) for i in range(len(rows))})


@pytest.mark.parametrize("size,percent,blocks", [(3, 90, {}), (5, 80, {}), (2, 60, {"block_sets": 2, "block_grams": 300, "most_partners": 2})])
def test_agrees_with_all_pairs(spark, size, percent, blocks):
    got = sorted((tuple(r) for r in ngram_classes(edge_docs(spark), size, percent, **blocks).collect()), key=repr)
    assert got == brute([r[:2] for r in edge_rows()], size, percent)[0]


def test_one_row_of_each_component_stays(spark):
    docs = edge_docs(spark)
    got = near_dedup(docs, 5, 80)
    assert got.columns == docs.columns
    stay = [(r.doc_id, r.text) for r in got.collect()]
    found, components = brute([r[:2] for r in edge_rows()], 5, 80)
    assert len(stay) == components
    assert {c for _, n, c in found if n and c is not None} <= {d for d, _ in stay}


def test_cells_bound_the_difference():
    random = np.random.default_rng(2)
    sizes = [5, 900, 1_950, 2_050, 2_100, 63_000, 66_000]
    sets = [np.unique(random.integers(0, 1 << 63, n).astype(np.uint64)) for n in sizes]
    sets += [np.unique(np.append(s[: len(s) - len(s) // 30], random.integers(0, 1 << 63, len(s) // 30).astype(np.uint64))) for s in sets]
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    raw = [_cells(s, np.array([len(s)]))[0] for s in sets]
    assert _cells(np.concatenate(sets), n) == raw
    labels = _may_link(n, raw, 90, 100)
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            linked = 100 * both >= 90 * (n[a] + n[b] - both)
            assert (labels[a] == labels[b] >= 0) == linked  # unlike sets of random numbers are all told apart


def test_empty_table(spark):
    assert ngram_classes(no_docs(spark)).collect() == [] and near_dedup(no_docs(spark)).collect() == []


def test_prefixes_meet():
    n = np.arange(0, 500)
    for percent in (60, 80, 90):
        length = prefix_lengths(n, percent)
        need = -(-percent * n // 100)
        # A different set that is similar enough shares at least ``need`` of the n-grams, so one of the first n - need + 1.
        assert ((length == 0) | (length == n - need + 1)).all()
        assert (length[100 * n >= percent * (n + 1)] > 0).all()


@pytest.mark.parametrize("size,percent,blocks", [(3, 90, {}), (2, 60, {"block_sets": 2, "block_grams": 300, "most_partners": 2})])
def test_links_are_counted(spark, size, percent, blocks):
    pick = np.random.default_rng(4)
    near = [" ".join(f"w{k if pick.random() > 0.02 else 1000 + pick.integers(50)}" for k in range(60)) for _ in range(25)]
    rows = [r[:2] for r in edge_rows()] + [(1000 + i, t) for i, t in enumerate(near + near[:3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = [grams(t, size) for _, t in rows]
    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
    want = sorted(((d, len(s), n) for (d, _), s, n in zip(rows, sets, links)), key=repr)
    got = ngram_links(docs, size, percent, **blocks).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in got), key=repr) == want
    assert sorted((tuple(r)[:3] for r in got), key=repr) == brute(rows, size, percent)[0]
    assert max(links) > 3


def test_row_keys_tell_null_from_empty(spark):
    rows = [(None, None), (None, ""), (1, None), (1, ""), (1, "1"), (11, ""), (1, ":"), (None, "null"), (1, "1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = [bytes(r.k) for r in docs.select(_row_key(docs.doc_id, docs.text).alias("k")).collect()]
    assert {len(k) for k in keys} == {16} and len(set(keys)) == 8 and keys[4] == keys[8]
