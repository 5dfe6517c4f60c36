import hashlib
from collections import defaultdict

from tests.llm.cases import edge_docs, edge_rows, lower, no_docs

from sampleflow.llm.exact import exact_dedup, exact_groups


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[lower(text)].append((doc_id is not None, doc_id or 0, i))
    out = []
    for text, members in groups.items():
        stay = max(members, key=lambda m: m[:2])
        for m in members:
            out.append((rows[m[2]][0], rows[stay[2]][0], len(members), m == stay, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_agrees_with_plain_groups(spark):
    got = exact_groups(edge_docs(spark), prefix_chars=8, all_hashes=True).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([r[:2] for r in edge_rows()])


def test_hashes_only_of_survivors(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "ABC"), (3, "abd"), (4, "ab")], "doc_id long, text string")
    got = {r.doc_id: r for r in exact_groups(docs, prefix_chars=2).collect()}
    assert got[4].text_sha256 is None and got[3].text_sha256 and not got[1].kept and got[2].kept
    got = {r.doc_id: r for r in exact_groups(docs, prefix_chars=3).collect()}
    assert got[3].text_sha256 is None


def test_rows_that_stay(spark):
    docs = edge_docs(spark)
    got = exact_dedup(docs)
    assert got.columns == docs.columns
    want = [r[0] for r in brute([r[:2] for r in edge_rows()]) if r[3]]
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert exact_dedup(no_docs(spark)).collect() == [] and exact_groups(no_docs(spark)).collect() == []
