import hashlib

import pytest
from tests.llm.cases import edge_docs, edge_rows, no_docs, words

from sampleflow.llm.substrings import remove_repeats

LAST = (1 << 63) - 1


def brute(rows, size):
    """Rows of (doc_id, words, removed, digest); windows compared one by one, rows without ties of ids."""
    split = [words(t) for _, t in rows]
    first = {}
    for i in sorted(range(len(rows)), key=lambda i: LAST if rows[i][0] is None else rows[i][0]):
        for s in range(len(split[i]) - size + 1):
            first.setdefault(tuple(split[i][s : s + size]), (i, s))
    out = []
    for i, w in enumerate(split):
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] != (i, s):
                gone.update(range(s, s + size))
        text = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((rows[i][0], len(w), len(gone), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def single(rows):
    """Rows without repeated ids, for which the first occurrence is plain."""
    seen, out = set(), []
    for r in rows:
        if r[0] not in seen:
            out.append(r)
            seen.add(r[0])
    return out


@pytest.mark.parametrize("size,block", [(20, 1 << 20), (20, 3000), (6, 2000), (3, 1 << 20)])
def test_agrees_with_all_windows(spark, size, block):
    rows = single(edge_rows())
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = sorted((tuple(r) for r in remove_repeats(docs, size, block_bytes=block, with_text=False).collect()), key=repr)
    assert got == brute([r[:2] for r in rows], size)


def test_repeated_rows_keep_their_passages_once(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text)], "doc_id long, text string")
    got = remove_repeats(docs, 20).collect()
    assert sorted(r.n_removed for r in got) == [0, 60, 60, 60]
    assert sorted(r.kept_text for r in got) == ["", "", "", text]


def test_edges(spark):
    docs = edge_docs(spark)
    assert remove_repeats(docs, 20).count() == docs.count()
    assert remove_repeats(no_docs(spark), 20).collect() == []
