from collections import Counter

from tests.llm.cases import edge_docs, edge_rows, no_docs, words

from sampleflow.llm.quality import LEAST_QUALITY, judge_quality, train_quality

SF = "/root/testdata/sf0.01"


def brute(text):
    w = words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def check(got, rows):
    have = sorted((tuple(r)[:6] + (r.base_failed,) for r in got), key=repr)
    want = []
    for doc_id, text in rows:
        counts = brute(text)
        want.append((doc_id, *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
    assert have == sorted(want, key=repr)


def test_base_counts(spark):
    docs = edge_docs(spark)
    got = judge_quality(docs, None).collect()
    check(got, [r[:2] for r in edge_rows()])
    assert all(r.kept is (not r.base_failed) and r.quality is None for r in got)
    odd = ["", "\n", "a\n\na\n a\na", "x\ny\nx", "#|é é#\n#|é é#\n", "\na\n", "a b c a b c d", "a a a a", "\r\na\r\na\r\n"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    check(judge_quality(docs, None).collect(), list(enumerate(odd)))
    assert judge_quality(no_docs(spark), None).collect() == []


def test_given_documents_and_model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = train_quality(docs, labels)
    judged = judge_quality(docs, model)
    got = judged.collect()
    check(got, [(r.doc_id, r.text) for r in docs.collect()])
    assert all(r.kept == (not r.base_failed and r.quality >= LEAST_QUALITY) for r in got)
    held = judged.join(labels, "doc_id").select(judged.quality.alias("p"), labels.quality.alias("y"), "base_failed", "kept").collect()
    good, bad = [r for r in held if r.y == 1], [r for r in held if r.y == 0]
    assert sum(r.kept for r in good) >= 0.9 * sum(not r.base_failed for r in good)
    # A random good row scores above a random bad one nearly always.
    wins = sum(g.p > b.p for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.9
    assert abs(sum(r.p for r in held) / len(held) - len(good) / len(held)) < 0.1
    again = train_quality(docs.repartition(3), labels.repartition(3))
    assert (again.weights == model.weights).all()


def test_no_labels(spark):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 7)], "doc_id long, quality int")
    assert train_quality(edge_docs(spark), labels) is None
    assert train_quality(edge_docs(spark), labels.where("false")) is None
