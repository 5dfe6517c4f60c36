import zlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tests.llm.cases import edge_docs, edge_rows, no_docs

import sampleflow.llm.language as language
from sampleflow.llm.language import FILTERS, WIDTHS, WINDOW, calibrated, held_out, identify, known_language, softmax, train, train_network

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = train_network(docs)
    found = identify(docs, network).join(docs.select("doc_id", "lang"), "doc_id").withColumn("out", held_out(F.col("doc_id")))
    rows = found.where("out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    again = train_network(docs.repartition(5))
    assert all(np.array_equal(a, b) for a, b in zip(network.filters.values(), again.filters.values()))
    strict = train_network(docs, other=True)
    assert known_language(docs, strict).count() >= 0.99 * docs.count()


def test_many_languages(spark):
    """More languages than a driver would list by hand, rows that repeat one id, and one row many times."""
    rows = []
    for lang in range(300):
        letters = [chr(0x100 + (lang * 7 + k) % 330) for k in range(6)]
        rows += [(lang * 20 + i, " ".join(letters[(i + k * k) % 6] * 3 for k in range(30)), f"l{lang}") for i in range(8)]
    rows += [(1, f"one id, another text {i}", "l0") for i in range(2000)] + [(2, "one row", "l0")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    network = train_network(docs)
    assert len(network.langs) == 300
    found = identify(docs, network).collect()
    assert len(found) == len(rows) and {r.lang_pred for r in found} <= set(network.langs)


def test_tables_are_the_convolution():
    random = np.random.default_rng(1)
    windows = random.integers(0, 256, (5, WINDOW)).astype(np.uint8)
    network = train(windows, np.array([0, 1, 0, 1, 1]), ["a", "b"], steps=3, batch=4)
    embedded, pooled = network.embed[windows], []
    for w in WIDTHS:
        k = network.filters[w].reshape(w, -1, FILTERS)
        reply = sum(embedded[:, j : WINDOW - w + 1 + j] @ k[j] for j in range(w))
        pooled.append(np.maximum(reply.max(axis=1) + network.biases[w], 0))
    want = np.concatenate(pooled, axis=1) @ network.last + network.last_bias
    assert np.allclose(network.logits(windows, network.tables()), want, atol=1e-4)
    assert np.allclose(softmax(want).sum(axis=1), 1)


def test_edges(spark):
    docs = edge_docs(spark)
    network = train_network(docs)
    got = identify(docs, network).collect()
    assert len(got) == len(edge_rows())
    texts = {(r[0], r[1]) for r in edge_rows()}
    no_letters = {d for d, t in texts if t is None or not any(c.isalpha() for c in t)}
    assert {r.doc_id for r in got if r.lang_pred == "und"} == no_letters
    stay = known_language(docs, network, 0.0)
    assert stay.columns == docs.columns and stay.count() == sum(r.lang_pred != "und" for r in got)
    assert train_network(no_docs(spark)) is None and identify(no_docs(spark), None).collect() == []
    assert {r.lang_pred for r in identify(docs, None).collect()} == {"und"}


def test_unlearned_scripts_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    strange = ["Съешь же ещё этих мягких французских булок да выпей чаю " * 9, "色は匂へど散りぬるを我が世誰ぞ常ならむ" * 9, "Привет, мир", "ξεσκεπάζω τὴν ψυχοφθόρα βδελυγμία " * 5]
    random = np.random.default_rng(5)
    strange += ["".join(random.choice(list("bcdfghjklmnpqrstvwxzQZX"), 400)), "".join(random.choice(list("xq zkjvw"), 300))]
    mixed = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(strange)], docs.schema)
    for langs in (["de", "en", "fr", "es"], ["en", "fr"], ["en"]):
        own = docs.where(F.col("lang").isin(langs))
        network = calibrated(own, train_network(own, other=True))
        stay = {r.doc_id for r in known_language(own.union(mixed), network).where("doc_id < 0").collect()}
        assert not stay, (langs, [strange[-1 - i] for i in stay])
        assert known_language(own, network).count() >= 0.99 * own.count()


def test_margin_of_all_held_out_texts(spark, monkeypatch):
    """However few documents are fitted, the margin is that of all held-out texts, equal ones once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    network = train_network(docs, other=True)
    # The other class ahead, so that margins are positive.
    ahead = replace(network, last_bias=network.last_bias + np.where(np.arange(len(network.langs)) == len(network.langs) - 1, 50, 0))
    monkeypatch.setattr(language, "MOST_ROWS", 8)
    held = {r.text for r in docs.where(held_out(F.col("doc_id")) & F.col("lang").isNotNull()).collect() if any(c.isalpha() for c in r.text or "")}
    found = sorted(language.margins(pa.array(sorted(held)), ahead, ahead.tables()))
    got = calibrated(docs.union(docs).repartition(5), ahead).least
    assert got > 0 and np.isclose(got, found[int(len(found) * (1 - language.REJECTED))], atol=1e-3)
