"""The registered queries, next to their SQL where there is one, and the pipeline's stages."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
import corpus_pipeline
from sampleflow.llm import queries
from sampleflow.llm.exact import LOWER, UPPER
from sampleflow.llm.graph import components, kept

SF = "/root/testdata/sf0.001"


def test_one_query_for_each():
    assert {int(m[1]) for q in queries.QUERIES if (m := re.match(r"op(\d+)_", q))} == set(range(1, 14))
    assert set(queries.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [q for q in queries.QUERIES if q != "pipeline"])
def test_query(spark, name):
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    verdict, _ = check.compare(spark, con, name, SF)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        last = docs
        docs = kept(stage(spark, docs, SF), name)
        if name == "byte_bpe":
            want = last.groupBy("doc_id", F.sha2("text", 256).alias("decoded_sha256")).count()
            assert docs.groupBy("doc_id", "decoded_sha256").count().exceptAll(want).count() == 0
            assert docs.count() == last.count()
            break
        assert docs.columns == columns
        now = docs.count()
        if name == "language_id":
            assert now >= 0.98 * before
        elif name == "exact_dedup":
            assert now == last.select(F.translate("text", UPPER, LOWER)).distinct().count()
        elif name == "ngram_jaccard_join":
            assert 0.8 * last.count() <= now <= last.count()
    empty = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_components(spark):
    links = [(1, 2), (2, 3), (7, 5), (5, 6), (9, 9), (10, None), (3, 1)] + [(i, i + 1) for i in range(100, 160)]
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    want = {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5} | {i: 100 for i in range(100, 161)}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
