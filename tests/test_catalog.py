"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import catalog
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    verdict, _ = check.compare(spark, con, name, SF)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "split_id", "sample_idx", "temperature", "response", "thinking_text"]
    assert df.count() > 0


def test_only_training_lacks_sql():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"mlp_train"}
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
