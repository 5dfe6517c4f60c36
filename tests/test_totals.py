"""Running totals over a stream, and what a run observes of itself, against the batch operators."""

from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sampleflow.operators import responses as ops
from sampleflow.operators.telemetry import batch_rollup, observed_stats, request_counters
from sampleflow.streaming import incremental, totals

KIND = "batch_id BIGINT, latency DOUBLE, success BOOLEAN, timestamp TIMESTAMP"


def requests(spark, n):
    start = pd.Timestamp("2024-01-01")
    rows = [
        (i % 5 if i % 11 else None, None if i % 13 == 0 else (i * 37 % 100) / 7, None if i % 17 == 0 else i % 3 > 0,
         None if i % 19 == 0 else (start + pd.Timedelta(microseconds=i * 1_234_567)).to_pydatetime())
        for i in range(n)
    ]
    return spark.createDataFrame(rows, KIND)


def plain(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_totals_after_stops(spark, folder):
    """Every stop and start leaves what the batch operators say of all that came in, and no file counts twice."""
    df = requests(spark, 600)
    for by, read, want in (([], totals.request_totals, request_counters), (["batch_id"], totals.batch_totals, batch_rollup)):
        base = f"{folder}/{len(by)}"
        for lot in range(3):
            part = df.where(F.pmod(F.xxhash64("timestamp", "latency"), F.lit(3)) == lot)
            incremental.stage_prompts(part, f"{base}/in", rows_per_file=40)
            for _ in range(2):  # the second run finds nothing new
                stream = incremental.read_prompt_stream(spark, f"{base}/in", df.schema, files_per_batch=3)
                totals.running_totals(stream, by, f"{base}/out", f"{base}/state", salts=3)
            assert plain(read(spark, f"{base}/out")) == plain(want(spark.read.schema(df.schema).parquet(f"{base}/in")))


def test_totals_of_nothing(spark, folder):
    incremental.stage_prompts(requests(spark, 5).limit(0), f"{folder}/in", 10)
    stream = incremental.read_prompt_stream(spark, f"{folder}/in", KIND)
    totals.running_totals(stream, [], f"{folder}/out", f"{folder}/state")
    assert tuple(totals.request_totals(spark, f"{folder}/out").first())[:2] == (0, 0)


def test_observed_stats_of_nothing():
    assert observed_stats({"total_items": 0, "total_responses": 0, "first": None, "last": None})["items_per_second"] == 0.0


@pytest.mark.parametrize("bits", [1, 40, 1 << 26])
@pytest.mark.parametrize("kind", ["BIGINT", "STRING", "DOUBLE"])
def test_remaining_is_exact(spark, bits, kind):
    """Whatever the filter lets through, the rows are those of the plain anti join."""
    df = spark.range(3000).select(F.when(F.col("id") % 50 != 0, F.col("id").cast(kind)).alias("k"), (F.col("id") % 2).alias("j"), "id")
    for share in (0, 1, 99):
        done = df.where(F.col("id") % 100 < share).select("k", "j")
        got = ops.resume_remaining(df, done, ["k", "j"], bits)
        want = df.join(done, ["k", "j"], "left_anti")
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()) and set(got.columns) == set(df.columns)
    other = df.select(F.col("k").cast("int").alias("k"), "j", "id").where("k < 10")
    assert ops.resume_remaining(df, other, ["k", "j"]).count() == df.join(other.select("k", "j"), ["k", "j"], "left_anti").count()


def test_state_has_few_partitions(spark, folder):
    """A trigger opens as many partitions of the state as its groups or the cores need, whatever a shuffle has."""
    df, setting = requests(spark, 60), "spark.sql.shuffle.partitions"
    given = spark.conf.get(setting)
    spark.conf.set(setting, "40")
    try:
        incremental.stage_prompts(df, f"{folder}/in", rows_per_file=20)
        for by, most in (([], 3), (["batch_id"], 2 * spark.sparkContext.defaultParallelism)):
            base = f"{folder}/{len(by)}"
            totals.running_totals(incremental.read_prompt_stream(spark, f"{folder}/in", df.schema), by, f"{base}/out", f"{base}/state", salts=3)
            assert len(list(Path(f"{base}/state/state/0").glob("[0-9]*"))) == most
        assert spark.conf.get(setting) == "40"
    finally:
        spark.conf.set(setting, given)
