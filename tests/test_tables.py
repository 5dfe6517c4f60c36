import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sampleflow.operators import evaluate
from sampleflow.operators import responses as ops
from sampleflow.operators import telemetry
from sampleflow.operators.embeddings import vector_statistics
from sampleflow.operators.select import assign_endpoint, distinct_texts, output_skeleton, shortest_prompt
from sampleflow.sources.tables import check_columns, describe_schema

REQUEST = "latency DOUBLE, success BOOLEAN, timestamp TIMESTAMP, model_endpoint STRING, batch_id INT"
START = datetime(2024, 1, 1)


def positioned(spark, values, name="response"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"row_pos BIGINT, {name} STRING")


def test_attach_needs_equal_counts(spark):
    rows = positioned(spark, ["a", "b", "c"], "q")
    got = ops.attach_responses(rows, positioned(spark, ["1", None, "3"])).orderBy("row_pos").collect()
    assert [(r.q, r.response) for r in got] == [("a", "1"), ("b", None), ("c", "3")]
    for wrong in (["1", "2"], ["1", "2", "3", "4"]):
        with pytest.raises(PySparkException, match="differ in number"):
            ops.attach_responses(rows, positioned(spark, wrong)).collect()


def test_update_and_expand_at_indices(spark):
    rows = positioned(spark, ["a", "b", "c"], "q")
    new = spark.createDataFrame([(1, "x")], "row_pos BIGINT, response STRING")
    got = ops.update_responses(rows, new).orderBy("row_pos").collect()
    assert [r.response for r in got] == [None, "x", None]
    given = spark.createDataFrame([(0, 2, ["u", "v"]), (1, 0, [])], "ord INT, row_pos BIGINT, responses ARRAY<STRING>")
    got = ops.expand_at_indices(rows, given).collect()
    assert [(r.row_pos, r.q, r.response) for r in got] == [(2, "c", "u"), (2, "c", "v")]


def test_expand_drops_empty_lists(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, ["c"]), (4, None)], "id INT, r ARRAY<STRING>")
    got = sorted((r.id, r.sample_idx, r.response) for r in ops.expand_responses(df, "r").collect())
    assert got == [(1, 0, "a"), (1, 1, "b"), (3, 0, "c")]


@pytest.mark.parametrize("n", [1, 3, 10])
def test_flatten_undoes_group(spark, n):
    values = ["r0", "", None, "r3", "r4", "r5", "r6"]
    grouped = ops.group_responses(positioned(spark, values).repartition(3), n)
    lists = [r.responses for r in grouped.orderBy("group_pos").collect()]
    assert lists == [values[i : i + n] for i in range(0, 7, n)]
    flat = ops.flatten_responses(grouped).orderBy("group_pos", "item_pos").collect()
    assert [r.response for r in flat] == values


def test_counts_and_remaining(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "id INT, sample_idx INT")
    got = {r.id: r.complete for r in ops.response_count_check(df, "id", 2).collect()}
    assert got == {1: True, 2: False}
    assert ops.total_count_check(df, 3).first().complete
    todo = spark.range(4).select(F.col("id").cast("int"))
    assert sorted(r.id for r in ops.resume_remaining(todo, df, ["id"]).collect()) == [0, 3]
    assert tuple(ops.merge_stats(df, ["id"]).first()) == (3, 2, 2, 2)
    assert ops.merge_stats(df.limit(0), ["id"]).first().total_rows == 0


def test_shortest_prompt_first_wins(spark):
    rows = positioned(spark, ["abc", "zz", "aa", None, "y" * 5], "q")
    assert shortest_prompt(rows, "q", ["row_pos"]).first()[0] == "zz"
    assert len(shortest_prompt(positioned(spark, ["y" * 1_000_000], "q"), "q", ["row_pos"]).first()[0]) == 1_000_000


def test_columns(spark):
    df = spark.createDataFrame([("a", 1)], "q STRING, n INT")
    assert [tuple(r) for r in describe_schema(df).collect()] == [("q", "string"), ("n", "int")]
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        check_columns(df, "x", ["q", "y", "x"])
    assert output_skeleton(df, "q", "response", ["n", "gone", "q"]).columns == ["q", "n", "response"]
    with pytest.raises(ValueError):
        distinct_texts(df, "gone")
    assert assign_endpoint(df, ["e1", "e2", "e3"], "n").first().endpoint == "e1"


def index_percentile(values, p):
    return sorted(values)[int(len(values) * p)]


@pytest.mark.parametrize("n", [1, 2, 20, 4000])
def test_index_percentiles(spark, n):
    rng = random.Random(n)
    kinds = {
        "wide": [rng.expovariate(0.01) for _ in range(n)],
        "ties": [float(rng.randrange(3)) for _ in range(n)],
        "narrow": [1.0 + rng.random() * 1e-9 for _ in range(n)],
        "one": [7.0] * n,
        None: [rng.random() for _ in range(n)],
    }
    rows = [(k, v) for k, values in kinds.items() for v in values]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE").repartition(5)
    marks = (0.0, 0.5, 0.95, 0.99)
    got = {(r.k, r.p): r.v for r in telemetry.index_percentiles(df, "v", marks, ["k"]).collect()}
    assert got == {(k, p): index_percentile(values, p) for k, values in kinds.items() for p in marks}
    got = {r.p: r.v for r in telemetry.index_percentiles(df, "v", marks).collect()}
    assert got == {p: index_percentile([v for _, v in rows], p) for p in marks}


def requests(spark, n=40):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        endpoint = [None, "", "a", "b"][i % 4]
        rows.append((round(rng.random() * 3, 6), i % 5 != 0, START + timedelta(seconds=i), endpoint, i // 7))
    return rows, spark.createDataFrame(rows, REQUEST)


def test_request_and_endpoint_summaries(spark):
    rows, df = requests(spark)
    latencies = [r[0] for r in rows]
    got = telemetry.request_summary(df).first().asDict()
    end = max(r[2] + timedelta(seconds=r[0]) for r in rows)
    duration = (end - START).total_seconds()
    want = {
        "total_requests": 40, "successful_requests": 32, "failed_requests": 8, "success_rate": 0.8,
        "average_latency": statistics.mean(latencies), "p50_latency": index_percentile(latencies, 0.5),
        "p95_latency": index_percentile(latencies, 0.95), "p99_latency": index_percentile(latencies, 0.99),
        "total_duration": duration, "overall_throughput": 40 / duration,
    }
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    together = telemetry.telemetry_summary(df)
    assert together["batch_summary"].first().total_batches == 6
    got = {r.model_endpoint: r for r in together["endpoint_summary"].collect()}
    assert set(got) == {"a", "b"}
    for name, row in got.items():
        mine = [r for r in rows if r[3] == name]
        assert row.total_requests == 10
        assert row.success_rate == sum(r[1] for r in mine) / 10
        assert row.p95_latency == index_percentile([r[0] for r in mine], 0.95)


def test_empty_summaries_are_zero(spark):
    empty = spark.createDataFrame([], REQUEST)
    assert all(v == 0 for v in telemetry.request_summary(empty).first())
    assert telemetry.endpoint_summary(empty).collect() == []
    assert all(v == 0 for v in telemetry.batch_summary(telemetry.batch_rollup(empty)).first())
    assert all(v == 0 for v in telemetry.column_statistics(empty, "latency").first())
    assert all(v == 0 for v in telemetry.run_stats(empty, ["batch_id"]).first())


def test_batches(spark):
    rows, df = requests(spark)
    batches = telemetry.batch_rollup(df)
    got = {r.batch_id: r for r in telemetry.batch_metrics(batches).collect()}
    for b, row in got.items():
        mine = [r for r in rows if r[4] == b]
        seconds = (max(r[2] + timedelta(seconds=r[0]) for r in mine) - min(r[2] for r in mine)).total_seconds()
        assert row.batch_size == len(mine) and row.successful_requests == sum(r[1] for r in mine)
        assert math.isclose(row.total_latency, seconds) and math.isclose(row.throughput, len(mine) / seconds)
        assert math.isclose(row.average_latency, seconds / len(mine))
    summary = telemetry.batch_summary(batches).first()
    assert summary.total_batches == 6
    assert math.isclose(summary.average_throughput, statistics.mean(r.throughput for r in got.values()))


def test_batch_ratios_without_denominator(spark):
    schema = (
        "batch_id INT, batch_size INT, successful_requests INT, failed_requests INT, "
        "total_latency DOUBLE, start_time TIMESTAMP, end_time TIMESTAMP"
    )
    rows = [(1, 0, 0, 0, 0.0, START, START), (2, 5, 0, 5, 2.0, START + timedelta(1), START)]
    got = {r.batch_id: r for r in telemetry.batch_metrics(spark.createDataFrame(rows, schema)).collect()}
    assert (got[1].success_rate, got[1].average_latency, got[1].throughput) == (0, 0, 0)
    assert (got[2].success_rate, got[2].average_latency, got[2].throughput) == (0, 0.4, 0)


def test_counters_on_a_stream(spark, folder):
    _, df = requests(spark)
    df.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
    query = (
        telemetry.request_counters(stream).writeStream.format("memory").queryName("counters")
        .outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("counters").first().successful_requests == 32


def test_statistics(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v DOUBLE")
    got = telemetry.column_statistics(df, "v").first()
    assert got["count"] == 3 and math.isclose(got["std"], statistics.stdev([1, 2, 4]))
    one = telemetry.column_statistics(df.limit(1), "v").first()
    assert one["count"] == 1 and one["std"] == 0
    vectors = spark.createDataFrame([([1.0, 2.0],), ([3.0, 6.0],)], "embedding ARRAY<FLOAT>")
    got = vector_statistics(vectors).first()
    assert (got.vectors, got.dim, got["mean"], got["min"], got["max"]) == (2, 2, 3.0, 1.0, 6.0)
    assert math.isclose(got.std, statistics.pstdev([1, 2, 3, 6]))


def answers(spark):
    rows = [
        (0, "p1", "1", "so \\boxed{1}"), (1, "p1", "2", "\\boxed{2}"), (2, "p1", "1", "none"), (3, "p1", "1", None),
        (4, "p2", "0.5", "\\boxed{\\frac{1}{2}}"), (5, "p3", "3", "\\boxed{4}"),
    ]
    return spark.createDataFrame(rows, "id INT, problem STRING, expected_answer STRING, response STRING")


def test_pass_rate_uses_the_first_expected_answer(spark):
    rates = evaluate.pass_rate(answers(spark).repartition(4), ["id"])
    got = {r.problem: (r.num_pass, r.num_total, r.pass_rate) for r in rates.collect()}
    assert got == {"p1": (1, 4, 0.25), "p2": (1, 1, 1.0), "p3": (0, 1, 0.0)}


def test_pass_rate_of_one_large_problem(spark):
    rows = spark.range(20000).select(
        "id",
        F.lit("hot").alias("problem"),
        F.lit("7").alias("expected_answer"),
        F.concat(F.lit("\\boxed{"), (F.col("id") % 10000).cast("string"), F.lit("}")).alias("response"),
    )
    got = evaluate.pass_rate(rows, ["id"]).first()
    assert (got.num_pass, got.num_total) == (2, 20000)


def test_join_with_embeddings(spark):
    vectors = spark.createDataFrame([("p1", [1.0]), ("p2", [2.0])], "text STRING, embedding ARRAY<FLOAT>")
    rates = evaluate.pass_rate(answers(spark), ["id"])
    got = evaluate.training_set(rates, vectors).collect()
    assert sorted((r.embedding[0], r.target) for r in got) == [(1.0, 0.25), (2.0, 1.0)]
    assert evaluate.join_embedding(rates, vectors, strict=False).count() == 2
    with pytest.raises(PySparkException, match="no embedding"):
        evaluate.join_embedding(rates, vectors).collect()
