"""Request and batch summaries; ``events`` stand in for request telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register, rounded
from sampleflow.operators import telemetry as ops
from sampleflow.sources.storage import work_dir
from sampleflow.streaming import incremental, totals

_REQUESTS = """
    WITH r AS (
        SELECT event_id, user_id, value AS latency, event_id % 7 <> 0 AS success, ts AS timestamp,
               ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS ended,
               CASE WHEN event_type = 'error' THEN '' WHEN event_type <> 'signup' THEN event_type END AS model_endpoint,
               event_id // 100 AS batch_id
        FROM events
    )
"""


def requests(spark, sf):
    """Signups have no endpoint and errors an empty one; every seventh request failed."""
    kind = F.col("event_type")
    endpoint = F.when(kind == "error", "").when(kind != "signup", kind)
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id",
        "user_id",
        F.col("value").alias("latency"),
        (F.col("event_id") % 7 != 0).alias("success"),
        F.col("ts").alias("timestamp"),
        endpoint.alias("model_endpoint"),
        F.floor(F.col("event_id") / 100).alias("batch_id"),
    )


_SECONDS = "(date_diff('microsecond', {0}, {1}) / 1e6)"
_AT = "(list_sort(list(latency)))[CAST(floor(count(*) * {0}::DOUBLE) AS BIGINT) + 1]"


@register(
    _REQUESTS
    + f"""
    , s AS (SELECT count(*) AS n, count(*) FILTER (success) AS ok, avg(latency) AS mean,
        {_AT.format(0.5)} AS p50, {_AT.format(0.95)} AS p95, {_AT.format(0.99)} AS p99,
        {_SECONDS.format("min(timestamp)", "max(ended)")} AS secs FROM r)
    SELECT n AS total_requests, ok AS successful_requests, n - ok AS failed_requests,
           round(ok / n, 6) AS success_rate, round(mean, 6) AS average_latency,
           p50 AS p50_latency, p95 AS p95_latency, p99 AS p99_latency,
           round(secs, 6) AS total_duration, round(n / secs, 6) AS overall_throughput
    FROM s
"""
)
def request_summary(spark, sf):
    return rounded(ops.request_summary(requests(spark, sf)))


@register(
    "WITH g AS (SELECT event_type, list_sort(list(value)) AS v FROM events GROUP BY event_type)"
    " SELECT event_type, p, v[CAST(floor(len(v) * p) AS BIGINT) + 1] AS value"
    " FROM g, unnest([0.0::DOUBLE, 0.5::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS u(p)"
)
def index_percentile(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    return ops.index_percentiles(events, "value", (0.0, 0.5, 0.95, 0.99), by=["event_type"])


@register(
    "WITH g AS (SELECT list_sort(list(l_quantity)) AS v FROM lineitem)"
    " SELECT p, CAST(v[CAST(floor(len(v) * p) AS BIGINT) + 1] AS DOUBLE) AS l_quantity"
    " FROM g, unnest([0.25::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS u(p)"
)
def index_percentile_ties(spark, sf):
    """Few distinct values over many rows: no task holds the rows of one value."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    return ops.index_percentiles(lines, "l_quantity", (0.25, 0.5, 0.9))


@register(
    _REQUESTS
    + f"""
    SELECT model_endpoint, count(*) AS total_requests, round(count(*) FILTER (success) / count(*), 6) AS success_rate,
           round(avg(latency), 6) AS average_latency, {_AT.format(0.95)} AS p95_latency
    FROM r WHERE model_endpoint <> '' GROUP BY model_endpoint
"""
)
def endpoint_summary(spark, sf):
    return rounded(ops.endpoint_summary(requests(spark, sf)))


_BATCHES = (
    _REQUESTS
    + f"""
    , b AS (SELECT batch_id, count(*) AS batch_size, count(*) FILTER (success) AS successful_requests,
        count(*) FILTER (NOT success) AS failed_requests, min(timestamp) AS start_time, max(ended) AS end_time,
        {_SECONDS.format("min(timestamp)", "max(ended)")} AS total_latency
        FROM r GROUP BY batch_id)
"""
)


@register(_BATCHES + "SELECT * REPLACE (round(total_latency, 6) AS total_latency) FROM b")
def batch_rollup(spark, sf):
    return rounded(ops.batch_rollup(requests(spark, sf)))


def _streamed(spark, sf, by):
    """Requests that arrive as files in two lots; the stream stops in between and goes on from its state."""
    base, rows = work_dir(spark, "totals"), requests(spark, sf)
    for lot in range(2):
        part = rows.where(F.col("event_id") % 2 == lot)
        incremental.stage_prompts(part, f"{base}/in", rows_per_file=20_000)
        stream = incremental.read_prompt_stream(spark, f"{base}/in", rows.schema, files_per_batch=8)
        totals.running_totals(stream, by, f"{base}/out", f"{base}/state", salts=4)
    return f"{base}/out"


@register(
    _REQUESTS
    + """
    SELECT count(*) AS total_requests, count(*) FILTER (success) AS successful_requests,
           round(avg(latency), 6) AS average_latency, min(timestamp) AS first, max(ended) AS last
    FROM r
"""
)
def stream_request_counters(spark, sf):
    return rounded(totals.request_totals(spark, _streamed(spark, sf, [])))


@register(_BATCHES + "SELECT * REPLACE (round(total_latency, 6) AS total_latency) FROM b")
def stream_batch_rollup(spark, sf):
    return rounded(totals.batch_totals(spark, _streamed(spark, sf, ["batch_id"])))


_BATCH_RATIOS = """
    , m AS (SELECT *, successful_requests / (successful_requests + failed_requests) AS success_rate,
        total_latency / batch_size AS average_latency,
        CASE WHEN total_latency > 0 THEN batch_size / total_latency ELSE 0 END AS throughput FROM b)
"""


@register(
    _BATCHES
    + _BATCH_RATIOS
    + """
    SELECT batch_id, batch_size, round(success_rate, 6) AS success_rate,
           round(average_latency, 6) AS average_latency, round(throughput, 6) AS throughput
    FROM m
"""
)
def batch_metrics(spark, sf):
    ratios = ops.batch_metrics(ops.batch_rollup(requests(spark, sf)))
    return rounded(ratios.select("batch_id", "batch_size", "success_rate", "average_latency", "throughput"))


@register(
    _BATCHES
    + _BATCH_RATIOS
    + """
    SELECT count(*) AS total_batches, round(avg(batch_size), 6) AS average_batch_size,
           round(avg(success_rate), 6) AS average_success_rate, round(avg(throughput), 6) AS average_throughput
    FROM m
"""
)
def batch_summary(spark, sf):
    return rounded(ops.batch_summary(ops.batch_rollup(requests(spark, sf))))


@register(
    _REQUESTS
    + f"""
    , s AS (SELECT count(DISTINCT user_id) AS items, count(*) AS n,
        {_SECONDS.format("min(timestamp)", "max(ended)")} AS secs FROM r)
    SELECT items AS total_items, n AS total_responses, round(secs, 6) AS processing_time,
           round(items / secs, 6) AS items_per_second, round(n / secs, 6) AS responses_per_second
    FROM s
"""
)
def run_stats(spark, sf):
    return rounded(ops.run_stats(requests(spark, sf), ["user_id"]))


@register("""
    SELECT count(value) AS count, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
           round(coalesce(stddev_samp(value), 0), 6) AS std
    FROM events
""")
def column_statistics(spark, sf):
    return rounded(ops.column_statistics(spark.read.parquet(f"{sf}/events.parquet"), "value"))
