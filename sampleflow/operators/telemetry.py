"""Summaries of request telemetry, of batches and of plain numbers.

Request tables have ``latency`` (seconds), ``success``, ``timestamp`` (start of
the call) and, where needed, ``model_endpoint`` and ``batch_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.operators.ordering import quantile_bucket, shuffle_buckets


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """A quotient that is 0 where it is not defined."""
    top = F.col(top) if isinstance(top, str) else top
    bottom = F.col(bottom) if isinstance(bottom, str) else bottom
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from one timestamp to another, whatever the session time zone."""
    gap = end - start
    whole = (
        F.extract(F.lit("DAY"), gap) * 86400
        + F.extract(F.lit("HOUR"), gap) * 3600
        + F.extract(F.lit("MINUTE"), gap) * 60
    )
    return whole + F.extract(F.lit("SECOND"), gap).cast("double")


def call_end() -> Column:
    """When a call ended, to the microsecond."""
    zero = F.lit(0)
    latency = F.round(F.col("latency"), 6).cast("decimal(18,6)")
    return F.col("timestamp") + F.make_dt_interval(zero, zero, zero, latency)


def _succeeded() -> Column:
    return F.coalesce("success", F.lit(False))


def index_percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """The value at index ``int(n * p)`` of each group's sorted values, exactly.

    Rows are counted in value ranges of about equal size; only the ranges that
    hold a wanted index are read again.  Neither a large group nor a value that
    many rows share is gathered in one place.
    """
    by = list(by)
    narrow = df.select(*by, F.col(value).cast("double").alias("_value")).where("_value IS NOT NULL")
    bucketed, _ = quantile_bucket(narrow, "_value", "_bucket", shuffle_buckets(df))

    # At most one row per group and range from here to `hits`.
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        bucketed.groupBy(*by, "_bucket")
        .agg(F.count("*").alias("_rows"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_rows").over(Window.partitionBy(*by)))
    )
    wanted = F.array(
        *(
            F.struct(F.lit(float(p)).alias("p"), F.floor(F.col("_total") * F.lit(float(p))).alias("rank"))
            for p in probabilities
        )
    )
    hits = (
        ranges.withColumn("_want", F.explode(wanted))
        .select("*", F.col("_want.p").alias("p"), (F.col("_want.rank") - F.col("_start")).alias("_nth"))
        .where("_nth >= 0 AND _nth < _rows")
    )

    # A range of one value answers by itself, however many rows it has.
    settled = hits.where("_low = _high").select(*by, "p", F.col("_low").alias(value))
    opened = hits.where("_low < _high").select(*by, F.col("_bucket").alias("_hit"), "p", "_nth")
    opened = opened.withColumnsRenamed({c: f"_{c}" for c in by})
    same = [F.col("_bucket") == F.col("_hit"), *(F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by)]
    inside = Window.partitionBy(*by, "_bucket", "p").orderBy("_value")
    # Equal values are counted before anything moves.
    values = bucketed.groupBy(*by, "_bucket", "_value").agg(F.count("*").alias("_rows"))
    searched = (
        values.join(opened, same)
        .withColumn("_upto", F.sum("_rows").over(inside))
        .where("_nth < _upto AND _nth >= _upto - _rows")
        .select(*by, "p", F.col("_value").alias(value))
    )
    return settled.unionByName(searched)


def _percentile(p: float, name: str) -> Column:
    return F.coalesce(F.max(F.when(F.col("p") == p, F.col("latency"))), F.lit(0.0)).alias(name)


def request_counters(df: DataFrame) -> DataFrame:
    """The part of the summary that also works on a stream."""
    return df.agg(
        F.count("*").alias("total_requests"),
        F.count_if(_succeeded()).alias("successful_requests"),
        F.avg("latency").alias("average_latency"),
        F.min("timestamp").alias("first"),
        F.max(call_end()).alias("last"),
    )


def request_summary(df: DataFrame) -> DataFrame:
    """Counts, success rate, latencies, duration and throughput of all requests.

    An empty table gives zeros.
    """
    marks = index_percentiles(df, "latency", (0.5, 0.95, 0.99))
    # Two results of a few rows, laid side by side by a union and one more total.
    both = request_counters(df).unionByName(marks, allowMissingColumns=True)
    one = both.agg(
        F.max("total_requests").alias("total_requests"),
        F.max("successful_requests").alias("successful_requests"),
        F.coalesce(F.max("average_latency"), F.lit(0.0)).alias("average_latency"),
        _percentile(0.5, "p50_latency"),
        _percentile(0.95, "p95_latency"),
        _percentile(0.99, "p99_latency"),
        F.coalesce(seconds_between(F.max("first"), F.max("last")), F.lit(0.0)).alias("total_duration"),
    )
    return one.select(
        "total_requests",
        "successful_requests",
        (F.col("total_requests") - F.col("successful_requests")).alias("failed_requests"),
        ratio("successful_requests", "total_requests").alias("success_rate"),
        "average_latency",
        "p50_latency",
        "p95_latency",
        "p99_latency",
        "total_duration",
        ratio("total_requests", "total_duration").alias("overall_throughput"),
    )


def endpoint_summary(df: DataFrame) -> DataFrame:
    """Requests, success rate, mean and p95 latency of every named endpoint."""
    named = df.where("model_endpoint <> ''")
    counters = named.groupBy("model_endpoint").agg(
        F.count("*").alias("total_requests"),
        F.count_if(_succeeded()).alias("ok"),
        F.avg("latency").alias("mean"),
    )
    marks = index_percentiles(named, "latency", (0.95,), by=("model_endpoint",))
    both = counters.unionByName(marks, allowMissingColumns=True)
    return (
        both.groupBy("model_endpoint")
        .agg(
            F.max("total_requests").alias("total_requests"),
            F.max("ok").alias("ok"),
            F.coalesce(F.max("mean"), F.lit(0.0)).alias("average_latency"),
            _percentile(0.95, "p95_latency"),
        )
        .select(
            "model_endpoint",
            "total_requests",
            ratio("ok", "total_requests").alias("success_rate"),
            "average_latency",
            "p95_latency",
        )
    )


def batch_rollup(df: DataFrame) -> DataFrame:
    """Requests to one row per batch; its latency is the time from start to end."""
    return (
        df.groupBy("batch_id")
        .agg(
            F.count("*").alias("batch_size"),
            F.count_if(_succeeded()).alias("successful_requests"),
            F.count_if(~_succeeded()).alias("failed_requests"),
            F.min("timestamp").alias("start_time"),
            F.max(call_end()).alias("end_time"),
        )
        .withColumn("total_latency", seconds_between(F.col("start_time"), F.col("end_time")))
    )


def batch_metrics(batches: DataFrame) -> DataFrame:
    """Success rate, mean latency and throughput of every batch."""
    answered = F.col("successful_requests") + F.col("failed_requests")
    duration = seconds_between(F.col("start_time"), F.col("end_time"))
    # A negative duration counts as none.
    return batches.select(
        "*",
        ratio("successful_requests", answered).alias("success_rate"),
        ratio("total_latency", "batch_size").alias("average_latency"),
        ratio("batch_size", F.greatest(duration, F.lit(0.0))).alias("throughput"),
    )


def batch_summary(batches: DataFrame) -> DataFrame:
    """Number of batches and the plain means of their size and ratios."""

    def mean(name: str) -> Column:
        return F.coalesce(F.avg(name), F.lit(0.0))

    return batch_metrics(batches).agg(
        F.count("*").alias("total_batches"),
        mean("batch_size").alias("average_batch_size"),
        mean("success_rate").alias("average_success_rate"),
        mean("throughput").alias("average_throughput"),
    )


def telemetry_summary(df: DataFrame) -> dict[str, DataFrame]:
    """All three summaries of a table of requests that were made in batches."""
    return {
        "request_summary": request_summary(df),
        "batch_summary": batch_summary(batch_rollup(df)),
        "endpoint_summary": endpoint_summary(df),
    }


def run_stats(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Items, responses, seconds and rates of a finished run with telemetry."""
    per_item = df.groupBy(*key).agg(
        F.count("*").alias("responses"), F.min("timestamp").alias("first"), F.max(call_end()).alias("last")
    )
    totals = per_item.agg(
        F.count("*").alias("total_items"),
        F.coalesce(F.sum("responses"), F.lit(0)).alias("total_responses"),
        F.coalesce(seconds_between(F.min("first"), F.max("last")), F.lit(0.0)).alias("processing_time"),
    )
    return totals.select(
        "*",
        ratio("total_items", "processing_time").alias("items_per_second"),
        ratio("total_responses", "processing_time").alias("responses_per_second"),
    )


def run_metrics(sample: str | None) -> list[Column]:
    """What to observe of answers as they pass: an item is its first sample (column ``sample``; None: one each)."""
    items = F.count_if(F.col(sample) == 0) if sample else F.count(F.lit(1))
    return [
        items.alias("total_items"),
        F.count(F.lit(1)).alias("total_responses"),
        F.min(F.unix_micros("timestamp")).alias("first"),
        F.max(F.unix_micros(call_end())).alias("last"),
    ]


def observed_stats(found: dict) -> dict[str, float]:
    """The numbers of ``run_stats`` from what ``run_metrics`` observed."""
    items, responses = found.get("total_items") or 0, found.get("total_responses") or 0
    seconds = (found["last"] - found["first"]) / 1e6 if responses and found["last"] is not None else 0.0
    rate = lambda n: n / seconds if seconds else 0.0
    return {
        "total_items": items,
        "total_responses": responses,
        "processing_time": seconds,
        "items_per_second": rate(items),
        "responses_per_second": rate(responses),
    }


def column_statistics(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, min, max and sample standard deviation; zeros when there are no values."""
    value = F.col(column)
    zero = F.lit(0.0)
    return df.agg(
        F.count(value).alias("count"),
        F.coalesce(F.avg(value), zero).alias("mean"),
        F.coalesce(F.min(value), zero).alias("min"),
        F.coalesce(F.max(value), zero).alias("max"),
        F.coalesce(F.stddev_samp(value), zero).alias("std"),
    )
