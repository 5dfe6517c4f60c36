"""Running totals of requests as they come in: stateful aggregation that goes on after a stop.

Each group's partial totals live in the stream's state store and their new values are
appended to the output, so a finished trigger is never counted twice; reading takes each
partial's last value and adds them up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sampleflow.operators.telemetry import call_end, seconds_between
from sampleflow.sources.storage import exists

_STATE = "requests BIGINT, ok BIGINT, latencies BIGINT, latency DOUBLE, first BIGINT, last BIGINT"


def _advance(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    requests, ok, latencies, latency, first, last = state.get if state.exists else (0, 0, 0, 0.0, None, None)
    # Most groups have a few rows at a time: plain arrays, as each pandas call costs more than those rows.
    for part in rows:
        requests += len(part)
        ok += int(np.count_nonzero(part["_ok"].to_numpy()))
        values = part["latency"].to_numpy()
        values = values[~np.isnan(values)]
        latencies += len(values)
        latency += float(values.sum())
        starts, ends = (part[c].to_numpy()[~part[f"_no{c}"].to_numpy()] for c in ("_start", "_end"))
        if len(starts):
            first = min(int(starts.min()), int(starts.min()) if first is None else first)
        if len(ends):
            last = max(int(ends.max()), int(ends.max()) if last is None else last)
    now = (requests, ok, latencies, latency, first, last)
    state.update(now)
    names = [f"key{i}" for i in range(len(key))] + [c.split()[0] for c in _STATE.split(", ")]
    yield pd.DataFrame({n: pd.Series([v], dtype=object) for n, v in zip(names, (*key, *now))})


def _micros(column: Column, kind: T.DataType) -> Column:
    start = F.lit("1970-01-01 00:00:00").cast(kind)
    return F.unix_micros(column) if isinstance(kind, T.TimestampType) else F.timestamp_diff("MICROSECOND", start, column)


def _timestamp(micros: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(micros)
    zero, seconds = F.lit(0), (F.col(micros).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast(kind) + F.make_dt_interval(zero, zero, zero, seconds)


def running_totals(
    stream: DataFrame, by: Sequence[str], output_path: str, state_path: str, salts: int = 16
) -> None:
    """Take what is new in a stream of requests into the totals of each ``by`` group (none: of all).

    Stops when nothing new is left; called again, also after a crash, it goes on from the
    state in ``state_path``. A group is kept as up to ``salts`` partial totals, by the part of the input
    that a row comes from: a frequent one is spread over tasks, a rare one is touched once or twice
    a trigger. Only the columns that are counted reach Python. The state has a partition for
    each salt, or two for each core: every trigger opens and commits all of them.
    """
    spark = stream.sparkSession
    kind = stream.schema["timestamp"].dataType
    start, end = _micros(F.col("timestamp"), kind), _micros(call_end(), kind)
    light = stream.select(
        *(F.col(c).alias(f"key{i}") for i, c in enumerate(by)),
        F.pmod(F.spark_partition_id(), F.lit(salts)).cast("int").alias(f"key{len(by)}"),
        F.coalesce("success", F.lit(False)).alias("_ok"),
        F.coalesce(F.col("latency").cast("double"), F.lit(math.nan)).alias("latency"),
        F.coalesce(start, F.lit(0)).alias("_start"),
        start.isNull().alias("_no_start"),
        F.coalesce(end, F.lit(0)).alias("_end"),
        end.isNull().alias("_no_end"),
    )
    keys = [f"key{i}" for i in range(len(by) + 1)]
    kinds = ", ".join(f"{k} {light.schema[k].dataType.simpleString()}" for k in keys)
    partial = light.groupBy(*keys).applyInPandasWithState(
        _advance, f"{kinds}, {_STATE}", _STATE, "append", GroupStateTimeout.NoTimeout
    )
    partial = partial.withColumns({name: _timestamp(name, kind) for name in ("first", "last")})
    writer = (
        partial.writeStream.format("parquet")
        .option("checkpointLocation", state_path)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    # A query takes the setting when it starts, and keeps it in its checkpoint; the session's stays as it is.
    setting = "spark.sql.shuffle.partitions"
    given, most = spark.conf.get(setting), 2 * spark.sparkContext.defaultParallelism if by else salts
    spark.conf.set(setting, str(min(int(given), most)))
    try:
        query = writer.start(output_path)
    finally:
        spark.conf.set(setting, given)
    query.awaitTermination()
    if not exists(spark, output_path):
        spark.createDataFrame([], partial.schema).write.parquet(output_path)


def _totals(spark: SparkSession, by: Sequence[str], output_path: str) -> DataFrame:
    """Each group's totals so far: of every partial the value with the most requests is the last."""
    rows = spark.read.parquet(output_path)
    keys = [f"key{i}" for i in range(len(by) + 1)]
    values = [c.split()[0] for c in _STATE.split(", ")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "requests").alias("v")).select(*keys, "v.*")
    named = last.select(*(F.col(k).alias(c) for k, c in zip(keys, by)), *values)
    return named.groupBy(*by).agg(
        F.sum("requests").alias("requests"),
        F.sum("ok").alias("ok"),
        F.try_divide(F.sum("latency"), F.sum("latencies")).alias("mean"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )


def request_totals(spark: SparkSession, output_path: str) -> DataFrame:
    """``request_counters`` of all requests that ``running_totals`` (by nothing) has taken in."""
    return _totals(spark, (), output_path).select(
        F.coalesce("requests", F.lit(0)).alias("total_requests"),
        F.coalesce("ok", F.lit(0)).alias("successful_requests"),
        F.col("mean").alias("average_latency"),
        "first",
        "last",
    )


def batch_totals(spark: SparkSession, output_path: str) -> DataFrame:
    """``batch_rollup`` of all requests that ``running_totals`` by ``batch_id`` has taken in."""
    return _totals(spark, ("batch_id",), output_path).select(
        "batch_id",
        F.col("requests").alias("batch_size"),
        F.col("ok").alias("successful_requests"),
        (F.col("requests") - F.col("ok")).alias("failed_requests"),
        F.col("first").alias("start_time"),
        F.col("last").alias("end_time"),
        seconds_between(F.col("first"), F.col("last")).alias("total_latency"),
    )
