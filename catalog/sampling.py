"""Fan-out, schedules, request parameters and generation."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from catalog import register, rounded
from catalog.selection import documents
from sampleflow.operators import sampling as ops
from sampleflow.operators.ordering import FileOrder, shuffle_partitions
from sampleflow.operators.select import filter_rows, limit_rows, split_rows
from sampleflow.operators.telemetry import endpoint_summary, run_stats
from sampleflow.plans import generation
from sampleflow.sources.storage import work_dir
from sampleflow.spec import DataOptions, JobSpec, RetryOptions, SamplingOptions

TEMPERATURES = [0.2, 0.6, 1.0, 1.4]
NO_WAIT = RetryOptions(retry_delay=0.0)


@register("SELECT doc_id, text, CAST(i AS INTEGER) AS sample_idx FROM documents, range(4) AS r(i)")
def sample_fanout(spark, sf):
    return ops.sample_fanout(documents(spark, sf).select("doc_id", "text"), 4)


@register("""
    SELECT doc_id, CAST(i AS INTEGER) AS sample_idx,
           ([0.2::DOUBLE, 0.6::DOUBLE, 1.0::DOUBLE, 1.4::DOUBLE])[i + 1] AS temperature
    FROM documents, range(4) AS r(i)
""")
def temperature_schedule(spark, sf):
    rows = ops.sample_fanout(documents(spark, sf).select("doc_id"), 4)
    return ops.temperature_schedule(rows, TEMPERATURES)


@register("""
    SELECT doc_id, CAST(i AS INTEGER) AS sample_idx,
           '{"model":"m","messages":[{"role":"user","content":' || to_json(text) || '}],"max_tokens":512,"temperature":'
           || ([ '0.2', '0.6', '1.0', '1.4'])[i + 1] || ',"top_p":0.95,"presence_penalty":0.0,"frequency_penalty":0.0,'
           || '"n":1,"stop":["###"],"seed":3,"extra_body":{"top_k":20,"chat_template_kwargs":{"enable_thinking":true}}}'
           AS request
    FROM documents, range(4) AS r(i)
""")
def request_params(spark, sf):
    options = SamplingOptions(
        num_samples=4, temperature=TEMPERATURES, top_p=0.95, top_k=20, stop_sequences=["###"], seed=3
    )
    rows = ops.sample_fanout(documents(spark, sf).select("doc_id", "text"), 4)
    asked = ops.request_params(ops.temperature_schedule(rows, TEMPERATURES), "text", options, "m")
    return asked.select("doc_id", "sample_idx", F.to_json("request").alias("request"))


@register("""
    SELECT doc_id, split_id, CAST(i AS INTEGER) AS sample_idx,
           ([0.2::DOUBLE, 0.6::DOUBLE, 1.0::DOUBLE, 1.4::DOUBLE])[i + 1] AS temperature,
           'Dry run sample ' || (i + 1) AS response, 'Dry run thinking ' || (i + 1) AS thinking_text
    FROM (
        SELECT doc_id, CAST(ntile(4) OVER (ORDER BY doc_id) AS INTEGER) AS split_id
        FROM (SELECT doc_id FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 500)
    ), range(4) AS r(i)
    WHERE split_id = 2
""")
def preview_job(spark, sf):
    """Filter, limit, split, fan out, schedule and preview in one plan."""
    rows = filter_rows(documents(spark, sf, positions=True), "lang = 'en'")
    rows = split_rows(limit_rows(rows, 500, FileOrder()), 4, FileOrder()).where("split_id = 2")
    previewed = ops.temperature_schedule(ops.preview_generate(rows, "text", 4), TEMPERATURES)
    return previewed.select("doc_id", "split_id", "sample_idx", "temperature", "response", "thinking_text")


# The words of dry runs and the field names of requests are fixed values.
@register("""
    SELECT doc_id, 'Dry run response for: ' || substring(text, 1, 50) || '...' AS response,
           'Dry run thinking...' AS thinking_text
    FROM documents
""")
def preview_generate(spark, sf):
    return ops.preview_generate(documents(spark, sf).select("doc_id", "text"), "text").drop("text")


class DigestBackend:
    """A stand-in model: answers with the md5 of the prompt and the sample number.

    By the first digit of that md5 it refuses (0), fails on the first attempt (1)
    or is never reachable (2).
    """

    def __init__(self):
        self.failed = set()

    def generate(self, prompt, temperature, sample_idx):
        digest = hashlib.md5(f"{prompt}|{sample_idx}".encode()).hexdigest()
        if digest[0] == "0":
            raise ValueError("refused")
        if digest[0] == "2" or (digest[0] == "1" and digest not in self.failed):
            self.failed.add(digest)
            raise ops.TransientError("unreachable")
        self.failed.discard(digest)
        choice = {"text": digest, "thinking_text": digest[:8], "finish_reason": "stop", "index": 0}
        usage = {"prompt_tokens": len(prompt), "completion_tokens": 32, "total_tokens": len(prompt) + 32}
        return {"choices": [choice], "usage": usage, "model": "digest", "id": digest, "created": 0}


_CALLS = """
    WITH c AS (
        SELECT doc_id, CAST(i AS INTEGER) AS sample_idx, text, md5(text || '|' || i) AS d
        FROM documents, range(2) AS r(i)
    ), a AS (SELECT *, substring(d, 1, 1) IN ('0', '2') AS failed, substring(d, 1, 1) AS kind FROM c)
"""


def _asked(spark, sf):
    """Two samples of every text, spread over as many tasks as a shuffle has."""
    asked = ops.sample_fanout(documents(spark, sf).select("doc_id", "text"), 2)
    return asked.repartition(shuffle_partitions(asked), "doc_id", "sample_idx")


@register(
    _CALLS
    + """
    SELECT doc_id, sample_idx, CASE WHEN failed THEN '' ELSE d END AS response,
           CASE WHEN failed THEN '' ELSE substring(d, 1, 8) END AS thinking_text
    FROM a
"""
)
def generate(spark, sf):
    answered = ops.generate(_asked(spark, sf), DigestBackend, "text", retry=NO_WAIT)
    return answered.drop("text")


@register(
    _CALLS
    + """
    SELECT doc_id, sample_idx, CASE WHEN failed THEN '' ELSE d END AS response,
           CASE WHEN failed THEN 'error' ELSE 'stop' END AS finish_reason,
           CASE kind WHEN '0' THEN 'refused' WHEN '2' THEN 'unreachable' END AS error,
           CASE WHEN NOT failed THEN CAST(length(text) + 32 AS INTEGER) END AS total_tokens
    FROM a
"""
)
def generate_with_errors(spark, sf):
    answered = ops.generate_with_errors(_asked(spark, sf), DigestBackend, "text", retry=NO_WAIT)
    return answered.select("doc_id", "sample_idx", "response", "finish_reason", "error", "total_tokens")


@register(
    _CALLS
    + """
    SELECT doc_id, sample_idx, CAST(length(text) AS INTEGER) AS prompt_length,
           CASE WHEN failed THEN 0 ELSE 32 END AS response_length, NOT failed AS success,
           CASE kind WHEN '1' THEN 2 WHEN '2' THEN 3 ELSE 1 END AS attempts,
           'http://localhost:8000' AS model_endpoint, true AS timed
    FROM a
"""
)
def request_telemetry(spark, sf):
    asked = _asked(spark, sf).withColumn("endpoint", F.lit("http://localhost:8000"))
    rows = ops.request_telemetry(asked, DigestBackend, "text", keep=["doc_id", "sample_idx"], retry=NO_WAIT)
    timed = (F.col("latency") >= 0) & F.col("timestamp").isNotNull()
    return rows.withColumn("timed", timed).drop("latency", "timestamp", "error")


class RequestBackend:
    """A stand-in model: says what it was asked for; some replies have not the form of one."""

    def generate(self, prompt, temperature, sample_idx, request, endpoint=None):
        digest = hashlib.md5(prompt.encode()).hexdigest()
        if digest[0] == "0":
            return "no record"
        asked = f"{request['max_tokens']} {request['top_p']} {request['seed']} {request['stop'][0]} {request['messages'][0]['role']}"
        text = f"{asked} {temperature} {sample_idx} {digest}"
        return {"choices": [{"text": text}], "model": request["model"], "id": endpoint}


def _job(spark, sf, name, **more):
    data = DataOptions(f"{sf}/documents.parquet", work_dir(spark, name), input_column="text", copy_columns=["doc_id", "lang"])
    sampling = SamplingOptions(2, [0.5, 0.7], max_tokens=77, top_p=0.5, seed=3, stop_sequences=["#"])
    return JobSpec(data, sampling, retry=NO_WAIT, prompt_template="Q: {text}", model="m1", **more)


_SAID = """
    WITH c AS (
        SELECT doc_id, lang, CAST(i AS INTEGER) AS sample_idx, md5('Q: ' || text) AS d,
               CAST(ntile(3) OVER (PARTITION BY i ORDER BY doc_id) AS INTEGER) AS split_id
        FROM documents, range(2) AS r(i)
    ), a AS (
        SELECT *, substring(d, 1, 1) = '0' AS failed, CASE WHEN substring(d, 1, 1) = '0' THEN '' ELSE
               '77 0.5 3 # user ' || CASE sample_idx WHEN 0 THEN '0.5 0 ' ELSE '0.7 1 ' END || d END AS response
        FROM c
    )
"""


@register(_SAID + "SELECT doc_id, lang, sample_idx, response, '' AS thinking_text FROM a")
def run_generation(spark, sf):
    return generation.run_generation(spark, _job(spark, sf, "run"), RequestBackend).drop("text")


@register(_SAID + "SELECT doc_id, lang, sample_idx, response, '' AS thinking_text, split_id FROM a")
def run_all_splits(spark, sf):
    return generation.run_all_splits(spark, _job(spark, sf, "splits"), 3, RequestBackend).drop("text")


@register(
    _SAID
    + """
    SELECT 'e' || split_id AS model_endpoint, count(*) AS total_requests, count(*) FILTER (NOT failed) AS named,
           round(count(*) FILTER (NOT failed) / count(*), 6) AS success_rate
    FROM a GROUP BY split_id
"""
)
def run_with_telemetry(spark, sf):
    """The summary of a run's endpoints, from the telemetry it keeps; ``named`` counts replies that name theirs."""
    spec = _job(spark, sf, "telemetry", keep_telemetry=True, endpoints=["e1", "e2", "e3"])
    run = generation.run_all_splits(spark, spec, 3, RequestBackend)
    named = run.where("reply_id = model_endpoint").groupBy("model_endpoint").agg(F.count("*").alias("named"))
    summary = endpoint_summary(run).select("model_endpoint", "total_requests", "success_rate")
    return rounded(summary.join(named, "model_endpoint"))


@register(_SAID + "SELECT doc_id, lang, sample_idx, response, '' AS thinking_text FROM a")
def run_incremental(spark, sf):
    return generation.run_incremental(spark, _job(spark, sf, "saved"), RequestBackend, 5000).drop("text")


@register(_SAID + "SELECT count(*) FILTER (sample_idx = 0) AS total_items, count(*) AS total_responses, true AS same FROM a")
def run_with_stats(spark, sf):
    """Numbers observed while a run is written; ``same`` says that they are those of its telemetry, read afterwards."""
    written, seen = generation.run_with_stats(spark, _job(spark, sf, "stats", keep_telemetry=True), RequestBackend)
    after = run_stats(written, ["doc_id"])
    same = F.lit(True)
    for name in ("processing_time", "items_per_second", "responses_per_second"):
        same = same & (F.abs(F.col(name) - F.lit(float(seen[name]))) <= 1e-6 * F.greatest(F.lit(1.0), F.col(name)))
    counts = (F.lit(seen["total_items"]) == F.col("total_items")) & (F.lit(seen["total_responses"]) == F.col("total_responses"))
    return after.select("total_items", "total_responses", (same & counts).alias("same"))
