import gc
import json
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sampleflow import DataOptions, JobSpec, RetryOptions, SamplingOptions, SplitOptions
from sampleflow import preview_generation, run_all_splits, run_generation, run_incremental
from sampleflow.operators import sampling as ops

NO_WAIT = RetryOptions(retry_delay=0.0)


class Echo:
    """Answers with the prompt; prompts name the way a call should go wrong."""

    def __init__(self):
        self.asked = {}

    def generate(self, prompt, temperature, sample_idx):
        key = (prompt, sample_idx)
        self.asked[key] = self.asked.get(key, 0) + 1
        if prompt.startswith("flaky") and self.asked[key] == 1:
            raise ops.TransientError("busy")
        if prompt.startswith("down"):
            raise ConnectionError("no route")
        if prompt.startswith("bad"):
            raise ValueError("bad prompt")
        if prompt.startswith("empty"):
            return {"choices": []}
        text = f"{prompt}/{temperature}/{sample_idx}"
        return {"choices": [{"text": text, "thinking_text": "t", "finish_reason": "stop", "index": 0}], "usage": {}}

    def close(self):
        self.asked = None


def prompts(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id INT, q STRING")


def test_fanout(spark):
    df = prompts(spark, "a", "b")
    assert ops.sample_fanout(df, 1).columns == ["id", "q"]
    rows = ops.sample_fanout(df, 3).orderBy("id", "sample_idx").collect()
    assert [(r.id, r.sample_idx) for r in rows] == [(i, s) for i in range(2) for s in range(3)]
    with pytest.raises(ValueError):
        ops.sample_fanout(df, 0)


def test_temperature_schedule(spark):
    df = ops.sample_fanout(prompts(spark, "a"), 3)

    def temperatures(*args):
        return [r.temperature for r in ops.temperature_schedule(df, *args).orderBy("sample_idx").collect()]

    assert temperatures(0.5) == [0.5] * 3
    assert temperatures(0.5, 0.9) == [0.9] * 3
    assert temperatures([0.1, 0.2]) == [0.1, 0.2, 0.1]
    assert temperatures([0.1, 0.2], 0.9) == [0.1, 0.2, 0.1]
    assert ops.temperature_schedule(prompts(spark, "a"), [0.3]).first().temperature == 0.3


def test_request_params_leave_out_what_is_unset(spark):
    df = ops.temperature_schedule(prompts(spark, 'say "é"'), 0.7)

    def request(options):
        return json.loads(ops.request_params(df, "q", options, "m").select(F.to_json("request")).first()[0])

    plain = request(SamplingOptions(enable_thinking=None))
    assert plain["messages"] == [{"role": "user", "content": 'say "é"'}]
    assert set(plain) == {
        "model", "messages", "max_tokens", "temperature", "top_p", "presence_penalty", "frequency_penalty", "n"
    }
    full = request(SamplingOptions(top_k=5, stop_sequences=["x"], seed=0, enable_thinking=False))
    assert full["stop"] == ["x"] and full["seed"] == 0
    assert full["extra_body"] == {"top_k": 5, "chat_template_kwargs": {"enable_thinking": False}}
    assert "top_k" not in request(SamplingOptions(top_k=-1))["extra_body"]


def test_option_checks():
    for bad in [
        {"num_samples": 0}, {"top_p": 1.5}, {"max_tokens": 0}, {"temperature": -1.0},
        {"num_samples": 2, "temperature": [0.1]}, {"num_samples": 1, "temperature": [0.1, -0.2]},
    ]:
        with pytest.raises(ValueError):
            SamplingOptions(**bad)
    for bad in [{"split_id": 1}, {"num_splits": 2}, {"split_id": 3, "num_splits": 2}, {"split_id": 0, "num_splits": 2}]:
        with pytest.raises(ValueError):
            SplitOptions(**bad)
    with pytest.raises(TypeError):
        SamplingOptions(temprature=1.0)
    waits = RetryOptions(retry_delay=1.0, backoff_factor=3.0, max_delay=5.0)
    assert [waits.wait(i) for i in (1, 2, 3)] == [1.0, 3.0, 5.0]


@pytest.mark.parametrize("concurrency", [1, 4])
def test_failures_keep_their_rows(spark, concurrency):
    df = prompts(spark, "fine", "flaky 1", "down", "bad", "empty", None).repartition(3)
    got = ops.generate_with_errors(df, Echo, "q", retry=NO_WAIT, concurrency=concurrency, batch_rows=2)
    rows = {r.id: r for r in got.collect()}
    assert rows[0].response == "fine/None/0" and rows[0].thinking_text == "t" and rows[0].success
    assert rows[1].response == "flaky 1/None/0" and rows[1].attempts == 2 and rows[1].error is None
    assert (rows[2].response, rows[2].finish_reason, rows[2].error, rows[2].attempts) == ("", "error", "no route", 3)
    assert (rows[3].response, rows[3].finish_reason, rows[3].error, rows[3].attempts) == ("", "error", "bad prompt", 1)
    assert rows[4].response == "" and rows[4].success
    assert rows[5].response == "None/None/0" and rows[5].q is None and rows[5].prompt_length == 4


def test_generate_columns_and_clashes(spark):
    df = ops.temperature_schedule(ops.sample_fanout(prompts(spark, "a"), 2), [0.1, 0.2])
    got = ops.generate(df, Echo, "q", output_column="answer")
    assert got.columns == ["id", "q", "sample_idx", "temperature", "answer", "thinking_text"]
    assert sorted(r.answer for r in got.collect()) == ["a/0.1/0", "a/0.2/1"]
    # Old answers are replaced; columns named like telemetry are the user's own.
    old = df.withColumn("response", F.lit("x")).withColumn("latency", F.lit("mine"))
    got = ops.generate(old, Echo, "q").collect()
    assert {r.response for r in got} == {"a/0.1/0", "a/0.2/1"} and {r.latency for r in got} == {"mine"}
    with pytest.raises(ValueError):
        ops.generate_with_errors(old, Echo, "q")
    assert ops.generate(df.limit(0), Echo, "q").collect() == []


def test_row_number_can_be_the_index(spark):
    df = prompts(spark, "a", "b")
    got = ops.generate_with_errors(df, Echo, "q", index="id").orderBy("id").collect()
    assert [r.response for r in got] == ["a/None/0", "b/None/1"]


def test_telemetry_feeds_the_summary(spark, folder):
    from sampleflow.operators.telemetry import request_summary
    from sampleflow.sources.sinks import write_table

    df = prompts(spark, "fine", "bad").withColumn("endpoint", F.lit("e1"))
    calls = ops.request_telemetry(df, Echo, "q", keep=["id"], retry=NO_WAIT)
    summary = request_summary(write_table(calls, f"{folder}/calls")).first()
    assert (summary.total_requests, summary.failed_requests, summary.success_rate) == (2, 1, 0.5)
    assert summary.p50_latency >= 0


def test_preview(spark):
    long = "x" * 60
    got = ops.preview_generate(prompts(spark, long, None), "q").orderBy("id").collect()
    assert got[0].response == "Dry run response for: " + "x" * 50 + "..."
    assert got[1].response == "Dry run response for: None..."
    got = ops.preview_generate(prompts(spark, long), "q", 2).orderBy("sample_idx").collect()
    assert [(r.response, r.thinking_text) for r in got] == [
        ("Dry run sample 1", "Dry run thinking 1"), ("Dry run sample 2", "Dry run thinking 2")
    ]


def job(folder, **changes):
    data = DataOptions(
        f"{folder}/in.parquet", f"{folder}/out.parquet", input_column="q", filter_condition="id >= 10", limit=50,
        shuffle_seed=changes.pop("shuffle_seed", None),
    )
    return JobSpec(data, SamplingOptions(num_samples=2, temperature=[0.1, 0.2]), retry=NO_WAIT, **changes)


@pytest.fixture
def prompt_folder(spark, folder):
    rows = spark.range(0, 100, 1, 4).select("id", F.concat(F.lit("q"), F.col("id").cast("string")).alias("q"))
    rows.write.parquet(f"{folder}/in.parquet")
    return folder


def test_whole_job(spark, prompt_folder):
    out = run_generation(spark, job(prompt_folder, prompt_template="<{text}>", partitions=3), Echo)
    assert out.columns == ["id", "q", "response", "thinking_text", "sample_idx"]
    rows = {(r.id, r.sample_idx): r.response for r in out.collect()}
    assert rows == {(i, s): f"<q{i}>/{[0.1, 0.2][s]}/{s}" for i in range(10, 60) for s in range(2)}
    assert preview_generation(spark, job(prompt_folder)).count() == 100


@pytest.mark.parametrize("seed", [None, 5])
def test_splits_run_apart_or_together(spark, prompt_folder, seed):
    seen = []
    for i in range(1, 4):
        spec = job(prompt_folder, split=SplitOptions(i, 3), shuffle_seed=seed)
        seen += [r.id for r in run_generation(spark, spec, Echo).where("sample_idx = 0").collect()]
        assert Path(f"{prompt_folder}/out-{i}-of-3.parquet").exists()
    assert sorted(seen) == list(range(10, 60))
    together = run_all_splits(spark, job(prompt_folder, shuffle_seed=seed), 3, Echo)
    files = list(Path(f"{prompt_folder}/out.parquet").glob("split_id=*/*.parquet"))
    assert len(files) <= 24  # eight tasks with a few splits each
    counts = {r["split_id"]: r["count"] for r in together.groupBy("split_id").count().collect()}
    assert counts == {1: 34, 2: 34, 3: 32}


def test_kept_columns_and_telemetry(spark, prompt_folder):
    from dataclasses import replace

    from sampleflow.operators.telemetry import run_stats

    spec = job(prompt_folder, keep_telemetry=True)
    spec = replace(spec, data=replace(spec.data, copy_columns=[]))
    out = run_generation(spark, spec, Echo)
    assert out.columns[:4] == ["q", "response", "thinking_text", "sample_idx"] and "latency" in out.columns
    stats = run_stats(out, ["q"]).first()
    assert (stats.total_items, stats.total_responses) == (50, 100) and stats.processing_time > 0


class Tripwire(Echo):
    """Stops the whole job at one prompt, as a lost machine would."""

    def generate(self, prompt, temperature, sample_idx):
        if prompt == "q40":
            raise SystemExit("stopped")
        return super().generate(prompt, temperature, sample_idx)


def test_incremental_job_goes_on_after_a_stop(spark, prompt_folder):
    spec = job(prompt_folder)
    size = {"rows_per_file": 6, "files_per_batch": 2}
    with pytest.raises(StreamingQueryException):
        run_incremental(spark, spec, Tripwire, **size)
    done = spark.read.parquet(f"{prompt_folder}/out.parquet").count()
    assert 0 < done < 100
    out = run_incremental(spark, spec, Echo, **size)
    rows = {(r.id, r.sample_idx): r.response for r in out.collect()}
    assert rows == {(i, s): f"q{i}/{[0.1, 0.2][s]}/{s}" for i in range(10, 60) for s in range(2)}
    assert out.count() == 100 and not Path(f"{prompt_folder}/out.parquet.work").exists()
    assert run_incremental(spark, spec, Tripwire, **size).count() == 100


def test_another_job_does_not_get_the_output(spark, prompt_folder):
    from dataclasses import replace

    spec = job(prompt_folder)
    assert run_incremental(spark, spec, Echo).count() == 100
    assert run_incremental(spark, replace(spec, concurrency=3), Echo).count() == 100
    for other in (replace(spec, prompt_template="new {text}"), replace(spec, data=replace(spec.data, limit=5))):
        with pytest.raises(ValueError, match="another job"):
            run_incremental(spark, other, Echo)


class Odd:
    """Answers with what no reply should be; the prompt says which."""

    replies = {
        "string": "plain", "none choice": {"choices": [None]}, "number": {"choices": [{"text": 5}], "created": "x", "usage": {"total_tokens": "y"}},
        "list": [1], "usage": {"choices": [{"text": "a"}], "usage": 3}, "none": None,
        "whole": {"choices": [{"text": "a"}], "model": "m", "id": 7, "created": 2**40},
    }

    def generate(self, prompt, temperature, sample_idx):
        return self.replies[prompt]


@pytest.mark.parametrize("concurrency", [1, 3])
def test_malformed_replies_keep_their_rows(spark, concurrency):
    got = ops.generate_with_errors(prompts(spark, *Odd.replies), Odd, "q", retry=NO_WAIT, concurrency=concurrency)
    rows = {r.q: r for r in got.collect()}
    assert {q: (r.success, r.response) for q, r in rows.items()} == {
        "string": (False, ""), "none choice": (False, ""), "number": (True, "5"), "list": (False, ""), "usage": (False, ""),
        "none": (False, ""), "whole": (True, "a"),
    }
    assert all(r.error and r.finish_reason == "error" for r in rows.values() if not r.success)
    assert rows["none"].attempts == 3 and rows["string"].attempts == 1
    assert (rows["whole"].reply_model, rows["whole"].reply_id, rows["whole"].reply_created) == ("m", "7", 2**40)


class Slow:
    def generate(self, prompt, temperature, sample_idx):
        import time

        time.sleep(30 if prompt == "hangs" else 0)
        return {"choices": [{"text": "done"}]}


def test_a_call_that_hangs_ends(spark):
    retry = RetryOptions(max_attempts=2, retry_delay=0.0, timeout=0.3)
    got = ops.generate_with_errors(prompts(spark, "hangs", "fine"), Slow, "q", retry=retry).collect()
    rows = {r.q: r for r in got}
    assert rows["hangs"].error == "no reply within 0.3 s" and rows["hangs"].attempts == 2 and rows["fine"].success


class Mirror:
    """Answers with the request it got."""

    def generate(self, prompt, temperature, sample_idx, request=None, endpoint=None):
        return {"choices": [{"text": json.dumps({"request": request, "endpoint": endpoint})}], "model": request["model"]}


def test_the_backend_gets_the_whole_request(spark, folder):
    rows = spark.range(6).select("id", F.lit("say").alias("q"), F.lit(9.5).alias("temperature"), F.lit("own").alias("endpoint"), F.lit(3).alias("sample_idx"))
    rows.write.parquet(f"{folder}/in.parquet")
    sampling = SamplingOptions(num_samples=2, temperature=[0.3, 0.6], max_tokens=77, top_p=0.5, seed=3, stop_sequences=["#"])
    data = DataOptions(f"{folder}/in.parquet", f"{folder}/out.parquet", input_column="q")
    spec = JobSpec(data, sampling, retry=NO_WAIT, model="m1", endpoints=["e1", "e2"])
    out = run_generation(spark, spec, Mirror).collect()
    assert len(out) == 12 and {(r.temperature, r.endpoint) for r in out} == {(9.5, "own")}
    assert sorted(r.sample_idx for r in out) == [0] * 6 + [1] * 6
    for r in out:
        said = json.loads(r.response)
        assert said["endpoint"] in ("e1", "e2")
        request = said["request"]
        assert request["temperature"] == [0.3, 0.6][r.sample_idx] and request["model"] == "m1"
        assert (request["max_tokens"], request["top_p"], request["seed"], request["stop"]) == (77, 0.5, 3, ["#"])
        assert request["messages"] == [{"role": "user", "content": "say"}]


def test_telemetry_names_endpoints_and_batches(spark, prompt_folder):
    from sampleflow.operators.telemetry import endpoint_summary

    spec = job(prompt_folder, keep_telemetry=True, endpoints=["e1", "e2", "e3"])
    together = run_all_splits(spark, spec, 3, Echo)
    served = {(r.split_id, r.model_endpoint) for r in together.select("split_id", "model_endpoint").distinct().collect()}
    assert served == {(1, "e1"), (2, "e2"), (3, "e3")}
    assert together.where("batch_id IS NULL").count() == 0
    assert endpoint_summary(together).count() == 3


def test_job_errors(spark, prompt_folder):
    spec = JobSpec(DataOptions(f"{prompt_folder}/in.parquet", f"{prompt_folder}/o.parquet"))
    with pytest.raises(ValueError, match="question"):
        run_generation(spark, spec, Echo)
    with pytest.raises(FileNotFoundError):
        run_generation(spark, JobSpec(DataOptions(f"{prompt_folder}/no.parquet", "o.parquet")), Echo)


class CountsRequests:
    """Answers with the number of requests that its process holds as Python objects."""

    def generate(self, prompt, temperature, sample_idx, request):
        held = sum(isinstance(o, dict) and "messages" in o for o in gc.get_objects())
        return {"choices": [{"text": str(held)}]}


def test_few_rows_become_objects(spark):
    """A batch of many prompts is turned into Python objects a few rows at a time."""
    rows = spark.range(200).select(F.concat(F.lit("p"), F.col("id")).alias("q"), F.lit(0.5).alias("temperature")).coalesce(1)
    asked = ops.request_params(rows, "q", SamplingOptions(), "m")
    for concurrency in (1, 2):
        answered = ops.generate(asked, CountsRequests, "q", concurrency=concurrency, batch_rows=10)
        held = [int(r.response) for r in answered.collect()]
        assert len(held) == 200 and max(held) <= 100
