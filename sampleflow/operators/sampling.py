"""Fan rows out to samples and have a backend answer them."""

from __future__ import annotations

import inspect
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleflow.functions.text import input_text
from sampleflow.spec import RetryOptions, SamplingOptions


class TransientError(Exception):
    """A backend failure that is worth another attempt."""


RETRIED = (TransientError, TimeoutError, ConnectionError)


class Backend(Protocol):
    """Answers one prompt; the reply has the form of ``REPLY_SCHEMA`` as a dict.

    A ``generate`` that also takes ``request`` gets the parameters of the call
    (see ``request_params``), one that takes ``endpoint`` the endpoint it is meant for.
    """

    def generate(self, prompt: str, temperature: float | None, sample_idx: int) -> dict[str, Any]: ...


BackendFactory = Callable[[], Backend]


def sample_fanout(df: DataFrame, num_samples: int) -> DataFrame:
    """Each row times ``num_samples``; ``sample_idx`` is added only above one sample, and replaces an older one."""
    if num_samples < 1:
        raise ValueError("num_samples must be positive")
    if num_samples == 1:
        return df
    return df.drop("sample_idx").select("*", F.explode(F.sequence(F.lit(0), F.lit(num_samples - 1))).alias("sample_idx"))


def temperature_schedule(
    df: DataFrame,
    temperature: float | Sequence[float],
    override: float | None = None,
    index: str = "sample_idx",
) -> DataFrame:
    """Add ``temperature``: a list is cycled by sample; a number yields to ``override``."""
    if isinstance(temperature, (int, float)):
        value = F.lit(float(temperature if override is None else override))
    else:
        steps = F.array(*(F.lit(float(t)) for t in temperature))
        position = F.col(index) if index in df.columns else F.lit(0)
        value = F.element_at(steps, (position % len(temperature) + 1).cast("int"))
    return df.withColumn("temperature", value)


def request_params(df: DataFrame, prompt: str, options: SamplingOptions, model: str) -> DataFrame:
    """Add ``request``: the parameters of one chat completion, unset ones left out.

    The names are those of the wire format: fixed values.
    """
    message = F.struct(F.lit("user").alias("role"), F.col(prompt).alias("content"))
    fields = {
        "model": F.lit(model),
        "messages": F.array(message),
        "max_tokens": F.lit(options.max_tokens),
        "temperature": F.col("temperature"),
        "top_p": F.lit(float(options.top_p)),
        "presence_penalty": F.lit(float(options.presence_penalty)),
        "frequency_penalty": F.lit(float(options.frequency_penalty)),
        "n": F.lit(1),
    }
    if options.stop_sequences:
        fields["stop"] = F.array(*map(F.lit, options.stop_sequences))
    if options.seed is not None:
        fields["seed"] = F.lit(options.seed)
    extra = {}
    if options.top_k > 0:
        extra["top_k"] = F.lit(options.top_k)
    if options.enable_thinking is not None:
        thinking = F.lit(options.enable_thinking).alias("enable_thinking")
        extra["chat_template_kwargs"] = F.struct(thinking)
    if extra:
        fields["extra_body"] = F.struct(*(c.alias(k) for k, c in extra.items()))
    return df.withColumn("request", F.struct(*(c.alias(k) for k, c in fields.items())))


def preview_generate(
    df: DataFrame, input_column: str, num_samples: int = 1, output_column: str = "response"
) -> DataFrame:
    """The rows a generation run would give, with placeholder answers and no model."""
    # The words of a dry run.
    rows = sample_fanout(df, num_samples)
    if num_samples == 1:
        start = F.substring(input_text(input_column), 1, 50)
        answer = F.concat(F.lit("Dry run response for: "), start, F.lit("..."))
        thinking = F.lit("Dry run thinking...")
    else:
        number = (F.col("sample_idx") + 1).cast("string")
        answer = F.concat(F.lit("Dry run sample "), number)
        thinking = F.concat(F.lit("Dry run thinking "), number)
    return rows.withColumn(output_column, answer).withColumn("thinking_text", thinking)


_CALL = pa.struct(
    [
        ("text", pa.string()),
        ("thinking", pa.string()),
        ("finish_reason", pa.string()),
        ("error", pa.string()),
        ("prompt_tokens", pa.int32()),
        ("completion_tokens", pa.int32()),
        ("total_tokens", pa.int32()),
        ("prompt_length", pa.int32()),
        ("response_length", pa.int32()),
        ("latency", pa.float64()),
        ("success", pa.bool_()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
        ("attempts", pa.int32()),
        ("model", pa.string()),
        ("id", pa.string()),
        ("created", pa.int64()),
    ]
)
_CALL_DDL = (
    "_call STRUCT<text STRING, thinking STRING, finish_reason STRING, error STRING, prompt_tokens INT, "
    "completion_tokens INT, total_tokens INT, prompt_length INT, response_length INT, "
    "latency DOUBLE, success BOOLEAN, timestamp TIMESTAMP, attempts INT, model STRING, id STRING, created BIGINT>"
)
OUTCOME = ["finish_reason", "prompt_tokens", "completion_tokens", "total_tokens"]
REPLY = ["model", "id", "created"]
TELEMETRY = ["prompt_length", "response_length", "latency", "success", "error", "timestamp", "attempts"]


def _within(seconds: float | None, call: Callable[[], Any]) -> Any:
    """What ``call`` returns, or a ``TimeoutError``; a call that hangs is left to its own thread."""
    if seconds is None:
        return call()
    done: list[tuple[Any, BaseException | None]] = []

    def run() -> None:
        try:
            done.append((call(), None))
        except BaseException as failure:  # raised again in the caller's thread
            done.append((None, failure))

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    thread.join(seconds)
    if not done:
        raise TimeoutError(f"no reply within {seconds:g} s")
    value, failure = done[0]
    if failure is not None:
        raise failure
    return value


def _number(value: Any) -> int | None:
    return int(value) if isinstance(value, (int, float)) and value == value and abs(value) < 2**31 else None


def _string(value: Any) -> str | None:
    return None if value is None else str(value)


def _read_reply(reply: Any) -> dict[str, Any]:
    """What a reply says, as a flat record; raises if it has not the form of one."""
    if not isinstance(reply, Mapping):
        raise ValueError(f"malformed reply: {type(reply).__name__}")
    choices = reply.get("choices") or []
    first = choices[0] if choices else {}
    usage = reply.get("usage") or {}
    if not isinstance(first, Mapping) or not isinstance(usage, Mapping):
        raise ValueError("malformed reply: its first choice or its usage is no record")
    created = reply.get("created")
    return {
        "text": _string(first.get("text")) or "",
        "thinking": _string(first.get("thinking_text")) or "",
        "finish_reason": _string(first.get("finish_reason")),
        "prompt_tokens": _number(usage.get("prompt_tokens")),
        "completion_tokens": _number(usage.get("completion_tokens")),
        "total_tokens": _number(usage.get("total_tokens")),
        "model": _string(reply.get("model")),
        "id": _string(reply.get("id")),
        "created": created if isinstance(created, int) and abs(created) < 2**63 else None,
    }


FAILED = {"text": "", "thinking": "", "finish_reason": "error"}


def _ask(call: Callable[[], Any], retry: RetryOptions, prompt: str) -> dict[str, Any]:
    """One call with its retries, as a flat record; a failed or malformed one reads empty."""
    started, clock = datetime.now(timezone.utc), time.monotonic()
    record, error, attempts = None, None, 0
    while record is None and attempts < retry.max_attempts:
        attempts += 1
        try:
            reply = _within(retry.timeout, call)
            if reply is None:
                raise TransientError("no reply")
            record = _read_reply(reply)
        except Exception as failure:  # the row is kept whatever the backend raises or returns
            error = str(failure)
            if not isinstance(failure, RETRIED):
                break
            if attempts < retry.max_attempts:
                time.sleep(retry.wait(attempts))
    return (record or FAILED) | {
        "error": error if record is None else None,
        "prompt_length": len(prompt),
        "response_length": len((record or FAILED)["text"]),
        "latency": time.monotonic() - clock,
        "success": record is not None,
        "timestamp": started,
        "attempts": attempts,
    }


def _answered(
    df: DataFrame,
    factory: BackendFactory,
    prompt: str,
    index: str = "sample_idx",
    retry: RetryOptions = RetryOptions(),
    concurrency: int = 1,
    batch_rows: int = 64,
    temperature: str = "temperature",
    request: str = "request",
    endpoint: str = "endpoint",
) -> DataFrame:
    """The rows, each with the record of its call as ``_call``."""
    given = {"temperature": temperature, "index": index, "request": request, "endpoint": endpoint}
    given = {name: column for name, column in given.items() if column in df.columns}

    def calls(backend: Backend, batch: pa.RecordBatch) -> Iterator[tuple[Callable[[], Any], str]]:
        taken = inspect.signature(backend.generate).parameters
        every = any(p.kind is p.VAR_KEYWORD for p in taken.values())
        named = [n for n in ("request", "endpoint") if n in given and (every or n in taken)]
        for start in range(0, batch.num_rows, batch_rows):
            # A batch can hold thousands of long prompts: only a few rows at a time become Python objects.
            part = batch.slice(start, batch_rows)
            values = {name: part.column(column).to_pylist() for name, column in given.items() if name not in ("request", "endpoint") or name in named}
            for i, text in enumerate(part.column(prompt).to_pylist()):
                # A missing prompt is asked as the text None, like any other value.
                heat = values["temperature"][i] if "temperature" in values else None
                number = values["index"][i] if "index" in values else 0
                more = {n: values[n][i] for n in named}
                yield (lambda t=str(text), h=heat, n=number, m=more: backend.generate(t, h, n, **m)), str(text)

    def in_turn(pool: ThreadPoolExecutor, asked: Iterator[tuple[Callable[[], Any], str]]) -> Iterator[dict[str, Any]]:
        """The records in order, a few times ``concurrency`` calls ahead at most."""
        window: deque = deque()
        for call, text in asked:
            if concurrency == 1:
                yield _ask(call, retry, text)
                continue
            window.append(pool.submit(_ask, call, retry, text))
            if len(window) >= 4 * concurrency:
                yield window.popleft().result()
        while window:
            yield window.popleft().result()

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = factory()
        try:
            with ThreadPoolExecutor(concurrency) as pool:
                for batch in batches:
                    start, records = 0, []
                    # Answers can be long: hand on a few rows at a time.
                    for record in in_turn(pool, calls(backend, batch)):
                        records.append(record)
                        if len(records) == batch_rows or start + len(records) == batch.num_rows:
                            part = batch.slice(start, len(records))
                            yield part.append_column("_call", pa.array(records, _CALL))
                            start, records = start + len(records), []
        finally:
            if hasattr(backend, "close"):
                backend.close()

    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(_CALL_DDL).fields)
    return df.mapInArrow(answer, schema)


def _with_answers(answered: DataFrame, columns: list[str], output: str, extra: list[str]) -> DataFrame:
    kept = [c for c in columns if c not in (output, "thinking_text")]
    answer = [F.col("_call.text").alias(output), F.col("_call.thinking").alias("thinking_text")]
    calls = (F.col(f"_call.{name}").alias(f"reply_{name}" if name in REPLY else name) for name in extra)
    return answered.select(*kept, *answer, *calls)


def generate(
    df: DataFrame, factory: BackendFactory, prompt: str, output_column: str = "response", **options: Any
) -> DataFrame:
    """One answer per row: the output column and ``thinking_text``; a failed call reads empty.

    ``factory`` opens a backend once per partition.  Options are ``index``,
    ``temperature``, ``request`` and ``endpoint`` (the columns that hold them),
    ``retry``, ``concurrency`` (calls at a time) and ``batch_rows`` (answers handed on together).  All columns of ``df`` travel with
    the row, so select what is needed first.  Answers are not repeatable: write the
    result before using it twice.
    """
    answered = _answered(df, factory, prompt, **options)
    return _with_answers(answered, df.columns, output_column, [])


def generate_with_errors(
    df: DataFrame, factory: BackendFactory, prompt: str, output_column: str = "response", **options: Any
) -> DataFrame:
    """``generate`` with how each call ended, its telemetry, and the reply's ``reply_model``, ``reply_id`` and ``reply_created``.

    A call that fails for good has ``finish_reason`` ``error`` and the message.
    """
    extra = [*OUTCOME, *TELEMETRY]
    clash = {*extra, *(f"reply_{c}" for c in REPLY)} & set(df.columns)
    if clash:
        raise ValueError(f"input columns would be overwritten: {sorted(clash)}")
    return _with_answers(_answered(df, factory, prompt, **options), df.columns, output_column, [*extra, *REPLY])


def request_telemetry(
    df: DataFrame, factory: BackendFactory, prompt: str, keep: Sequence[str] = (), **options: Any
) -> DataFrame:
    """Call telemetry per row; an ``endpoint`` column of the input names the endpoint."""
    answered = _answered(df, factory, prompt, **options)
    calls = (F.col(f"_call.{name}").alias(name) for name in TELEMETRY)
    named = options.get("endpoint", "endpoint")
    endpoint = F.col(named) if named in df.columns else F.lit(None).cast("string")
    return answered.select(*keep, *calls, endpoint.alias("model_endpoint"))
