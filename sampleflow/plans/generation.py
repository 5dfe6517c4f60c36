"""Whole jobs: from a prompt table to a table of answers."""

from __future__ import annotations

import hashlib
from dataclasses import fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sampleflow.functions.prompts import build_prompt
from sampleflow.functions.text import input_text
from sampleflow.operators.ordering import (
    FILE_COLUMNS,
    FileOrder,
    HashOrder,
    RowOrder,
    shuffle_partitions,
)
from sampleflow.operators.sampling import (
    OUTCOME,
    REPLY,
    TELEMETRY,
    BackendFactory,
    generate_with_errors,
    preview_generate,
    request_params,
    sample_fanout,
    temperature_schedule,
)
from sampleflow.operators.telemetry import observed_stats, run_metrics
from sampleflow.operators.select import filter_rows, limit_rows, select_split, split_rows
from sampleflow.sources.sinks import split_path, write_splits, write_table
from sampleflow.sources.storage import exists, files_digest, remove
from sampleflow.sources.tables import check_columns, scan_prompts
from sampleflow.spec import JobSpec
from sampleflow.streaming.incremental import incremental_save, read_prompt_stream, stage_prompts


def _ordered(spark: SparkSession, spec: JobSpec) -> tuple[DataFrame, RowOrder]:
    """Rows after filter and limit, and the order they are split in.

    A shuffle is an order, not a sort: it moves no rows here.
    """
    data = spec.data
    rows = scan_prompts(spark, data.input_path, data.input_column, positions=True)
    check_columns(rows, data.input_column, data.copy_columns or ())
    rows = limit_rows(filter_rows(rows, data.filter_condition), data.limit, FileOrder())
    if data.copy_columns is not None:
        rows = rows.select(*dict.fromkeys([data.input_column, *data.copy_columns, *FILE_COLUMNS]))
    if data.shuffle_seed is None:
        return rows, FileOrder()
    return rows, HashOrder(FILE_COLUMNS, data.shuffle_seed)


def _selected(spark: SparkSession, spec: JobSpec) -> DataFrame:
    rows, order = _ordered(spark, spec)
    if spec.split.split_id is None:
        return rows
    return select_split(rows, spec.split.split_id, spec.split.num_splits, order)


def select_prompts(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """The rows a job works on: filter, then limit, then shuffle, then split."""
    return _selected(spark, spec).drop(*FILE_COLUMNS)


def _spread(asked: DataFrame, tasks: int, index: list[str], num_splits: int) -> DataFrame:
    """Deal calls out over the tasks: they cost far more than a shuffle.

    This comes after the fan-out, so that the samples of one prompt spread too, and
    goes by where a row is stored, so that equal prompts do.  When several splits
    are written, each task gets rows of few of them and so writes few files.
    """
    if not set(FILE_COLUMNS) <= set(asked.columns):
        return asked.repartition(tasks)
    place = [*FILE_COLUMNS, *index]
    if num_splits > 1:
        parts = max(1, 4 * tasks // num_splits)
        asked = asked.repartition(tasks, "split_id", F.pmod(F.xxhash64(*place), F.lit(parts)))
    else:
        asked = asked.repartition(tasks, *place)
    return asked.drop(*FILE_COLUMNS)


def _endpoint(spec: JobSpec, rows: DataFrame) -> Column:
    """Which endpoint serves a row: its split's, or one by where the row is stored."""
    choices = F.array(*map(F.lit, spec.endpoints))
    if "split_id" in rows.columns:
        turn = F.col("split_id") - 1
    elif spec.split.split_id is not None:
        turn = F.lit(spec.split.split_id - 1)
    else:
        place = FILE_COLUMNS if set(FILE_COLUMNS) <= set(rows.columns) else ["_prompt"]
        turn = F.xxhash64(*place)
    return F.get(choices, F.pmod(turn, F.lit(len(spec.endpoints))).cast("int"))


def _answer(
    rows: DataFrame, spec: JobSpec, factory: BackendFactory, num_splits: int = 1, observed: Observation | None = None
) -> DataFrame:
    """The rows with their answers; the input's own columns travel as one, whatever they are called."""
    data, sampling = spec.data, spec.sampling
    index = ["sample_idx"] if sampling.num_samples > 1 else []
    split = ["split_id"] if num_splits > 1 else []
    places = [c for c in FILE_COLUMNS if c in rows.columns]
    replaced = {data.output_column, "thinking_text", *index, *split, *places}
    columns = [c for c in rows.columns if c not in replaced]
    prompt = build_prompt(input_text(data.input_column), spec.prompt_template, spec.system_prompt)
    own = F.struct(*(F.col(c) for c in columns)).alias("_row")
    asked = rows.select(own, *places, *split, prompt.alias("_prompt"))
    if spec.endpoints:
        asked = asked.withColumn("endpoint", _endpoint(spec, asked))
    asked = temperature_schedule(sample_fanout(asked, sampling.num_samples), sampling.temperature)
    asked = _spread(asked, spec.partitions or shuffle_partitions(rows), index, num_splits)
    # The request repeats the prompt: it is put together after the shuffle.
    asked = request_params(asked, "_prompt", sampling, spec.model)
    answered = generate_with_errors(
        asked,
        factory,
        "_prompt",
        output_column="_answer",
        retry=spec.retry,
        concurrency=spec.concurrency,
    )
    if observed:
        answered = answered.observe(observed, *run_metrics("sample_idx" if index else None))
    named = {"model_endpoint": F.col("endpoint")} if spec.endpoints else {}
    # A batch is what one task answers.
    named |= {"batch_id": F.spark_partition_id().cast("long")}
    calls = ["temperature", *OUTCOME, *TELEMETRY, *(f"reply_{c}" for c in REPLY)]
    extra = [*calls, *(c.alias(k) for k, c in named.items())] if spec.keep_telemetry else []
    texts = [F.col("_answer").alias(data.output_column), F.col("thinking_text")]
    return answered.select("_row.*", *split, *texts, *index, *extra)


def run_generation(spark: SparkSession, spec: JobSpec, factory: BackendFactory) -> DataFrame:
    """Answer every selected prompt and write the result; returns it read back."""
    answered = _answer(_selected(spark, spec), spec, factory)
    return write_table(answered, split_path(spec.data.output_path, spec.split))


def run_with_stats(spark: SparkSession, spec: JobSpec, factory: BackendFactory) -> tuple[DataFrame, dict[str, float]]:
    """``run_generation``, and what ``run_stats`` says of it, observed while it was written.

    There is no second pass, and the output needs no telemetry. A task that ran again after a
    loss counts once, as its output does.
    """
    observed = Observation("run")
    answered = _answer(_selected(spark, spec), spec, factory, observed=observed)
    written = write_table(answered, split_path(spec.data.output_path, spec.split))
    return written, observed_stats(observed.get)


def _claim(spark: SparkSession, spec: JobSpec, output: str) -> None:
    """Note next to ``output`` which job it belongs to, or raise if it is another one's."""
    asked = {f.name: getattr(spec, f.name) for f in fields(spec)}
    for name in ("retry", "concurrency", "partitions", "endpoints"):  # they do not change what is asked
        del asked[name]
    job = hashlib.md5(repr((asked, files_digest(spark, spec.data.input_path))).encode()).hexdigest()
    note = f"{output}.job"
    if exists(spark, note):
        known = spark.read.text(note).first()
        if known is None or known.value != job:
            raise ValueError(f"{output} belongs to another job: its data, prompts or sampling differ; remove it with {note} and {output}.work, or choose another output")
    elif exists(spark, output) or exists(spark, f"{output}.work"):
        raise ValueError(f"{output} was not written by an incremental run; choose another output")
    else:
        spark.range(1).select(F.lit(job).alias("value")).write.text(note)


def run_incremental(
    spark: SparkSession,
    spec: JobSpec,
    factory: BackendFactory,
    rows_per_file: int = 1000,
    files_per_batch: int = 100,
    cleanup: bool = True,
) -> DataFrame:
    """``run_generation`` that saves as it goes and, called again, goes on where it stopped.

    The selected prompts are first stored as files of ``rows_per_file`` rows; every
    ``files_per_batch`` of them are answered and committed together.  The stored
    prompts and the record of progress lie next to the output until it is whole.
    An output that is already whole is returned as it is.  Output and stored prompts
    belong to one job: a call with other data, prompts or sampling is refused.
    """
    output = split_path(spec.data.output_path, spec.split)
    work = f"{output}.work"
    _claim(spark, spec, output)
    if exists(spark, output) and not exists(spark, work):
        return spark.read.parquet(output)
    if not exists(spark, f"{work}/prompts/_SUCCESS"):
        remove(spark, f"{work}/prompts")
        stage_prompts(select_prompts(spark, spec), f"{work}/prompts", rows_per_file)
    schema = spark.read.parquet(f"{work}/prompts").schema
    prompts = read_prompt_stream(spark, f"{work}/prompts", schema, files_per_batch)
    saved = incremental_save(prompts, lambda rows: _answer(rows, spec, factory), output, f"{work}/state")
    if cleanup:
        remove(spark, work)
    return saved


def run_all_splits(
    spark: SparkSession, spec: JobSpec, num_splits: int, factory: BackendFactory
) -> DataFrame:
    """All splits in one job, written by ``split_id``."""
    rows, order = _ordered(spark, spec)
    answered = _answer(split_rows(rows, num_splits, order), spec, factory, num_splits)
    return write_splits(answered, spec.data.output_path)


def preview_generation(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """The rows a run would give, with placeholder answers; nothing is written."""
    rows = select_prompts(spark, spec)
    previewed = preview_generate(
        rows, spec.data.input_column, spec.sampling.num_samples, spec.data.output_column
    )
    columns = [c for c in rows.columns if c not in (spec.data.output_column, "thinking_text")]
    index = ["sample_idx"] if spec.sampling.num_samples > 1 else []
    return previewed.select(*columns, spec.data.output_column, "thinking_text", *index)
