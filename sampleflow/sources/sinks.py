"""Writing results, in one piece, by split or by batch, and merging the parts."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleflow.functions.prompts import chat_unwrap
from sampleflow.sources.storage import bucket_table, exists, publish, remove
from sampleflow.spec import SplitOptions


def _stem(path: str) -> tuple[str, str]:
    stem = path.removesuffix(".parquet")
    return stem, path[len(stem) :]


def split_path(path: str, split: SplitOptions) -> str:
    """The output name of one split: ``stem-<i>-of-<n>`` with the suffix of ``path``."""
    stem, suffix = _stem(path)
    return f"{stem}{split.suffix()}{suffix}"


def batch_path(path: str, batch_id: int) -> str:
    """The output name of one batch: the stem, then the batch number in four digits."""
    return f"{_stem(path)[0]}_batch_{batch_id:04d}.parquet"


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write a whole table as snappy parquet, replacing what was there once it is whole; returns it read back."""
    publish(df.sparkSession, path, df.write.option("compression", "snappy").parquet)
    return df.sparkSession.read.parquet(path)


def write_split(df: DataFrame, path: str, split: SplitOptions) -> DataFrame:
    """Write one split under its own name."""
    return write_table(df, split_path(path, split))


def _write_parts(df: DataFrame, path: str, column: str) -> DataFrame:
    publish(df.sparkSession, path, df.write.option("compression", "snappy").partitionBy(column).parquet)
    # Folder names carry no type, so say what the column was.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_splits(df: DataFrame, path: str) -> DataFrame:
    """Write all splits in one job, one folder per ``split_id``."""
    return _write_parts(df, path, "split_id")


def write_batches(df: DataFrame, path: str) -> DataFrame:
    """Write all batches in one job, one folder per ``batch_id``."""
    return _write_parts(df, path, "batch_id")


def write_batch(df: DataFrame, path: str, batch_id: int) -> str:
    """Write one batch under its own name; returns that name."""
    target = batch_path(path, batch_id)
    write_table(df, target)
    return target


def _read_together(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One scan over all parts; a column only some parts have is null in the others."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def merge_batches(spark: SparkSession, paths: Sequence[str], output_path: str) -> DataFrame | None:
    """Join the batch outputs that exist into one, then remove them.

    Without any, there is a warning and no output.
    """
    found = [p for p in paths if exists(spark, p)]
    if not found:
        warnings.warn("no batch outputs to merge", stacklevel=2)
        return None
    merged = write_table(_read_together(spark, found), output_path)
    for path in found:  # the merged output is committed by now
        remove(spark, path)
    return merged


def find_splits(spark: SparkSession, path: str, num_splits: int) -> tuple[list[str], list[str]]:
    """Names of the split outputs that exist and of those that do not, by split number."""
    names = [split_path(path, SplitOptions(i, num_splits)) for i in range(1, num_splits + 1)]
    found = [n for n in names if exists(spark, n)]
    if not found:
        raise FileNotFoundError(f"no splits of {path} in {num_splits}")
    return found, [n for n in names if n not in found]


def merge_splits(
    spark: SparkSession, path: str, num_splits: int, output_path: str | None = None
) -> DataFrame:
    """Join the split outputs of ``path`` into one; missing ones are warned about."""
    found, missing = find_splits(spark, path, num_splits)
    if missing:
        warnings.warn(f"missing {len(missing)} splits: {missing}", stacklevel=2)
    return write_table(_read_together(spark, found), output_path or path)


def write_checkpoint(
    df: DataFrame, base: str, checkpoint_id: str, metadata: Mapping[str, Any], split_id: int | None = None
) -> str:
    """Write a table with notes, all kept as text; returns where.

    The notes come last, so a checkpoint that has them is whole.
    """
    # Where a checkpoint lies and what it is called.
    parts = ["checkpoint", checkpoint_id, *(f"split{i}" for i in (split_id,) if i is not None)]
    path = f"{base.rstrip('/')}/checkpoints/{'_'.join(parts)}"
    spark = df.sparkSession
    remove(spark, f"{path}/metadata")
    write_table(df, f"{path}/data")
    notes = [F.struct(F.lit(k).alias("key"), F.lit(str(v)).alias("value")) for k, v in metadata.items()]
    entries = F.array(*notes) if notes else F.lit(None)
    record = F.map_from_entries(entries.cast("array<struct<key: string, value: string>>"))
    write_table(spark.range(1).select(record.alias("metadata")), f"{path}/metadata")
    return path


def read_checkpoint(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, str]]:
    """The table of a checkpoint and its notes."""
    notes = spark.read.parquet(f"{path}/metadata").first()["metadata"]
    return spark.read.parquet(f"{path}/data"), dict(notes or {})


def write_scores(df: DataFrame, path: str) -> DataFrame:
    """Write text and score as JSON lines, one per distinct text."""
    scores = df.select("text", "score").dropDuplicates(["text"])
    publish(df.sparkSession, path, scores.write.json)
    return df.sparkSession.read.schema(scores.schema).json(path)


def write_embeddings(df: DataFrame, path: str) -> DataFrame:
    """Write text and vector pairs."""
    vectors = F.col("embedding").cast("array<float>").alias("embedding")
    return write_table(df.select("text", vectors), path)


def write_embedding_buckets(df: DataFrame, path: str, buckets: int, wrapped: bool = False) -> DataFrame:
    """Write text and vector pairs in ``buckets`` by a digest of the text, for joins that leave the vectors where they are.

    ``wrapped`` texts are in chat form: the digest is of the text inside. ``read_embedding_buckets``
    finds the table again, in any session.
    """
    spark = df.sparkSession
    inner = chat_unwrap("text") if wrapped else F.col("text")
    rows = df.select(F.md5(inner).alias("text_key"), inner.alias("text"), F.col("embedding").cast("array<float>").alias("embedding"))
    name = bucket_table(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = rows.repartition(buckets, "text_key").write.mode("overwrite").format("parquet")
    writer.option("path", path).bucketBy(buckets, "text_key").sortBy("text_key").saveAsTable(name)
    publish(spark, f"{path.rstrip('/')}.buckets", spark.range(1).select(F.lit(str(buckets)).alias("value")).write.text)
    return spark.table(name)
