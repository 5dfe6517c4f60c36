"""Reading prompt tables and embeddings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleflow.operators.ordering import FILE_COLUMNS
from sampleflow.sources.storage import bucket_table


def scan_prompts(
    spark: SparkSession, path: str, input_column: str | None = None, positions: bool = False
) -> DataFrame:
    """A parquet table; a missing path or input column is an error.

    ``positions`` adds ``src_file`` and ``src_row``, where each row is stored.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"input not found: {path}") from error
        raise
    if input_column is not None and input_column not in df.columns:
        raise ValueError(f"input column {input_column!r} not found; available: {df.columns}")
    if not positions:
        return df
    file, row = FILE_COLUMNS
    return df.select(
        "*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)
    )


def describe_schema(df: DataFrame) -> DataFrame:
    """Column names and type texts, without reading rows."""
    return df.sparkSession.createDataFrame(df.dtypes, "name STRING, type STRING")


def check_columns(df: DataFrame, input_column: str, copy_columns: Sequence[str] = ()) -> DataFrame:
    """The table itself, or one error that names every missing column."""
    missing = [c for c in dict.fromkeys([input_column, *copy_columns]) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """Text and vector pairs as ``write_embeddings`` stores them."""
    df = scan_prompts(spark, path)
    return check_columns(df, "text", ["embedding"]).select("text", "embedding")


def read_embedding_buckets(spark: SparkSession, path: str) -> DataFrame:
    """``text_key``, ``text`` and ``embedding`` as ``write_embedding_buckets`` stores them, with their buckets."""
    name, buckets = bucket_table(path), int(spark.read.text(f"{path.rstrip('/')}.buckets").first().value)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (text_key STRING, text STRING, embedding ARRAY<FLOAT>) USING parquet "
        f"CLUSTERED BY (text_key) SORTED BY (text_key) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
