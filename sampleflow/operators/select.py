"""Row selection: filter, limit, shuffle, split, chunk and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleflow.functions.text import input_text
from sampleflow.operators.ordering import (
    HashOrder,
    RowOrder,
    at_or_after,
    before,
    before_rank,
    count_true,
    keyed,
    ordered_counts,
    unkeyed,
    with_row_pos,
)

# More bounds than this are not compared with in place; the splits are the same.
COMPARED_SPLITS = 256


def filter_rows(df: DataFrame, condition: str | None) -> DataFrame:
    """Keep rows for which a Spark SQL condition holds; no condition keeps all."""
    return df.where(F.expr(condition)) if condition else df


def limit_rows(df: DataFrame, n: int | None, order: RowOrder) -> DataFrame:
    """First ``n`` rows; ``None`` and 0 mean no limit, a negative ``n`` drops the last rows."""
    return before_rank(df, order, n) if n else df


def shuffle_rows(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    """Give the rows new positions, ``row_pos``, in a seeded random order that any run repeats."""
    return with_row_pos(df, HashOrder(tuple(key), seed))


def split_start(total: int, num_splits: int, split_id: int) -> int:
    """First position of a 1-based split; the remainder goes to the first splits."""
    size, extra = divmod(total, num_splits)
    return (split_id - 1) * size + min(split_id - 1, extra)


def split_rows(df: DataFrame, num_splits: int, order: RowOrder) -> DataFrame:
    """Add ``split_id``: contiguous balanced splits, numbered from 1.

    The split boundaries are found on the order columns alone; the rows
    themselves are compared with them in place and do not move.  Where there are
    too many boundaries to compare with, or one of them falls between rows with equal
    order values, rows get positions instead; the sizes are the same.
    """
    if num_splits < 1:
        raise ValueError("num_splits must be positive")
    cuts = None
    if num_splits <= COMPARED_SPLITS:
        counted = ordered_counts(df, order)
        # Splits that start past the last row are empty and have no cut.
        cuts = counted.cuts_at([split_start(counted.total, num_splits, i) for i in range(2, num_splits + 1)])
    if cuts is None:
        size, extra = divmod(df.count(), num_splits)
        pos, longer = F.col("_pos"), extra * (size + 1)
        short = F.floor((pos - longer) / max(size, 1)) + extra
        split = F.when(pos < longer, F.floor(pos / (size + 1))).otherwise(short) + 1
        return with_row_pos(df, order, "_pos").withColumn("split_id", split.cast("int")).drop("_pos")
    beyond = [at_or_after(df, order, cut) for _, cut in sorted(cuts.items())]
    numbered = keyed(df, order).withColumn("split_id", count_true(beyond) + 1)
    return unkeyed(numbered)


def select_split(df: DataFrame, split_id: int, num_splits: int, order: RowOrder) -> DataFrame:
    """Rows of one split; the bounds become scan filters."""
    if not 1 <= split_id <= num_splits:
        raise ValueError(f"split_id must be between 1 and {num_splits}, got {split_id}")
    counted = ordered_counts(df, order)
    start = split_start(counted.total, num_splits, split_id)
    end = split_start(counted.total, num_splits, split_id + 1)
    if start == end:
        return df.limit(0)
    bounds = [r for r in (start, end) if 0 < r < counted.total]
    cuts = counted.cuts_at(bounds)
    if cuts is None:
        placed = with_row_pos(df, order, "_pos")
        return placed.where((F.col("_pos") >= start) & (F.col("_pos") < end)).drop("_pos")
    rows = keyed(df, order)
    if start in cuts:
        rows = rows.where(at_or_after(df, order, cuts[start]))
    return unkeyed(rows.where(before(df, order, cuts[end])) if end in cuts else rows)


def split_bounds(df: DataFrame, num_splits: int) -> DataFrame:
    """Half-open position range of every split, empty ones included."""
    total = df.agg(F.count("*").alias("n"))
    size, extra = F.floor(F.col("n") / num_splits), F.col("n") % num_splits

    def start(split: Column) -> Column:
        return split * size + F.least(split, extra)

    return total.select("n", F.explode(F.sequence(F.lit(1), F.lit(num_splits))).alias("split_id")).select(
        "split_id",
        start(F.col("split_id") - 1).cast("long").alias("start_pos"),
        start(F.col("split_id")).cast("long").alias("end_pos"),
    )


def chunk_rows(df: DataFrame, size: int, order: RowOrder) -> DataFrame:
    """Add ``row_pos`` and ``batch_id``: consecutive chunks of ``size`` rows."""
    if size < 1:
        raise ValueError("chunk size must be positive")
    return with_row_pos(df, order).withColumn("batch_id", F.floor(F.col("row_pos") / size))


def distribute_rows(df: DataFrame, workers: int, order: RowOrder) -> DataFrame:
    """Add ``row_pos`` and ``worker``: rows dealt out in turn."""
    if workers <= 0:
        raise ValueError("number of workers must be positive")
    return with_row_pos(df, order).withColumn("worker", (F.col("row_pos") % workers).cast("int"))


def assign_endpoint(df: DataFrame, endpoints: Sequence[str], split: str = "split_id") -> DataFrame:
    """Add ``endpoint``: split i is served by endpoint i, in turn."""
    choices = F.array(*map(F.lit, endpoints))
    index = (F.col(split) - 1) % len(endpoints) + 1
    return df.withColumn("endpoint", F.element_at(choices, index.cast("int")))


def port_endpoints(count: int, host: str = "localhost", base_port: int = 8000) -> list[str]:
    """One URL per split, on consecutive ports."""
    return [f"http://{host}:{base_port + i}" for i in range(count)]


def input_texts(df: DataFrame, column: str) -> DataFrame:
    """The input column as text; a missing value reads ``None``."""
    return df.select(input_text(column).alias(column))


def output_skeleton(
    df: DataFrame, input_column: str, output_column: str, copy_columns: Sequence[str] = ()
) -> DataFrame:
    """Input column, the copy columns that exist, and an empty output column."""
    kept = dict.fromkeys([input_column, *(c for c in copy_columns if c in df.columns)])
    return df.select(*kept, F.lit(None).cast("string").alias(output_column))


def nested_input(df: DataFrame, field: str = "model_response.input") -> DataFrame:
    """The input text inside a struct column, duplicates kept."""
    return df.select(F.col(field).alias("input"))


def distinct_texts(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null texts of a column."""
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found; available: {df.columns}")
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def shortest_prompt(df: DataFrame, column: str, order_columns: Sequence[str]) -> DataFrame:
    """The first of the shortest texts."""
    best = F.min_by(F.col(column), F.struct(F.length(column), *order_columns))
    return df.where(F.col(column).isNotNull()).agg(best.alias(column)).where(F.col(column).isNotNull())


def train_val_split(
    df: DataFrame, key: Sequence[str], seed: int, train_fraction: float = 0.9
) -> DataFrame:
    """Add ``is_train``: a seeded random split with exactly ``int(fraction * n)`` train rows."""
    order = HashOrder(tuple(key), seed)
    counted = ordered_counts(df, order)
    train = int(train_fraction * counted.total)
    cuts = counted.cuts_at([train])
    if cuts is None:
        return with_row_pos(df, order, "_pos").withColumn("is_train", F.col("_pos") < train).drop("_pos")
    is_train = before(df, order, cuts[train]) if train in cuts else F.lit(True)
    return unkeyed(keyed(df, order).withColumn("is_train", is_train))
