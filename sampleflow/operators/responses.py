"""Bring responses and their rows together, and nest or unnest them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_responses(df: DataFrame, responses: DataFrame, output_column: str = "response") -> DataFrame:
    """Give every row the response at its ``row_pos``.

    There must be as many responses as rows: a position that only one side has
    fails the job when it runs.
    """
    rows = df.drop(output_column).withColumn("_row", F.lit(True))
    given = responses.select("row_pos", output_column, F.lit(True).alias("_given"))
    unpaired = F.col("_row").isNull() | F.col("_given").isNull()
    position = F.col("row_pos").cast("string")
    error = F.raise_error(F.concat(F.lit("rows and responses differ in number at "), position))
    checked = F.when(unpaired, error).otherwise(F.col(output_column))
    joined = rows.join(given, "row_pos", "full")
    return joined.withColumn(output_column, checked).drop("_row", "_given")


def update_responses(df: DataFrame, responses: DataFrame, output_column: str = "response") -> DataFrame:
    """Overwrite the response of the rows named in ``responses``; keep the others."""
    if output_column not in df.columns:
        df = df.withColumn(output_column, F.lit(None).cast("string"))
    new = responses.select("row_pos", F.col(output_column).alias("_new"))
    merged = F.coalesce("_new", output_column)
    return df.join(new, "row_pos", "left").withColumn(output_column, merged).drop("_new")


def expand_responses(df: DataFrame, list_column: str, output_column: str = "response") -> DataFrame:
    """One row per response in a list column, numbered by ``sample_idx``.

    A row with an empty list goes away.
    """
    kept = [c for c in df.columns if c not in (list_column, output_column, "sample_idx")]
    return df.select(*kept, F.posexplode(list_column).alias("sample_idx", output_column))


def expand_at_indices(df: DataFrame, given: DataFrame, output_column: str = "response") -> DataFrame:
    """Rows at the given positions, once per response.

    ``given`` holds ``ord`` (the order it is listed in), ``row_pos`` and
    ``responses``; rows it does not name are dropped.
    """
    kept = [c for c in df.columns if c not in (output_column, "row_pos")]
    joined = df.join(given.select("ord", "row_pos", "responses"), "row_pos")
    return joined.select("ord", "row_pos", *kept, F.explode("responses").alias(output_column))


def group_responses(
    df: DataFrame, num_samples: int, response: str = "response", pos: str = "row_pos"
) -> DataFrame:
    """Lists of ``num_samples`` consecutive responses; the last may be shorter."""
    if num_samples < 1:
        raise ValueError("num_samples must be positive")
    group = F.floor(F.col(pos) / num_samples).alias("group_pos")
    # A list never holds more than num_samples items.
    items = F.sort_array(F.collect_list(F.struct(pos, F.col(response).alias("r"))))
    return df.groupBy(group).agg(F.transform(items, lambda i: i["r"]).alias("responses"))


def flatten_responses(df: DataFrame, list_column: str = "responses", pos: str = "group_pos") -> DataFrame:
    """Lists back to single responses; ``(pos, item_pos)`` carries the order."""
    return df.select(pos, F.posexplode(list_column).alias("item_pos", "response"))


def response_count_check(df: DataFrame, key: str, expected: int) -> DataFrame:
    """Responses per input, and whether there are as many as expected."""
    return df.groupBy(key).agg(F.count("*").alias("responses")).withColumn(
        "complete", F.col("responses") == expected
    )


def total_count_check(df: DataFrame, expected: int) -> DataFrame:
    """Responses in all, and whether there are as many as expected."""
    return df.agg(F.count("*").alias("responses")).withColumn("complete", F.col("responses") == expected)


#: Bits of the filter on done keys, at most: 8 MB of bitmaps.
DONE_BITS = 1 << 26
#: Types whose equal values always have the same hash.
HASHED_ALIKE = ("string", "binary", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp")


def resume_remaining(df: DataFrame, done: DataFrame, key: list[str], bits: int = DONE_BITS) -> DataFrame:
    """Rows that have no answer yet.

    Done keys set bits of a filter of at most ``bits``, which is sent to all tasks: rows whose
    bit is not set are new and stay where they are, only the others move to be looked
    up among the done keys. Keys of types whose hashes may differ, and streams, are all looked up.
    """
    keys, kinds = done.select(*key), dict(done.dtypes)
    alike = all(t == kinds[c] and t in HASHED_ALIKE for c, t in df.select(*key).dtypes)
    if df.isStreaming or not alike:
        return df.join(keys, key, "left_anti")
    # Bitmap functions count places from 1.
    place = F.pmod(F.xxhash64(*key), F.lit(bits)) + 1
    marks = keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_bucket"))
    marks = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = df.join(F.broadcast(marks), F.bitmap_bucket_number(place) == F.col("_bucket"), "left")
    seen = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    marked = marked.withColumn("_seen", seen).drop("_bucket", "_bits")
    new = marked.where(~F.col("_seen")).drop("_seen")
    return new.unionByName(marked.where("_seen").drop("_seen").join(keys, key, "left_anti").select(*new.columns))


def merge_stats(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows, samples per input, sample numbers in use, and distinct inputs of an output.

    An output of one sample each has no ``sample_idx``.
    """
    if "sample_idx" not in df.columns:
        df = df.withColumn("sample_idx", F.lit(0))
    # Inputs first: a distinct count next to other totals would expand every row.
    per_input = df.groupBy(*key).agg(F.count("*").alias("rows"), F.max("sample_idx").alias("last"))
    inputs = per_input.agg(
        F.sum("rows").alias("total_rows"),
        (F.max("last") + 1).alias("samples_per_input"),
        F.count("*").alias("distinct_inputs"),
    )
    numbers = df.select("sample_idx").where("sample_idx IS NOT NULL").distinct()
    numbers = numbers.agg(F.count("*").alias("sample_numbers"))
    both = inputs.unionByName(numbers, allowMissingColumns=True)
    return both.agg(
        F.coalesce(F.max("total_rows"), F.lit(0)).alias("total_rows"),
        F.max("samples_per_input").alias("samples_per_input"),
        F.max("sample_numbers").alias("sample_numbers"),
        F.max("distinct_inputs").alias("distinct_inputs"),
    )
