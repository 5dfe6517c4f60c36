"""Exact deduplication in steps: by length, then by a hash of the start, then by a hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.llm.graph import kept, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else. All-ASCII texts take the faster ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _marked(rows: DataFrame, prefix_chars: int, all_hashes: bool) -> DataFrame:
    """``rows`` (``doc_id``, ``text``, others) with ``hash`` (of the whole text, if one of a group that survives the first steps), ``keep_id``, ``n`` and ``kept``."""
    others = rows.columns[2:]
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumns(
        {"size": F.octet_length("text"), "head": F.xxhash64(ascii_lower(F.substring("text", 1, prefix_chars)))}
    )
    # As many rows as there are lengths; broadcast while few, so that a frequent length is no one task's.
    lengths = kept(rows.groupBy("size").count().where("count > 1").select("size"), "lengths")
    heads = rows.select("size", "head").join(small(lengths), "size", "left_semi")
    heads = kept(heads.groupBy("size", "head").count().where("count > 1").drop("count"), "heads")
    rows = rows.join(small(heads.withColumn("alike", F.lit(True))), ["size", "head"], "left")
    whole = F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)
    rows = rows.select(
        "doc_id", *others, "size", "alike", (whole if all_hashes else F.when(F.col("alike"), whole)).alias("hash")
    )
    by_id = rows.where("alike").groupBy("size", "hash", "doc_id").agg(F.count("*").alias("ties"))
    groups = by_id.groupBy("size", "hash").agg(F.sum("ties").alias("n"), F.max(F.struct("doc_id", "ties")).alias("last"))
    groups = groups.where("n > 1").select("size", "hash", "n", F.col("last.doc_id").alias("keep_id"), "last.ties")
    groups = kept(groups, "groups")
    rows = rows.join(small(groups), ["size", "hash"], "left")
    mine = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    rows = rows.withColumn("kept", F.col("n").isNull() | mine)
    if groups.where("ties > 1").limit(1).count():  # rows that repeat a doc_id and its text: one stays
        tied = F.col("n").isNotNull() & mine & (F.coalesce("ties", F.lit(1)) > 1)
        order = [F.to_json(c) for c in others] or ["doc_id"]
        one = F.row_number().over(Window.partitionBy("size", "hash").orderBy(*order)) == 1
        rows = rows.where(~tied).unionByName(rows.where(tied).withColumn("kept", one))
    return rows


def exact_groups(docs: DataFrame, prefix_chars: int = 64, all_hashes: bool = False) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest doc_id is kept (of rows that repeat that doc_id and
    text, one). A null doc_id is smaller than any other. A group's length comes first,
    then a hash of the first ``prefix_chars`` characters; the whole text is read and
    hashed only where both are shared, and ``text_sha256`` is null elsewhere unless
    ``all_hashes``. Other columns are not used.
    """
    return _marked(docs.select("doc_id", "text"), prefix_chars, all_hashes).select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        "kept",
        F.col("hash").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, prefix_chars: int = 64) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    return _marked(rows, prefix_chars, False).where("kept").select("row.*")
