"""Writing, merging and reading back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.selection import documents
from sampleflow.operators.ordering import FileOrder
from sampleflow.operators.sampling import preview_generate
from sampleflow.operators.select import chunk_rows, select_split, split_rows
from sampleflow.sources import sinks, tables
from sampleflow.sources.storage import work_dir
from sampleflow.spec import SplitOptions
from sampleflow.streaming import incremental

@register("SELECT * FROM documents")
def write_table(spark, sf):
    return sinks.write_table(documents(spark, sf), work_dir(spark, "table") + ".parquet")


@register("SELECT *, CAST(ntile(8) OVER (ORDER BY doc_id) AS INTEGER) AS split_id FROM documents")
def write_splits(spark, sf):
    rows = split_rows(documents(spark, sf, positions=True), 8, FileOrder()).drop("src_file", "src_row")
    return sinks.write_splits(rows, work_dir(spark, "splits"))


@register("""
    SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 500 AS batch_id FROM documents
""")
def write_batches(spark, sf):
    rows = chunk_rows(documents(spark, sf, positions=True), 500, FileOrder())
    return sinks.write_batches(rows.select("doc_id", "text", "batch_id"), work_dir(spark, "batches"))


@register("""
    SELECT *, CASE WHEN b = 1 THEN 'late' END AS note
    FROM (SELECT doc_id, text, CAST(doc_id % 3 AS INTEGER) AS b FROM documents)
""")
def merge_batches(spark, sf):
    """Three batch outputs, one with a column of its own, and a fourth that is missing."""
    out = work_dir(spark, "merged") + ".parquet"
    rows = documents(spark, sf).select("doc_id", "text", (F.col("doc_id") % 3).cast("int").alias("b"))
    paths = []
    for i in range(3):
        part = rows.where(F.col("b") == i)
        part = part.withColumn("note", F.lit("late")) if i == 1 else part
        paths.append(sinks.write_batch(part, out, i))
    merged = sinks.merge_batches(spark, [*paths, sinks.batch_path(out, 3)], out)
    return merged.select("doc_id", "text", "b", "note")


@register("SELECT * FROM documents")
def merge_splits(spark, sf):
    """Four separate runs, one split each, merged."""
    out = work_dir(spark, "runs") + ".parquet"
    for i in range(1, 5):
        part = select_split(documents(spark, sf, positions=True), i, 4, FileOrder())
        sinks.write_split(part.drop("src_file", "src_row"), out, SplitOptions(i, 4))
    return sinks.merge_splits(spark, out, 4)


def _checkpointed(spark, sf):
    base = work_dir(spark, "state")
    path = sinks.write_checkpoint(documents(spark, sf), base, "docs", {"stage": "scan", "step": 3}, split_id=2)
    return sinks.read_checkpoint(spark, path)


@register("SELECT * FROM documents")
def write_checkpoint(spark, sf):
    return _checkpointed(spark, sf)[0]


@register("SELECT doc_id, lang, 'scan' AS stage, '3' AS step FROM documents")
def read_checkpoint(spark, sf):
    rows, notes = _checkpointed(spark, sf)
    return rows.select("doc_id", "lang", *(F.lit(v).alias(k) for k, v in sorted(notes.items())))


@register("""
    SELECT doc_id, 'Dry run response for: ' || substring(text, 1, 50) || '...' AS response,
           'Dry run thinking...' AS thinking_text
    FROM documents
""")
def incremental_save(spark, sf):
    """Stage prompts as files, answer and save them file by file."""
    base = work_dir(spark, "incremental")
    prompts = documents(spark, sf).select("doc_id", "text")
    incremental.stage_prompts(prompts, f"{base}/prompts", rows_per_file=5000)
    stream = incremental.read_prompt_stream(spark, f"{base}/prompts", prompts.schema)
    return incremental.incremental_save(
        stream, lambda df: preview_generate(df, "text").drop("text"), f"{base}/out", f"{base}/state"
    )


@register("""
    SELECT text, length(text) / 20000 AS score FROM (SELECT DISTINCT text FROM documents)
""")
def write_scores(spark, sf):
    scored = documents(spark, sf).select("text", (F.length("text") / 20000).alias("score"))
    return sinks.write_scores(scored, work_dir(spark, "scores"))


_VECTOR_SQL = """
    SELECT 'vector ' || vec_id AS text, CAST(len(embedding) AS INTEGER) AS dim,
           CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[-1] AS DOUBLE) AS last
    FROM embeddings
"""


def _stored_vectors(spark, sf, path):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    named = rows.select(F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("text"), "embedding")
    return sinks.write_embeddings(named, path)


def _ends(df):
    first, last = (F.element_at("embedding", i).cast("double") for i in (1, -1))
    return df.select("text", F.size("embedding").alias("dim"), first.alias("first"), last.alias("last"))


@register(_VECTOR_SQL)
def write_embeddings(spark, sf):
    return _ends(_stored_vectors(spark, sf, work_dir(spark, "vectors")))


@register(_VECTOR_SQL)
def read_embeddings(spark, sf):
    path = work_dir(spark, "vectors")
    _stored_vectors(spark, sf, path)
    return _ends(tables.read_embeddings(spark, path))
