"""Filters, limits, shuffles, splits, chunks and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from sampleflow.operators import select as ops
from sampleflow.operators.ordering import FileOrder, KeyOrder
from sampleflow.sources import tables


def documents(spark, sf, positions=False):
    return tables.scan_prompts(spark, f"{sf}/documents.parquet", "text", positions)


@register("SELECT * FROM documents")
def scan_prompts(spark, sf):
    return documents(spark, sf)


@register("""
    SELECT column_name AS name,
           CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' END AS type
    FROM (DESCRIBE documents)
""")
def describe_schema(spark, sf):
    return tables.describe_schema(documents(spark, sf))


@register("SELECT text, lang, source FROM documents")
def check_columns(spark, sf):
    return tables.check_columns(documents(spark, sf), "text", ["lang", "source"]).select(
        "text", "lang", "source"
    )


@register("SELECT * FROM documents WHERE lang <> 'de' AND n_chars > 500")
def filter_rows(spark, sf):
    return ops.filter_rows(documents(spark, sf), "lang <> 'de' AND n_chars > 500")


@register("SELECT doc_id, lang, text FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 100")
def limit_rows(spark, sf):
    english = ops.filter_rows(documents(spark, sf, positions=True), "lang = 'en'")
    return ops.limit_rows(english, 100, FileOrder()).select("doc_id", "lang", "text")


@register("""
    SELECT doc_id, text, row_number() OVER (ORDER BY md5('7|' || doc_id)) - 1 AS row_pos FROM documents
""")
def shuffle_rows(spark, sf):
    return ops.shuffle_rows(documents(spark, sf).select("doc_id", "text"), ["doc_id"], seed=7)


@register("""
    SELECT doc_id, text, CAST(ntile(7) OVER (ORDER BY doc_id) AS INTEGER) AS split_id
    FROM documents WHERE lang = 'en'
""")
def split_rows(spark, sf):
    english = ops.filter_rows(documents(spark, sf, positions=True), "lang = 'en'")
    return ops.split_rows(english, 7, FileOrder()).select("doc_id", "text", "split_id")


@register("""
    SELECT conv_id, turn, CAST(ntile(8) OVER (ORDER BY conv_id, turn) AS INTEGER) AS split_id
    FROM conversations
""")
def split_rows_by_key(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    return ops.split_rows(turns, 8, KeyOrder(("conv_id", "turn"))).select("conv_id", "turn", "split_id")


@register("""
    SELECT doc_id, text FROM (
        SELECT doc_id, text, ntile(4) OVER (ORDER BY md5('11|' || doc_id)) AS split_id FROM documents
    ) WHERE split_id = 2
""")
def select_split(spark, sf):
    """One split of the shuffled table; splits of one seed never overlap."""
    from sampleflow.operators.ordering import HashOrder

    rows = documents(spark, sf).select("doc_id", "text")
    return ops.select_split(rows, 2, 4, HashOrder(("doc_id",), 11))


@register("""
    SELECT CAST(i AS INTEGER) AS split_id,
           (i - 1) * (n // 7) + least(i - 1, n % 7) AS start_pos,
           i * (n // 7) + least(i, n % 7) AS end_pos
    FROM (SELECT count(*) AS n FROM documents WHERE lang = 'fr'), range(1, 8) AS r(i)
""")
def split_bounds(spark, sf):
    return ops.split_bounds(ops.filter_rows(documents(spark, sf), "lang = 'fr'"), 7)


@register("""
    SELECT doc_id, lang, p AS row_pos, p // 64 AS batch_id FROM (
        SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents WHERE lang <> 'de'
    )
""")
def chunk_rows(spark, sf):
    rows = ops.filter_rows(documents(spark, sf, positions=True), "lang <> 'de'")
    return ops.chunk_rows(rows, 64, FileOrder()).select("doc_id", "lang", "row_pos", "batch_id")


@register("""
    SELECT conv_id, turn, p AS row_pos, CAST(p % 8 AS INTEGER) AS worker FROM (
        SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS p FROM conversations
    )
""")
def distribute_rows(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn")
    return ops.distribute_rows(turns, 8, KeyOrder(("conv_id", "turn")))


@register("""
    SELECT doc_id, s AS split_id, 'http://localhost:' || (8000 + s - 1) AS endpoint FROM (
        SELECT doc_id, CAST(ntile(8) OVER (ORDER BY doc_id) AS INTEGER) AS s FROM documents
    )
""")
def assign_endpoint(spark, sf):
    rows = ops.split_rows(documents(spark, sf).select("doc_id"), 8, KeyOrder(("doc_id",)))
    return ops.assign_endpoint(rows, ops.port_endpoints(8))


@register("""
    SELECT coalesce(CAST(quality AS VARCHAR), 'None') AS quality FROM documents LEFT JOIN labels USING (doc_id)
""")
def input_texts(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return ops.input_texts(documents(spark, sf).join(labels, "doc_id", "left"), "quality")


@register("SELECT text, lang, CAST(NULL AS VARCHAR) AS response FROM documents")
def output_skeleton(spark, sf):
    return ops.output_skeleton(documents(spark, sf), "text", "response", ["lang", "absent"])


@register("SELECT text AS input FROM documents")
def nested_input(spark, sf):
    record = F.struct(F.col("text").alias("input"), "lang").alias("model_response")
    return ops.nested_input(documents(spark, sf).select(record))


@register("SELECT DISTINCT text FROM documents WHERE text IS NOT NULL")
def distinct_texts(spark, sf):
    return ops.distinct_texts(documents(spark, sf), "text")


@register("""
    SELECT text FROM documents WHERE text IS NOT NULL ORDER BY length(text), doc_id LIMIT 1
""")
def shortest_prompt(spark, sf):
    return ops.shortest_prompt(documents(spark, sf), "text", ["doc_id"])


@register("""
    SELECT vec_id, label, p <= CAST(floor(0.9::DOUBLE * n) AS BIGINT) AS is_train FROM (
        SELECT *, row_number() OVER (ORDER BY md5('42|' || vec_id)) AS p, count(*) OVER () AS n FROM embeddings
    )
""")
def train_val_split(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label")
    return ops.train_val_split(rows, ["vec_id"], seed=42)


def judged(spark, sf):
    """Documents with their label, where there is one."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return documents(spark, sf).join(labels, "doc_id", "left").select("doc_id", "quality", "text")


BY_QUALITY = KeyOrder(("quality", "doc_id"))
JUDGED = "documents d LEFT JOIN labels l USING (doc_id)"
NULLS_FIRST = "ORDER BY quality NULLS FIRST, doc_id"


@register(f"SELECT doc_id, quality, text FROM {JUDGED} {NULLS_FIRST} LIMIT 150")
def limit_rows_null_key(spark, sf):
    return ops.limit_rows(judged(spark, sf), 150, BY_QUALITY)


@register(f"""
    SELECT doc_id, quality, CAST(ntile(7) OVER ({NULLS_FIRST}) AS INTEGER) AS split_id FROM {JUDGED}
""")
def split_rows_null_key(spark, sf):
    return ops.split_rows(judged(spark, sf).drop("text"), 7, BY_QUALITY)


@register(f"""
    SELECT doc_id, quality FROM (SELECT doc_id, quality, ntile(4) OVER ({NULLS_FIRST}) AS split_id FROM {JUDGED})
    WHERE split_id = 2
""")
def select_split_null_key(spark, sf):
    return ops.select_split(judged(spark, sf).drop("text"), 2, 4, BY_QUALITY)


@register("""
    SELECT doc_id, CAST(ntile(300) OVER (ORDER BY doc_id) AS INTEGER) AS split_id FROM documents
""")
def split_rows_many(spark, sf):
    return ops.split_rows(documents(spark, sf).select("doc_id"), 300, KeyOrder(("doc_id",)))


@register("SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 500")
def limit_rows_by_time(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    return ops.limit_rows(events, 500, KeyOrder(("ts", "event_id")))


@register("""
    SELECT doc_id, CAST(ntile(5) OVER (ORDER BY encode(repeat('same ', 80) || text), doc_id) AS INTEGER) AS split_id
    FROM documents
""")
def split_rows_by_text(spark, sf):
    """Keys that share their first 400 bytes."""
    prefixed = F.concat(F.lit("same " * 80), "text").alias("key")
    rows = documents(spark, sf).select("doc_id", prefixed)
    return ops.split_rows(rows, 5, KeyOrder(("key", "doc_id"))).select("doc_id", "split_id")
