"""Joining, nesting and counting responses; pass rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register, rounded
from catalog.selection import documents
from sampleflow.operators import evaluate
from sampleflow.operators import responses as ops
from sampleflow.operators.ordering import FileOrder, HashOrder, KeyOrder, with_row_pos
from sampleflow.operators.sampling import sample_fanout
from sampleflow.sources import sinks, tables
from sampleflow.sources.storage import work_dir

TURNS = KeyOrder(("conv_id", "turn"))


def turns(spark, sf):
    return spark.read.parquet(f"{sf}/conversations.parquet")


@register("""
    WITH r AS (SELECT source AS response, row_number() OVER (ORDER BY md5('5|' || doc_id)) - 1 AS row_pos FROM documents),
         d AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS row_pos FROM documents)
    SELECT row_pos, doc_id, text, response FROM d JOIN r USING (row_pos)
""")
def attach_responses(spark, sf):
    rows = with_row_pos(documents(spark, sf, positions=True), FileOrder()).select("doc_id", "text", "row_pos")
    shuffled = with_row_pos(documents(spark, sf).select("doc_id", "source"), HashOrder(("doc_id",), 5))
    return ops.attach_responses(rows, shuffled.select("row_pos", F.col("source").alias("response")))


@register("""
    WITH d AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS row_pos FROM documents)
    SELECT row_pos, doc_id, coalesce(CAST(quality AS VARCHAR), lang) AS response
    FROM d LEFT JOIN (SELECT doc_id AS row_pos, quality FROM labels) USING (row_pos)
""")
def update_responses(spark, sf):
    rows = with_row_pos(documents(spark, sf, positions=True), FileOrder())
    rows = rows.select("row_pos", "doc_id", F.col("lang").alias("response"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    new = labels.select(F.col("doc_id").alias("row_pos"), F.col("quality").cast("string").alias("response"))
    return ops.update_responses(rows, new)


@register("""
    SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS sample_idx, unnest(l) AS response
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE lang <> 'de')
""")
def expand_responses(spark, sf):
    """The lines of every text; German documents have an empty list and go away."""
    lines = F.when(F.col("lang") == "de", F.array().cast("array<string>")).otherwise(F.split("text", "\n"))
    return ops.expand_responses(documents(spark, sf).select("doc_id", lines.alias("responses")), "responses")


@register("""
    WITH d AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS row_pos FROM documents)
    SELECT 1000000 - l.doc_id AS ord, row_pos, d.doc_id, lang, r AS response
    FROM d JOIN labels l ON l.doc_id = row_pos, unnest(['quality ' || quality, 'toxic ' || toxic]) AS u(r)
""")
def expand_at_indices(spark, sf):
    rows = with_row_pos(documents(spark, sf, positions=True), FileOrder()).select("doc_id", "lang", "row_pos")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    given = labels.select(
        (F.lit(1000000) - F.col("doc_id")).alias("ord"),
        F.col("doc_id").alias("row_pos"),
        F.array(
            F.concat(F.lit("quality "), F.col("quality").cast("string")),
            F.concat(F.lit("toxic "), F.col("toxic").cast("string")),
        ).alias("responses"),
    )
    return ops.expand_at_indices(rows, given)


@register("""
    SELECT p // 4 AS group_pos, CAST(count(*) AS INTEGER) AS n, string_agg(text, chr(30) ORDER BY p) AS responses
    FROM (SELECT text, row_number() OVER (ORDER BY conv_id, turn) - 1 AS p FROM conversations)
    GROUP BY p // 4
""")
def group_responses(spark, sf):
    grouped = ops.group_responses(with_row_pos(turns(spark, sf), TURNS), 4, "text")
    return grouped.select(
        "group_pos", F.size("responses").alias("n"), F.array_join("responses", "\x1e").alias("responses")
    )


@register("""
    SELECT p // 3 AS group_pos, CAST(p % 3 AS INTEGER) AS item_pos, text AS response
    FROM (SELECT text, row_number() OVER (ORDER BY conv_id, turn) - 1 AS p FROM conversations)
""")
def flatten_responses(spark, sf):
    return ops.flatten_responses(ops.group_responses(with_row_pos(turns(spark, sf), TURNS), 3, "text"))


@register("SELECT conv_id, count(*) AS responses, count(*) = 4 AS complete FROM conversations GROUP BY conv_id")
def response_count_check(spark, sf):
    return ops.response_count_check(turns(spark, sf), "conv_id", 4)


@register("SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_remaining(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return ops.resume_remaining(documents(spark, sf).select("doc_id", "text"), labels, ["doc_id"])


@register("""
    SELECT count(*) * 4 AS total_rows, 4 AS samples_per_input, CAST(4 AS BIGINT) AS sample_numbers,
           count(DISTINCT doc_id) AS distinct_inputs
    FROM documents
""")
def merge_stats(spark, sf):
    return ops.merge_stats(sample_fanout(documents(spark, sf), 4), ["doc_id"])


_MATCH = r"""
    WITH a AS (
        SELECT d.doc_id, {problem} AS problem, CAST(l.toxic AS VARCHAR) AS expected, CAST(l.quality AS VARCHAR) AS answer
        FROM documents d JOIN labels l USING (doc_id)
    ), g AS (SELECT problem, arg_min(expected, doc_id) AS gold FROM a GROUP BY problem)
    SELECT problem, count(*) FILTER (answer = gold) AS num_pass, count(*) AS num_total,
           round(count(*) FILTER (answer = gold) / count(*), 6) AS pass_rate
    FROM a JOIN g USING (problem) GROUP BY problem
"""


def answered_problems(spark, sf, problem):
    """Labelled documents as answers: boxed quality, expected to equal the toxic flag."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    boxed = F.concat("text", F.lit(" so \\boxed{"), F.col("quality").cast("string"), F.lit("}"))
    return documents(spark, sf).join(labels, "doc_id").select(
        "doc_id",
        F.col(problem).alias("problem"),
        F.col("toxic").cast("string").alias("expected_answer"),
        boxed.alias("response"),
    )


@register(_MATCH.format(problem="d.source"))
def pass_rate(spark, sf):
    return rounded(evaluate.pass_rate(answered_problems(spark, sf, "source"), ["doc_id"]))


@register(_MATCH.format(problem="d.text"))
def pass_rate_by_text(spark, sf):
    return rounded(evaluate.pass_rate(answered_problems(spark, sf, "text"), ["doc_id"]))


def text_vectors(spark, sf):
    """One vector per text: that of the first document with it."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").withColumnRenamed("vec_id", "doc_id")
    texts = documents(spark, sf).join(vectors, "doc_id").groupBy("text")
    return texts.agg(F.min_by("embedding", "doc_id").alias("embedding"))


_VECTORS = """
    v AS (
        SELECT text, arg_min(embedding, doc_id) AS embedding
        FROM documents JOIN (SELECT vec_id AS doc_id, embedding FROM embeddings) USING (doc_id) GROUP BY text
    )
"""


@register(
    "WITH"
    + _VECTORS
    + """
    SELECT doc_id, text, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[-1] AS DOUBLE) AS last
    FROM documents JOIN v USING (text)
"""
)
def join_embedding(spark, sf):
    rows = documents(spark, sf).select("doc_id", "text")
    joined = evaluate.join_embedding(rows, text_vectors(spark, sf), "text", strict=False)
    first, last = (F.element_at("embedding", i).cast("double") for i in (1, -1))
    return joined.select("doc_id", "text", first.alias("first"), last.alias("last"))


@register(
    "WITH"
    + _VECTORS
    + """
    SELECT doc_id, text, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[-1] AS DOUBLE) AS last
    FROM documents JOIN v USING (text)
"""
)
def join_embedding_buckets(spark, sf):
    """The same from vectors in buckets: they stay where they are stored."""
    path = work_dir(spark, "buckets")
    sinks.write_embedding_buckets(text_vectors(spark, sf), path, buckets=8)
    rows = documents(spark, sf).select("doc_id", "text")
    joined = evaluate.join_embedding(rows, tables.read_embedding_buckets(spark, path), "text", strict=False)
    first, last = (F.element_at("embedding", i).cast("double") for i in (1, -1))
    return joined.select("doc_id", "text", first.alias("first"), last.alias("last"))


@register(
    "WITH m AS ("
    + _MATCH.format(problem="d.text")
    + "),"
    + _VECTORS
    + """
    SELECT round(CAST(embedding[1] AS DOUBLE), 6) AS first, pass_rate AS target
    FROM m JOIN v ON problem = text WHERE pass_rate > 0
"""
)
def training_set(spark, sf):
    rates = evaluate.pass_rate(answered_problems(spark, sf, "text"), ["doc_id"])
    examples = evaluate.training_set(rates, text_vectors(spark, sf), strict=False)
    return rounded(examples.select(F.element_at("embedding", 1).cast("double").alias("first"), "target"), 6)


_EVERY = "v AS (SELECT DISTINCT text, [length(text), length(text) % 7] AS embedding FROM documents)"


def every_vector(spark, sf):
    """A vector for every text."""
    size = F.length("text")
    return documents(spark, sf).select("text").distinct().withColumn("embedding", F.array(size, size % 7).cast("array<float>"))


@register("WITH " + _EVERY + " SELECT doc_id, text, CAST(embedding[2] AS DOUBLE) AS last FROM documents JOIN v USING (text)")
def join_embedding_strict(spark, sf):
    """A join that fails if a text has no vector."""
    rows = documents(spark, sf).select("doc_id", "text")
    joined = evaluate.join_embedding(rows, every_vector(spark, sf), "text")
    return joined.select("doc_id", "text", F.element_at("embedding", 2).cast("double").alias("last"))


@register(
    "WITH m AS ("
    + _MATCH.format(problem="d.text")
    + "),"
    + _EVERY
    + """
    SELECT CAST(embedding[1] AS DOUBLE) AS first, pass_rate AS target
    FROM m JOIN v ON problem = text WHERE pass_rate > 0
"""
)
def training_set_strict(spark, sf):
    rates = evaluate.pass_rate(answered_problems(spark, sf, "text"), ["doc_id"])
    examples = evaluate.training_set(rates, every_vector(spark, sf))
    return rounded(examples.select(F.element_at("embedding", 1).cast("double").alias("first"), "target"), 6)
