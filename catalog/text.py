"""Column expressions on whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.selection import documents
from sampleflow.functions import answers, prompts, replies, text, vectors


@register(r"""
    SELECT doc_id, 'Be brief.' || chr(10) || chr(10) || 'Q {1}: ' || text || chr(10) || 'A:' AS prompt,
           text AS bare
    FROM documents
""")
def build_prompt(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        prompts.build_prompt("text", "Q {{1}}: {text}\nA:", "Be brief.").alias("prompt"),
        prompts.build_prompt("text", None, "Be brief.").alias("bare"),
    )


@register(r"""
    SELECT doc_id, '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10)
           || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || chr(10) AS prompt
    FROM documents
""")
def chat_wrap(spark, sf):
    return documents(spark, sf).select("doc_id", prompts.chat_wrap("text").alias("prompt"))


@register("SELECT doc_id, text FROM documents")
def chat_unwrap(spark, sf):
    """Undoing the chat form gives back every text."""
    wrapped = documents(spark, sf).select("doc_id", prompts.chat_wrap("text").alias("prompt"))
    return wrapped.select("doc_id", prompts.chat_unwrap("prompt").alias("text"))


@register("""
    SELECT conv_id, turn, CASE role WHEN 'assistant' THEN text WHEN 'system' THEN text ELSE '' END AS answer
    FROM conversations
""")
def extract_reply(spark, sf):
    """Assistant turns as choices, system turns as a top-level text, user turns without either."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    choice = F.struct("text", F.lit("stop").alias("finish_reason"), F.lit(0).alias("index"))
    second = F.struct(
        F.lit("other").alias("text"), F.lit("stop").alias("finish_reason"), F.lit(1).alias("index")
    )
    choices = F.when(F.col("role") == "assistant", F.array(choice, second)).when(
        F.col("role") == "user", F.array().cast("array<struct<text:string,finish_reason:string,index:int>>")
    )
    top = F.when(F.col("role") == "system", F.col("text"))
    raw = F.struct(choices.alias("choices"), top.alias("text")).alias("reply")
    replied = turns.select("conv_id", "turn", raw)
    return replied.select("conv_id", "turn", replies.extract_reply(replied, "reply").alias("answer"))


@register(r"""
    SELECT doc_id, trim(regexp_replace(text,
        '[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+',
        ' ', 'g')) AS clean
    FROM documents
""")
def clean_text(spark, sf):
    return documents(spark, sf).select("doc_id", text.clean_text("text").alias("clean"))


@register("""
    SELECT doc_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) ELSE text END AS cut,
           text AS whole
    FROM documents
""")
def truncate_hard(spark, sf):
    return documents(spark, sf).select(
        "doc_id", text.truncate_hard("text", 200).alias("cut"), text.truncate_hard("text", 0).alias("whole")
    )


@register("""
    SELECT doc_id, CASE WHEN length(text) <= 100 THEN text ELSE substring(text, 1, 97) || '...' END AS cut
    FROM documents
""")
def truncate_suffix(spark, sf):
    return documents(spark, sf).select("doc_id", text.truncate_suffix("text").alias("cut"))


@register("SELECT doc_id, substring(text, 1, 100) || '...' AS preview FROM documents")
def preview_text(spark, sf):
    return documents(spark, sf).select("doc_id", text.preview_text("text").alias("preview"))


@register("SELECT doc_id, substring(md5(text), 1, 8) AS batch FROM documents")
def batch_hash(spark, sf):
    return documents(spark, sf).select("doc_id", text.batch_hash("text").alias("batch"))


@register("SELECT event_id, substring(md5(props), 1, 8) AS batch FROM events")
def batch_hash_struct(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    record = F.from_json("props", "k INT")
    return events.select("event_id", text.batch_hash_struct(record, "k INT").alias("batch"))


@register("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, -1 AS broken_k,
           replace(props, ' ', '') AS parsed, '{"k":0}' AS broken
    FROM events
""")
def json_or_default(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    broken = F.concat("props", F.lit("}"))
    return events.select(
        "event_id",
        text.json_field_or_default("props", "$.k", "int", -1).alias("k"),
        text.json_field_or_default(broken, "$.k", "int", -1).alias("broken_k"),
        F.to_json(text.json_or_default("props")).alias("parsed"),
        F.to_json(text.json_or_default(broken, '{"k": 0}')).alias("broken"),
    )


@register("""
    SELECT event_id, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%.1fm', s / 60)
           ELSE printf('%.1fh', s / 3600) END AS took
    FROM (SELECT event_id, CASE event_type WHEN 'view' THEN value ELSE value * 100 END AS s FROM events)
""")
def format_duration(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    seconds = F.when(F.col("event_type") == "view", F.col("value")).otherwise(F.col("value") * 100)
    return events.select("event_id", text.format_duration(seconds).alias("took"))


def boxed_texts(spark, sf):
    """Every document as an answer that ends in one of six kinds of box."""
    kinds = [
        "no box",
        "\\boxed{N}",
        "\\boxed{a} and \\boxed{\\frac{N}{2}} end}",
        "\\boxed{N",
        "\\boxed{a{b{N}}}",
        "\\boxed{x \\boxed{N}} z}",
    ]
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("doc_id") % 6 + 1).cast("int"))
    box = F.replace(kind, F.lit("N"), F.col("n_chars").cast("string"))
    return documents(spark, sf).select("doc_id", F.concat("text", F.lit(" "), box).alias("response"))


@register(r"""
    WITH t AS (
        SELECT doc_id, text || ' ' || replace((['no box', '\boxed{N}', '\boxed{a} and \boxed{\frac{N}{2}} end}',
            '\boxed{N', '\boxed{a{b{N}}}', '\boxed{x \boxed{N}} z}'])[doc_id % 6 + 1],
            'N', CAST(n_chars AS VARCHAR)) AS response
        FROM documents
    ), p AS (
        SELECT doc_id, contains(response, '\boxed{') AS has, string_split(response, '\boxed{')[-1] AS piece FROM t
    ), braces AS (
        SELECT doc_id, i, sum(CASE c WHEN '{' THEN 1 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY i) AS depth
        FROM (SELECT doc_id, unnest(range(1, length(piece) + 1)) AS i, unnest(string_split(piece, '')) AS c FROM p WHERE has)
        WHERE c IN ('{', '}')
    ), ends AS (SELECT doc_id, min(i) FILTER (depth < 0) AS close FROM braces GROUP BY doc_id),
    deep AS (SELECT b.doc_id, max(depth) AS depth FROM braces b JOIN ends e ON b.doc_id = e.doc_id AND b.i < e.close GROUP BY b.doc_id)
    SELECT p.doc_id, CASE WHEN coalesce(depth, 0) <= 1 AND close IS NOT NULL THEN substring(piece, 1, close - 1) END AS answer
    FROM p LEFT JOIN ends USING (doc_id) LEFT JOIN deep USING (doc_id)
""")
def boxed_answer(spark, sf):
    return boxed_texts(spark, sf).select("doc_id", answers.boxed_answer("response").alias("answer"))


@register(r"""
    SELECT doc_id, quality, toxic, quality = 1 AS same_number, toxic = 1 AS same_fraction,
           quality = toxic AS same_text, false AS missing, false AS next_integer, true AS same_integer,
           false AS overflow, false AS bad_commas, true AS commas
    FROM labels
""")
def answer_match(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    quality, toxic = F.col("quality").cast("string"), F.col("toxic").cast("string")
    big = F.concat(F.lit("12345678901234567890"), quality)
    fraction = F.concat(F.lit("\\frac{"), toxic, F.lit("}{2}"))
    return labels.select(
        "*",
        answers.answer_match(F.concat(F.lit(" $"), quality, F.lit(".0$ ")), F.lit("1")).alias("same_number"),
        answers.answer_match(fraction, F.lit("0.5")).alias("same_fraction"),
        answers.answer_match(F.concat(F.lit("x "), quality), F.concat(F.lit("x  "), toxic)).alias("same_text"),
        answers.answer_match(F.lit(None).cast("string"), quality).alias("missing"),
        answers.answer_match(F.concat(F.lit("900719925474099"), quality), F.lit("9007199254740992")).alias("next_integer"),
        answers.answer_match(F.concat(F.lit("+0"), big, F.lit(".0")), big).alias("same_integer"),
        answers.answer_match(F.lit("1e400"), F.concat(F.lit("1e50"), quality)).alias("overflow"),
        answers.answer_match(F.concat(quality, F.lit(",2345")), F.concat(quality, F.lit("2345"))).alias("bad_commas"),
        answers.answer_match(F.concat(F.lit("1,23"), quality, F.lit(",567")), F.concat(F.lit("123"), quality, F.lit("567"))).alias("commas"),
    )


@register("""
    SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6)
           AS cosine
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def cosine_similarity(spark, sf):
    vectors_ = spark.read.parquet(f"{sf}/embeddings.parquet")
    following = vectors_.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following"))
    cosine = F.round(vectors.cosine_similarity("embedding", "following"), 6)
    return vectors_.join(following, "vec_id").select("vec_id", cosine.alias("cosine"))
