"""Pass rates of answered problems, and their join with embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleflow.functions.answers import answer_number, boxed_answer, normal_answer, same_answer
from sampleflow.functions.prompts import chat_unwrap

SALTS = 16  # a power of two


def pass_rate(
    df: DataFrame,
    order_columns: list[str],
    problem: str = "problem",
    expected: str = "expected_answer",
    response: str = "response",
) -> DataFrame:
    """Passed and total responses per problem and their ratio.

    The gold answer of a problem is the one its first row expects; finding it does
    not read the responses.  Equal answers to a problem are counted before anything
    moves and compared once; a problem with very many different answers is spread
    over several tasks.
    """
    first = F.min(F.struct(*order_columns, F.col(expected).alias("answer")))
    gold = _with_forms(df.groupBy(problem).agg(first.getField("answer").alias("answer")), "gold")
    gold = gold.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    answers = (
        df.select(problem, boxed_answer(response).alias("answer"))
        .groupBy(problem, "answer")
        .agg(F.count("*").alias("n"))
        .withColumn("salt", F.xxhash64("answer").bitwiseAND(SALTS - 1).cast("int"))
    )
    joined = _with_forms(answers, "own").join(gold, [problem, "salt"])
    same = same_answer(*map(F.col, ("own_text", "own_number", "gold_text", "gold_number")))
    return (
        joined.groupBy(problem)
        .agg(F.sum(F.when(same, F.col("n")).otherwise(0)).alias("num_pass"), F.sum("n").alias("num_total"))
        .withColumn("pass_rate", F.col("num_pass") / F.col("num_total"))
    )


def _with_forms(df: DataFrame, name: str) -> DataFrame:
    """Replace ``answer`` by its normalised text and the number it spells."""
    text = df.withColumn(f"{name}_text", normal_answer(F.col("answer"))).drop("answer")
    return text.withColumn(f"{name}_number", answer_number(F.col(f"{name}_text")))


def join_embedding(
    df: DataFrame,
    embeddings: DataFrame,
    text: str = "problem",
    strict: bool = True,
    wrapped: bool = False,
) -> DataFrame:
    """Add the vector of each row's text.

    ``embeddings`` has ``text`` and ``embedding``; chat-form texts are unwrapped
    first when ``wrapped`` is set.  A text without a vector makes a strict join
    fail when it runs; otherwise its rows are left out.  Embeddings read from buckets
    (``read_embedding_buckets``) are joined by their digests there: only ``df`` moves,
    and texts are compared where digests match.
    """
    if "text_key" in embeddings.columns:
        vectors = embeddings.select("text_key", F.col("text").alias("_text"), "embedding")
        how = "left" if strict else "inner"
        rows = df.withColumn("_key", F.md5(F.col(text)))
        # Two comparisons: an equation would be a key beside the buckets' own, and make the vectors move.
        same = (F.col(text) <= F.col("_text")) & (F.col(text) >= F.col("_text"))
        joined = rows.join(vectors, (F.col("_key") == F.col("text_key")) & same, how)
        joined = joined.drop("_key", "text_key", "_text")
    else:
        key = chat_unwrap("text") if wrapped else F.col("text")
        joined = df.join(embeddings.select(key.alias(text), "embedding"), text, "left" if strict else "inner")
    if not strict:
        return joined
    missing = F.raise_error(F.concat(F.lit("no embedding for: "), F.coalesce(text, F.lit("null"))))
    checked = F.when(F.col("embedding").isNull(), missing).otherwise(F.col("embedding"))
    return joined.withColumn("embedding", checked)


def training_set(rates: DataFrame, embeddings: DataFrame, problem: str = "problem", **options) -> DataFrame:
    """Embedding and pass rate of the problems that were solved at least once."""
    solved = rates.where("pass_rate > 0").select(problem, F.col("pass_rate").alias("target"))
    return join_embedding(solved, embeddings, problem, **options).select("embedding", "target")
