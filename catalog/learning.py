"""Embeddings and the pass-rate predictor."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from catalog import register, rounded
from catalog.selection import documents
from sampleflow.operators import embeddings as vectors
from sampleflow.operators import mlp
from sampleflow.operators.select import train_val_split
from sampleflow.functions.prompts import THINK_START, USER_END, USER_START


def letter_model():
    """A stand-in model: length, blanks, line breaks and a-letters of a text."""

    def embed(texts):
        rows = [[len(t), t.count(" "), t.count("\n"), t.count("a")] for t in texts.reshape(-1)]
        return np.asarray(rows, dtype=np.float32)

    return embed


@register(f"""
    WITH t AS (SELECT DISTINCT '{USER_START}' || text || '{USER_END}{THINK_START}' AS text FROM documents)
    SELECT text, CAST(length(text) AS DOUBLE) AS v0,
           CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS v1,
           CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS v2,
           CAST(length(text) - length(replace(text, 'a', '')) AS DOUBLE) AS v3
    FROM t
""")
def embed_texts(spark, sf):
    embedded = vectors.embed_texts(documents(spark, sf), "text", letter_model)
    return embedded.select("text", *(F.get("embedding", F.lit(i)).cast("double").alias(f"v{i}") for i in range(4)))


def examples(spark, sf):
    """Vectors with their label, scaled to 0..1, as the value to predict."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return rows.select("vec_id", "embedding", (F.col("label") / 9).alias("target"))


@register("""
    SELECT (SELECT count(*) FROM embeddings) AS vectors, (SELECT CAST(max(len(embedding)) AS INTEGER) FROM embeddings) AS dim,
           round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max
    FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
""")
def vector_statistics(spark, sf):
    return rounded(vectors.vector_statistics(spark.read.parquet(f"{sf}/embeddings.parquet")))


@register("""
    SELECT count(*) AS samples, CAST(max(len(embedding)) AS INTEGER) AS dim,
           round(min(label / 9), 6) AS min_target, round(max(label / 9), 6) AS max_target
    FROM embeddings
""")
def target_range(spark, sf):
    return rounded(vectors.target_range(examples(spark, sf)))


MODEL = mlp.Mlp.init(64, 8, seed=42)


def _forward_sql(model):
    """The network written out in SQL, its weights as numbers."""
    w1, b1, w2, b2 = model.layers()
    vector = "CAST(embedding AS DOUBLE[])"

    def numbers(values):
        return "[" + ", ".join(f"{v!r}::DOUBLE" for v in map(float, values)) + "]"

    units = ", ".join(f"list_dot_product({vector}, {numbers(w)}) + {float(b)!r}" for w, b in zip(w1, b1))
    # The error function by its power series around 0, on z / sqrt(2).
    power = "pow(z / sqrt(2::DOUBLE), 2 * n + 1)"
    series = f"list_sum(list_transform(range(0, 80), lambda n: pow(-1::DOUBLE, n) * {power} / (gamma(n + 1) * (2 * n + 1))))"
    erf = f"(2 / sqrt(pi())) * {series}"
    return f"""
        WITH h AS (SELECT vec_id, [{units}] AS zs FROM embeddings),
             g AS (SELECT vec_id, list_transform(zs, lambda z: z * 0.5 * (1 + {erf})) AS hidden FROM h)
        SELECT vec_id, round(1 / (1 + exp(-(list_dot_product(hidden, {numbers(w2)}) + {float(b2)!r}))), 6) AS score
        FROM g
    """


@register(_forward_sql(MODEL))
def mlp_score(spark, sf):
    return rounded(mlp.mlp_score(examples(spark, sf), MODEL).select("vec_id", "score"))


def _gradient_sql(model):
    """The gradient over all rows, and the first AdamW step along it, with the weights as numbers."""
    w1, b1, w2, b2 = model.layers()
    h, d = w1.shape

    def numbers(values):
        return "[" + ", ".join(f"{v!r}::DOUBLE" for v in map(float, values)) + "]"

    units = ", ".join(f"list_dot_product(x, {numbers(w)}) + {float(b)!r}" for w, b in zip(w1, b1))
    power = "pow(z / sqrt(2::DOUBLE), 2 * n + 1)"
    series = f"list_sum(list_transform(range(0, 80), lambda n: pow(-1::DOUBLE, n) * {power} / (gamma(n + 1) * (2 * n + 1))))"
    cdf = f"0.5 * (1 + (2 / sqrt(pi())) * {series})"
    return f"""
        WITH v AS (SELECT CAST(embedding AS DOUBLE[]) AS x, label / 9 AS y FROM embeddings),
             z AS (SELECT *, [{units}] AS zs FROM v),
             c AS (SELECT *, list_transform(zs, lambda z: {cdf}) AS cs FROM z),
             o AS (SELECT *, list_transform(range(1, {h} + 1), lambda i: zs[i] * cs[i]) AS hs FROM c),
             e AS (SELECT *, 1 / (1 + exp(-(list_dot_product(hs, {numbers(w2)}) + {float(b2)!r}))) AS p FROM o),
             g AS (SELECT *, 2 * (p - y) * p * (1 - p) AS dp FROM e),
             s AS (SELECT *, list_transform(range(1, {h} + 1), lambda i:
                       dp * {numbers(w2)}[i] * (cs[i] + zs[i] * exp(-0.5 * zs[i] * zs[i]) / sqrt(2 * pi()))) AS dz FROM g),
             parts AS (
                 SELECT i * {d} + j AS place, dz[i + 1] * x[j + 1] AS part FROM s, range({h}) a(i), range({d}) b(j)
                 UNION ALL SELECT {h * d} + i, dz[i + 1] FROM s, range({h}) a(i)
                 UNION ALL SELECT {h * d + h} + i, dp * hs[i + 1] FROM s, range({h}) a(i)
                 UNION ALL SELECT {h * d + 2 * h}, dp FROM s
             ),
             sums AS (SELECT place, avg(part) AS gradient, {numbers(model.flat)}[place + 1] AS weight FROM parts GROUP BY place)
        SELECT place, round(gradient, 9) AS gradient,
               round(weight * (1 - 0.001::DOUBLE * 0.00001) - 0.001::DOUBLE * gradient / (abs(gradient) + 1e-8), 6) AS weight
        FROM sums
    """


@register(_gradient_sql(MODEL))
def mlp_step(spark, sf):
    """One full-batch step: the gradient summed over all partitions, and the weights after it."""
    gradient = mlp.mlp_gradient(examples(spark, sf), MODEL, ["vec_id"], mlp.TrainOptions(rows_per_task=256))
    state = mlp.AdamW.start(MODEL.flat)
    state.step(gradient, rate=1e-3, decay=1e-5)
    rows = [(i, round(float(g), 9), round(float(w), 6)) for i, (g, w) in enumerate(zip(gradient, state.flat))]
    return spark.createDataFrame(rows, "place BIGINT, gradient DOUBLE, weight DOUBLE")


@register("""
    SELECT round(avg(pow(l_discount * 10 - l_tax * 10, 2)), 6) AS loss,
           round(avg(abs(l_discount * 10 - l_tax * 10)), 6) AS mae
    FROM lineitem
""")
def mlp_evaluate(spark, sf):
    """Discounts as predictions of taxes: the measures over a large table."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    scaled = lines.select((F.col("l_discount") * 10).alias("score"), (F.col("l_tax") * 10).alias("target"))
    return rounded(mlp.mlp_evaluate(scaled))


@register()
def mlp_train(spark, sf):
    """History of a short training run on all vectors."""
    options = mlp.TrainOptions(num_epochs=5, rows_per_task=512)
    return mlp.mlp_train(examples(spark, sf), ["vec_id"], options).history


@register("""
    WITH n AS (SELECT count(*) AS n FROM embeddings)
    SELECT CAST(e AS INTEGER) AS epoch, round(0.001 * (1 - 0.9 * e / 12), 9) AS learning_rate,
           CAST(floor(0.9::DOUBLE * n) AS BIGINT) AS train_rows, n - CAST(floor(0.9::DOUBLE * n) AS BIGINT) AS val_rows,
           true AS has_losses, true AS learns
    FROM n, range(12) AS r(e)
""")
def mlp_train_history(spark, sf):
    """What a run must keep to whatever its weights are: epochs, rates, rows, and a falling loss."""
    rows = examples(spark, sf)
    history = mlp.mlp_train(rows, ["vec_id"], mlp.TrainOptions(num_epochs=12, rows_per_task=512)).history
    split = train_val_split(rows, ["vec_id"], 42).agg(
        F.count_if("is_train").alias("train_rows"), F.count_if(~F.col("is_train")).alias("val_rows")
    )
    first = history.agg(F.max_by("train_loss", -F.col("epoch")).alias("first"), F.max_by("train_loss", "epoch").alias("last"))
    return history.join(split.join(first)).select(
        "epoch",
        F.round("learning_rate", 9).alias("learning_rate"),
        "train_rows",
        "val_rows",
        (F.col("train_loss").isNotNull() & F.col("val_loss").isNotNull()).alias("has_losses"),
        (F.col("last") < F.col("first")).alias("learns"),
    )
