"""Text embeddings by a user's model, and statistics of vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleflow.functions.prompts import USER_END, USER_START, chat_wrap
from sampleflow.operators.select import distinct_texts

# Opens a model; the model turns an array of texts into a matrix of vectors.
ModelFactory = Callable[[], Callable[[np.ndarray], np.ndarray]]


def _alike(lengths: np.ndarray, batch_size: int, batch_chars: int) -> list[slice]:
    """Runs of sorted lengths with at most ``batch_size`` rows whose padded size stays within ``batch_chars``; a longer text alone."""
    cuts, start = [], 0
    for i, n in enumerate(lengths):
        if i > start and (i - start == batch_size or (i - start + 1) * n > batch_chars):
            cuts.append(slice(start, i))
            start = i
    return [*cuts, slice(start, len(lengths))] if len(lengths) else []


def embed_texts(
    df: DataFrame,
    column: str,
    factory: ModelFactory,
    prefix: str | None = USER_START,
    suffix: str = USER_END,
    batch_size: int = 64,
    batch_chars: int = 65_536,
    partitions: int | None = None,
) -> DataFrame:
    """Distinct texts of a column in chat form, each with its vector.

    The one shuffle is that of the distinct texts; each task then sorts its texts by length
    and gives the model batches of like lengths: at most ``batch_size`` texts and, padded to
    the longest, ``batch_chars`` characters (a longer text goes alone).  ``partitions`` asks
    for so many tasks, at the price of a second shuffle.  The model is opened once a task.
    """
    wrapped = distinct_texts(df, column).select(chat_wrap(column, prefix, suffix).alias("text"))
    if partitions:
        wrapped = wrapped.repartition(partitions, "text")

    def embedded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for frame in frames:
            model = model or factory()
            texts = frame["text"].to_numpy(dtype=object)
            lengths = np.fromiter((len(t or "") for t in texts), dtype=np.int64, count=len(texts))
            for batch in _alike(lengths, batch_size, batch_chars):
                found = np.asarray(model(texts[batch]), dtype=np.float32)
                if len(found) != batch.stop - batch.start:
                    raise ValueError(f"{batch.stop - batch.start} texts, but {len(found)} vectors")
                yield pd.DataFrame({"text": texts[batch], "embedding": list(found)})

    ordered = wrapped.sortWithinPartitions(F.length("text"), "text")
    return ordered.mapInPandas(embedded, "text string, embedding array<float>")


def vector_statistics(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows, dimension, and mean, population deviation, min and max over all elements; null elements do not count.

    Each vector is reduced to its moments in place, those of vectors of one length are
    merged by Spark's own variance, and those of different lengths by Chan's formula.
    """
    x = F.filter(F.transform(column, lambda v: v.cast("double")), lambda v: v.isNotNull())
    rows = df.where(F.size(column) > 0).select(F.size(column).alias("dim"), x.alias("x"), F.size(x).alias("k"))
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    rows = rows.select("*", (total / F.nullif("k", F.lit(0))).alias("m"))
    spread = F.aggregate("x", F.lit(0.0), lambda a, v: a + (v - F.col("m")) * (v - F.col("m")))
    alike = rows.groupBy("k").agg(
        F.count("*").alias("vectors"),
        F.max("dim").alias("dim"),
        F.avg("m").alias("mean"),
        (F.sum(spread) + F.col("k") * F.count("*") * F.var_pop("m")).alias("m2"),
        F.min(F.array_min("x")).alias("min"),
        F.max(F.array_max("x")).alias("max"),
    )
    held = F.collect_list(F.when(F.col("k") > 0, F.struct((F.col("k") * F.col("vectors")).cast("double").alias("n"), "mean", "m2")))
    both = alike.agg(F.coalesce(F.sum("vectors"), F.lit(0)).alias("vectors"), F.max("dim").alias("dim"), held.alias("parts"), F.min("min").alias("min"), F.max("max").alias("max"))
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def chan(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        mean, m2 = a["mean"] + gap * b["n"] / n, a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n
        return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))

    merged = both.select("*", F.aggregate("parts", none, chan).alias("all"))
    some = F.col("all.n") > 0
    mean, std = F.when(some, F.col("all.mean")), F.when(some, F.sqrt(F.try_divide("all.m2", "all.n")))
    return merged.select("vectors", "dim", mean.alias("mean"), std.alias("std"), "min", "max")


def target_range(df: DataFrame, target: str = "target", column: str = "embedding") -> DataFrame:
    """Rows, vector dimension, and smallest and largest target of a training set."""
    return df.agg(
        F.count("*").alias("samples"),
        F.max(F.size(column)).alias("dim"),
        F.min(target).alias("min_target"),
        F.max(target).alias("max_target"),
    )
