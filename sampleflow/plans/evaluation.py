"""Whole jobs: from answers to a trained pass-rate predictor and its scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleflow.functions.prompts import think_start
from sampleflow.operators.embeddings import ModelFactory, embed_texts
from sampleflow.operators.evaluate import pass_rate, training_set
from sampleflow.operators.mlp import Mlp, Trained, TrainOptions, mlp_score, mlp_train
from sampleflow.sources.sinks import write_embeddings
from sampleflow.sources.storage import work_dir


@dataclass(frozen=True)
class Evaluation:
    rates: DataFrame
    embeddings: DataFrame
    trained: Trained


def evaluate_answers(
    answers: DataFrame,
    order_columns: list[str],
    factory: ModelFactory,
    problem: str = "problem",
    options: TrainOptions = TrainOptions(),
    embeddings_path: str | None = None,
) -> Evaluation:
    """Pass rates, embeddings of the problems, and a predictor fitted to both."""
    rates = pass_rate(answers, order_columns, problem)
    path = embeddings_path or work_dir(answers.sparkSession, "embeddings")
    # The model is the costly step: its vectors are stored before they are used.
    embeddings = write_embeddings(embed_texts(answers, problem, factory), path)
    examples = training_set(rates, embeddings, problem, wrapped=True)
    keyed = examples.withColumn("key", F.md5(F.to_json("embedding")))
    return Evaluation(rates, embeddings, mlp_train(keyed, ["key"], options))


def score_prompts(prompts: DataFrame, column: str, factory: ModelFactory, model: Mlp) -> DataFrame:
    """Predicted pass rate of each distinct prompt, by its text in answer-ready form."""
    ready = prompts.select(think_start(column).alias("text"))
    vectors = embed_texts(ready, "text", factory, prefix=None)
    return mlp_score(vectors, model).select("text", "score")
