import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sampleflow import evaluate_answers, score_prompts
from sampleflow.operators import mlp
from sampleflow.operators.embeddings import embed_texts


def plain_forward(model, x):
    """The formula, one number at a time."""
    w1, b1, w2, b2 = model.layers()
    out = []
    for row in x:
        z = [sum(w * v for w, v in zip(w1[h], row)) + b1[h] for h in range(model.hidden_dim)]
        gelu = [v * 0.5 * (1 + math.erf(v / math.sqrt(2))) for v in z]
        out.append(1 / (1 + math.exp(-(sum(g * w for g, w in zip(gelu, w2)) + b2))))
    return out


def vectors(spark, n, dim=6, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    y = 1 / (1 + np.exp(-(2 * x[:, 0] - 1.5 * x[:, 1] * x[:, 2])))
    rows = [(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id INT, embedding ARRAY<FLOAT>, target DOUBLE"), x, y


def test_score_agrees_with_a_plain_forward_pass(spark):
    df, x, _ = vectors(spark, 50)
    model = mlp.Mlp.init(6, 9, seed=3)
    got = [r.score for r in mlp.mlp_score(df, model).orderBy("id").collect()]
    assert np.allclose(got, plain_forward(model, x), atol=1e-6)


def test_init_is_bounded_and_seeded():
    model = mlp.Mlp.init(64, 64, seed=1)
    w1, b1, w2, b2 = model.layers()
    assert np.abs(w1).max() <= math.sqrt(6 / 128) and np.abs(w2).max() <= math.sqrt(6 / 65)
    assert not b1.any() and b2 == 0
    assert (mlp.Mlp.init(64, 64, seed=1).flat == model.flat).all()


def test_gradient_agrees_with_differences():
    rng = np.random.default_rng(1)
    model = mlp.Mlp.init(4, 5, seed=2)
    x, y = rng.normal(size=(7, 4)), rng.random(7)
    keep = (rng.random((7, 5)) > 0.3) / 0.7
    gradient, _ = model.gradient(x, y, keep)

    def loss(flat):
        return float(((mlp.Mlp(4, 5, flat).gradient(x, y, keep)[1] - y) ** 2).mean())

    for i in range(len(model.flat)):
        step = np.zeros_like(model.flat)
        step[i] = 1e-4
        slope = (loss(model.flat + step) - loss(model.flat - step)) / 2e-4
        assert math.isclose(gradient[i], slope, rel_tol=1e-2, abs_tol=1e-4)


@pytest.mark.parametrize("rows_per_task", [4096, 100])
def test_training_beats_a_constant(spark, folder, rows_per_task):
    df, _, y = vectors(spark, 800)
    options = mlp.TrainOptions(hidden_dim=16, num_epochs=12, batches=40, learning_rate=0.02, rows_per_task=rows_per_task)
    trained = mlp.mlp_train(df.repartition(5), ["id"], options, output_dir=folder)
    history = trained.history.orderBy("epoch").collect()
    assert [h.epoch for h in history] == list(range(12))
    assert history[-1].train_loss < history[0].train_loss / 2
    assert history[-1].val_loss < y.var() / 2
    assert math.isclose(history[0].learning_rate, 0.02) and history[-1].learning_rate < 0.005
    best = min(range(12), key=lambda e: history[e].val_loss)
    kept = mlp.load_mlp(spark, f"{folder}/model-epoch-{best}")
    assert np.allclose(kept.flat, trained.best.flat)
    assert np.allclose(mlp.load_mlp(spark, f"{folder}/best_model").flat, trained.best.flat)
    assert np.allclose(mlp.load_mlp(spark, f"{folder}/final_model").flat, trained.final.flat)


def test_same_seed_gives_the_same_weights(spark):
    df, _, _ = vectors(spark, 300)
    options = mlp.TrainOptions(hidden_dim=8, num_epochs=2, rows_per_task=60)
    a = mlp.mlp_train(df.repartition(2), ["id"], options)
    b = mlp.mlp_train(df.repartition(7), ["id"], options)
    assert np.allclose(a.final.flat, b.final.flat)


def test_weights_do_not_depend_on_the_number_of_parts(spark):
    df, _, _ = vectors(spark, 300)
    runs = [mlp.mlp_train(df, ["id"], mlp.TrainOptions(hidden_dim=8, num_epochs=2, rows_per_task=n)) for n in (4096, 70, 11)]
    for run in runs[1:]:
        assert np.allclose(run.final.flat, runs[0].final.flat, rtol=1e-9, atol=1e-12)
        assert np.allclose([h.train_loss for h in run.history.collect()], [h.train_loss for h in runs[0].history.collect()])


def test_many_partial_results_are_added_up_first(spark):
    """More partitions than one level of the tree takes give the plain gradient."""
    df, x, y = vectors(spark, 400)
    model = mlp.Mlp.init(6, 8, seed=1)
    got = mlp.mlp_gradient(df, model, ["id"], mlp.TrainOptions(rows_per_task=5))
    want, _ = model.gradient(x.astype(np.float64), y, 1.0)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-12)


def test_batch_size_sets_the_steps(spark):
    df, _, _ = vectors(spark, 100)
    few, many = (mlp.TrainOptions(hidden_dim=4, num_epochs=1, batch_size=n) for n in (90, 30))
    a, b = (mlp.mlp_train(df, ["id"], o).final.flat for o in (few, many))
    assert not np.allclose(a, b)


def test_dropout_is_by_row(spark):
    place = np.arange(5000, dtype=np.uint64) * np.uint64(977)
    keep = mlp._dropped(place, 8, 3, 42, 0.1)
    assert abs((keep == 0).mean() - 0.1) < 0.01 and np.allclose(keep[keep > 0], 1 / 0.9)
    assert (mlp._dropped(place[::-1], 8, 3, 42, 0.1)[::-1] == keep).all() and (mlp._dropped(place, 8, 4, 42, 0.1) != keep).any()


def test_early_stop(spark):
    df, _, _ = vectors(spark, 200)
    # With no learning rate nothing gets better after the first epoch.
    options = mlp.TrainOptions(hidden_dim=4, num_epochs=30, patience=2, learning_rate=0.0)
    trained = mlp.mlp_train(df, ["id"], options)
    assert trained.history.count() == 3
    with pytest.raises(ValueError):
        mlp.mlp_train(df.limit(0), ["id"], options)


def test_evaluate(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.0, 0.25)], "score DOUBLE, target DOUBLE")
    assert tuple(mlp.mlp_evaluate(df).first()) == ((0.25 + 0.0625) / 2, 0.375)


def counting_model():
    def embed(texts):
        assert len(texts) <= 64
        return np.asarray([[len(t), t.count("1")] for t in texts.reshape(-1)], dtype=np.float32)

    return embed


def test_embeddings_are_of_distinct_wrapped_texts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b11",)], "q STRING")
    got = {r.text: r.embedding for r in embed_texts(df, "q", counting_model, prefix=None).collect()}
    assert got == {"a": [1.0, 0.0], "b11": [3.0, 2.0]}
    wrapped = embed_texts(df, "q", counting_model).select("text").first()[0]
    assert wrapped.endswith("<think>\n\n")


def test_from_answers_to_scores(spark):
    rows = spark.range(400).select(
        "id",
        F.concat(F.lit("problem "), (F.col("id") % 40).cast("string")).alias("problem"),
        F.lit("1").alias("expected_answer"),
        F.concat(F.lit("\\boxed{"), (F.col("id") % 3).cast("string"), F.lit("}")).alias("response"),
    )
    options = mlp.TrainOptions(hidden_dim=4, num_epochs=2)
    result = evaluate_answers(rows, ["id"], counting_model, options=options)
    assert result.rates.count() == 40 and result.embeddings.count() == 40
    scores = score_prompts(rows, "problem", counting_model, result.trained.best).collect()
    assert len(scores) == 40 and all(0 < s.score < 1 and s.text.endswith("<think>\n\n") for s in scores)


def seen_model():
    """Each text's vector tells how many texts came with it, and the longest of them."""
    return lambda texts: np.array([[len(texts), max(len(t) for t in texts)] for _ in texts], dtype=np.float32)


def test_embed_batches_of_like_lengths(spark):
    texts = ["x" * (n % 97 * 10 + 1) + str(n) for n in range(900)] + ["y" * 5000, "z" * 20_000]
    df = spark.createDataFrame([(t,) for t in texts + texts[:50]], "q STRING")
    got = embed_texts(df, "q", seen_model, prefix=None, batch_size=16, batch_chars=4000)
    rows = got.collect()
    assert sorted(r.text for r in rows) == sorted(texts)
    assert all(r.embedding[0] <= 16 and (r.embedding[0] * r.embedding[1] <= 4000 or r.embedding[0] == 1) for r in rows)
    padded, real = sum(r.embedding[1] for r in rows), sum(map(len, texts))
    mixed = np.random.default_rng(1).permutation([len(t) for t in texts])
    assert padded < 1.15 * real < sum(16 * max(mixed[i : i + 16]) for i in range(0, len(mixed), 16)) / 1.5
    plan = got.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange round" not in plan
    assert embed_texts(df.where("false"), "q", seen_model).collect() == []
    again = embed_texts(df, "q", seen_model, prefix=None, partitions=3)
    assert again.rdd.getNumPartitions() == 3 and again.count() == len(texts)


def test_steps_have_few_tasks(spark):
    """A large table has two partitions for each core: a step is a job, and its tasks do not grow with the rows."""
    cores = spark.sparkContext.defaultParallelism
    options = mlp.TrainOptions(rows_per_task=512)
    assert [mlp._partitions(spark, n, options) for n in (0, 512, 513, 10_000_000)] == [1, 1, 2, 2 * cores]
    assert mlp._partitions(spark, 100 * cores * mlp.HELD_ROWS, options) == 100 * cores
