"""A small pass-rate predictor: one hidden layer over embeddings.

``sigmoid(w2 . GELU(w1 x + b1) + b2)``.  Training is data-parallel: rows stay in place, each
step adds up the gradients of a global batch over all partitions by a tree, and takes one
AdamW step.  Batches are drawn by a hash of the row, so neither they nor the weights
depend on how many partitions there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleflow.operators.select import train_val_split

def _erf(x: np.ndarray) -> np.ndarray:
    """The error function in double precision: a series of positive terms, so nothing cancels."""
    size = np.minimum(np.abs(x), 6.0)  # erf(6) is 1 in double precision
    term = size.astype(np.float64)
    total, n = term.copy(), 0
    while term.size and (term > 1e-17 * total).any():
        n += 1
        term = term * (2.0 * size * size / (2 * n + 1))
        total += term
    return np.sign(x) * np.minimum(total * (2.0 / math.sqrt(math.pi)) * np.exp(-size * size), 1.0)


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + _erf(x / math.sqrt(2.0)))


@dataclass(frozen=True)
class Mlp:
    """Weights as one flat vector: w1 by hidden unit, b1, w2, b2."""

    input_dim: int
    hidden_dim: int
    flat: np.ndarray

    @classmethod
    def init(cls, input_dim: int, hidden_dim: int = 64, seed: int = 42) -> Mlp:
        """Xavier-uniform weights and zero biases."""
        rng = np.random.default_rng(seed)
        bound1 = math.sqrt(6.0 / (input_dim + hidden_dim))
        bound2 = math.sqrt(6.0 / (hidden_dim + 1))
        w1 = rng.uniform(-bound1, bound1, hidden_dim * input_dim)
        w2 = rng.uniform(-bound2, bound2, hidden_dim)
        return cls(input_dim, hidden_dim, np.concatenate([w1, np.zeros(hidden_dim), w2, [0.0]]))

    def layers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        h, d = self.hidden_dim, self.input_dim
        w1, b1, w2, b2 = np.split(self.flat, [h * d, h * d + h, h * d + 2 * h])
        return w1.reshape(h, d), b1, w2, b2[0]

    def predict(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers()
        z = x.astype(np.float64) @ w1.T + b1
        return 1.0 / (1.0 + np.exp(-((z * _normal_cdf(z)) @ w2 + b2)))

    def gradient(
        self, x: np.ndarray, y: np.ndarray, keep: np.ndarray | float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the mean squared error, and the outputs; ``keep`` masks hidden units."""
        w1, b1, w2, b2 = self.layers()
        z = x @ w1.T + b1
        cdf = _normal_cdf(z)
        hidden = z * cdf * keep
        out = 1.0 / (1.0 + np.exp(-(hidden @ w2 + b2)))
        d_out = 2.0 * (out - y) / len(y) * out * (1.0 - out)
        slope = cdf + z * np.exp(-0.5 * z * z) / math.sqrt(2.0 * math.pi)
        d_z = d_out[:, None] * w2[None, :] * keep * slope
        parts = [(d_z.T @ x).ravel(), d_z.sum(0), hidden.T @ d_out, [d_out.sum()]]
        return np.concatenate(parts), out


@dataclass(frozen=True)
class TrainOptions:
    """How to train. Steps are taken over ``batches`` global batches an epoch, or batches of about ``batch_size`` rows if that is set.

    A step is a Spark job, so small batches suit small tables only.
    """

    hidden_dim: int = 64
    batches: int = 8
    batch_size: int | None = None
    learning_rate: float = 1e-3
    weight_decay: float = 1e-5
    num_epochs: int = 50
    patience: int = 15
    dropout: float = 0.1
    seed: int = 42
    train_fraction: float = 0.9
    rows_per_task: int = 4096

    def rate(self, epoch: int) -> float:
        """The learning rate falls in a line to a tenth over the epochs."""
        return self.learning_rate * (1.0 - 0.9 * min(epoch / self.num_epochs, 1.0))


@dataclass
class AdamW:
    """Weights, moments and the number of steps taken."""

    flat: np.ndarray
    m: np.ndarray
    v: np.ndarray
    steps: int = 0

    @classmethod
    def start(cls, flat: np.ndarray) -> AdamW:
        return cls(flat.copy(), np.zeros_like(flat), np.zeros_like(flat))

    def step(self, gradient: np.ndarray, rate: float, decay: float) -> None:
        self.steps += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient**2
        move = (self.m / (1.0 - 0.9**self.steps)) / (np.sqrt(self.v / (1.0 - 0.999**self.steps)) + 1e-8)
        self.flat = self.flat * (1.0 - rate * decay) - rate * move


def _dropped(place: np.ndarray, units: int, epoch: int, seed: int, share: float) -> np.ndarray:
    """Which hidden units each row keeps in an epoch, scaled; by the row's hash, not by where it lies."""
    x = place[:, None] + np.arange(1, units + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x += np.uint64((seed * 1_000_003 + epoch) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x >> np.uint64(11)) >= share * 2.0**53) / (1.0 - share)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


_PACKED = "batch INT, x BINARY, y BINARY, place BINARY"
#: Rows of a partition at most, however few cores there are.
HELD_ROWS = 1 << 20


def _partitions(spark: SparkSession, rows: int, options: TrainOptions) -> int:
    """Partitions of ``rows_per_task`` rows, but no more than two for each core: a step is a job over all of them."""
    most = max(2 * spark.sparkContext.defaultParallelism, math.ceil(rows / HELD_ROWS))
    return max(1, min(math.ceil(rows / options.rows_per_task), most))


def _packed(batches: Iterable[pa.RecordBatch], dim: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Rows of one partition, sorted by batch, as one row for each batch, or each ``rows`` rows of one."""
    held: list[pa.RecordBatch] = []

    def out() -> pa.RecordBatch:
        parts = [(_matrix(b.column("embedding"), dim), *(b.column(c).to_numpy(zero_copy_only=False) for c in ("target", "place"))) for b in held]
        x, y, place = (np.concatenate(p).tobytes() for p in zip(*parts))
        number = held[0].column("batch")[0].as_py()
        held.clear()
        columns = [pa.array([number], pa.int32()), *(pa.array([c], pa.binary()) for c in (x, y, place))]
        return pa.RecordBatch.from_arrays(columns, names=["batch", "x", "y", "place"])

    for batch in batches:
        number = batch.column("batch").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if held and (held[0].column("batch")[0].as_py() != number[a] or sum(h.num_rows for h in held) >= rows):
                yield out()
            held += [batch.slice(a, b - a)] if b > a else []
    if held:
        yield out()


_Sum = tuple[np.ndarray, int, float]


def _added(one: _Sum, two: _Sum) -> _Sum:
    return one[0] + two[0], one[1] + two[1], one[2] + two[2]


def _batch_sum(rows: RDD, model: Mlp, parts: int, keep: Callable[[np.ndarray], np.ndarray | float]) -> _Sum:
    """Summed gradient, rows and squared errors of packed rows, added up by a tree over the partitions."""

    def work(found: Iterator) -> Iterator[_Sum]:
        total = (np.zeros_like(model.flat), 0, 0.0)
        for r in found:
            x, y, place = np.frombuffer(r.x).reshape(-1, model.input_dim), np.frombuffer(r.y), np.frombuffer(r.place, np.uint64)
            gradient, out = model.gradient(x, y, keep(place))
            total = _added(total, (gradient * len(y), len(y), float(((out - y) ** 2).sum())))
        yield total

    zero = (np.zeros_like(model.flat), 0, 0.0)
    return rows.mapPartitions(work).treeAggregate(zero, _added, _added, depth=1 if parts <= 64 else 2)


def pack_rows(df: DataFrame, key: Sequence[str], dim: int, parts: int, batches: int, options: TrainOptions) -> DataFrame:
    """``embedding`` and ``target`` of ``df`` dealt over ``parts`` partitions, packed by batch."""
    place = F.xxhash64(F.lit(options.seed), *key, "embedding", "target")
    # A batch is a range of the hash; what decides the partition is another hash of it.
    batch = F.pmod(F.shiftright("place", 20), F.lit(batches)).cast("int")
    part = F.pmod(F.xxhash64("place"), F.lit(parts)).cast("int")
    dealt = df.withColumn("place", place).withColumn("batch", batch).repartitionById(parts, part).sortWithinPartitions("batch", "place")
    rows = dealt.select("embedding", F.col("target").cast("double").alias("target"), "place", "batch")
    return rows.mapInArrow(lambda b: _packed(b, dim, options.rows_per_task), _PACKED)


def mlp_gradient(df: DataFrame, model: Mlp, key: Sequence[str], options: TrainOptions = TrainOptions()) -> np.ndarray:
    """The gradient of the mean squared error over all rows of ``df``, without dropout."""
    parts = _partitions(df.sparkSession, df.count(), options)
    packed = pack_rows(df, key, model.input_dim, parts, 1, options)
    gradient, rows, _ = _batch_sum(packed.rdd, model, parts, lambda place: 1.0)
    return gradient / max(rows, 1)


@dataclass(frozen=True)
class Trained:
    """The best weights, the last ones, and one history row per epoch."""

    best: Mlp
    final: Mlp
    history: DataFrame


HISTORY = "epoch INT, train_loss DOUBLE, val_loss DOUBLE, val_mae DOUBLE, learning_rate DOUBLE"


def mlp_train(
    df: DataFrame,
    key: Sequence[str],
    options: TrainOptions = TrainOptions(),
    output_dir: str | None = None,
) -> Trained:
    """Fit the predictor to ``embedding`` and ``target``.

    Rows are dealt out once, in partitions of about ``rows_per_task`` or, of a large table, more
    rows (two partitions for each core), and stay in memory there, packed by ``rows_per_task``.
    An epoch goes through the batches in a seeded order: each step sums the batch's gradients
    over all partitions and takes one AdamW step, so more machines shorten a step. Equal rows
    share a batch. An epoch's validation loss belongs to the weights that epoch ends
    with.  With ``output_dir`` the weights of every epoch are kept there.  The final
    weights are the best ones; a loss is null where no row took part.
    """
    spark = df.sparkSession
    marked = train_val_split(df, key, options.seed, options.train_fraction)
    sizes = F.size("embedding")
    rows, vectors, least, dim = marked.agg(F.count("*"), F.count("embedding"), F.min(sizes), F.max(sizes)).first()
    if not rows:
        raise ValueError("the training set is empty")
    if vectors < rows or least != dim:
        raise ValueError(f"all vectors must have one size, got {least} to {dim} and {rows - vectors} missing ones")
    data = marked.select(*key, "embedding", F.col("target").cast("double").alias("target"), "is_train")
    held = data.where(~F.col("is_train")).persist()
    train = data.where("is_train")
    train_rows = train.count()
    parts = _partitions(spark, train_rows, options)
    batches = max(1, math.ceil(train_rows / options.batch_size) if options.batch_size else options.batches)
    packed = pack_rows(train, key, dim, parts, batches, options).persist()
    by_batch = [packed.where(F.col("batch") == b).rdd for b in range(batches)]
    first = Mlp.init(dim, options.hidden_dim, options.seed)
    state = AdamW.start(first.flat)
    history: list[tuple] = []
    best, best_loss, waited = first, math.inf, 0
    try:
        for epoch in range(options.num_epochs):
            squared = 0.0
            for b in np.random.default_rng([options.seed, epoch]).permutation(batches):
                model = Mlp(dim, options.hidden_dim, state.flat)
                keep = partial(_dropped, units=options.hidden_dim, epoch=epoch, seed=options.seed, share=options.dropout)
                gradient, n, errors = _batch_sum(by_batch[b], model, parts, keep)
                if n:
                    state.step(gradient / n, options.rate(epoch), options.weight_decay)
                squared += errors
            loss = squared / train_rows if train_rows else None
            model = Mlp(dim, options.hidden_dim, state.flat)
            if output_dir:
                save_mlp(spark, model, f"{output_dir}/model-epoch-{epoch}")
            found = mlp_evaluate(mlp_score(held, model)).first()
            history.append((epoch, loss, found.loss, found.mae, options.rate(epoch)))
            if found.loss is None or found.loss < best_loss:
                best, best_loss, waited = model, found.loss if found.loss is not None else math.inf, 0
            else:
                waited += 1
                if waited >= options.patience:
                    break
    finally:
        packed.unpersist()
        held.unpersist()
    if output_dir:
        save_mlp(spark, best, f"{output_dir}/best_model")
        save_mlp(spark, best, f"{output_dir}/final_model")
    return Trained(best, best, spark.createDataFrame(history, HISTORY))


def mlp_score(df: DataFrame, model: Mlp, column: str = "embedding", batch_size: int = 1024) -> DataFrame:
    """Add ``score``, the predicted pass rate of every vector; dropout is off."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def factory():
        return lambda x: shared.value.predict(x)

    predict = predict_batch_udf(
        factory,
        return_type=T.DoubleType(),
        batch_size=batch_size,
        input_tensor_shapes=[[model.input_dim]],
    )
    return df.withColumn("score", predict(column))


def mlp_evaluate(df: DataFrame, prediction: str = "score", target: str = "target") -> DataFrame:
    """Mean squared error and mean absolute error."""
    gap: Column = F.col(prediction) - F.col(target)
    return df.agg(F.avg(gap * gap).alias("loss"), F.avg(F.abs(gap)).alias("mae"))


def save_mlp(spark: SparkSession, model: Mlp, path: str) -> None:
    row = (model.input_dim, model.hidden_dim, model.flat.tolist())
    table = spark.createDataFrame([row], "input_dim INT, hidden_dim INT, weights ARRAY<DOUBLE>")
    table.write.mode("overwrite").parquet(path)


def load_mlp(spark: SparkSession, path: str) -> Mlp:
    row = spark.read.parquet(path).first()
    return Mlp(row.input_dim, row.hidden_dim, np.asarray(row.weights))
