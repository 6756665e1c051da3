"""Multilayer perceptron for two classes, trained data-parallel with Adam.

ReLU layers and a sigmoid output; binary cross-entropy; class 1 above 0.5.

Mini-batches follow one global order of the rows, new in every epoch: a hash of id,
epoch and seed. Step by step the weights are those of a plain loop over these batches,
for any number of tasks and any layout. The order is sorted in parallel and cut into
ranges of whole batches; the ranges are tasks, and the state (weights and Adam moments)
passes from range to range, since each step needs the one before it. A batch larger
than a range is the other case: its ranges sum their gradients in parallel, one Spark
job for each step. No task sees more than a range of RANGE_ROWS rows.

With ``synchronous=False`` each of ``shards`` replicas takes its own mini-batch steps
over its rows, from the same state, and the states are averaged after the epoch, on the
executors in blocks and weighted by rows: one job per epoch and another model.

Without a batch size an epoch is one step by the gradient of all rows: shards
stream their Arrow batches and return sums of gradients, which are added on the
executors, so any number of shards gives the same step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions.vectors import matrix
from inkgauge.operators.scaling import Standardizer, StandardizerModel
from inkgauge.session import arrow_batches, remove_path, scratch_path

BLOCK = 4096
SLICE = 1024  # rows scored at once
RANGE_ROWS = 16_384  # rows of an epoch's order that one task takes
PREFIX = 4  # hex digits by which the order is sorted in parallel
# Adam's decay rates and epsilon (Kingma & Ba 2015), and the floor
# of a logarithm in the loss.
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
LOG_FLOOR = -100.0


def _shapes(layers: list[int]) -> list[tuple[int, int]]:
    return list(zip(layers[:-1], layers[1:]))


def n_parameters(layers: list[int]) -> int:
    return sum(i * o + o for i, o in _shapes(layers))


def initial_parameters(layers: list[int], seed: int) -> np.ndarray:
    """Uniform within 1/sqrt(inputs) for weights and offsets."""
    rng = np.random.default_rng(seed)
    return np.concatenate(
        [rng.uniform(-1, 1, i * o + o) / np.sqrt(i) for i, o in _shapes(layers)]
    )


def _unpack(flat: np.ndarray, layers: list[int]):
    at = 0
    for i, o in _shapes(layers):
        yield flat[at : at + i * o].reshape(i, o), flat[at + i * o : at + i * o + o]
        at += i * o + o


def forward(flat: np.ndarray, layers: list[int], x: np.ndarray) -> list[np.ndarray]:
    """Activations of all layers, the input first; the last is the probability."""
    steps = [x]
    weights = list(_unpack(flat, layers))
    for depth, (w, b) in enumerate(weights):
        z = steps[-1] @ w + b
        if depth == len(weights) - 1:
            steps.append(0.5 * (1.0 + np.tanh(0.5 * z)))
        else:
            steps.append(np.maximum(z, 0.0))
    return steps


def loss_sum(p: np.ndarray, y: np.ndarray) -> float:
    with np.errstate(divide="ignore"):
        yes, no = np.maximum(np.log(p), LOG_FLOOR), np.maximum(np.log1p(-p), LOG_FLOOR)
    return float(-(y * yes + (1 - y) * no).sum())


def gradient(flat: np.ndarray, layers: list[int], steps: list[np.ndarray], y: np.ndarray):
    """Gradient of the mean loss of a batch."""
    found, delta = np.empty(len(flat)), (steps[-1] - y) / len(y)
    pairs = zip(_unpack(flat, layers), _unpack(found, layers), strict=True)
    for depth, ((w, _), (of_w, of_b)) in reversed(list(enumerate(pairs))):
        below = steps[depth]
        np.matmul(below.T, delta, out=of_w)
        delta.sum(axis=0, out=of_b)
        if depth:
            delta = (delta @ w.T) * (below > 0)
    return found


@dataclass
class _State:
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    step: int

    def update(self, grad: np.ndarray, rate: float) -> None:
        """One step, in place; ``grad`` is used up."""
        self.step += 1
        mean, square, one = grad, grad * grad, np.empty_like(grad)
        square *= 1 - BETA2
        self.second *= BETA2
        self.second += square
        mean *= 1 - BETA1
        self.first *= BETA1
        self.first += mean
        np.divide(self.first, 1 - BETA1**self.step, out=one)
        one *= rate
        np.divide(self.second, 1 - BETA2**self.step, out=square)
        np.sqrt(square, out=square)
        square += EPSILON
        one /= square
        self.weights -= one

    def copy(self) -> _State:
        return _State(self.weights.copy(), self.first.copy(), self.second.copy(), self.step)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return matrix(batch.column("features")), batch.column("label").to_numpy(zero_copy_only=False)


def _mini_batches(batches, size: int):
    """Rows of the Arrow batches regrouped to ``size`` rows; the last may be smaller."""
    xs, ys, held = [], [], 0
    for batch in batches:
        x, y = _rows(batch)
        at = 0
        while at < len(y):
            take = min(size - held, len(y) - at)
            xs.append(x[at : at + take])
            ys.append(y[at : at + take])
            held, at = held + take, at + take
            if held == size:
                yield np.concatenate(xs), np.concatenate(ys)[:, None]
                xs, ys, held = [], [], 0
    if held:
        yield np.concatenate(xs), np.concatenate(ys)[:, None]


def _shard_epoch(state: _State, layers, batch_size, rate, scaler):
    def run(batches):
        own = state.copy()
        rows = correct = 0
        loss = 0.0
        for x, y in _mini_batches(batches, batch_size):
            x = scaler.apply(x) if scaler is not None else x
            steps = forward(own.weights, layers, x)
            loss += loss_sum(steps[-1], y)
            correct += int(((steps[-1] > 0.5) == (y > 0.5)).sum())
            rows += len(y)
            own.update(gradient(own.weights, layers, steps, y), rate)
        if not rows:
            return
        vector = np.concatenate([own.weights, own.first, own.second])
        yield _blocks(vector, rows, own.step - state.step, loss, correct)

    return run


def _shard_gradient(weights: np.ndarray, layers, scaler):
    def run(batches):
        total = np.zeros_like(weights)
        rows = correct = 0
        loss = 0.0
        for batch in batches:
            x, y = _rows(batch)
            if not len(y):
                continue
            x, y = scaler.apply(x) if scaler is not None else x, y[:, None]
            steps = forward(weights, layers, x)
            loss += loss_sum(steps[-1], y)
            correct += int(((steps[-1] > 0.5) == (y > 0.5)).sum())
            rows += len(y)
            total += gradient(weights, layers, steps, y) * len(y)
        if rows:
            yield _blocks(total, rows, 1, loss, correct)

    return run


def _blocks(vector: np.ndarray, rows: int, steps: int, loss: float, correct: int) -> pa.RecordBatch:
    """What a shard returns: its vector in blocks, each with the shard's counts."""
    offsets = np.append(np.arange(0, len(vector), BLOCK, dtype=np.int32), np.int32(len(vector)))
    n = len(offsets) - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(n), pa.int32()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(vector)),
            pa.array([rows] * n, pa.int64()),
            pa.array([steps] * n, pa.int64()),
            pa.array([loss] * n, pa.float64()),
            pa.array([correct] * n, pa.int64()),
        ],
        ["block", "values", "n", "steps", "loss", "correct"],
    )


def _collected(blocks: DataFrame) -> tuple[np.ndarray, dict]:
    """The vector of collected blocks and the counts that came with them."""
    table = blocks.toArrow().sort_by("block")
    return table["values"].combine_chunks().flatten().to_numpy(), table.drop_columns(["values"]).slice(0, 1).to_pylist()[0]


_SHARD = "block int, values array<double>, n bigint, steps bigint, loss double, correct bigint"


def epoch_order(key: str, epoch: int | Column, seed: int) -> Column:
    """Order of the rows in an epoch: a hash that is new for every epoch and seed."""
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), epoch.cast("string"), F.lit(str(seed))))


def place_in_epoch(rows: DataFrame, epoch: int | Column, seed: int, key: str = "id", out: str = "place") -> DataFrame:
    """``rows`` plus their places (from 0) in the order of an epoch.

    Places within a prefix of the hash plus the sizes of the prefixes before it: no
    task sorts more than a prefix, and there are 16 ** PREFIX of them in an epoch.
    """
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    hashed = rows.withColumn("_epoch", epoch).withColumn("_order", epoch_order(key, epoch, seed))
    hashed = hashed.withColumn("_prefix", F.substring("_order", 1, PREFIX))
    earlier = Window.partitionBy("_epoch").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy("_epoch", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("_epoch", "_prefix", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_epoch", "_prefix").orderBy("_order", key)) - 1
    placed = hashed.withColumn("_within", within).join(sizes, ["_epoch", "_prefix"])
    return placed.select(*rows.columns, (F.col("_before") + F.col("_within")).alias(out))


@dataclass
class MlpModel:
    layers: list[int]
    weights: np.ndarray
    scaler: StandardizerModel | None = None
    history: DataFrame | None = None

    def probability(self, features: str = "features") -> Column:
        weights, layers, scaler = self.weights, self.layers, self.scaler

        @F.arrow_udf("double")
        def score(vectors: pa.Array) -> pa.Array:
            found = np.zeros(len(vectors))
            for at in range(0, len(vectors), SLICE):
                x = matrix(vectors.slice(at, SLICE))
                x = scaler.apply(x) if scaler is not None else x
                found[at : at + SLICE] = forward(weights, layers, x)[-1][:, 0]
            return pa.array(found)

        return score(F.col(features))

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` plus ``probability`` and ``predicted`` (1 strictly above one half)."""
        scored = df.withColumn("probability", self.probability(features))
        return scored.withColumn("predicted", F.when(F.col("probability") > 0.5, 1).otherwise(0))

    def validate(self, df: DataFrame) -> DataFrame:
        """(loss, accuracy, total): mean cross-entropy and share of right classes."""
        scored = self.transform(df.select("features", F.col("label").cast("double")))
        p, y = F.col("probability"), F.col("label")
        floor = F.lit(LOG_FLOOR)
        # ln of 0 is null in SQL: it is the floor here
        yes = F.greatest(F.coalesce(F.ln(p), floor), floor)
        no = F.greatest(F.coalesce(F.ln(1 - p), floor), floor)
        return scored.agg(
            F.avg(-(y * yes + (1 - y) * no)).alias("loss"),
            F.avg((F.col("predicted") == y).cast("double")).alias("accuracy"),
            F.count(F.lit(1)).alias("total"),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        scaler = self.scaler
        spark.createDataFrame(
            [
                (
                    self.layers,
                    self.weights.tolist(),
                    scaler.mean.tolist() if scaler else None,
                    scaler.std.tolist() if scaler else None,
                )
            ],
            "layers array<int>, weights array<double>, mean array<double>, std array<double>",
        ).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> MlpModel:
        row = spark.read.parquet(path).first()
        scaler = row["mean"] and StandardizerModel(np.array(row["mean"]), np.array(row["std"]))
        return MlpModel(list(row["layers"]), np.array(row["weights"]), scaler)


@dataclass
class MlpClassifier:
    layers: list[int] | None = None
    epochs: int = schema.EPOCHS
    batch_size: int | None = schema.BATCH_SIZE  # None: all rows are one batch
    rate: float = schema.LEARNING_RATE
    seed: int = schema.SEED
    standardize: bool = False
    shards: int = schema.SHARDS  # tasks of a full-batch gradient, or replicas
    synchronous: bool = True  # mini-batches of one global order
    start: np.ndarray | None = None  # weights to begin with; drawn with the seed if there are none

    def fit(self, train: DataFrame, val: DataFrame | None = None) -> MlpModel:
        """Train on (id, features, label); ``history`` has one row per epoch.

        The same rows give the same model on any cluster: the batches follow from the
        ids, and ``shards`` is a parameter.
        """
        spark = train.sparkSession
        rows = train.select("id", "features", F.col("label").cast("double").alias("label"))
        held = []
        try:
            one = rows.first()
            if one is None:
                raise ValueError("cannot train on an empty table")
            layers = self.layers or [len(one["features"]), *schema.LAYERS[1:]]
            scaler = Standardizer().fit(rows) if self.standardize else None
            if self.batch_size is None or not self.synchronous:
                rows = rows.repartition(self.shards, F.xxhash64("id"))
            rows = rows.persist()
            held.append(rows)
            n = rows.count()
            if val is not None:
                val = val.select("id", "features", "label").persist()
                held.append(val)
            size = n_parameters(layers)
            start = initial_parameters(layers, self.seed) if self.start is None else self.start
            state = _State(start, np.zeros(size), np.zeros(size), 0)
            history = []
            for epoch in range(1, self.epochs + 1):
                with arrow_batches(spark):  # the first steps begin while the other rows are on their way
                    if self.batch_size is None or not self.synchronous:
                        state, loss, share = self._epoch(rows, state, layers, scaler, epoch)
                    else:
                        state, loss, share = self._ordered_epoch(rows, n, state, layers, scaler, epoch)
                    model = MlpModel(layers, state.weights, scaler)
                    seen = model.validate(val).first() if val is not None else None
                history.append(
                    (epoch, loss, share, seen and seen["loss"], seen and seen["accuracy"])
                )
        finally:
            for df in held:
                df.unpersist()
        model.history = spark.createDataFrame(
            history,
            "epoch int, train_loss double, train_accuracy double, "
            "val_loss double, val_accuracy double",
        )
        return model

    def _ordered_epoch(self, rows: DataFrame, n: int, state: _State, layers, scaler, epoch: int):
        """One pass over the batches of the global order."""
        size = self.batch_size
        loss = correct = 0
        if size <= RANGE_ROWS:
            width = RANGE_ROWS // size * size
            for part in self._ranges(rows, n, width, epoch):
                run = _shard_epoch(state, layers, size, self.rate, scaler)
                vector, one = _collected(part.drop("id").mapInArrow(run, _SHARD))
                state = _State(*vector.reshape(3, -1), state.step + one["steps"])
                loss, correct = loss + one["loss"], correct + one["correct"]
        else:
            for part in self._ranges(rows, n, size, epoch):
                run = _shard_gradient(state.weights, layers, scaler)
                sums = part.drop("id").mapInArrow(run, _SHARD).groupBy("block").agg(
                    vector_to_array(Summarizer.sum(array_to_vector("values"))).alias("values"),
                    *(F.sum(c).alias(c) for c in ("n", "loss", "correct")),
                )
                vector, one = _collected(sums)
                state = state.copy()
                state.update(vector / one["n"], self.rate)
                loss, correct = loss + one["loss"], correct + one["correct"]
        return state, loss / n, correct / n

    def _ranges(self, rows: DataFrame, n: int, width: int, epoch: int):
        """The rows of an epoch's order in ranges of ``width``, each sorted within tasks.

        Small tables are one range and are sorted by one task. Others are written
        range by range, so that a lost executor costs the range it was in.
        """
        if n <= min(width, RANGE_ROWS):
            yield rows.coalesce(1).sortWithinPartitions(epoch_order("id", epoch, self.seed), "id")
            return
        spark = rows.sparkSession
        path = scratch_path(spark, "epoch")
        placed = place_in_epoch(rows, epoch, self.seed).withColumn("_range", F.expr(f"place div {width}"))
        dealt = placed.repartition("_range", F.expr(f"place div {RANGE_ROWS}") if width > RANGE_ROWS else F.lit(0))
        dealt.sortWithinPartitions("_range", "place").write.partitionBy("_range").parquet(path)
        columns = placed.drop("_range").schema
        try:
            for r in range(-(-n // width)):
                part = spark.read.schema(columns).parquet(f"{path}/_range={r}")
                if width <= RANGE_ROWS:
                    part = part.coalesce(1).sortWithinPartitions("place")
                yield part.drop("place")
        finally:
            remove_path(spark, path)

    def _epoch(self, sharded: DataFrame, state: _State, layers, scaler, epoch: int):
        """One pass in a new order of the rows of every shard."""
        shuffled = sharded.sortWithinPartitions(epoch_order("id", epoch, self.seed), "id")
        values = array_to_vector("values")
        if self.batch_size is None:
            run = _shard_gradient(state.weights, layers, scaler)
            vector = Summarizer.sum(values)
        else:
            run = _shard_epoch(state, layers, self.batch_size, self.rate, scaler)
            vector = Summarizer.mean(values, F.col("n").cast("double"))
        blocks = (
            shuffled.drop("id")
            .mapInArrow(run, _SHARD)
            .groupBy("block")
            .agg(
                vector.alias("vector"),
                F.sum("n").alias("n"),
                F.max("steps").alias("steps"),
                F.sum("loss").alias("loss"),
                F.sum("correct").alias("correct"),
            )
            .collect()
        )
        blocks.sort(key=lambda b: b["block"])
        vector = np.concatenate([b["vector"].toArray() for b in blocks])
        size = len(state.weights)
        one = blocks[0]
        loss, share = one["loss"] / one["n"], one["correct"] / one["n"]
        if self.batch_size is None:
            after = state.copy()
            after.update(vector / one["n"], self.rate)
        else:
            after = _State(
                vector[:size], vector[size : 2 * size], vector[2 * size :], state.step + one["steps"]
            )
        return after, loss, share
