"""Principal components of standardised features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions.vectors import list_array, matrix
from inkgauge.operators.scaling import Standardizer, StandardizerModel
from inkgauge.session import arrow_batches

OVERSAMPLED = 10  # directions beyond the components asked for
SLICE = 1024  # rows multiplied at once
BLOCK_BYTES = 1 << 22  # of vectors that are kept as one value, and of a batch sent to Python
PART = 4096  # numbers of a sum that travel as one row
FAN_IN = 32  # triangles factorised together


@dataclass(frozen=True)
class PcaModel:
    scaler: StandardizerModel
    components: np.ndarray  # (k, dimensions); the largest loading of each is positive
    explained: np.ndarray  # share of variance

    def variance_table(self, spark: SparkSession) -> DataFrame:
        """Percent explained per component and cumulated (before rounding)."""
        rows = [
            (f"PC{i + 1}", round(float(own) * 100, 2), round(float(total) * 100, 2))
            for i, (own, total) in enumerate(zip(self.explained, np.cumsum(self.explained)))
        ]
        return spark.createDataFrame(
            rows, "pc string, explained_variance_pct double, cumulative_variance_pct double"
        )

    def transform(self, df: DataFrame, features: str = "features", out: str = "pca") -> DataFrame:
        scaler, components = self.scaler, self.components

        @F.arrow_udf("array<double>")
        def project(vectors: pa.Array) -> pa.Array:
            parts = [scaler.apply(matrix(vectors.slice(at, SLICE))) @ components.T for at in range(0, len(vectors), SLICE)]
            return list_array(np.concatenate(parts) if parts else np.zeros((0, len(components))), pa.float64())

        return df.withColumn(out, project(F.col(features)))

    def projection(self, df: DataFrame) -> DataFrame:
        """(id, pc1, pc2, label): the scatter plot as a table."""
        return self.transform(df).select(
            "id", F.col("pca")[0].alias("pc1"), F.col("pca")[1].alias("pc2"), "label"
        )


class PcaReport:
    """Components by a randomised block Krylov method (Musco and Musco 2015).

    From a seeded block of k + OVERSAMPLED directions each pass over the rows adds the
    block's image under the covariance, made orthogonal to what is known. The image is
    a sum over rows, so what moves and what the driver holds is dimensions x block,
    never dimensions x dimensions. Passes end when the residuals of the k components
    fall below ``tol`` of the largest variance, or after ``max_blocks`` of them.

    A last pass projects the rows on the directions found. The tall projection is
    factorised by a tree of small QR factorisations: a task keeps the triangle of its
    rows, triangles are stacked and factorised again. The singular values of the last
    triangle are those of the projection, without the loss a product of it would bring.
    """

    def __init__(self, k: int = 5, seed: int = schema.SEED, tol: float = 1e-10, max_blocks: int = 30):
        self.k, self.seed, self.tol, self.max_blocks = k, seed, tol, max_blocks

    def fit(self, df: DataFrame, features: str = "features") -> PcaModel:
        scaler = Standardizer().fit(df, features)
        with arrow_batches(df.sparkSession, BLOCK_BYTES):
            # on disk: in memory the rows of a large table fill the heaps beside what the tasks need
            rows = _blocks(df.select(features), len(scaler.mean)).persist(StorageLevel.DISK_ONLY)
            try:
                found, total = self._directions(rows, scaler)
                triangle = _triangle(rows, scaler, found)
            finally:
                rows.unpersist()
        _, sizes, turn = np.linalg.svd(triangle)
        k = min(self.k, len(sizes))
        components = turn[:k] @ found.T
        largest = np.abs(components).argmax(axis=1)
        signs = np.sign(components[np.arange(k), largest])
        explained = sizes[:k] ** 2 / total if total > 0 else np.zeros(k)
        return PcaModel(scaler, components * signs[:, None], explained)

    def _directions(self, rows: DataFrame, scaler: StandardizerModel) -> tuple[np.ndarray, float]:
        dims = len(scaler.mean)
        width = min(dims, self.k + OVERSAMPLED)
        block = np.linalg.qr(np.random.default_rng(self.seed).normal(size=(dims, width)))[0]
        basis, images = np.zeros((dims, 0)), np.zeros((dims, 0))
        for _ in range(self.max_blocks):
            image, total = _covariance_times(rows, scaler, block)
            basis, images = np.hstack([basis, block]), np.hstack([images, image])
            inner = basis.T @ images
            sizes, turns = np.linalg.eigh((inner + inner.T) / 2)
            best = np.argsort(sizes)[::-1][:width]
            top = turns[:, best[: self.k]]
            residual = np.linalg.norm(images @ top - basis @ top * sizes[best[: self.k]], axis=0)
            if basis.shape[1] >= dims or residual.max() <= self.tol * max(sizes.max(), 0.0):
                break
            block = _orthogonal(image, basis)
            if not block.shape[1]:
                break
        return basis @ turns[:, best], total


def _orthogonal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What a block adds to the space of a basis, as orthogonal unit columns."""
    length = np.linalg.norm(block)
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    directions, sizes, _ = np.linalg.svd(block, full_matrices=False)
    fresh = directions[:, sizes > 1e-12 * length]
    fresh = fresh - basis @ (basis.T @ fresh)
    return np.linalg.qr(fresh)[0][:, : max(0, len(basis) - basis.shape[1])]


def _blocks(vectors: DataFrame, dims: int) -> DataFrame:
    """Vectors of up to SLICE rows as one value, which every pass takes as it is."""
    size = max(1, min(SLICE, BLOCK_BYTES // (8 * max(dims, 1))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), size):
                value = matrix(batch.column(0).slice(at, size)).tobytes()
                yield pa.record_batch([pa.array([value], pa.binary())], ["features"])

    return vectors.mapInArrow(pack, "features binary")


def _scaled(batches: Iterator[pa.RecordBatch], scaler: StandardizerModel) -> Iterator[np.ndarray]:
    for batch in batches:
        for value in batch.column(0):
            yield scaler.apply(np.frombuffer(value.as_buffer(), np.float64).reshape(-1, len(scaler.mean)))


def _covariance_times(rows: DataFrame, scaler: StandardizerModel, block: np.ndarray) -> tuple[np.ndarray, float]:
    """X'X block and the sum of squares of X, for the standardised rows X."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares = np.zeros(block.shape), 0.0
        for x in _scaled(batches, scaler):
            total += x.T @ (x @ block)
            squares += float((x**2).sum())
        flat = np.append(total.ravel(), squares)
        parts = [flat[at : at + PART] for at in range(0, len(flat), PART)]
        values = pa.array([p.tolist() for p in parts], pa.list_(pa.float64()))
        yield pa.record_batch([pa.array(range(len(parts)), pa.int32()), values], ["part", "numbers"])

    parts = rows.mapInArrow(run, "part int, numbers array<double>")
    sums = parts.groupBy("part").agg(Summarizer.sum(array_to_vector("numbers")).alias("numbers")).collect()
    if not sums:
        return np.zeros(block.shape), 0.0
    flat = np.concatenate([s["numbers"].toArray() for s in sorted(sums, key=lambda s: s["part"])])
    return flat[:-1].reshape(block.shape), float(flat[-1])


def _triangle(rows: DataFrame, scaler: StandardizerModel, directions: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of the rows' projections, by a tree of factorisations."""
    width = directions.shape[1]

    def rows_of(triangle: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([list_array(triangle, pa.float64())], ["row"])

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, width))
        for x in _scaled(batches, scaler):
            held = np.linalg.qr(np.vstack([held, x @ directions]), "r")
        yield rows_of(held)

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, width))
        for batch in batches:
            if len(batch):
                held = np.linalg.qr(np.vstack([held, matrix(batch.column(0))]), "r")
        yield rows_of(held)

    level = rows.mapInArrow(leaf, "row array<double>")
    tasks = level.rdd.getNumPartitions()
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        level = level.repartition(tasks).mapInArrow(branch, "row array<double>")
    found = [r["row"] for r in level.collect()]  # FAN_IN triangles at most
    return np.linalg.qr(np.array(found).reshape(-1, width), "r")
