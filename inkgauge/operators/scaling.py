"""Standardisation with the population standard deviation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge.functions.vectors import constant_array


@dataclass(frozen=True)
class StandardizerModel:
    mean: np.ndarray
    std: np.ndarray

    @property
    def factor(self) -> np.ndarray:
        """1 / std; 0 for a constant dimension, which therefore becomes 0."""
        return np.divide(1.0, self.std, out=np.zeros_like(self.std), where=self.std > 0)

    def apply(self, rows: np.ndarray) -> np.ndarray:
        """For use inside Arrow functions."""
        return (rows - self.mean) * self.factor

    def transform(self, df: DataFrame, features: str = "features", out: str | None = None):
        """Replace (or add as ``out``) the standardised vector."""
        shift = constant_array(self.mean.tolist(), "double")
        factor = constant_array(self.factor.tolist(), "double")
        centred = F.zip_with(features, shift, lambda x, m: x.cast("double") - m)
        return df.withColumn(out or features, F.zip_with(centred, factor, lambda x, f: x * f))


class Standardizer:
    """``fit`` makes one pass and brings 2 numbers per dimension to the driver."""

    def fit(self, df: DataFrame, features: str = "features") -> StandardizerModel:
        vectors = df.select(array_to_vector(F.col(features).cast("array<double>")).alias("v"))
        # grouped by a constant: an empty table then gives no row instead of an error
        row = (
            vectors.groupBy(F.lit("all"))
            .agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s"))
            .first()
        )
        if row is None:
            raise ValueError("cannot standardise an empty table")
        stats = row["s"]
        n = stats["count"]
        variance = stats["variance"].toArray() * (n - 1) / n
        # rounding noise of a constant dimension must not be blown up to unit size
        mean = stats["mean"].toArray()
        variance[variance <= (1e-15 * np.abs(mean)) ** 2] = 0.0
        return StandardizerModel(mean, np.sqrt(variance))
