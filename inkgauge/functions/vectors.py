"""Feature vectors as array columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkgauge.schema import NUMERIC_COLS


def assemble_features(
    df: DataFrame,
    numeric: list[str] = NUMERIC_COLS,
    embedding: str = "embedding",
    label: str = "generated",
    id_col: str = "id",
    out: str = "features",
) -> DataFrame:
    """(id, features, label): the embedding followed by the numeric features."""
    vector = F.concat(
        F.col(embedding).cast("array<double>"),
        F.array(*(F.col(c).cast("double") for c in numeric)),
    )
    return df.select(
        F.col(id_col).alias("id"), vector.alias(out), label_cast(label).alias("label")
    )


def label_cast(label: str | Column) -> Column:
    return (F.col(label) if isinstance(label, str) else label).cast("double")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """0 when either vector is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), norms))


def constant_array(values, kind: str) -> Column:
    """Array constant of many numbers, as one literal the optimizer folds."""
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast(f"array<{kind}>")


def matrix(vectors: pa.Array) -> np.ndarray:
    """Arrow list column without nulls -> (rows, dimensions) float64 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(vectors), -1)


def list_array(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """(rows, width) matrix -> Arrow list column."""
    n, width = rows.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), type=kind))


def row_lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
