"""Text to vectors through a pluggable encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkgauge import schema
from inkgauge.functions import text as X
from inkgauge.functions.vectors import list_array, row_lengths


RUN_BYTES, RUN_ROWS = 1 << 20, 512  # encoded at once


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, number) of rows encoded at once: their memory does not follow the Arrow batch."""
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        n = int(np.searchsorted(ends, before + RUN_BYTES, "right")) - at
        n = min(max(n, 1), RUN_ROWS, len(sizes) - at)
        yield at, n
        at += n


def _cells(words: pa.Array, dim: int, known: dict[str, tuple[int, float]]) -> pa.Array:
    """Vectors of some rows of words; ``known`` remembers the dimension and sign of words."""
    lengths = row_lengths(words)
    coded = words.flatten().dictionary_encode()
    slot, sign = np.zeros(len(coded.dictionary), dtype=np.int64), np.zeros(len(coded.dictionary))
    for i, w in enumerate(coded.dictionary.to_pylist()):
        if w not in known:
            digest = hashlib.md5(w.encode()).hexdigest()
            known[w] = int(digest[:8], 16) % dim, 1.0 if digest[8] >= "8" else -1.0
        slot[i], sign[i] = known[w]
    code = coded.indices.to_numpy()
    row = np.repeat(np.arange(len(words)), lengths)
    cells = np.bincount(row * dim + slot[code], weights=sign[code], minlength=len(words) * dim)
    # counts of an empty batch come back as integers
    cells = cells.astype(np.float64).reshape(len(words), dim)
    norm = np.linalg.norm(cells, axis=1, keepdims=True)
    unit = np.divide(cells, norm, out=np.zeros_like(cells), where=norm > 0)
    return list_array(unit.astype(np.float32), pa.float32())


class HashingEncoder:
    """Signed feature hashing of regex words (Weinberger et al. 2009), scaled to unit length.

    md5 of a word gives its dimension (first 8 hex digits modulo ``dim``) and its
    sign (9th digit). Words are cut in the JVM; an Arrow batch is encoded in runs of
    bounded size, each one weighted count over (row, dimension), hashing each distinct
    word of the batch once.
    Text without a word gives the zero vector.
    """

    def __init__(self, dim: int = schema.EMBEDDING_DIM):
        self.dim = dim

    def column(self, text: str | Column, batch_size: int) -> Column:
        dim = self.dim

        @F.arrow_udf("array<float>")
        def encode(words: pa.Array) -> pa.Array:
            known = {"": (0, 0.0)}  # what splitting a text without words gives
            sizes = pc.fill_null(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
            parts = [_cells(pc.split_pattern(words.slice(at, n), " "), dim, known) for at, n in _runs(sizes)]
            return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))

        # one string a row: a list would bring an offset for every word
        return encode(F.array_join(X.regex_words(F.lower(X._col(text))), " "))


class BatchModelEncoder:
    """Any batch model: ``make_predict_fn()`` loads it once per Python worker and
    returns a function from an array of texts to a (texts, dim) array."""

    def __init__(self, make_predict_fn, dim: int = schema.EMBEDDING_DIM):
        self.make_predict_fn, self.dim = make_predict_fn, dim

    def column(self, text: str | Column, batch_size: int) -> Column:
        encode = predict_batch_udf(
            self.make_predict_fn,
            return_type=T.ArrayType(T.FloatType()),
            batch_size=batch_size,
        )
        return encode(X._col(text))


def embed_text(
    df: DataFrame,
    encoder=None,
    batch_size: int = schema.BATCH_SIZE,
    text: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """Add ``embedding`` and drop the text."""
    encoder = encoder or HashingEncoder()
    vectors = df.withColumn("embedding", encoder.column(F.coalesce(text, F.lit("")), batch_size))
    return vectors if keep_text else vectors.drop(text)
