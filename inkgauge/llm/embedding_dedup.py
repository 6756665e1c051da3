"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Unit centroids divide the sphere into cells; since only vectors of one label are
compared, there are as many cells as the largest label needs. A vector lives in the
cell of its nearest centroid h and visits cells c in which a partner may live: if x
lives in c and y = x + e, then <y, h> - <y, c> <= <e, h - c>. With |e| at most
r = sqrt(2 - 2 t) that is at most r |h - c|, whatever the direction of e, and with
``margin`` = 1 a vector meets all its partners in its own cell. In many dimensions e
hardly ever points along h - c: its part in that direction is r / sqrt(d) or so. The
default margin is WIDE times that share (all of it up to 16 dimensions, one half in
64), which makes a vector visit a few cells instead of most; the tests measure recall.

Beyond COARSE cells, each is divided again, by centroids fitted inside it, with the
same rule for visits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge.llm.frames import components, map_batches, sample_per_class, written

PER_CELL = 2048  # vectors of the largest label in a cell, about
COARSE = 256  # cells of the first level
FINE = 256  # cells into which one of them is divided, at most
SAMPLE = 16384  # vectors the centroids of the first level are fitted on, at most
INNER_SAMPLE = 4096  # vectors the centroids inside a cell are fitted on, at most
ROUNDS = 10
BLOCK = 4096  # rows of one side of a product
STRIP = 512  # of them multiplied at once
WIDE = 4.0
_SLACK = 1e-9


def spherical_kmeans(vectors: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids; the start is drawn with a fixed seed."""
    order = np.random.default_rng(5).permutation(len(vectors))
    centroids = vectors[order[:k]].copy()
    for _ in range(ROUNDS):
        nearest = (vectors @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        norms = np.linalg.norm(sums, axis=1)
        filled = norms > 1e-12
        centroids[filled] = sums[filled] / norms[filled, None]
    return centroids


def _unit(values: pd.Series) -> np.ndarray:
    x = np.array(values.tolist(), float).reshape(len(values), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Cells:
    """Centroids of one dimensionality: the first level and, if there is one, the second."""

    def __init__(self, coarse: np.ndarray, inner: dict[int, np.ndarray] | None = None):
        self.coarse, self.inner = coarse, inner or {}

    def home(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.coarse.T).argmax(1)

    def visits(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, whether it lives there) of each cell a vector visits."""
        row, cell, lives = _visited(x, self.coarse, reach)
        if not self.inner:
            return row, cell.astype(np.int64), lives
        found = []
        for c in np.unique(cell).tolist():
            at = np.flatnonzero(cell == c)
            if c not in self.inner:  # a cell without a vector of the sample
                found.append((row[at], np.full(len(at), c * FINE), lives[at]))
                continue
            inner_row, inner_cell, inner_lives = _visited(x[row[at]], self.inner[c], reach)
            found.append((row[at][inner_row], c * FINE + inner_cell, lives[at][inner_row] & inner_lives))
        return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def _visited(x: np.ndarray, centroids: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sims = x @ centroids.T
    home = sims.argmax(1)
    best = sims[np.arange(len(x)), home]
    apart = np.linalg.norm(centroids[:, None] - centroids[None], axis=2)
    row, cell = np.nonzero(best[:, None] - sims <= reach * apart[home] + _SLACK)
    return row, cell, home[row] == cell


def _assign(cells: dict[int, Cells], reach: dict[int, float]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for dim, part in pdf.groupby("dim"):
                row, cell, home = cells[dim].visits(_unit(part["vec"]), reach[dim])
                rep, label = part["rep"].to_numpy()[row], part["label"].to_numpy()[row]
                out.append(pd.DataFrame({"rep": rep, "label": label, "dim": dim, "cell": cell, "home": home}))
            if out:
                yield pd.concat(out)

    return run


def _fit_cells(classes: DataFrame, dim: int, needed: int) -> Cells:
    """Centroids fitted on bounded samples; ``needed`` cells of two levels at most."""
    own = classes.where(F.col("dim") == dim).select("dim", "rep", "vec")
    sample = sample_per_class(own, "dim", F.xxhash64("rep"), SAMPLE)
    sample = sample.select("rep", "vec").toPandas().drop_duplicates("rep").sort_values("rep")
    coarse = Cells(spherical_kmeans(_unit(sample["vec"]), min(len(sample), COARSE, needed)))
    if needed <= COARSE:
        return coarse
    inside = min(FINE, -(-needed // len(coarse.coarse)))

    def homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=coarse.home(_unit(pdf["vec"])).astype("int32"))[["rep", "vec", "cell"]]

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("rep").sort_values("rep")
        found = spherical_kmeans(_unit(pdf["vec"]), min(inside, len(pdf)))
        return pd.DataFrame({"cell": key[0], "centroid": list(found)})

    placed = written(map_batches(own, homes, f"rep bigint, vec {own.schema['vec'].dataType.simpleString()}, cell int"), "homes")
    sampled = sample_per_class(placed, "cell", F.xxhash64("rep"), INNER_SAMPLE).select("cell", "rep", "vec")
    # COARSE x FINE centroids at most
    rows = sampled.groupBy("cell").applyInPandas(fit, "cell int, centroid array<double>").collect()
    inner: dict[int, list] = {}
    for r in rows:
        inner.setdefault(r["cell"], []).append(r["centroid"])
    return Cells(coarse.coarse, {c: np.array(sorted(v)) for c, v in inner.items()})


def local_links(
    left: np.ndarray, right: np.ndarray, left_ids: np.ndarray, right_ids: np.ndarray, weights: np.ndarray, threshold: float
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Weighted number of partners of each left row, and edges that span the links' components."""
    near = (left @ right.T) >= threshold
    near &= left_ids[:, None] != right_ids[None, :]
    counts = near @ weights
    rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not len(rows):
        return counts, []
    near = near[np.ix_(rows, cols)]
    a, b = left_ids[rows].copy(), right_ids[cols].copy()
    most = np.iinfo(np.int64).max
    while True:
        low_b = np.minimum(b, np.where(near, a[:, None], most).min(0))
        low_a = np.minimum(a, np.where(near, low_b[None, :], most).min(1))
        if (low_a == a).all() and (low_b == b).all():
            break
        a, b = low_a, low_b
    edges = {(int(i), int(x)) for i, x in zip(left_ids[rows], a, strict=True) if i != x}
    edges |= {(int(i), int(x)) for i, x in zip(right_ids[cols], b, strict=True) if i != x}
    return counts, sorted(edges)


def _compare(threshold: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["left"]], pdf[pdf["right"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "links": []}, dtype="int64")
        x, y = _unit(left["vec"]), _unit(right["vec"])
        left_ids, right_ids, weights = left["rep"].to_numpy(), right["rep"].to_numpy(), right["weight"].to_numpy()
        found = []
        for at in range(0, len(x), STRIP):
            strip = slice(at, at + STRIP)
            counts, edges = local_links(x[strip], y, left_ids[strip], right_ids, weights, threshold)
            some = counts > 0
            found += [(int(r), None, int(c)) for r, c in zip(left_ids[strip][some], counts[some], strict=True)]
            found += [(a, b, None) for a, b in edges]
        return pd.DataFrame(found, columns=["a", "b", "links"]).astype("Int64")

    return run


def embedding_near_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    margin: float | None = None,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row: links of cosine >= threshold within a label.

    ``margin`` is the share of the worst case by which a vector visits cells beside
    its own: 1 finds every link, whatever the vectors; None is WIDE / sqrt(dimensions).

    Vectors are compared only when their labels are equal and not null and their
    lengths are equal. Rows whose vector is null, empty or zero or holds null or
    non-finite components, and rows without label or id, link with nothing
    (``component_id`` is their id). Equal vectors of a label are one class and
    travel once; each of its rows is linked with all others. ``kept`` marks the
    smallest id of a component. An id names one vector; repeated rows of it are
    counted as rows. Other columns are ignored; an empty table gives an empty result.

    Cells are cut into blocks of bounded size, so a crowded cell is many products;
    counts and spanning edges leave a product, never its pairs.
    """
    # single precision travels as it is and is widened where it is compared
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    vec = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vec", lambda x: x != 0.0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(2), "vec")})
    classes = (
        rows.where("usable")
        .groupBy("label", "h1", "h2")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.any_value("vec").alias("vec"))
        .withColumn("dim", F.size("vec"))
    )
    classes = written(classes, "classes")
    largest = classes.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("dim").agg(F.max("n").alias("n"))
    fitted = {dim: _fit_cells(classes, dim, max(1, n // PER_CELL)) for dim, n in largest.collect()}
    worst = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))
    reach = {dim: worst * (min(1.0, WIDE / np.sqrt(dim)) if margin is None else margin) for dim in fitted}
    cells = map_batches(
        classes.select("rep", "label", "dim", "vec"),
        _assign(fitted, reach),
        f"rep bigint, label {classes.schema['label'].dataType.simpleString()}, dim int, cell bigint, home boolean",
    )
    cells = written(cells, "cells")
    by = ["label", "dim", "cell"]
    sizes = cells.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cells = cells.join(sizes, by).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # products (i, j): vectors that live in block i against all vectors of block j
    as_right = F.transform(every, lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), (F.col("home") & (i == F.col("block"))).alias("left"), F.lit(True).alias("right")))
    as_left = F.transform(F.filter(every, lambda j: F.col("home") & (j != F.col("block"))), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"), F.lit(True).alias("left"), F.lit(False).alias("right")))
    placed = cells.select("rep", *by, F.inline(F.concat(as_right, as_left)))
    found = (
        placed.join(classes.select("rep", "label", "weight", "vec"), ["rep", "label"])
        .groupBy(*by, "i", "j")
        .applyInPandas(_compare(threshold), "a bigint, b bigint, links bigint")
    )
    found = written(found, "links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    named = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("id", "rep")
    classes = classes.select("label", "h1", "h2", "rep", "weight").join(links, "rep", "left").join(named, "rep", "left")
    classes = classes.select(
        "label", "h1", "h2",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
        F.lit(True).alias("usable"),
    )
    return (
        rows.select("id", "label", "h1", "h2", "usable")
        .join(classes, ["label", "h1", "h2", "usable"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )
