"""K-means clusters as a classifier: clusters take the majority class of their rows.

All numbers of clusters and all restarts are fitted together: each pass over the rows
serves every model that has not converged yet, with one matrix product per slice of
rows, and returns one sum per model and cluster; after the first pass only rows that
changed their cluster are summed. Products are in single precision with a bound of their
error, and rows it does not decide are compared again in double precision. Restarts begin
with k-means|| (Bahmani et al. 2012), whose samples are drawn by hashes of the rows.

Results do not depend on how the rows are stored or partitioned. Samples and ties are
decided by hash and by exactly summed distances; centroids are means of sums in
integers (two of them per number, as exact as a double), which no order changes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions.vectors import list_array, matrix
from inkgauge.operators.evaluation import (
    accuracy,
    apply_cluster_map,
    best_config,
    cluster_majority,
    f1_positive,
)
from inkgauge.session import arrow_batches

TASK_BYTES = 1 << 27  # of vectors in a task, which reads them in batches of BLOCK_BYTES
SLICE = 1024  # rows compared with all centroids at once
BLOCK_BYTES = 1 << 22  # of vectors that are kept as one value
ROUNDS = 2  # of oversampling
OVERSAMPLING = 2  # candidates a round draws, as a multiple of k
SLACK = 1e-5  # of the lengths, by which a margin is taken for less than it is
CLOSE = 1e-10  # relative gap of two distances below which they are summed exactly
LIMB_BITS = 26
LIMB = 2.0**LIMB_BITS  # a number is kept as two integers up to this size


@dataclass(frozen=True)
class KMeansModel:
    """``cost`` is the sum of squared distances to the centroids over the fitted rows."""

    centroids: np.ndarray
    cost: float

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, c.tolist(), self.cost) for i, c in enumerate(self.centroids)]
        table = spark.createDataFrame(rows, "cluster int, centroid array<double>, cost double")
        table.coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> KMeansModel:
        rows = sorted(spark.read.parquet(path).collect())
        return KMeansModel(np.array([r["centroid"] for r in rows]), rows[0]["cost"])


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances row by row, summed alike wherever a row stands."""
    return np.ascontiguousarray((x - y) ** 2).sum(axis=1)


def nearest(x: np.ndarray, centres: np.ndarray, squares: np.ndarray | None = None) -> np.ndarray:
    """Number of the nearest centre of each row; the lower number among equals.

    ``squares`` has the rows' squared lengths where they are known.
    """
    lengths = (centres**2).sum(axis=1)
    distance = lengths - 2.0 * (x @ centres.T)  # a row's own length changes nothing
    found = distance.argmin(axis=1)
    if len(centres) == 1:
        return found
    gap = CLOSE * (((x**2).sum(axis=1) if squares is None else squares) + lengths.max())
    close = distance <= (distance[np.arange(len(x)), found] + gap)[:, None]
    for row in np.flatnonzero(close.sum(axis=1) > 1):
        rivals = np.flatnonzero(close[row])
        found[row] = rivals[_squared(centres[rivals], x[row]).argmin()]
    return found


class _Nearest:
    """``nearest`` for the centres of many models, by one product in single precision.

    With n numbers in a vector, lengths |x| and at most L, and u = 2 ** -24, a distance less
    |x| ** 2 is off by less than u ((2 n + 10) |x| L + 4 L ** 2), for any order of the sum. Rows
    whose least distance is not less than all others by twice that and more, or within what
    ``nearest`` takes for close, go to ``nearest`` itself: the result is always its own.
    """

    def __init__(self, models: list[np.ndarray], scale: float):
        centres = np.concatenate(models) / scale  # at most 1 each, as the rows' numbers
        lengths = (centres**2).sum(axis=1)
        self.models, self.scale = models, scale
        begins = np.cumsum([0, *map(len, models)]).tolist()
        # neighbours of one size are looked at together: (first column, size, numbers of the models)
        self.alike = []
        for m, (known, begin) in enumerate(zip(models, begins, strict=False)):
            if self.alike and self.alike[-1][1] == len(known):
                self.alike[-1][2].append(m)
            else:
                self.alike.append((begin, len(known), [m]))
        self.apart = [_Nearest([m], scale) for m in models] if len(models) > 1 else [self]
        self.turned = np.ascontiguousarray(-2.0 * centres.T, dtype=np.float32)
        self.lengths = lengths.astype(np.float32)
        self.longest = [lengths[a:b].max() for a, b in zip(begins, begins[1:])]

    def __call__(
        self, x: np.ndarray, squares: np.ndarray, drifts: list[np.ndarray] | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Model by model the number of each row's nearest centre.

        With ``drifts``, how far each centre has come (as shares of the scale), also whether
        it was surely the nearest one before: the others are further away by more than they
        and it have moved (Elkan 2003). What products are rounded by is taken off, and far more
        than ``nearest`` takes for close.
        """
        moved = np.concatenate(drifts).astype(np.float32) if drifts else None
        dims = x.shape[1]
        u, lost = 2.0**-24, dims * 2.0**-124  # rounding, and what gets too small for its range
        distance = (x / self.scale).astype(np.float32) @ self.turned
        distance += self.lengths
        own = (squares / self.scale / self.scale)[:, None]
        for first, size, models in self.alike:
            part = distance[:, first : first + size * len(models)].reshape(len(x), len(models), size)
            found = part.argmin(axis=2)
            at = found[:, :, None]
            least = np.take_along_axis(part, at, axis=2)[:, :, 0]
            np.put_along_axis(part, at, np.float32(np.inf), axis=2)
            longest = np.array([self.longest[m] for m in models])
            error = u * ((2 * dims + 10) * np.sqrt(own * longest) + 4 * longest) + lost
            decided = part.min(axis=2) > least + (2.2 * error + 2 * CLOSE * (own + longest))
            stayed = None
            if drifts:
                drift = moved[first : first + size * len(models)].reshape(len(models), size)
                part += (own - error)[:, :, None].astype(np.float32)
                np.sqrt(np.maximum(part, 0, out=part), out=part)
                part -= drift
                reach = np.sqrt(np.maximum(least + own + error, 0.0)) + np.take_along_axis(drift[None], at, axis=2)[:, :, 0]
                reach += SLACK * (np.sqrt(own + longest) + drift.max(axis=1))
                stayed = decided & (part.min(axis=2) > reach)
            for i, m in enumerate(models):
                open_ = np.flatnonzero(~decided[:, i])
                if len(open_) and size > 1:
                    found[open_, i] = nearest(x[open_], self.models[m], squares[open_])
                yield found[:, i], stayed[:, i] if drifts else None

    def were(self, x: np.ndarray, squares: np.ndarray, now: list[tuple]) -> list[np.ndarray]:
        """The same, where ``now`` has been found with the drifts from these centres."""
        doubts = [np.flatnonzero(~stayed) for _, stayed in now]
        if 4 * sum(map(len, doubts)) > len(x) * len(now):
            return [at for at, _ in self(x, squares)]
        found = [at.copy() for at, _ in now]
        for at, of, one in zip(found, doubts, self.apart, strict=True):
            if len(of):
                at[of] = next(one(x[of], squares[of]))[0]
        return found


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (Steele et al. 2014)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draw(hashes: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) per row, from its hash."""
    u = _mix(hashes + _mix(np.array([salt], np.uint64)))
    return ((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _limbs(x: np.ndarray, scale: float) -> np.ndarray:
    """Integers (high, low) of each number, side by side."""
    high = np.rint(x / scale * LIMB)
    low = np.rint((x / scale * LIMB - high) * LIMB)
    return np.concatenate([high, low], axis=1).astype(np.int64)


def _whole(x: np.ndarray, scale: float) -> np.ndarray:
    """Both limbs of each number as one integer, below 2 ** 53: a slice of rows can be summed."""
    rest = x / scale * LIMB
    high = np.rint(rest)
    rest -= high
    rest *= LIMB
    return (high.astype(np.int64) << LIMB_BITS) + np.rint(rest, out=rest).astype(np.int64)


def _halves(whole: np.ndarray) -> np.ndarray:
    """Limbs, side by side, of integers."""
    return np.concatenate([whole >> LIMB_BITS, whole & ((1 << LIMB_BITS) - 1)], axis=1)


def _number(limbs: np.ndarray, scale: float) -> np.ndarray:
    half = limbs.shape[-1] // 2
    return (limbs[..., :half] + limbs[..., half:] / LIMB) / LIMB * scale


_BLOCK = "rows binary, features binary"


def _blocks(rows: DataFrame, tasks: int, dims: int) -> DataFrame:
    """Hashes and vectors of up to SLICE rows as two values, which every pass takes as they are."""
    size = max(1, min(SLICE, BLOCK_BYTES // (8 * max(dims, 1))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.slice(at, size)
                values = part.column(0).to_numpy().tobytes(), matrix(part.column(1)).tobytes()
                yield pa.record_batch([pa.array([v], pa.binary()) for v in values], ["rows", "features"])

    return rows.repartition(tasks).mapInArrow(pack, _BLOCK)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for rows, features in zip(batch.column(0), batch.column(1), strict=True):
            hashes = np.frombuffer(rows.as_buffer(), np.uint64)
            yield hashes, np.frombuffer(features.as_buffer(), np.float64).reshape(len(hashes), -1)


def _reduced(rows: DataFrame, fn: Callable, columns: str, key: str, merge: Callable) -> pa.Table:
    """Map every partition, bring rows of one key together, merge them there, collect the merged rows.

    Both functions return few rows: their number follows the models, not the table.
    """
    return rows.mapInArrow(fn, columns).repartition(key).mapInArrow(merge, columns).toArrow()


# -- sampling --------------------------------------------------------------------------

_DRAWN = "model int, priority double, row bigint, vector array<double>"


def _drawn_batch(model: int, priority: np.ndarray, hashes: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array([model] * len(x), pa.int32()),
            pa.array(priority),
            pa.array(hashes.view(np.int64)),
            list_array(x, pa.float64()),
        ],
        ["model", "priority", "row", "vector"],
    )


def _first(held: tuple | None, priority: np.ndarray, hashes: np.ndarray, x: np.ndarray, n: int) -> tuple:
    """The ``n`` rows of least priority; a row drawn twice counts once."""
    if held is not None and len(held[0]) == n:
        may = np.flatnonzero(priority <= held[0][-1])
        if not len(may):
            return held
        priority, hashes, x = priority[may], hashes[may], x[may]
    if held is not None:
        priority, hashes = np.concatenate([held[0], priority]), np.concatenate([held[1], hashes])
        x = np.concatenate([held[2], x])
    order = np.lexsort([hashes, priority])
    order = order[np.isfinite(priority[order])]
    same = np.zeros(len(order), bool)
    same[1:] = hashes[order[1:]] == hashes[order[:-1]]
    order = order[~same][:n]
    return priority[order], hashes[order], x[order]


def _sample(
    rows: DataFrame, candidates: list[np.ndarray] | None, sizes: list[int], salts: list[int], scale: float
) -> list[np.ndarray]:
    """Draw rows for each model, with chances by their squared distance to its candidates.

    Without candidates all rows have the same chance.

    The rows of least -ln(u) / weight are a weighted sample without replacement
    (Efraimidis and Spirakis 2006), so a round needs one pass and no total.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple | None] = [None] * len(sizes)
        finder = _Nearest(candidates, scale) if candidates else None
        for hashes, x in _slices(batches):
            near = finder(x, _squared(x, 0.0)) if finder else [(None, None)] * len(sizes)
            for m, ((at, _), size, salt) in enumerate(zip(near, sizes, salts, strict=True)):
                with np.errstate(divide="ignore"):
                    weight = 1.0 if at is None else _squared(x, candidates[m][at])
                    priority = -np.log(_draw(hashes, salt)) / weight
                held[m] = _first(held[m], priority, hashes, x, size)
        for m, found in enumerate(held):
            if found is not None:
                yield _drawn_batch(m, *found)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            models, x = batch.column(0).to_numpy(), matrix(batch.column(3))
            priority, hashes = batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
            for m in np.unique(models).tolist():
                of = models == m
                held[m] = _first(held.get(m), priority[of], hashes[of], x[of], sizes[m])
        for m, found in held.items():
            yield _drawn_batch(m, *found)

    table = _reduced(rows, draw, _DRAWN, "model", merge).sort_by([("model", "ascending"), ("priority", "ascending"), ("row", "ascending")])
    models = table["model"].to_numpy()
    vectors = matrix(table["vector"]) if len(models) else np.zeros((0, 1))
    return [vectors[models == m] for m in range(len(sizes))]


# -- sums by model and cluster ------------------------------------------------------------

_SUMS = "slot int, n bigint, sums binary"


def _sums_batch(slots: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(slots.astype(np.int32)), pa.array(counts.astype(np.int64)), pa.array([s.tobytes() for s in sums], pa.binary())]
    return pa.record_batch(columns, ["slot", "n", "sums"])


def _sums_of(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, width)


def _grouped(at: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Clusters that rows are in, and the limbs of the sums of their rows."""
    order = np.argsort(at, kind="stable")
    present, starts = np.unique(at[order], return_index=True)
    return present, _halves(np.add.reduceat(exact[order], starts, axis=0))


def _cluster_sums(
    rows: DataFrame, centres: list[np.ndarray], scale: float, vectors: bool = True, before: list[np.ndarray] | None = None
) -> tuple:
    """Rows and, with ``vectors``, sums of each model's clusters in one pass over the rows.

    Slot by slot in the order of the centres; the last slot has all rows and, in its
    first two numbers, the sum of their squared lengths. With ``before``, the centres
    these ones came from, it is what they add to the counts and sums found with those
    (less than nothing where rows left): only rows that changed their cluster are summed.
    """
    begins = np.cumsum([0, *map(len, centres)]).tolist()
    last, dims = begins[-1], centres[0].shape[1]
    width = 2 * dims if vectors else 2
    whole = scale**2 * dims

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(last + 1, np.int64), np.zeros((last + 1, width), np.int64)
        finder = _Nearest(centres, scale)
        earlier = _Nearest(before, scale) if before else None
        drifts = [np.sqrt(_squared(a / scale, b / scale)) for a, b in zip(centres, before, strict=True)] if before else []
        for _, x in _slices(batches):
            squares = _squared(x, 0.0)
            found = list(finder(x, squares, drifts))
            was = earlier.were(x, squares, found) if before else [None] * len(found)
            now = [at for at, _ in found]
            if vectors and not before:
                counts[last] += len(x)
                sums[last, :2] += _limbs(squares[:, None], whole).sum(axis=0)
            moved = [np.arange(len(x)) if b is None else np.flatnonzero(a != b) for a, b in zip(now, was, strict=True)]
            if vectors:
                place = np.zeros(len(x), np.int64)  # of a row among those that are summed
                some = np.unique(np.concatenate(moved))
                place[some] = np.arange(len(some))
                exact = _whole(x[some], scale)
            for begin, known, a, b, of in zip(begins, centres, now, was, moved, strict=False):
                for at, sign in ((a, 1), (b, -1)):
                    if at is None or not len(of):
                        continue
                    counts[begin : begin + len(known)] += sign * np.bincount(at[of], minlength=len(known))
                    if vectors:
                        present, added = _grouped(at[of], exact[place[of]])
                        sums[begin + present] += sign * added
        kept = np.flatnonzero((counts != 0) | (sums != 0).any(axis=1))
        if len(kept):
            yield _sums_batch(kept, counts[kept], sums[kept])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            numbers = _sums_of(batch.column(2), width)
            for i, (slot, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                held = total.setdefault(slot, [0, np.zeros(width, np.int64)])
                held[0] += n
                held[1] += numbers[i]
        if total:
            yield _sums_batch(np.array(list(total)), np.array([n for n, _ in total.values()]), np.array([s for _, s in total.values()]))

    table = _reduced(rows, add, _SUMS, "slot", merge)
    counts, sums = np.zeros(last + 1, np.int64), np.zeros((last + 1, width), np.int64)
    slots = table["slot"].to_numpy()
    counts[slots] = table["n"].to_numpy()
    if len(slots):
        sums[slots] = _sums_of(table["sums"], width)
    return begins, counts, sums, float(_number(sums[last, :2], whole)[0])


# -- fitting ---------------------------------------------------------------------------


def _spread_centres(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of few weighted points by k-means++, then improved among the points."""
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    far = _squared(points, points[chosen[0]])
    while len(chosen) < min(k, len(points)) and (far * weights).sum() > 0:
        chance = far * weights
        chosen.append(int(rng.choice(len(points), p=chance / chance.sum())))
        far = np.minimum(far, _squared(points, points[chosen[-1]]))
    centres = points[chosen]
    for _ in range(30):
        at = nearest(points, centres)
        moved = centres.copy()
        for c in np.unique(at):
            of = at == c
            moved[c] = (points[of] * weights[of, None]).sum(axis=0) / weights[of].sum()
        if (moved == centres).all():
            break
        centres = moved
    return centres


def kmeans_rows(df: DataFrame) -> DataFrame:
    """What the fit reads of (id, features): a hash of the row and its vector."""
    vector = F.col("features").cast("array<double>").alias("features")
    key = ["id", "features"] if "id" in df.columns else ["features"]
    return df.select(F.xxhash64(*key).alias("row"), vector)


def kmeans_fit_all(
    df: DataFrame,
    ks: list[int],
    n_init: int = 10,
    max_iter: int = 300,
    seed: int = schema.SEED,
    tol: float = 1e-4,
) -> dict[int, KMeansModel]:
    """For each number of clusters the best of ``n_init`` restarts by within-cluster cost.

    A model stops once its centroids move, in total, by less than ``tol`` of a
    dimension's mean variance. Where there are fewer different rows than clusters
    asked for, there are fewer clusters.
    """
    models = [(k, run) for k in dict.fromkeys(ks) for run in range(n_init)]
    rows = kmeans_rows(df)
    size = F.max(F.greatest(F.array_max("features"), -F.array_min("features")))
    largest, n, dims = rows.agg(size, F.count(F.lit(1)), F.max(F.size("features"))).first()
    if largest is None:
        raise ValueError("cannot cluster an empty table")
    scale = largest or 1.0
    # every pass starts its tasks anew: no more of them than the cores or the rows' bytes ask for,
    # of equal size and as many for every core, since all wait for the last
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = cores * max(1, -(-n * dims * 8 // (TASK_BYTES * cores)))
    rows = _blocks(rows, tasks, dims).persist()
    with arrow_batches(df.sparkSession, BLOCK_BYTES), ExitStack() as end:
        end.callback(rows.unpersist)
        centres = _starts(rows, models, seed, scale)
        cost = [0.0] * len(models)
        active = list(range(len(models)))
        before, held, lengths = {}, {}, None  # centres, and counts and sums of the pass before
        for _ in range(max_iter):
            known = [before[m] for m in active] if before else None
            begins, counts, sums, squares = _cluster_sums(rows, [centres[m] for m in active], scale, before=known)
            lengths = squares if lengths is None else lengths
            still = []
            enough = None
            for i, m in enumerate(active):
                of = slice(begins[i], begins[i + 1])
                held[m] = (held[m][0] + counts[of], held[m][1] + sums[of]) if before else (counts[of], sums[of])
            before = {m: centres[m] for m in active}
            for m in active:
                n = held[m][0][:, None]
                total = _number(held[m][1], scale)
                moved = np.where(n > 0, total / np.maximum(n, 1), centres[m])
                if enough is None:
                    mean = total.sum(axis=0) / n.sum()
                    enough = tol * max(lengths / n.sum() - (mean**2).sum(), 0.0) / len(mean)
                shift = _squared(moved, centres[m]).sum()
                centres[m], cost[m] = moved, max(float(lengths - (n * moved**2).sum()), 0.0)
                if shift > enough:
                    still.append(m)
            active = still
            if not active:
                break
    best: dict[int, KMeansModel] = {}
    for (k, _), found, paid in zip(models, centres, cost, strict=True):
        if k not in best or paid < best[k].cost:
            best[k] = KMeansModel(found, paid)
    return best


def _starts(rows: DataFrame, models: list[tuple[int, int]], seed: int, scale: float) -> list[np.ndarray]:
    """First centroids of every model: k-means|| in ROUNDS + 2 passes for all models together."""

    def salts(step: int) -> list[int]:
        return [int(np.random.SeedSequence([seed, k, run, step]).generate_state(1, np.uint64)[0]) for k, run in models]

    found = _sample(rows, None, [1] * len(models), salts(0), scale)
    for step in range(1, ROUNDS + 1):
        more = _sample(rows, found, [OVERSAMPLING * k for k, _ in models], salts(step), scale)
        found = [np.unique(np.concatenate([a, b]), axis=0) if len(b) else a for a, b in zip(found, more, strict=True)]
    begins, counts, _, _ = _cluster_sums(rows, found, scale, vectors=False)
    return [
        _spread_centres(points, counts[a:b].astype(np.float64), k, np.random.default_rng([seed, k, run]))
        for points, a, b, (k, run) in zip(found, begins[:-1], begins[1:], models, strict=True)
    ]


def kmeans_fit(
    df: DataFrame,
    k: int,
    n_init: int = 10,
    max_iter: int = 300,
    seed: int = schema.SEED,
    tol: float = 1e-4,
) -> KMeansModel:
    """Best of ``n_init`` restarts, which share every pass over the rows."""
    return kmeans_fit_all(df, [k], n_init, max_iter, seed, tol)[k]


def kmeans_assign(model: KMeansModel, df: DataFrame) -> DataFrame:
    """``df`` plus ``cluster``, the nearest centroid; the lower number among equals."""
    centres = model.centroids

    @F.arrow_udf("int")
    def assign(vectors: pa.Array) -> pa.Array:
        parts = [nearest(matrix(vectors.slice(at, SLICE)), centres) for at in range(0, len(vectors), SLICE)]
        return pa.array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32))

    return df.withColumn("cluster", assign(F.col("features")))


def nearest_centroid(
    df: DataFrame, centroids: np.ndarray, features: str = "features", out: str = "cluster"
) -> DataFrame:
    """Number of the nearest row of ``centroids``; the lower number among equals."""
    centres = np.asarray(centroids, dtype=np.float64)
    lengths = (centres**2).sum(axis=1)

    @F.arrow_udf("int")
    def assign(vectors: pa.Array) -> pa.Array:
        # the row's own length does not change which centroid is nearest
        distance = lengths - 2.0 * (matrix(vectors) @ centres.T)
        return pa.array(np.round(distance, 9).argmin(axis=1).astype(np.int32))

    return df.withColumn(out, assign(F.col(features)))


SETTINGS = (
    "k int, n_init int, max_iter int, seed int, label_source string, threshold double"
)


@dataclass
class KMeansClassifier:
    """``label_source="train"`` learns the clusters' classes on the training rows;
    ``"eval"`` on the rows being scored, which makes accuracy the purity of clusters."""

    k: int
    n_init: int = 10
    max_iter: int = 300
    seed: int = schema.SEED
    label_source: str = "train"
    threshold: float = 0.5
    model: KMeansModel | None = field(default=None, repr=False)
    mapping: DataFrame | None = field(default=None, repr=False)

    def fit(self, train: DataFrame) -> KMeansClassifier:
        return self.named(train, kmeans_fit(train, self.k, self.n_init, self.max_iter, self.seed))

    def named(self, train: DataFrame, model: KMeansModel) -> KMeansClassifier:
        """Take a fitted model and learn its clusters' classes."""
        if self.label_source not in ("train", "eval"):
            raise ValueError("label_source is 'train' or 'eval'")
        self.model, self.mapping = model, None
        if self.label_source == "train":
            self.mapping = cluster_majority(
                kmeans_assign(self.model, train), threshold=self.threshold
            )
        return self

    def cluster_classes(self, df: DataFrame) -> DataFrame:
        if self.mapping is not None:
            return self.mapping
        return cluster_majority(kmeans_assign(self.model, df), threshold=self.threshold)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``cluster`` and ``predicted``.

        A cluster no training row fell into has no majority and counts as class 1,
        as a tie does.
        """
        clustered = kmeans_assign(self.model, df)
        scored = apply_cluster_map(clustered, self.cluster_classes(df), n_clusters=self.k)
        return scored.withColumn("predicted", F.coalesce("predicted", F.lit(1)))

    def save(self, path: str, scored: DataFrame | None = None) -> None:
        """Centroids and cluster classes. Pass the scored rows when they are the label source."""
        if self.mapping is None and scored is None:
            raise ValueError("clusters named by the scored rows cannot be saved without them: pass `scored`")
        path = path.rstrip("/")
        self.model.save(SparkSession.active(), f"{path}/kmeans")
        mapping = self.mapping if scored is None else self.cluster_classes(scored)
        mapping.write.mode("overwrite").parquet(f"{path}/cluster_classes")
        settings = (self.k, self.n_init, self.max_iter, self.seed, self.label_source, self.threshold)
        SparkSession.active().createDataFrame([settings], SETTINGS).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> KMeansClassifier:
        path = path.rstrip("/")
        model = KMeansModel.load(spark, f"{path}/kmeans")
        mapping = spark.read.parquet(f"{path}/cluster_classes")
        settings = spark.read.parquet(f"{path}/settings").first().asDict()
        return KMeansClassifier(**settings, model=model, mapping=mapping)


def kmeans_grid_search(
    train: DataFrame,
    val: DataFrame,
    grid: list[int] = schema.CLUSTER_GRID,
    n_init: int = 10,
    seed: int = schema.SEED,
    label_source: str = "eval",
) -> tuple[dict[int, KMeansClassifier], DataFrame]:
    """Validation accuracy per number of clusters: the fitted classifiers and
    (grid_pos, n_clusters, accuracy, correct, total). One fit serves the whole grid."""
    models = kmeans_fit_all(train, grid, n_init, seed=seed)
    fitted, results = {}, []
    for position, k in enumerate(grid):
        fitted[k] = KMeansClassifier(k, n_init, seed=seed, label_source=label_source).named(train, models[k])
        score = accuracy(fitted[k].transform(val)).first()
        results.append((position, k, score["accuracy"], score["correct"], score["total"]))
    table = train.sparkSession.createDataFrame(
        results, "grid_pos int, n_clusters int, accuracy double, correct bigint, total bigint"
    )
    return fitted, table


def clustering_report(best: DataFrame, scored: DataFrame) -> DataFrame:
    """The one-row report from the best grid row and the scored test rows."""
    found = best_config(best).select(
        F.col("n_clusters").alias("best_n_clusters"),
        F.col("accuracy").alias("validation_accuracy"),
    )
    quality = accuracy(scored).select(F.struct("accuracy")).scalar()
    return found.select(
        "*",
        quality["accuracy"].alias("test_accuracy"),
        f1_positive(scored).scalar().alias("test_f1_score"),
    )
