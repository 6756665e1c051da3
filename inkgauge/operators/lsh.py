"""Random-hyperplane LSH: approximate nearest neighbours by cosine, and votes on labels.

A vector gets one key per table: the signs of its projections on that table's
hyperplanes. Base vectors that share a key with a query in some table are its
candidates; the ``top_k`` candidates of highest cosine vote on its label.

How the search is laid out
--------------------------
Candidate pairs are never written out. What moves is:

1. Signatures, (id, label, keys), about one tenth of a vector's size. Of a group
   of identical base vectors only the ``top_k`` lowest ids are routed on. That is
   exact: they tie on similarity, lower ids go first, so no other copy can be
   among the ``top_k``.
2. Bucket sizes by (table, key). A bucket without a query stops here.
3. Vectors, once per bucket they are needed in, to *cells*: a bucket cut into
   blocks of base rows and blocks of queries by hash of the id. A bucket that
   holds a third of the table thus becomes many cells of bounded size.
4. The ``top_k`` of each query in each cell, found by matrix products on Arrow
   batches, and merged per query. The best of a union are among the best of its
   parts, so this, too, is exact.

Cosines are compared after rounding to nine decimals, so that equal vectors tie
whatever the order of summation; ties go to the lower id.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions.vectors import list_array, matrix
from inkgauge.operators.evaluation import accuracy, best_config
from inkgauge.operators.scaling import Standardizer, StandardizerModel
from inkgauge.session import written

QUERY_BLOCK = 2048
BASE_BLOCK = 131_072
BASE_CHUNK = 2048
HOT_SHARE = 1000  # a bucket with over 1/1000 of all entries is hot; there are < 1000
HOT_ROWS = 2048  # smaller buckets never are
NO_NEIGHBOUR_CLASS = 1
NO_NEIGHBOUR_PROBABILITY = 0.75


def random_hyperplanes(
    tables: int, bits: int, dim: int, seed: int = schema.SEED, kind: str = "gaussian"
) -> np.ndarray:
    """Array (tables, bits, dim). More tables or bits extend a smaller set, never change it.

    ``gaussian`` draws standard normals; ``md5`` takes +1 / -1 from a digest of
    the position (Achlioptas 2003), which SQL can reproduce.
    """
    planes = np.empty((tables, bits, dim))
    for t, b in itertools.product(range(tables), range(bits)):
        if kind == "gaussian":
            planes[t, b] = np.random.default_rng([seed, t, b]).standard_normal(dim)
        elif kind == "md5":
            first = (hashlib.md5(f"{seed}|{t}|{b}|{d}".encode()).hexdigest()[0] for d in range(dim))
            planes[t, b] = [1.0 if c >= "8" else -1.0 for c in first]
        else:
            raise ValueError(f"unknown kind of hyperplanes: {kind}")
    return planes


def _best(scores: np.ndarray, k: int):
    """Row, column and score of the k highest finite scores per row, lower columns first."""
    keep = np.isfinite(scores)
    if scores.shape[1] > k:
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        keep &= scores >= kth
    row, col = np.nonzero(keep)
    return _ranked(row, col, scores[row, col], k)


def _ranked(row, tie, score, k):
    """Keep the k best per row, in order; ``tie`` breaks equal scores."""
    order = np.lexsort((tie, -score, row))
    row, tie, score = row[order], tie[order], score[order]
    start = np.searchsorted(row, row, side="left")
    top = np.arange(len(row)) - start < k
    return row[top], tie[top], score[top]


class _Cell:
    """Top-k search of one cell; queries arrive first, base rows after them in id order."""

    def __init__(self, key, k: int, shifts: dict[int, int], chunk: int = BASE_CHUNK):
        self.key, self.k, self.shifts, self.chunk = key, k, shifts, chunk
        self.parts: list = []
        self.queries = None
        self.best = {bits: [] for bits in shifts}

    def add(self, side, ids, hashes, labels, vectors):
        asks = side == 0
        if asks.any():
            self.parts.append((ids[asks], hashes[asks], vectors[asks]))
        if asks.all() or not self.parts:
            return
        if self.queries is None:
            self.queries = [np.concatenate(column) for column in zip(*self.parts)]
        base = ~asks
        ids, hashes, labels, vectors = ids[base], hashes[base], labels[base], vectors[base]
        for at in range(0, len(ids), self.chunk):
            part = slice(at, at + self.chunk)
            self._search(ids[part], hashes[part], labels[part], vectors[part])

    def _search(self, ids, hashes, labels, vectors):
        _, q_hashes, q_vectors = self.queries
        scores = np.round(q_vectors @ vectors.T, 9)
        for bits, shift in self.shifts.items():
            same = (q_hashes[:, None] >> shift) == (hashes[None, :] >> shift)
            row, col, score = _best(np.where(same, scores, -np.inf), self.k)
            self.best[bits].append((row, ids[col], score, labels[col]))
            if len(self.best[bits]) > 1:
                self.best[bits] = [self._merged(self.best[bits])]

    def _merged(self, parts):
        row, ids, score, labels = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((ids, -score, row))
        row, ids, score, labels = row[order], ids[order], score[order], labels[order]
        top = np.arange(len(row)) - np.searchsorted(row, row, side="left") < self.k
        return row[top], ids[top], score[top], labels[top]

    def found(self):
        """Columns query_id, id, similarity, label, table_idx, bits."""
        for bits, parts in self.best.items():
            for row, ids, score, labels in parts:
                if len(row):
                    yield (
                        self.queries[0][row],
                        ids,
                        score,
                        labels,
                        np.full(len(row), self.key[0], dtype=np.int32),
                        np.full(len(row), bits, dtype=np.int32),
                    )


_CELL = ["table_idx", "bucket", "base_block", "query_block"]
_FOUND = "query_id bigint, id bigint, similarity double, label double, table_idx int, bits int"


def _cell_search(k: int, shifts: dict[int, int], scaler: StandardizerModel | None):
    """Function for mapInArrow over partitions sorted by cell and side."""

    def unit(vectors: np.ndarray) -> np.ndarray:
        if scaler is not None:
            vectors = scaler.apply(vectors)
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)

    def batch_of(found):
        columns = [np.concatenate(c) for c in zip(*found)]
        names = [part.split()[0] for part in _FOUND.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def search(batches):
        cell, found, waiting = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack(
                [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _CELL]
            )
            side, ids, hashes, labels = (
                batch.column(c).to_numpy(zero_copy_only=False)
                for c in ("side", "id", "hash", "label")
            )
            vectors = unit(matrix(batch.column("features")))
            starts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in itertools.pairwise([0, *starts.tolist(), len(keys)]):
                key = tuple(keys[lo])
                if cell is None or cell.key != key:
                    if cell is not None:
                        for rows in cell.found():
                            found.append(rows)
                            waiting += len(rows[0])
                    if waiting > 20_000:
                        yield batch_of(found)
                        found, waiting = [], 0
                    cell = _Cell(key, k, shifts)
                part = slice(lo, hi)
                cell.add(side[part], ids[part], hashes[part], labels[part], vectors[part])
        if cell is not None:
            found.extend(cell.found())
        if found:
            yield batch_of(found)

    return search


def _key_text(key: Column, bits: int) -> Column:
    return F.lpad(F.bin(key), bits, "0")


@dataclass(frozen=True)
class LshModel:
    tables: int
    bits: int
    planes: np.ndarray
    scaler: StandardizerModel | None
    base: DataFrame  # id, features, label
    signed: DataFrame  # id, label, h1, h2, keys
    path: str | None = None  # where a loaded model still reads its rows

    # -- signatures ---------------------------------------------------------

    def keys_column(self, features: str = "features") -> Column:
        """array<bigint>: the key of every table, its bits as a binary number."""
        tables, bits, scaler = self.tables, self.bits, self.scaler
        planes = self.planes[:tables, :bits].reshape(tables * bits, -1)
        powers = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)

        @F.arrow_udf("array<bigint>")
        def keys(vectors: pa.Array) -> pa.Array:
            rows = matrix(vectors)
            if scaler is not None:
                rows = scaler.apply(rows)
            positive = (rows @ planes.T > 0).reshape(len(rows), tables, bits)
            return list_array(positive @ powers, pa.int64())

        return keys(F.col(features))

    def signatures(self, df: DataFrame) -> DataFrame:
        """(id, hash_keys): the keys written as strings of 0 and 1."""
        return df.select(
            "id",
            F.transform(self.keys_column(), lambda key: _key_text(key, self.bits)).alias(
                "hash_keys"
            ),
        )

    def index(self) -> DataFrame:
        """(table_idx, hash_key, id) for every base row and table."""
        return self.signed.select("id", F.posexplode("keys").alias("table_idx", "key")).select(
            "table_idx", _key_text(F.col("key"), self.bits).alias("hash_key"), "id"
        )

    def bucket_hits(self, queries: DataFrame) -> DataFrame:
        """(query_id, table_idx, hash_key, n): size of the bucket each query meets, if any."""
        asked = queries.select(
            F.col("id").alias("query_id"),
            F.posexplode(self.keys_column()).alias("table_idx", "key"),
        )
        sizes = (
            self.signed.select(F.posexplode("keys").alias("table_idx", "key"))
            .groupBy("table_idx", "key")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        total = sizes.agg(F.sum("n")).scalar()
        hot = (F.col("n") > HOT_ROWS) & (F.col("n") * HOT_SHARE > total)
        hits = _lookup(asked, sizes, ["table_idx", "key"], hot)
        return hits.select(
            "query_id", "table_idx", _key_text(F.col("key"), self.bits).alias("hash_key"), "n"
        )

    # -- search -------------------------------------------------------------

    def table_neighbours(
        self, queries: DataFrame, top_k: int = 10, levels: list[int] | None = None
    ) -> DataFrame:
        """Per query and key length: the union over tables of each bucket's ``top_k``.

        ``table_idx`` is the first table that lists the candidate. A shorter key
        is the prefix of a longer one, so several ``levels`` share one search.
        """
        levels = sorted(levels or [self.bits])
        width = self.bits
        if levels[-1] > width:
            raise ValueError(f"the index has {width} bits")
        bucket = F.shiftright("hash", width - levels[0])

        def entries(signed: DataFrame, *cols: str) -> DataFrame:
            return signed.select(
                "id", *cols, F.posexplode("keys").alias("table_idx", "hash")
            ).withColumn("bucket", bucket)

        # copies beyond the top_k lowest ids cannot be chosen, see the module text
        copy = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
        base = entries(self.signed.withColumn("copy", copy).where(F.col("copy") <= top_k))
        asked_signed = written(queries.select("id", self.keys_column().alias("keys")), "asked")
        asked = entries(asked_signed)

        by = ["table_idx", "bucket"]
        base_sizes = base.groupBy(*by).agg(F.count(F.lit(1)).alias("n_base"))
        asked_sizes = asked.groupBy(*by).agg(F.count(F.lit(1)).alias("n_asked"))
        sizes = written(base_sizes.join(asked_sizes, by, "full"), "buckets")
        extent = sizes.agg(
            *(f(c).alias(f"{f.__name__}_{c}") for c in ("n_base", "n_asked") for f in (F.max, F.sum))
        ).first()

        def routed(side: DataFrame, size: str) -> DataFrame:
            bound = max(HOT_ROWS, (extent[f"sum_{size}"] or 0) // HOT_SHARE)
            is_hot = (extent[f"max_{size}"] or 0) > bound
            both = F.col("n_base").isNotNull() & F.col("n_asked").isNotNull()
            if is_hot:
                # hot buckets stay in the table without a partner, to catch their rows early
                table = sizes.where(both | (F.col(size) > bound))
                found = _lookup(side, table, by, F.col(size) > bound).where(both)
            else:
                found = side.join(sizes.where(both), by)
            return found.select(
                "id",
                *by,
                "hash",
                F.ceil(F.col("n_base") / BASE_BLOCK).alias("base_blocks"),
                F.ceil(F.col("n_asked") / QUERY_BLOCK).alias("query_blocks"),
            )

        def with_vectors(side: DataFrame, vectors: DataFrame) -> DataFrame:
            places = F.struct(*[c for c in side.columns if c != "id"])
            # at most one place per table
            listed = side.groupBy("id").agg(F.collect_list(places).alias("places"))
            return vectors.join(listed, "id").select(
                "id", "features", "label", F.inline("places")
            )

        def spot(blocks: str) -> Column:
            return F.pmod(F.xxhash64("id"), F.col(blocks))

        def every(blocks: str) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1))

        base_vectors = self.base.select("id", "features", F.col("label").cast("double"))
        asked_vectors = queries.select("id", "features", F.lit(0.0).alias("label"))
        shared = [F.col(c) for c in ("table_idx", "bucket", "id", "hash", "label", "features")]
        to_search = (
            with_vectors(routed(base, "n_base"), base_vectors)
            .select(
                *shared,
                F.lit(1).alias("side"),
                spot("base_blocks").alias("base_block"),
                every("query_blocks").alias("query_block"),
            )
            .unionByName(
                with_vectors(routed(asked, "n_asked"), asked_vectors).select(
                    *shared,
                    F.lit(0).alias("side"),
                    every("base_blocks").alias("base_block"),
                    spot("query_blocks").alias("query_block"),
                )
            )
            .repartition(*_CELL)
            .sortWithinPartitions(*_CELL, "side", "id")
        )
        shifts = {bits: width - bits for bits in levels}
        found = to_search.mapInArrow(_cell_search(top_k, shifts, self.scaler), _FOUND)
        return found.groupBy("query_id", "bits", "id").agg(
            F.min("table_idx").alias("table_idx"),
            F.max("similarity").alias("similarity"),
            F.max("label").alias("label"),
        )

    def query(self, queries: DataFrame, top_k: int = 10) -> DataFrame:
        """(query_id, rank, id, similarity, label) of up to ``top_k`` neighbours per query."""
        nearest = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "id")
        return (
            self.table_neighbours(queries, top_k)
            .withColumn("rank", F.row_number().over(nearest))
            .where(F.col("rank") <= top_k)
            .select("query_id", "rank", "id", "similarity", "label")
        )

    def votes(self, queries: DataFrame, top_k: int = 10) -> DataFrame:
        """(query_id, n, share): number of neighbours and mean of their labels; share may be null.

        Queries without a neighbour stay in, by a row of their own with no vote.
        """
        marks = queries.select(
            F.col("id").alias("query_id"), F.lit(None).cast("double").alias("label")
        )
        cast = self.query(queries, top_k).select("query_id", "label")
        return (
            cast.unionByName(marks)
            .groupBy("query_id")
            .agg(F.count("label").alias("n"), F.avg("label").alias("share"))
        )

    def predict(self, queries: DataFrame, top_k: int = 10) -> DataFrame:
        """(query_id, predicted): 1 from a share of one half on, and 1 without neighbours."""
        return self.votes(queries, top_k).select(
            "query_id", _vote_class(F.col("share")).alias("predicted")
        )

    def predict_probability(self, queries: DataFrame, top_k: int = 10) -> DataFrame:
        """(query_id, probability): the mean vote, 0.75 without neighbours."""
        return self.votes(queries, top_k).select(
            "query_id",
            F.coalesce("share", F.lit(NO_NEIGHBOUR_PROBABILITY)).alias("probability"),
        )

    def predictions(self, queries: DataFrame, top_k: int = 10) -> DataFrame:
        """(query_id, label, predicted) for labelled queries."""
        truth = queries.select(F.col("id").alias("query_id"), F.col("label").cast("double"))
        return truth.join(self.predict(queries, top_k), "query_id")

    def evaluate(self, queries: DataFrame, top_k: int = 10) -> DataFrame:
        """(accuracy, correct, total) over labelled queries."""
        return accuracy(self.predictions(queries, top_k))

    # -- storage ------------------------------------------------------------

    def save(self, path: str) -> None:
        spark = self.base.sparkSession
        path = path.rstrip("/")
        if path == self.path:
            raise ValueError("a loaded model cannot be saved over the files it reads: choose another path")
        self.base.write.mode("overwrite").parquet(f"{path}/base")
        self.signed.write.mode("overwrite").parquet(f"{path}/signed")
        planes = [
            (t, b, self.planes[t, b].tolist())
            for t, b in itertools.product(range(self.tables), range(self.bits))
        ]
        spark.createDataFrame(planes, "table_idx int, bit int, plane array<double>").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/planes")
        scaler = [] if self.scaler is None else [(self.scaler.mean.tolist(), self.scaler.std.tolist())]
        spark.createDataFrame(scaler, "mean array<double>, std array<double>").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/scaler")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LshModel:
        path = path.rstrip("/")
        rows = spark.read.parquet(f"{path}/planes").collect()
        tables = 1 + max(r["table_idx"] for r in rows)
        bits = 1 + max(r["bit"] for r in rows)
        planes = np.empty((tables, bits, len(rows[0]["plane"])))
        for r in rows:
            planes[r["table_idx"], r["bit"]] = r["plane"]
        stored = spark.read.parquet(f"{path}/scaler").first()
        scaler = stored and StandardizerModel(np.array(stored["mean"]), np.array(stored["std"]))
        return LshModel(
            tables,
            bits,
            planes,
            scaler,
            spark.read.parquet(f"{path}/base"),
            spark.read.parquet(f"{path}/signed"),
            path,
        )


def _vote_class(share: Column) -> Column:
    return F.when(share.isNull(), NO_NEIGHBOUR_CLASS).when(share >= 0.5, 1).otherwise(0)


def _lookup(rows: DataFrame, table: DataFrame, on: list[str], hot: Column) -> DataFrame:
    """Inner join of many ``rows`` with a ``table`` unique on ``on``, safe against hot keys.

    ``hot`` marks the table rows whose key holds over 1/HOT_SHARE of some fixed
    total, so there are fewer than HOT_SHARE of them: they are broadcast, and their
    rows never meet in one task. All other keys are joined by shuffle.
    """
    flagged = table.withColumn("_hot", F.coalesce(hot, F.lit(False)))
    few = F.broadcast(flagged.where("_hot"))
    tagged = rows.join(few, on, "left")
    at_once = tagged.where(F.col("_hot").isNotNull())
    rest = tagged.where(F.col("_hot").isNull()).select(rows.columns).join(
        flagged.where(~F.col("_hot")), on
    )
    return at_once.unionByName(rest).drop("_hot")


class HyperplaneLsh:
    def __init__(
        self,
        tables: int = 24,
        bits: int = 18,
        seed: int = schema.SEED,
        planes: str = "gaussian",
        normalize: bool = True,
    ):
        if not 1 <= bits <= 62:
            raise ValueError("a key has 1 to 62 bits")
        self.tables, self.bits, self.seed = tables, bits, seed
        self.planes, self.normalize = planes, normalize

    def fit(self, df: DataFrame) -> LshModel:
        """Index ``df`` (id bigint unique, features, label): scale, sign, write the signatures."""
        base = df.select("id", "features", "label")
        scaler = Standardizer().fit(base) if self.normalize else None
        dim = len(scaler.mean) if scaler else len(base.first()["features"])
        planes = random_hyperplanes(self.tables, self.bits, dim, self.seed, self.planes)
        model = LshModel(self.tables, self.bits, planes, scaler, base, base)
        signed = base.select(
            "id",
            F.col("label").cast("double"),
            # 128 bits that equal vectors share
            F.xxhash64("features").alias("h1"),
            F.xxhash64(F.lit(self.seed), "features").alias("h2"),
            model.keys_column().alias("keys"),
        )
        return replace(model, signed=written(signed, "signed"))


def hyperparameter_grid(**values: list) -> list[dict]:
    """All combinations, the last name varying fastest."""
    return [dict(zip(values, combo)) for combo in itertools.product(*values.values())]


def lsh_grid_search(
    train: DataFrame,
    val: DataFrame,
    tables: list[int] = schema.TABLES_GRID,
    bits: list[int] = schema.BITS_GRID,
    top_k: list[int] = schema.TOP_K_GRID,
    seed: int = schema.SEED,
    planes: str = "gaussian",
) -> tuple[LshModel, DataFrame]:
    """Validation accuracy of every configuration, from one index and one search.

    Configurations nest: fewer tables are the first of many, a short key is the
    prefix of a long one, a small k is the head of a large one. Returns the
    largest model and (grid_pos, num_hash_tables, num_hash_bits, top_k, accuracy,
    correct, total).
    """
    model = HyperplaneLsh(max(tables), max(bits), seed, planes).fit(train)
    grid = hyperparameter_grid(num_hash_tables=tables, num_hash_bits=bits, top_k=top_k)
    listed = model.table_neighbours(val, max(top_k), levels=sorted(set(bits)))
    fewer = F.array(*(F.lit(t) for t in sorted(set(tables))))
    nearest = Window.partitionBy("query_id", "num_hash_tables", "num_hash_bits").orderBy(
        F.col("similarity").desc(), "id"
    )
    ranked = (
        listed.withColumnRenamed("bits", "num_hash_bits")
        .withColumn("num_hash_tables", F.explode(fewer))
        .where(F.col("table_idx") < F.col("num_hash_tables"))
        .withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= max(top_k))
    )
    config = ["num_hash_tables", "num_hash_bits", "top_k"]
    shares = (
        ranked.withColumn("top_k", F.explode(F.array(*(F.lit(k) for k in sorted(set(top_k))))))
        .where(F.col("rank") <= F.col("top_k"))
        .groupBy("query_id", *config)
        .agg(F.avg("label").alias("share"))
    )
    truth = val.select(F.col("id").alias("query_id"), (F.col("label") == 1).alias("positive"))
    hit = (_vote_class(F.col("share")) == 1) == F.col("positive")
    met = (
        shares.join(truth, "query_id")
        .groupBy(*config)
        .agg(
            F.count_if(hit).alias("hits"),
            F.count_if("positive").alias("met_positive"),
        )
    )
    # queries that met nobody are class 1: right for the positives among them
    totals = truth.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("positive").alias("positives")
    )
    size = totals.select(F.struct("total", "positives")).scalar()
    spark = train.sparkSession
    configs = spark.createDataFrame(
        [(i, *(g[c] for c in config)) for i, g in enumerate(grid)],
        "grid_pos int, num_hash_tables int, num_hash_bits int, top_k int",
    )
    correct = F.coalesce("hits", F.lit(0)) + size["positives"] - F.coalesce("met_positive", F.lit(0))
    results = configs.join(met, config, "left").select(
        "grid_pos",
        *config,
        F.try_divide(correct.cast("double"), size["total"]).alias("accuracy"),
        correct.cast("bigint").alias("correct"),
        size["total"].alias("total"),
    )
    return model, results


def best_lsh(model: LshModel, results: DataFrame) -> tuple[LshModel, dict]:
    """Cut the largest model of a grid down to the best configuration."""
    best = best_config(results).first().asDict()
    tables, bits = best["num_hash_tables"], best["num_hash_bits"]
    short = F.transform(
        F.slice("keys", 1, tables), lambda key: F.shiftright(key, model.bits - bits)
    )
    smaller = replace(
        model,
        tables=tables,
        bits=bits,
        planes=model.planes[:tables, :bits],
        signed=model.signed.withColumn("keys", short),
    )
    return smaller, best
