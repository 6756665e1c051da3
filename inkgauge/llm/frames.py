"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkgauge.session import ship_package, written

__all__ = ["components", "filter_rows", "indexed", "map_batches", "map_groups", "ranked", "sample_per_class", "table", "written"]

SLICE = 256  # rows handed to a Python function at once
FEW_SAMPLES = 100_000  # sampled keys are broadcast up to this many


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables, as Spark splits it."""
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """``mapInPandas`` with the package at hand on the workers.

    ``fn`` sees ``SLICE`` rows at a time, so what it holds per row stays small
    whatever the size of Spark's batches.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return fn(pdf.iloc[i : i + SLICE].reset_index(drop=True) for pdf in batches for i in range(0, len(pdf), SLICE))

    return df.mapInPandas(run, schema)


def map_groups(
    df: DataFrame, keys: list[str], fn: Callable[[tuple, dict[str, np.ndarray]], list[tuple]], schema: str
) -> DataFrame:
    """Apply ``fn(key, columns)`` to each group of non-null integer keys; it returns rows.

    For very many small groups, which stream through a task in key order; a group
    must fit in memory.
    """
    ship_package(df.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def groups(pdf: pd.DataFrame, last: bool) -> tuple[list[tuple], int]:
            columns = {c: pdf[c].to_numpy() for c in pdf.columns}
            changes = np.zeros(len(pdf), bool)
            for k in keys:
                changes[1:] |= columns[k][1:] != columns[k][:-1]
            starts = [0, *np.flatnonzero(changes).tolist()]
            ends = [*starts[1:], len(pdf)]
            rows = []
            for a, b in zip(starts, ends, strict=True) if last else zip(starts[:-1], ends[:-1], strict=True):
                rows += fn(tuple(int(columns[k][a]) for k in keys), {c: v[a:b] for c, v in columns.items()})
            return rows, starts[-1]

        for pdf in batches:
            if not len(pdf):
                continue
            same = held and all(held[0][k].iloc[0] == pdf[k].iloc[-1] for k in keys)
            held.append(pdf)
            if same:
                continue  # still one group
            whole = pd.concat(held, ignore_index=True) if len(held) > 1 else pdf
            rows, rest = groups(whole, False)
            held = [whole.iloc[rest:]]
            if rows:
                yield pd.DataFrame(rows, columns=names)
        if held:
            rows, _ = groups(pd.concat(held, ignore_index=True), True)
            if rows:
                yield pd.DataFrame(rows, columns=names)

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def filter_rows(df: DataFrame, columns: list[str], start: Callable[[], Callable[..., list[bool]]]) -> DataFrame:
    """Rows of ``df``, all columns untouched, for which the test says so.

    ``start()`` makes the test once per task; it gets the named columns as lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = start()
        for batch in batches:
            kept = test(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns))
            yield batch.filter(pa.array(kept, pa.bool_()))

    ship_package(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of an edge (a, b) reaches.

    Each round hooks every vertex to its smallest neighbour and contracts the
    edges, which at least halves the vertices of a component. Rounds are written
    to the shared folder, so that a lost executor costs one round at most. Hubs
    are safe: the minimum is combined before the shuffle, and the joins have one
    row per vertex on the other side, so Spark can split a hub's edges.
    """
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = written(ends.where("a < b").distinct(), "edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("to"))
        hooked = written(hooked, "hooked")
        rounds.append(hooked)
        edges = (
            edges.join(hooked.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
            .join(hooked.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        edges = written(edges.distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    found = rounds.pop().withColumnRenamed("to", "component")
    for hooked in reversed(rounds):
        up = found.select(F.col("id").alias("to"), F.col("component").alias("top"))
        found = hooked.join(up, "to", "left").select("id", F.coalesce("top", "to").alias("component"))
    return found


def ranked(df: DataFrame, keys: list[str], order: list[str], out: str, salts: int = 64) -> DataFrame:
    """Number the rows of each key 0..n-1, however many rows one key holds.

    ``order[0]`` is a long hash: its value modulo ``salts`` splits a key into
    parts that are sorted apart; the sizes of the earlier parts are then added.
    Null keys are keys like any other. ``df`` is read twice, so hand in a
    written, narrow table.
    """
    salted = df.withColumn("_part", F.pmod(F.col(order[0]), F.lit(salts)).cast("int"))
    by = [*keys, "_part"]
    within = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = salted.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select(
        *(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]
    return (
        salted.withColumn("_within", within)
        .join(parts, same)
        .select(*df.columns, (F.col("_before") + F.col("_within")).alias(out))
    )


def indexed(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Number the rows 0..n-1 in a global order: sort, then add the sizes of earlier partitions."""
    placed = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = written(placed, "indexed").withColumn("_task", F.shiftright("_at", 33))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # one row per sorted partition
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.col("_at") - F.shiftleft(F.col("_task"), 33)
    return placed.join(F.broadcast(sizes), "_task").select(*df.columns, (F.col("_before") + within).alias(out))


def sample_per_class(df: DataFrame, cls: str, order: Column, size: int) -> DataFrame:
    """At most ``size`` rows of each class, spread by a hash: the least ``order`` of each hash bucket.

    A two-phase minimum picks them, so a class may hold all the rows. The picked
    keys are counted and, if few, broadcast, so that no row has to move.
    """
    hashed = df.withColumn("_order", order)
    hashed = hashed.withColumn("_bucket", F.pmod(F.xxhash64("_order"), F.lit(size)).cast("int"))
    least = written(hashed.groupBy(cls, "_bucket").agg(F.min("_order").alias("_order")), "least")
    if least.count() <= FEW_SAMPLES:
        least = F.broadcast(least)
    return hashed.join(least, [cls, "_bucket", "_order"]).drop("_bucket")
