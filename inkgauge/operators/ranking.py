"""Exact ranks and exact cuts without sorting a table in one task.

Two tools, both deterministic and independent of how the rows are partitioned:

* ``hash_cutoffs`` finds the hash value that separates the first r rows from the
  rest. Rows are then kept or split by a comparison in the scan stage, and no
  row moves.
* ``dense_ids`` numbers rows 0..n-1 with a window per bucket plus the number of
  rows in all earlier buckets.

Only counters are gathered: at most 65,536 per class for a cut and one per bucket
(65,536 at most by hash) for numbering.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkgauge.functions.vectors import constant_array
from inkgauge.session import written

PREFIX = 4  # hex digits: 65,536 counters
FEW_CLASSES = 10_000  # broadcast up to this many; the result is the same beyond


def order_hash(*keys: str | Column, seed: int) -> Column:
    """Seeded pseudo-random order of rows: md5 of the key columns and the seed."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", *(p.cast("string") for p in parts), F.lit(str(seed))))


def hash_cutoffs(
    df: DataFrame,
    order: Column,
    take: dict[str, Callable[[Column], Column]],
    by: Column | None = None,
) -> DataFrame:
    """One row per class: its size and, per name in ``take``, the last hash to keep.

    ``take[name]`` maps the class size to the number of rows wanted; exactly that
    many rows satisfy ``order <= cutoff``, given that ``order`` is unique. Wanting
    no row gives the empty string, which is below every hash.

    First the rows are counted per hash prefix, which tells the prefix each cut
    falls into; then only the hashes of those prefixes are ranked (1 row in
    65,536 per cut).
    """
    by = F.lit(0) if by is None else by
    keys = df.select(by.alias("cls"), order.alias("h"))
    keys = keys.withColumn("prefix", F.substring("h", 1, PREFIX))
    per_class = Window.partitionBy("cls")
    counted = (
        keys.groupBy("cls", "prefix")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(per_class.orderBy("prefix")))
        .withColumn("total", F.sum("n").over(per_class))
    )
    wanted = F.array(
        *(
            F.struct(F.lit(name).alias("cut"), rule(F.col("total")).cast("bigint").alias("rank"))
            for name, rule in take.items()
        )
    )
    edges = (
        counted.select("cls", "prefix", "n", "upto", F.inline(wanted))
        .withColumn("rest", F.col("rank") - (F.col("upto") - F.col("n")))
        .where((F.col("rest") >= 1) & (F.col("rest") <= F.col("n")))
        .select("cls", "prefix", "cut", "rest")
    )
    # looked up by hash: many classes have cuts in all 65,536 prefixes
    prefixes = F.broadcast(edges.select("prefix").distinct())
    last = (
        keys.join(prefixes, "prefix", "left_semi")
        .join(edges, ["cls", "prefix"])
        .withColumn("place", F.row_number().over(Window.partitionBy("cls", "cut").orderBy("h")))
        .where(F.col("place") == F.col("rest"))
        .select("cls", "cut", "h", F.lit(None).cast("bigint").alias("total"))
    )
    # every class has a size but, where nothing is taken, no last hash
    sizes = counted.groupBy("cls").agg(F.max("total").alias("total"))
    return (
        last.unionByName(sizes, allowMissingColumns=True)
        .groupBy("cls")
        .agg(
            F.max("total").alias("total"),
            *(
                F.coalesce(F.max(F.when(F.col("cut") == name, F.col("h"))), F.lit("")).alias(name)
                for name in take
            ),
        )
    )


def with_cutoffs(df: DataFrame, cutoffs: DataFrame, by: Column, out: str) -> DataFrame:
    """Add to each row the cut-offs of its class as one struct column, for any number of classes.

    There is one row per class, so a class that holds most rows costs no more than
    others. Few classes are broadcast, which leaves the rows where they are; many
    are joined as Spark sees fit.
    """
    names = [c for c in cutoffs.columns if c != "cls"]
    cutoffs = written(cutoffs.select(F.col("cls").alias("_cls"), F.struct(*names).alias(out)), "cutoffs")
    if cutoffs.count() <= FEW_CLASSES:
        cutoffs = F.broadcast(cutoffs)
    return df.join(cutoffs, by == F.col("_cls")).drop("_cls")


def range_bucket(value: Column, bounds: list, fan: int) -> Column:
    """Number of bounds below ``value``: a coarse look-up, then one among ``fan`` fine bounds."""
    kind = "double" if isinstance(bounds[0], float) else "bigint"
    coarse = constant_array(bounds[fan - 1 :: fan], kind) if len(bounds) >= fan else F.array()
    block = F.array_size(F.filter(coarse, lambda b: b < value))
    fine = F.slice(constant_array(bounds, kind), block * fan + 1, F.lit(fan))
    return block * fan + F.array_size(F.filter(fine, lambda b: b < value))


def dense_ids(
    df: DataFrame,
    out: str,
    order_by: str | None = None,
    order_hash_hex: Column | None = None,
    buckets: int = 1024,
) -> DataFrame:
    """Number the rows 0..n-1 in the order of a unique numeric column or a unique hex hash.

    Hash order takes the first four hex digits as the bucket. For a numeric
    column the bucket bounds are approximate quantiles, read once by the driver
    (``buckets`` numbers), so clustered values still fill the buckets evenly.
    """
    if order_hash_hex is not None:
        key = order_hash_hex
        bucket = F.conv(F.substring(key, 1, PREFIX), 16, 10).cast("int")
    else:
        key = F.col(order_by)
        shares = constant_array([i / buckets for i in range(1, buckets)], "double")
        bounds = df.agg(F.percentile_approx(order_by, shares, 10_000)).first()[0] or []
        bounds = sorted(set(bounds))
        bucket = range_bucket(key, bounds, fan=32) if bounds else F.lit(0)
    keyed = df.withColumns({"_key": key, "_bucket": bucket})
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    # one row per bucket, so at most ``buckets`` rows: safe to sort and to broadcast
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key"))
    return (
        keyed.withColumn("_within", within)
        .join(F.broadcast(offsets), "_bucket")
        .select(*df.columns, (F.col("_before") + F.col("_within") - 1).cast("bigint").alias(out))
    )
