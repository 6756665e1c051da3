"""Votes and quality measures. All take per-row predictions and return small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cluster_majority(
    df: DataFrame, cluster: str = "cluster", label: str = "label", threshold: float = 0.5
) -> DataFrame:
    """Class of every cluster that occurs: 1 where the mean label reaches the threshold."""
    share = F.avg(F.col(label).cast("double"))
    return df.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"),
        share.alias("share"),
        F.when(share >= threshold, 1).otherwise(0).alias("class"),
    )


MAX_BROADCAST_CLUSTERS = 1_000_000


def apply_cluster_map(
    df: DataFrame,
    mapping: DataFrame,
    cluster: str = "cluster",
    out: str = "predicted",
    n_clusters: int | None = None,
) -> DataFrame:
    """Look every row's cluster up in ``cluster_majority``; null for a cluster without class.

    The mapping has one row per cluster. Where the number of clusters is known and
    moderate it is broadcast, and rows stay where they are; else Spark decides by
    its size, with a shuffled join (split for hot clusters) as the other way.
    """
    classes = mapping.select(F.col("cluster").alias("_c"), F.col("class").alias(out))
    if n_clusters is not None and n_clusters <= MAX_BROADCAST_CLUSTERS:
        classes = F.broadcast(classes)
    return df.join(classes, F.col(cluster) == F.col("_c"), "left").drop("_c")


def _hit(label: str, predicted: str) -> Column:
    return (F.col(label).cast("double") == F.col(predicted).cast("double")).cast("double")


def accuracy(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    hit = _hit(label, predicted)
    return df.agg(
        F.avg(hit).alias("accuracy"),
        F.coalesce(F.sum(hit), F.lit(0.0)).cast("bigint").alias("correct"),
        F.count(F.lit(1)).alias("total"),
    )


def f1_positive(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """F1 of class 1; 0 when nothing is positive."""
    actual, guess = F.col(label).cast("int") == 1, F.col(predicted).cast("int") == 1
    tp = F.count_if(actual & guess)
    wrong = F.count_if(actual != guess)
    return df.agg(F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + wrong), F.lit(0.0)).alias("f1"))


def confusion_matrix(
    df: DataFrame, label: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """Counts of the four (actual, predicted) cells; an absent cell counts 0."""
    actual, guess = F.col(label).cast("int"), F.col(predicted).cast("int")
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    counts = df.agg(
        *(F.count_if((actual == a) & (guess == p)).alias(f"c{a}{p}") for a, p in cells)
    )
    rows = F.array(
        *(
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{a}{p}").alias("n"))
            for a, p in cells
        )
    )
    return counts.select(F.inline(rows))


def best_config(results: DataFrame, position: str = "grid_pos") -> DataFrame:
    """The row of highest accuracy; among equals the first in grid order."""
    return results.orderBy(F.col("accuracy").desc_nulls_last(), F.col(position)).limit(1)
