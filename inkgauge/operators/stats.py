"""Descriptive statistics of a corpus, each as one small result table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkgauge import schema
from inkgauge.functions import text as X
from inkgauge.session import written

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
STAT_COLS = ["count", "nulls", "mean", "std", "min", "q25", "q50", "q75", "max"]


FEW_GROUPS = 10_000  # brackets of so many groups are broadcast; the result is the same beyond


def _unpivoted(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
            for c in cols
        )
    )
    return df.select(*by, F.inline(pairs))


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    by: list[str],
    probs: dict[str, float],
    accuracy: int = 10_000,
) -> DataFrame:
    """Linearly interpolated quantiles per (group, column), exact at any size.

    Spark's exact ``percentile`` gathers all distinct values of a group in one
    task. Here an approximate sketch first brackets each quantile (its rank error
    is bounded, so the bracket surely holds it); then values inside the bracket
    are counted one by one and the ones below only in total. What is sorted in
    one task is a share of about 6/accuracy of the distinct values.
    """
    long = _unpivoted(df, cols, by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    keys = [*by, "column"]
    margin = 3.0 / accuracy
    lows = [max(0.0, p - margin) for p in probs.values()]
    highs = [min(1.0, p + margin) for p in probs.values()]
    sketch = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.percentile_approx("value", lows + highs, accuracy).alias("marks"),
    )
    # in a small group a margin is less than one rank: take all of it
    few = F.col("n") <= 2 * accuracy
    brackets = sketch.select(
        *keys,
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("q"),
                        ((F.col("n") - 1) * F.lit(p)).alias("rank"),
                        F.when(few | F.lit(lows[i] == 0.0), F.col("least"))
                        .otherwise(F.col("marks")[i])
                        .alias("lo"),
                        F.when(few | F.lit(highs[i] == 1.0), F.col("most"))
                        .otherwise(F.col("marks")[len(probs) + i])
                        .alias("hi"),
                    )
                    for i, (name, p) in enumerate(probs.items())
                )
            )
        ),
    )
    # One row per group and column. Few of them are broadcast, so values are dropped
    # or merged in the scan stage and only bracket contents are shuffled.
    named = {k: f"_{i}" for i, k in enumerate(keys)}
    entries = brackets.groupBy(*(F.col(k).alias(n) for k, n in named.items())).agg(
        F.collect_list(F.struct("q", "rank", "lo", "hi")).alias("ranges"), F.max("hi").alias("most")
    )
    entries = written(entries, "brackets")
    if entries.count() <= FEW_GROUPS:
        entries = F.broadcast(entries)
    here = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()))
    counted = (
        long.join(entries, here & (F.col("value") <= F.col("most")))
        .select(*keys, "value", F.inline("ranges"))
        .where(F.col("value") <= F.col("hi"))
        .withColumn("value", F.when(F.col("value") >= F.col("lo"), F.col("value")))
        .groupBy(*keys, "q", "rank", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(
        Window.partitionBy(*keys, "q").orderBy(F.col("value").asc_nulls_first())
    )
    lower = F.floor("rank")
    return (
        counted.withColumn("upto", upto)
        .groupBy(*keys, "q", "rank")
        .agg(
            F.min(F.when(F.col("upto") > lower, F.col("value"))).alias("a"),
            F.min(F.when(F.col("upto") > F.ceil("rank"), F.col("value"))).alias("b"),
            F.max(F.when(F.col("value").isNull(), F.col("upto"))).alias("below"),
        )
        .withColumn(
            "a",
            F.when(
                F.col("below") > lower, F.raise_error(F.lit("quantile lies outside its bracket"))
            ).otherwise(F.col("a")),
        )
        .select(
            *keys,
            "q",
            (F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - lower)).alias("value"),
        )
    )


def describe(
    df: DataFrame, cols: list[str], by: str | list[str] | None = None, approx: bool = False
) -> DataFrame:
    """Per group and column: count, nulls, mean, sample std, min, quartiles, max.

    Text columns have no mean, std or quartiles; min and max are reported in
    ``min_text`` and ``max_text`` when there is a text column. NaN is a missing
    value in every measure: it counts among the nulls.
    """
    by = [by] if isinstance(by, str) else list(by or [])
    texts = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in cols if c not in texts]
    null_num, null_text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def measures(c: str) -> list[Column]:
        v, is_text = F.col(c), c in texts
        x = F.lit(None).cast("double")
        if not is_text:
            x = F.when(~F.isnan(v.cast("double")), v.cast("double"))
            v = F.when(x.isNotNull(), v)
        return [
            F.count(v).alias("count"),
            F.count_if(v.isNull()).alias("nulls"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            (F.min(v) if is_text else null_text).alias("min_text"),
            (F.max(v) if is_text else null_text).alias("max_text"),
            (
                F.percentile_approx(x, list(QUARTILES.values()), 10_000)
                if approx and not is_text
                else F.lit(None).cast("array<double>")
            ).alias("quartiles"),
        ]

    # one pass over the table for everything but the exact quartiles
    summary = df.groupBy(*by).agg(*(F.struct(*measures(c)).alias(f"_{c}") for c in cols))
    rows = F.array(
        *(F.struct(F.lit(c).alias("column"), F.col(f"_{c}").alias("m")) for c in cols)
    )
    summary = summary.select(*by, F.inline(rows)).select(*by, "column", "m.*")
    if approx or not numbers:
        quarts = {q: F.try_element_at("quartiles", F.lit(i + 1)) for i, q in enumerate(QUARTILES)}
        result = summary.withColumns(quarts)
    else:
        q = exact_quantiles(df, numbers, by, QUARTILES)
        wide = q.groupBy(*by, "column").agg(
            *(F.max(F.when(F.col("q") == name, F.col("value"))).alias(name) for name in QUARTILES)
        )
        same = [summary[k].eqNullSafe(wide[k]) for k in [*by, "column"]]
        result = summary.join(wide, same, "left").select(
            *(summary[c] for c in summary.columns), *(wide[name] for name in QUARTILES)
        )
    extra = ["min_text", "max_text"] if texts else []
    return result.select(*by, "column", *STAT_COLS, *extra)


def label_distribution(df: DataFrame, label: str = "generated") -> DataFrame:
    """Share of every label in percent, rounded to two places."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("label", F.round(F.col("n") * 100.0 / total, 2).alias("percentage"))


def class_counts(df: DataFrame, label: str = "generated") -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def length_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """How many texts have each number of space words; the reports below start here."""
    return (
        df.where(F.col(text).isNotNull())
        .groupBy(X.ws_word_count(text).alias("length"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def text_length_histogram(df: DataFrame, bins: int = 50, text: str = "text") -> DataFrame:
    """Equal-width histogram of text lengths; empty bins are listed with 0.

    All texts of one length fall into a single bin (the first), as there is no range.
    """
    lengths = length_counts(df, text)
    span = lengths.agg(F.min("length").alias("lo"), F.max("length").alias("hi"))
    extent = span.select(F.struct("lo", "hi")).scalar()
    lo, hi = extent["lo"], extent["hi"]
    # integer arithmetic keeps values on a bin edge in the right-hand bin
    place = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(
            F.floor((F.col("length") - lo) * F.lit(bins) / (hi - lo)).cast("int"), F.lit(bins - 1)
        )
    )
    counts = lengths.groupBy(place.alias("bin")).agg(F.sum("n").alias("n"))
    frame = span.where(F.col("lo").isNotNull()).select(
        "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def text_length_kde(df: DataFrame, grid: int = 200, text: str = "text") -> DataFrame:
    """Gaussian kernel density of text lengths on ``grid`` points from min to max.

    Bandwidth by Scott's rule. The work is (distinct lengths x grid), whatever the
    number of texts. No density where all lengths are equal.
    """
    lengths = length_counts(df, text)
    weight, x = F.col("n"), F.col("length").cast("double")
    moments = lengths.agg(
        F.sum("n").alias("total"),
        F.min("length").alias("lo"),
        F.max("length").alias("hi"),
        (F.sum(x * weight) / F.sum("n")).alias("mean"),
    )
    mean = moments.select("mean").scalar()
    spread_sq = lengths.agg(F.sum(weight * (x - mean) * (x - mean))).scalar()
    shape = moments.select(
        F.struct(
            "total",
            "lo",
            "hi",
            (
                F.sqrt(F.try_divide(spread_sq, F.col("total") - 1))
                * F.pow(F.col("total").cast("double"), F.lit(-0.2))
            ).alias("bandwidth"),
        )
    ).scalar()
    step = (shape["hi"] - shape["lo"]) / F.lit(float(grid - 1))
    z = (F.col("x") - F.col("length")) / shape["bandwidth"]
    norm = shape["total"] * shape["bandwidth"] * F.sqrt(2 * F.pi())
    return (
        lengths.where(shape["bandwidth"] > 0)
        .select("length", "n", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
        .withColumn("x", shape["lo"] + F.col("point") * step)
        .groupBy("point", "x")
        .agg((F.sum(weight * F.exp(-0.5 * z * z))).alias("mass"))
        .select("point", "x", (F.col("mass") / norm).alias("density"))
    )


def length_cutoff_counts(
    df: DataFrame,
    min_len: int = schema.MIN_WORDS,
    max_len: int = schema.MAX_WORDS,
    text: str = "text",
) -> DataFrame:
    """Rows below, inside (ends included) and above the two cut-offs, as three rows."""
    n = X.ws_word_count(text)
    zone = F.when(n < min_len, "below").when(n > max_len, "above").otherwise("inside")
    counts = (
        df.where(F.col(text).isNotNull())
        .select(zone.alias("zone"))
        .agg(*(F.count_if(F.col("zone") == z).alias(z) for z in ("below", "inside", "above")))
    )
    return counts.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(z).alias("zone"), F.col(z).alias("n"))
                    for z in ("below", "inside", "above")
                )
            )
        )
    )
