"""Mixing sources to target weights by subset-sum budget fitting.

Each source has a target of words. Whole passes over the source come first; what
is left of the target is fitted with a subset of its documents. The subset is
planned on counts of documents per exact length: a share of each length in
proportion, then a bounded-knapsack dynamic programme for the remaining budget.
The planned number of documents of a length are those of the least seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge.llm.frames import indexed, ranked, written

WINDOW = 1 << 16  # largest budget that is left to the dynamic programme
WORD = r"[^\x20\x09-\x0D]+"


def bounded_subset(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take so that the sum comes as near to ``budget`` from below as can be.

    Reachable sums are bits of an integer; a count is split into powers of two.
    """
    reach, steps = 1, []
    mask = (1 << (budget + 1)) - 1
    for i, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        size = 1
        while count and length * size <= budget and not reach >> budget & 1:
            size = min(size, count)
            steps.append((i, size, reach))
            reach = (reach | reach << length * size) & mask
            count -= size
            size *= 2
    rest = reach.bit_length() - 1
    taken = [0] * len(lengths)
    for i, size, before in reversed(steps):
        if not before >> rest & 1:
            taken[i] += size
            rest -= lengths[i] * size
    return taken


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents to take of each length for a sum of ``budget`` words (all, if there are too few)."""
    order = np.lexsort((lengths,))
    lengths, counts = lengths[order].astype(object), counts[order].astype(object)
    usable = lengths > 0
    total = int((lengths * counts)[usable].sum())
    taken = np.zeros(len(lengths), object)
    if total <= budget:
        taken[usable] = counts[usable]
    elif budget > 0:
        core = max(0, budget - WINDOW // 2)  # what is spent in proportion
        taken[usable] = counts[usable] * core // total
        left = budget - int((lengths * taken).sum())
        # the largest lost fractions first, while too much is left for the programme
        lost = sorted(np.flatnonzero(usable), key=lambda i: (-(counts[i] * core % total), lengths[i]))
        for i in lost:
            if left <= WINDOW:
                break
            more = min(counts[i] - taken[i], 1, left // lengths[i])
            taken[i] += more
            left -= more * lengths[i]
        for i in reversed(range(len(lengths))):
            if left > WINDOW and usable[i]:
                more = min(counts[i] - taken[i], left // lengths[i])
                taken[i] += more
                left -= more * lengths[i]
        if left <= WINDOW:
            some = [i for i in lost if taken[i] < counts[i] and lengths[i] <= left]
            fit = bounded_subset([int(lengths[i]) for i in some], [int(counts[i] - taken[i]) for i in some], int(left))
            for i, n in zip(some, fit, strict=True):
                taken[i] += n
    out = np.zeros(len(lengths), np.int64)
    out[order] = taken.astype(np.int64)
    return out


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    budget = int(pdf["budget"].iloc[0])
    extra = fit_budget(pdf["size"].to_numpy(), pdf["n"].to_numpy(), budget)
    return pdf[["place", "size"]].assign(extra=extra)


def source_targets(
    rows: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int
) -> DataFrame:
    """(source, place, source_size, target): shares by weight, none above ``most`` times its size.

    The common level of the open sources rises until no further one is full; each
    round is one sum over the sources, of which the driver sees two numbers.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = indexed(sources, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = written(
        sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))), "sources"
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level = total * share[0] / share[1], 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * level
        held, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not open_weight:
            break
        raised = (budget - held) / open_weight
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("cap"), F.col("weight") * level)
    return sources.select("source", "place", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
    seed: int = 42,
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) per row of ``docs``.

    Sources in code-point order, null last, take the ``weights`` in turn; together
    they take ``share`` of all words, each at most ``most`` times its own. ``copies``
    says how often a row is taken and ``taken`` is size x copies. The draw depends
    on ids and seed alone, so reruns and retried tasks agree.

    Null and empty texts have size 0 and are never drawn beyond whole passes. Null
    sources are one source. Equal ids or lengths are told apart by the hash, then
    the id; repeated rows are rows of their own. A single source may hold all rows:
    what is gathered per source is one row per distinct length, and ranks within a
    length are salted. An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size")
    )
    rows = written(rows.withColumn("draw", F.xxhash64("id", F.lit(seed))), "sized")
    targets = written(source_targets(rows, weights, share, most), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("passes", whole.cast("bigint"))
    budget = F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("bigint")
    targets = targets.withColumn("budget", budget).withColumnRenamed("source", "name")
    same = F.col("source").eqNullSafe(F.col("name"))
    counts = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    plan = (
        counts.join(targets, same)
        .groupBy("place")
        .applyInPandas(_plan, "place bigint, size bigint, extra bigint")
        .where("extra > 0")
    )
    placed = ranked(rows, ["source", "size"], ["draw", "id"], "rank").join(targets, same)
    copies = F.col("passes") + (F.col("rank") < F.coalesce("extra", F.lit(0))).cast("bigint")
    return (
        placed.join(plan, ["place", "size"], "left")
        .withColumn("copies", copies)
        .select(
            F.col("id").alias(id_col),
            F.col("source").alias(source_col),
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )
