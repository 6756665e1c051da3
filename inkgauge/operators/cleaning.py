"""Filters, length report, exact sample, deduplication and numbering of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions import text as X
from inkgauge.operators.ranking import dense_ids, hash_cutoffs, order_hash


def filter_word_count(
    df: DataFrame,
    min_words: int = schema.MIN_WORDS,
    max_words: int = schema.MAX_WORDS,
    text: str = "text",
) -> DataFrame:
    """Keep rows of ``min_words`` to ``max_words`` space words, both included; null text goes.

    k words need at least 2k-1 characters, so the length test drops short texts
    before the scan for words. The range test is written so that the words are
    counted once; two comparisons would be two filters with a scan each.
    """
    long_enough = F.length(text) >= 2 * min_words - 1
    from_middle = F.abs(2 * X.ws_word_count(text) - (min_words + max_words))
    return df.where(long_enough & (from_middle <= max_words - min_words))


def filter_blank(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(X.has_content(text))


def length_outliers(
    df: DataFrame,
    min_len: int = schema.MIN_BYTES,
    max_len: int = schema.MAX_BYTES,
    text: str = "text",
) -> DataFrame:
    """Rows below ``min_len`` and above ``max_len`` bytes, their sum and its share in percent.

    The share is null for an empty table.
    """
    size = X.byte_length(text)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(size < min_len).alias("too_short"),
        F.count_if(size > max_len).alias("too_long"),
    )
    removed = F.col("too_short") + F.col("too_long")
    return counts.select(
        "too_short",
        "too_long",
        removed.alias("removed"),
        (F.try_divide(removed, F.col("total")) * 100.0).alias("pct_removed"),
    )


def sample_n(
    df: DataFrame,
    n: int,
    key: str | list[str],
    seed: int = schema.SEED,
    clamp: bool = False,
) -> DataFrame:
    """Exactly ``n`` rows without replacement, chosen by seeded hash of the unique ``key``.

    Asking for more rows than there are fails when the result is computed, or
    returns all of them with ``clamp``. Selection is a filter: no row is moved.
    """
    order = order_hash(*([key] if isinstance(key, str) else key), seed=seed)
    cutoffs = hash_cutoffs(df, order, {"last": lambda total: F.least(total, F.lit(n))})
    # an empty table has no class and so no row here, but a size all the same
    cutoffs = cutoffs.agg(F.coalesce(F.max("total"), F.lit(0)).alias("total"), F.max("last").alias("last"))
    cutoff = F.col("last")
    if not clamp:
        message = F.concat(
            F.lit(f"cannot sample {n} rows out of "), F.col("total").cast("string")
        )
        cutoff = F.when(F.col("total") >= n, cutoff).otherwise(F.raise_error(message))
    return df.where(order <= cutoffs.select(cutoff).scalar())


def distinct_texts(
    df: DataFrame,
    order_by: str | list[str],
    text: str = "text",
    unique_key: str | list[str] | None = None,
) -> DataFrame:
    """One row per text: the one that comes first by ``order_by``.

    Copies are collapsed on a digest before anything is shuffled, so a text that
    makes up a third of the corpus costs one row per task.

    With ``unique_key`` only (digest, order, key) is aggregated and the winning
    rows are then picked by key through a hash join: texts are shuffled once and
    never sorted, at the price of reading the input twice. Without it the winning
    row itself travels through the aggregation, which sorts whole rows.
    """
    order_by = [order_by] if isinstance(order_by, str) else order_by
    if unique_key:
        unique_key = [unique_key] if isinstance(unique_key, str) else unique_key
        keep = first_keys(df, order_by, text, unique_key)
        # keys are the small side: hashing them leaves the texts unsorted
        return df.join(keep.hint("shuffle_hash"), unique_key, "left_semi").select(df.columns)
    row = F.min_by(F.struct(*df.columns), F.struct(*order_by))
    digest = F.sha2(F.col(text), 256)
    return df.groupBy(digest.alias("digest")).agg(row.alias("row")).select("row.*")


def first_keys(df: DataFrame, order_by: list[str], text: str, unique_key: list[str]) -> DataFrame:
    """The keys of the rows that come first among equal texts; no text is moved."""
    # a plain minimum where it will do: it is aggregated by hash, without a sort
    if order_by == unique_key and len(unique_key) == 1:
        first = F.struct(F.min(unique_key[0]).alias(unique_key[0]))
    else:
        first = F.min_by(F.struct(*unique_key), F.struct(*order_by))
    digest = F.sha2(F.col(text), 256)
    return df.groupBy(digest.alias("digest")).agg(first.alias("first")).select("first.*")


def any_distinct_text(df: DataFrame, text: str = "text") -> DataFrame:
    """One arbitrary row per text; cheaper to write down, not reproducible."""
    return df.dropDuplicates([text])


def add_unique_id(
    df: DataFrame,
    order_by: str | None = None,
    column_name: str = "id",
    order_hash_hex: Column | None = None,
    buckets: int = 1024,
) -> DataFrame:
    """Dense id from 0, in the order of a unique numeric column or a unique hash.

    ``buckets`` bounds the tasks that number by value; take more than the
    session's shuffle partitions.
    """
    return dense_ids(df, column_name, order_by, order_hash_hex, buckets)
