"""Documents to chunks of nearly equal size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions import text as X


def chunk_by_tokens(
    df: DataFrame,
    token_limit: int = schema.TOKEN_LIMIT,
    min_tokens: int = schema.MIN_TOKENS,
    text: str = "text",
) -> DataFrame:
    """Split every document into the fewest chunks of at most ``token_limit`` space words.

    Sizes differ by one word at most, larger chunks first; words are joined by one
    space. Chunks under ``min_tokens`` are dropped unless the document has only
    one. All other columns are kept and ``chunk_idx`` is added. Blank documents
    yield nothing.

    The chunk texts are built next to the word list and only they are multiplied
    out, so a long document's words are not copied into each of its chunks.
    """
    words = F.col("_words")
    n_words = F.array_size(words)
    n_chunks = F.ceil(n_words / token_limit).cast("int")
    base = F.expr("array_size(_words) div _n")
    larger = n_words % F.col("_n")

    def chunk(i):
        size = (base + F.when(i < larger, 1).otherwise(0)).cast("int")
        start = (i * base + F.least(i, larger) + 1).cast("int")
        return F.struct(
            F.array_join(F.slice(words, start, size), " ").alias(text),
            i.cast("int").alias("chunk_idx"),
            size.alias("_size"),
        )

    chunks = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), chunk)
    # no row for blank or null text: there is nothing to unfold
    chunks = F.when(n_words > 0, chunks)
    kept = F.filter(chunks, lambda c: (c["_size"] >= min_tokens) | (F.col("_n") == 1))
    others = [c for c in df.columns if c != text]
    return (
        df.withColumn("_words", X.space_words(text))
        .withColumn("_n", n_chunks)
        .select(*others, F.inline(kept))
        .select(*df.columns, "chunk_idx")
    )
