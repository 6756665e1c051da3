"""From raw corpora to the processed feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkgauge import schema
from inkgauge.functions.text import compact_types, text_features
from inkgauge.operators.chunking import chunk_by_tokens
from inkgauge.operators.cleaning import (
    add_unique_id,
    filter_word_count,
    first_keys,
    sample_n,
)
from inkgauge.operators.embedding import embed_text
from inkgauge.operators.ranking import order_hash
from inkgauge.session import arrow_batches, written
from inkgauge.sources.corpus import (
    Corpus,
    merge_corpora,
    scan_csv,
    subset_path,
    write_cleaned,
    write_csv,
    write_processed,
)


def clean_corpus(corpora: list[Corpus], sample: int | None = None) -> DataFrame:
    """Merge, sample (before filtering, so fewer rows survive), filter, drop copies, number."""
    df = merge_corpora(corpora)
    ingest = ["source_pos", "row_key"]
    if sample is not None:
        df = sample_n(df, sample, key=ingest)
    # counting words costs more than a copy of the rows that stay: they are read twice
    df = written(filter_word_count(df), "filtered")
    # narrow keys are deduplicated and numbered; the texts move once, to meet them
    keys = written(first_keys(df, ingest, "text", ingest), "keys")
    numbered = add_unique_id(keys, order_hash_hex=order_hash(*ingest, seed=schema.SEED))
    return df.join(numbered.hint("shuffle_hash"), ingest).select(*df.columns, "id")


def chunk_features(cleaned: DataFrame) -> DataFrame:
    """Chunks of the cleaned corpus with their text features."""
    return text_features(chunk_by_tokens(cleaned.select(*schema.RAW_COLS)))


def prepare_corpus(
    corpora: list[Corpus],
    processed_path: str,
    cleaned_path: str | None = None,
    sample: int | None = None,
    encoder=None,
    batch_size: int = schema.BATCH_SIZE,
) -> DataFrame:
    """The whole preparation. Returns the processed table as read back from ``processed_path``.

    The cleaned corpus is written once and feeds both the CSV copy and the chunks.
    The rows that pass the filter are written, too, and read twice: for the keys of the
    first copies, and for their texts.
    """
    cleaned = written(clean_corpus(corpora, sample), "cleaned")
    return process_cleaned(cleaned, processed_path, cleaned_path, encoder, batch_size)


def process_cleaned(
    cleaned: DataFrame,
    processed_path: str,
    cleaned_path: str | None = None,
    encoder=None,
    batch_size: int = schema.BATCH_SIZE,
) -> DataFrame:
    """The preparation from a written cleaned corpus on."""
    spark = cleaned.sparkSession
    if cleaned_path:
        write_cleaned(cleaned, cleaned_path)
    features = compact_types(chunk_features(cleaned))
    with arrow_batches(spark):
        write_processed(embed_text(features, encoder, batch_size), processed_path)
    return spark.read.parquet(processed_path)


def corpus_subset(
    spark: SparkSession, cleaned_csv: str, n: int = 100, seed: int = schema.SEED
) -> str:
    """Write ``n`` rows (all, if there are fewer) next to the input as ``<name>_subset``."""
    path = subset_path(cleaned_csv)
    df = scan_csv(spark, cleaned_csv, schema.CLEANED_SCHEMA)
    write_csv(sample_n(df, n, key="id", seed=seed, clamp=True), path)
    return path
