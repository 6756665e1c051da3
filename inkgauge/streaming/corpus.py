"""Corpora that arrive as files: the preparation and the scoring as streams.

Filters, chunks and measures are column expressions and the same on a stream. Copies
of a text are recognised by the digests of all texts seen before, which are state of
the query; the state is kept in RocksDB, so it may outgrow the executors' memory.
Files come in through a checkpoint and go out through Spark's file sink, whose log
names the files that count: a query that is stopped anywhere and started again neither
loses nor repeats a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkgauge import schema
from inkgauge.functions.text import compact_types, text_features
from inkgauge.operators.chunking import chunk_by_tokens
from inkgauge.operators.cleaning import filter_blank, filter_word_count
from inkgauge.session import ship_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def scan_stream(
    spark: SparkSession, path: str, columns: T.StructType, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Rows of the files at ``path``, and of those that appear there later."""
    ship_package(spark)
    reader = spark.readStream.schema(columns).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_features(
    rows: DataFrame,
    text: str = "text",
    min_words: int = schema.MIN_WORDS,
    max_words: int = schema.MAX_WORDS,
) -> DataFrame:
    """Filter, drop copies, chunk and measure the rows of a stream (or of a table).

    Of equal texts one row goes on: the one that arrives first, or any of those that
    arrive together.
    """
    kept = filter_word_count(filter_blank(rows, text), min_words, max_words, text)
    kept = kept.withColumn("_digest", F.sha2(F.col(text), 256)).dropDuplicates(["_digest"]).drop("_digest")
    return compact_types(text_features(chunk_by_tokens(kept)))


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def prepare_available(features: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Process all files there are, then stop; returns everything written so far.

    Call it again, with the same checkpoint, when there are more files.
    """
    spark = features.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKSDB)
    try:
        writer = features.writeStream.format("parquet").outputMode("append")
        _finish(writer.option("path", out_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    return spark.read.parquet(out_path)


def score_available(
    rows: DataFrame, score: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str
) -> DataFrame:
    """Score all files there are with a fitted model; returns everything scored so far.

    ``score`` gets each batch as a table, so it may join it with the model's own tables
    (votes of stored neighbours, clusters, a net). A batch overwrites its own folder,
    so one that is run again after a failure replaces what it had left.
    """

    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={number}")

    _finish(rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return rows.sparkSession.read.parquet(out_path).drop("batch")
