"""A prepared corpus that grows: each call adds what is new of some raw corpora.

The corpus is a folder with the tables ``cleaned`` (text, label, id), ``digests``
(digest, id) and ``processed`` (features and embeddings of the chunks), each in one
part per call, and ``log``, one row per part. A part counts once its row is in the
log, which is written last: a call that fails leaves nothing behind that counts, and
the next call overwrites it. One call at a time may write to a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions.text import compact_types
from inkgauge.operators.cleaning import add_unique_id, filter_word_count
from inkgauge.operators.embedding import embed_text
from inkgauge.operators.ranking import order_hash
from inkgauge.plans.corpus import chunk_features
from inkgauge.session import written
from inkgauge.sources.corpus import Corpus, merge_corpora

FEW_DIGESTS = 500_000  # some 50 MB in memory; more are joined by shuffle
TABLES = ("cleaned", "digests", "processed")


def _log(spark: SparkSession, store: str) -> tuple[int, int]:
    """Number of parts that count, and of texts in them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{store}/log")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return 0, 0
    log = spark.read.schema("part int, texts bigint").parquet(f"{store}/log/*")
    row = log.agg(F.count(F.lit(1)), F.coalesce(F.sum("texts"), F.lit(0))).first()
    return row[0], row[1]


def stored(spark: SparkSession, store: str, name: str) -> DataFrame:
    """All rows of one of the tables, of the parts that count."""
    parts, _ = _log(spark, store)
    if not parts:
        raise ValueError(f"nothing was added to {store} yet")
    return spark.read.parquet(*(f"{store}/{name}/{i}" for i in range(parts)))


def unknown_texts(keys: DataFrame, digests: DataFrame) -> DataFrame:
    """Rows of ``keys`` whose digest is not among ``digests``.

    What arrives is small beside what is stored: up to FEW_DIGESTS new digests are
    sent to where the stored ones are read, so that of these only the ones met again
    move. More are joined as Spark sees fit, with the same result.
    """
    if keys.count() <= FEW_DIGESTS:
        digests = digests.join(F.broadcast(keys.select("digest")), "digest", "left_semi")
    return keys.join(digests.select("digest"), "digest", "left_anti")


def add_to_corpus(
    corpora: list[Corpus],
    store: str,
    min_words: int = schema.MIN_WORDS,
    max_words: int = schema.MAX_WORDS,
    encoder=None,
    batch_size: int = schema.BATCH_SIZE,
) -> DataFrame:
    """Prepare the texts the corpus does not hold yet and add them; returns their chunks.

    Of equal texts the one added first stays; among those of one call the first by
    (corpus, key). Ids continue densely from the ids there are, so the texts of the
    corpus do not depend on how the rows were divided into calls. Texts move once, to
    meet their ids; of known texts no more than the digest moves.
    """
    spark = corpora[0].df.sparkSession
    part, texts = _log(spark, store)
    rows = filter_word_count(merge_corpora(corpora), min_words, max_words)
    key = ["source_pos", "row_key"]
    keys = rows.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min(F.struct(*key)).alias("first"))
    keys = written(keys.select("digest", "first.*"), "keys")
    if part:
        keys = written(unknown_texts(keys, stored(spark, store, "digests")), "unknown")
    numbered = add_unique_id(keys, order_hash_hex=order_hash(*key, seed=schema.SEED))
    numbered = numbered.withColumn("id", F.col("id") + F.lit(texts).cast("bigint"))

    def add(df: DataFrame, table: str) -> DataFrame:
        path = f"{store}/{table}/{part}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    digests = add(numbered, "digests")
    cleaned = add(rows.join(digests.hint("shuffle_hash"), key).select(*schema.RAW_COLS), "cleaned")
    processed = add(embed_text(compact_types(chunk_features(cleaned)), encoder, batch_size), "processed")
    added = digests.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("texts"))
    added.coalesce(1).write.mode("overwrite").parquet(f"{store}/log/{part}")
    return processed
