"""Corpus pipeline: stages that filter, deduplicate, mix and pack the documents table.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns rows that are written and read again as the next one's docs. All stages
but the last return the columns of documents, whatever columns there are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkgauge.llm.frames import table, written
from inkgauge.llm.language_id import keep_identified, learn_dictionaries
from inkgauge.llm.mixing import mix_sources
from inkgauge.llm.ngram_join import ngram_jaccard_join
from inkgauge.llm.packing import pack_best_fit
from inkgauge.llm.quality import keep_good, learn_quality
from inkgauge.llm.queries import fold

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language cannot be told: without letters, or with a narrow margin."""
    learned = docs.where(fold("doc_id", 4) != 2)
    return keep_identified(docs, learn_dictionaries(learned, "text", "lang", "doc_id"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that score below 0.3; labels come from the labels table."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    return keep_good(docs, learn_quality(docs, labels, "doc_id", "text", "quality", ("n_chars",)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of near copies (5 words, 0.8).

    Of repeated rows of one id one stays. Rows without an id go with their group,
    or stay if it has no id.
    """
    found = ngram_jaccard_join(docs, width=5, percent=80)
    kept = found.where("component_id <=> doc_id").select(F.col("doc_id").alias("kept")).distinct()
    docs = docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept"]), "left_semi")
    nth = f"_nth_{uuid.uuid4().hex}"
    copies = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    return docs.withColumn(nth, F.row_number().over(copies)).where((F.col(nth) == 1) | F.col("doc_id").isNull()).drop(nth)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that the sources take their target shares of words."""
    copies = mix_sources(docs).groupBy(F.col("doc_id").alias("id")).agg(F.max("copies").alias("copies"))
    joined = docs.alias("d").join(copies.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.id")))
    nth = f"_nth_{uuid.uuid4().hex}"
    return joined.select("d.*", F.explode(F.array_repeat(F.lit(0), F.col("c.copies").cast("int"))).alias(nth)).drop(nth)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the token ids of all documents into sequences of 2048."""
    return pack_best_fit(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]
ORACLE_SQL: str | None = None  # SQL cannot express the classifiers and the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
