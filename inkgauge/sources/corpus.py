"""Reading, merging and writing corpora."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkgauge import schema
from inkgauge.session import spread
from inkgauge.sources.quoted_csv import scan_quoted_csv

# Texts hold quotes, line breaks and outer spaces, and must come back unchanged.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def scan_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_text_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """As ``scan_table``, spread over the cores for work that is heavy per row."""
    return spread(scan_table(spark, folder, name))


def scan_csv(
    spark: SparkSession, path: str, columns: T.StructType | str = schema.RAW_SCHEMA
) -> DataFrame:
    """CSV with a header and quoted line breaks.

    ``columns`` are found by their names in the header, in any order and among
    others, and cast to their types. Types are given, so no pass over the data is
    spent on guessing them; only the header is read ahead.

    Large files are read by many tasks (``sources.quoted_csv``), in two passes.
    """
    if isinstance(columns, str):
        columns = T.StructType.fromDDL(columns)
    # a missing value is null and a quoted empty one is an empty text: with the
    # default mark for null, which is the empty string, both would be null
    options = {**CSV_OPTIONS, "multiLine": "true", "nullValue": "\0"}
    header = spark.read.options(**options).csv(path).columns
    return scan_quoted_csv(spark, path, columns, header, options)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_cleaned(df: DataFrame, path: str) -> None:
    """Text, label and id of the cleaned corpus as CSV."""
    write_csv(df.select(*schema.RAW_COLS), path)


def write_processed(df: DataFrame, path: str, partition_by_label: bool = False) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy("generated") if partition_by_label else writer).parquet(path)


def scan_processed(
    spark: SparkSession, path: str, numeric: list[str] = schema.NUMERIC_COLS
) -> DataFrame:
    """The columns models need of a processed table; nothing else is read from disk."""
    return spark.read.parquet(path).select("id", *numeric, "embedding", "generated")


def subset_path(path: str) -> str:
    """``data.csv`` -> ``data_subset.csv``."""
    stem, dot, ext = path.rstrip("/").rpartition(".")
    if not dot or "/" in ext:
        stem, dot, ext = path.rstrip("/"), "", ""
    return f"{stem}_subset{dot}{ext}"


def load_before_after(
    spark: SparkSession, before_csv: str, after_parquet: str, subset: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The cleaned corpus and the processed table; with ``subset`` their ``_subset`` copies."""
    if subset:
        before_csv, after_parquet = subset_path(before_csv), subset_path(after_parquet)
    return (
        scan_csv(spark, before_csv, schema.CLEANED_SCHEMA),
        spark.read.parquet(after_parquet),
    )


def stage_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of the table before and after processing, as two rows."""
    return reduce(
        DataFrame.unionByName,
        (
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), "n")
            for stage, df in (("before", before), ("after", after))
        ),
    )


@dataclass(frozen=True)
class Corpus:
    """A raw corpus: which columns hold text and label, and a key unique per row.

    Without a key column a row is known by its content: a hash of text, label and,
    among rows that are equal in both, a running number. No key depends on how the
    rows are stored or partitioned; giving one saves a shuffle of the texts.
    """

    name: str
    df: DataFrame
    text: str = "text"
    label: str = "generated"
    key: str | None = None


def harmonize_schema(corpus: Corpus) -> DataFrame:
    """(text, generated, row_key): renamed, label narrowed, all other columns dropped.

    A label written "0.0" or "1.0" is read as the number it is.
    """
    label = F.col(corpus.label)
    if isinstance(corpus.df.schema[corpus.label].dataType, T.StringType):
        label = label.cast("double")
    key = F.col(corpus.key) if corpus.key else F.lit(None)
    rows = corpus.df.select(
        F.col(corpus.text).cast("string").alias("text"),
        label.cast("tinyint").alias("generated"),
        key.cast("bigint").alias("row_key"),
    )
    if corpus.key:
        return rows
    rows = rows.withColumn("_content", F.sha2(F.concat_ws(":", "generated", "text"), 256))
    nth = F.row_number().over(Window.partitionBy("_content").orderBy("generated"))
    return rows.withColumn("row_key", F.xxhash64("_content", "text", nth)).drop("_content")


def merge_corpora(corpora: list[Corpus]) -> DataFrame:
    """UNION ALL in the given order.

    (source_pos, row_key) identifies a row; ordering by it is the order of ingest.
    """
    parts = (
        harmonize_schema(c).withColumns({"source": F.lit(c.name), "source_pos": F.lit(i)})
        for i, c in enumerate(corpora)
    )
    return reduce(DataFrame.unionByName, parts)
