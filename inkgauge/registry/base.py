"""Named queries with, where SQL can express the result, the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkgauge.functions.vectors import assemble_features
from inkgauge.operators.splits import split_random
from inkgauge.plans.corpus import clean_corpus, process_cleaned
from inkgauge.session import scratch_path, ship_package, written
from inkgauge.sources.corpus import Corpus, scan_table, scan_text_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 8


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(c: str | Column, digits: int = DIGITS) -> Column:
    """Value as checked: double, rounded, no negative zero."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits) + F.lit(0.0)


# -- inputs shared by the queries ------------------------------------------------


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return scan_text_table(spark, sf, "documents")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, text, generated) of the documents that have a label."""
    labels = scan_table(spark, sf, "labels").select("doc_id", F.col("quality").alias("generated"))
    return scan_text_table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id")


def corpora(spark: SparkSession, sf: str) -> list[Corpus]:
    """Three corpora with different column names."""
    talk = scan_text_table(spark, sf, "conversations")
    turns = talk.agg(F.max("turn") + 1).scalar()
    talk = talk.select(
        (F.col("conv_id") * turns + F.col("turn")).alias("key"),
        F.col("text").alias("text_content"),
        (F.col("role") == "assistant").cast("int").alias("label"),
        "role",
    )
    items = scan_text_table(spark, sf, "benchmark").withColumn("generated", F.lit("0.0"))
    return [
        Corpus("documents", labelled(spark, sf), key="doc_id"),
        Corpus("conversations", talk, text="text_content", label="label", key="key"),
        Corpus("benchmark", items, key="item_id"),
    ]


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(id, features, label 0/1) of the embeddings table."""
    return scan_text_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
        (F.col("label") % 2).cast("double").alias("label"),
    )


def vector_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = written(split_random(vectors(spark, sf)), "split")
    return tuple(rows.where(F.col("split") == s).drop("split") for s in ("train", "val", "test"))


_CLEANED: dict[tuple[str, str], str] = {}
_PROCESSED: dict[tuple[str, str], str] = {}


def cleaned_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned corpus of the corpora; prepared once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CLEANED:
        path = scratch_path(spark, "cleaned")
        clean_corpus(corpora(spark, sf)).write.parquet(path)
        _CLEANED[key] = path
    return spark.read.parquet(_CLEANED[key])


def processed(spark: SparkSession, sf: str) -> DataFrame:
    """The processed table of the corpora; prepared once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PROCESSED:
        path = scratch_path(spark, "processed")
        process_cleaned(cleaned_corpus(spark, sf), path)
        _PROCESSED[key] = path
    return spark.read.parquet(_PROCESSED[key])


# -- SQL building blocks ---------------------------------------------------------

SQL_WORD = r"[\p{L}\p{N}_]+"
SQL_SPACE_WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"
SQL_REGEX_WORDS = f"regexp_extract_all(text, '{SQL_WORD}')"
SQL_LOWER_WORDS = f"regexp_extract_all(lower(text), '{SQL_WORD}')"
SQL_SENTENCES = r"list_filter(regexp_split_to_array(text, '[.!?]+'), lambda s: regexp_matches(s, '\S'))"
SQL_PARAGRAPHS = r"list_filter(regexp_split_to_array(text, '\n\s*\n'), lambda s: regexp_matches(s, '\S'))"
SQL_SYLLABLES = (
    "list_transform(lw, lambda w: greatest(1, len(regexp_extract_all(w, '[aeiouy]+'))"
    " - CASE WHEN regexp_matches(w, '[^aeiouyl]e$') THEN 1 ELSE 0 END))"
)

SQL_LABELLED = "SELECT doc_id, text, quality AS generated FROM documents JOIN labels USING (doc_id)"

SQL_MERGED = f"""
SELECT text, generated, doc_id AS row_key, 'documents' AS source, 0 AS source_pos FROM ({SQL_LABELLED})
UNION ALL
SELECT text, CASE WHEN role = 'assistant' THEN 1 ELSE 0 END, conv_id * (SELECT max(turn) + 1 FROM conversations) + turn, 'conversations', 1
FROM conversations
UNION ALL
SELECT text, 0, item_id, 'benchmark', 2 FROM benchmark
"""

SQL_CLEANED = f"""
SELECT text, generated, source, source_pos, row_key,
       row_number() OVER (ORDER BY md5(source_pos || ':' || row_key || ':42')) - 1 AS id
FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY source_pos, row_key) AS copy
  FROM ({SQL_MERGED}) WHERE len({SQL_SPACE_WORDS}) BETWEEN 100 AND 1000
) WHERE copy = 1
"""


def sql_chunks(source: str, keep: str, limit: int = 250, least: int = 100) -> str:
    return f"""
SELECT {keep}, i::INT AS chunk_idx,
       array_to_string(w[i * b + least(i, r) + 1 : i * b + least(i, r) + b + (i < r)::INT], ' ') AS text
FROM (
  SELECT {keep}, w, n, unnest(range(n)) AS i, len(w) // n AS b, len(w) % n AS r
  FROM (
    SELECT {keep}, w, greatest(1, ceil(len(w) / {limit}.0))::BIGINT AS n
    FROM (SELECT {keep}, {SQL_SPACE_WORDS} AS w FROM ({source})) WHERE len(w) > 0
  )
) WHERE b + (i < r)::INT >= {least} OR n = 1
"""


def sql_measures(source: str, keep: str) -> str:
    """Counts behind all text features."""
    return f"""
SELECT *, list_sum({SQL_SYLLABLES}) AS syl, len(list_filter({SQL_SYLLABLES}, lambda s: s >= 3)) AS cx
FROM (
  SELECT {keep}, len({SQL_REGEX_WORDS}) AS wc, length(text) AS cc, len({SQL_SENTENCES}) AS sc,
         len({SQL_PARAGRAPHS}) AS pp, {SQL_LOWER_WORDS} AS lw,
         length(array_to_string({SQL_REGEX_WORDS}, '')) AS letters,
         len(regexp_extract_all(text, '[^\\p{{L}}\\p{{N}}_\\s]')) AS pc
  FROM ({source})
)
"""


SQL_FEATURES = {
    "word_count": "wc::INT",
    "character_count": "cc::INT",
    "lexical_diversity": "CASE WHEN len(lw) = 0 THEN 0.0 ELSE len(list_distinct(lw))::DOUBLE / len(lw) END",
    "avg_sentence_length": "CASE WHEN sc = 0 THEN 0.0 ELSE wc::DOUBLE / sc END",
    "avg_word_length": "CASE WHEN wc = 0 THEN 0.0 ELSE letters::DOUBLE / wc END",
    "flesch_reading_ease": "CASE WHEN wc = 0 THEN 0.0 ELSE 206.835::DOUBLE - 1.015::DOUBLE * wc / sc - 84.6::DOUBLE * syl / wc END",
    "gunning_fog_index": "CASE WHEN wc = 0 THEN 0.0 ELSE 0.4::DOUBLE * (wc::DOUBLE / sc + 100.0::DOUBLE * cx / wc) END",
    "punctuation_ratio": "CASE WHEN cc = 0 THEN 0.0 ELSE pc::DOUBLE / cc END",
}


def sql_features(source: str, keep: str, digits: int | None = DIGITS, cast: str = "DOUBLE") -> str:
    """The eight features. ``digits=None`` leaves them unrounded."""
    cols = []
    for name, expr in SQL_FEATURES.items():
        if name.endswith("_count"):
            cols.append(f"{expr} AS {name}")
        elif digits is None:
            cols.append(f"({expr})::DOUBLE AS {name}")
        else:
            cols.append(f"round((({expr})::{cast})::DOUBLE, {digits}) AS {name}")
    return f"SELECT {keep}, {', '.join(cols)} FROM ({sql_measures(source, keep)})"


SQL_CHUNK_FEATURES = sql_features(
    sql_chunks(SQL_CLEANED, "id, generated"), "id, generated, chunk_idx", digits=None
)


def sql_split(source: str) -> str:
    """Rows of ``source`` (with ``id``) plus rn, n and split: 80/10/10 by md5 order."""
    return f"""
SELECT *, CASE WHEN rn <= n - ceil(0.2::DOUBLE * n) THEN 'train'
               WHEN rn <= n - ceil(0.5::DOUBLE * ceil(0.2::DOUBLE * n)) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY md5(id || ':42')) AS rn, count(*) OVER () AS n FROM ({source}))
"""


SQL_VECTORS = "SELECT vec_id AS id, embedding::DOUBLE[] AS v, (label % 2)::DOUBLE AS label FROM embeddings"


def sql_lsh(tables: int, bits: int, asked: str = "test") -> str:
    """CTEs: parts, z (standardised), keys (id, t, key), pairs (q, c, t, sim, label)."""
    return f"""
WITH parts AS ({sql_split(SQL_VECTORS)}),
stat AS (
  SELECT pos, avg(x) AS m, stddev_pop(x) AS s
  FROM (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM parts WHERE split = 'train')
  GROUP BY pos
),
z AS (
  SELECT id, split, label, list(CASE WHEN s = 0 THEN 0 ELSE (x - m) / s END ORDER BY pos) AS z
  FROM (SELECT id, split, label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM parts)
  JOIN stat USING (pos) GROUP BY id, split, label
),
planes AS (
  SELECT t, b, list(CASE WHEN substr(md5('42|' || t || '|' || b || '|' || d), 1, 1) >= '8'
                         THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY d) AS p
  FROM (SELECT range AS t FROM range({tables})), (SELECT range AS b FROM range({bits})),
       (SELECT unnest(range(len(embedding))) AS d FROM (SELECT embedding FROM embeddings LIMIT 1))
  GROUP BY t, b
),
keys AS (
  SELECT id, split, t, string_agg(CASE WHEN list_dot_product(z, p) > 0 THEN '1' ELSE '0' END, '' ORDER BY b) AS key
  FROM z, planes GROUP BY id, split, t
),
pairs AS (
  SELECT q.id AS q, c.id AS c, q.t AS t, q.key AS key, zc.label AS label,
         round(list_cosine_similarity(zq.z, zc.z), 9) AS sim
  FROM keys q JOIN keys c ON q.t = c.t AND q.key = c.key AND q.split = '{asked}' AND c.split = 'train'
  JOIN z zq ON zq.id = q.id JOIN z zc ON zc.id = c.id
),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY sim DESC, c) AS rank
  FROM (SELECT q, c, any_value(sim) AS sim, any_value(label) AS label FROM pairs GROUP BY q, c)
),
votes AS (
  SELECT z.id AS query_id, z.label, avg(nearest.label) AS share
  FROM z LEFT JOIN nearest ON nearest.q = z.id AND rank <= 10 WHERE z.split = '{asked}' GROUP BY z.id, z.label
)
"""


__all__ = [name for name in dir() if not name.startswith("_")] + ["_PROCESSED"]
