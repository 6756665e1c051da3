"""Queries on sources, cleaning, chunks and text measures."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions import text as X
from inkgauge.operators import cleaning
from inkgauge.operators.chunking import chunk_by_tokens
from inkgauge.operators.embedding import HashingEncoder, embed_text
from inkgauge.plans.corpus import chunk_features, clean_corpus, corpus_subset, prepare_corpus
from inkgauge.plans.increments import add_to_corpus, stored
from inkgauge.registry.base import *  # noqa: F403
from inkgauge.session import scratch_path, written
from inkgauge.sources import corpus as S

# -- sources and sinks -----------------------------------------------------------


@query(
    "scan_csv",
    f"SELECT doc_id, md5(text) AS text_md5, length(text)::INT AS chars, generated FROM ({SQL_LABELLED})",
)
def _(spark, sf):
    path = scratch_path(spark, "csv")
    S.write_csv(labelled(spark, sf).repartition(4, "doc_id"), path)
    df = S.scan_csv(spark, path, labelled(spark, sf).schema)
    return df.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("chars"), "generated")


@query(
    "scan_processed",
    "SELECT * EXCLUDE (chunk_idx), 384 AS dims FROM ("
    + sql_features(
        sql_chunks(SQL_CLEANED, "id, generated"), "id, generated, chunk_idx", 5, "FLOAT"
    )
    + ")",
)
def _(spark, sf):
    path = scratch_path(spark, "processed")
    S.write_processed(processed(spark, sf), path)
    df = S.scan_processed(spark, path)
    ratios = schema.NUMERIC_COLS[2:]
    return df.select(
        "id",
        F.col("generated").cast("int").alias("generated"),
        "word_count",
        "character_count",
        *(rounded(c, 5).alias(c) for c in ratios),
        F.array_size("embedding").alias("dims"),
    )


@query(
    "load_before_after",
    f"""SELECT 'before' AS stage, count(*) AS n FROM ({SQL_CLEANED})
    UNION ALL SELECT 'after', count(*) FROM ({sql_chunks(SQL_CLEANED, "id, generated")})""",
)
def _(spark, sf):
    path = scratch_path(spark, "before")
    S.write_cleaned(cleaned_corpus(spark, sf), path)
    after = scratch_path(spark, "after")
    S.write_processed(processed(spark, sf), after)
    return S.stage_counts(*S.load_before_after(spark, path, after))


@query(
    "write_cleaned", f"SELECT id, generated::INT AS generated, md5(text) AS text_md5 FROM ({SQL_CLEANED})"
)
def _(spark, sf):
    path = scratch_path(spark, "cleaned")
    S.write_cleaned(clean_corpus(corpora(spark, sf)), path)
    back = S.scan_csv(spark, path, schema.CLEANED_SCHEMA)
    return back.select(
        "id", F.col("generated").cast("int").alias("generated"), F.md5("text").alias("text_md5")
    )


@query(
    "write_processed",
    f"SELECT id, generated::BOOLEAN AS generated, chunk_idx, word_count FROM ({SQL_CHUNK_FEATURES})",
)
def _(spark, sf):
    path = scratch_path(spark, "by_label")
    S.write_processed(processed(spark, sf), path, partition_by_label=True)
    back = spark.read.parquet(path)
    return back.select("id", F.col("generated").cast("boolean").alias("generated"), "chunk_idx", "word_count")


# -- projections, filters, union -------------------------------------------------


@query(
    "harmonize_schema",
    """SELECT conv_id * (SELECT max(turn) + 1 FROM conversations) + turn AS row_key, text,
    CASE WHEN role = 'assistant' THEN 1 ELSE 0 END::INT AS generated FROM conversations""",
)
def _(spark, sf):
    df = S.harmonize_schema(corpora(spark, sf)[1])
    return df.select("row_key", "text", F.col("generated").cast("int").alias("generated"))


@query(
    "compact_types",
    sql_features(SQL_LABELLED, "doc_id, generated::BOOLEAN AS generated", None)
    .replace("SELECT doc_id, generated::BOOLEAN AS generated, wc::INT", "SELECT doc_id, generated, wc::INT", 1)
    .replace("::DOUBLE AS", "::FLOAT::DOUBLE AS"),
)
def _(spark, sf):
    df = X.compact_types(X.text_features(labelled(spark, sf)))
    ratios = schema.NUMERIC_COLS[2:]
    return df.select(
        "doc_id",
        "generated",
        "word_count",
        "character_count",
        *(F.col(c).cast("double").alias(c) for c in ratios),
    )


@query("drop_text", f"SELECT doc_id, generated FROM ({SQL_LABELLED})")
def _(spark, sf):
    return labelled(spark, sf).drop("text")


@query(
    "filter_word_count",
    f"SELECT doc_id, len({SQL_SPACE_WORDS})::INT AS n_words FROM documents WHERE len({SQL_SPACE_WORDS}) BETWEEN 100 AND 1000",
)
def _(spark, sf):
    df = cleaning.filter_word_count(documents(spark, sf))
    return df.select("doc_id", X.ws_word_count("text").alias("n_words"))


@query(
    "filter_blank",
    r"""SELECT page_id, n FROM (SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS text,
    length(regexp_replace(html, '<[^>]*>', '', 'g'))::INT AS n FROM pages)
    WHERE text IS NOT NULL AND regexp_matches(text, '\S')""",
)
def _(spark, sf):
    # what is left of a page without its tags, if anything
    pages = S.scan_text_table(spark, sf, "pages")
    df = pages.select("page_id", F.regexp_replace("html", "<[^>]*>", "").alias("text"))
    return cleaning.filter_blank(df).select("page_id", F.length("text").alias("n"))


@query(
    "split_by_label",
    f"""SELECT generated, count(*) AS n, round(avg(len({SQL_SPACE_WORDS})), 8) AS mean_words
    FROM ({SQL_LABELLED}) GROUP BY generated""",
)
def _(spark, sf):
    return (
        labelled(spark, sf)
        .groupBy("generated")
        .agg(F.count("*").alias("n"), rounded(F.avg(X.ws_word_count("text"))).alias("mean_words"))
    )


@query(
    "merge_corpora",
    f"SELECT source, row_key, generated::INT AS generated, md5(text) AS text_md5 FROM ({SQL_MERGED})",
)
def _(spark, sf):
    return S.merge_corpora(corpora(spark, sf)).select(
        "source", "row_key", F.col("generated").cast("int").alias("generated"), F.md5("text").alias("text_md5")
    )


# -- cleaning --------------------------------------------------------------------


@query(
    "length_outliers",
    """SELECT a AS too_short, b AS too_long, a + b AS removed, round((a + b) * 100.0::DOUBLE / n, 8) AS pct_removed
    FROM (SELECT count(*) AS n, count(*) FILTER (strlen(text) < 100) AS a,
                 count(*) FILTER (strlen(text) > 5000) AS b FROM documents)""",
)
def _(spark, sf):
    df = cleaning.length_outliers(documents(spark, sf))
    return df.withColumn("pct_removed", rounded("pct_removed"))


@query(
    "distinct_texts",
    "SELECT min(doc_id) AS doc_id, md5(text) AS text_md5, count(*) > 0 AS kept FROM documents GROUP BY text",
)
def _(spark, sf):
    df = cleaning.distinct_texts(
        documents(spark, sf).select("doc_id", "text"), order_by="doc_id", unique_key="doc_id"
    )
    return df.select("doc_id", F.md5("text").alias("text_md5"), F.lit(True).alias("kept"))


@query(
    "distinct_texts_carried",
    f"""SELECT source, row_key, generated::INT AS generated FROM (
    SELECT *, row_number() OVER (PARTITION BY text ORDER BY source_pos, row_key) AS copy FROM ({SQL_MERGED})) WHERE copy = 1""",
)
def _(spark, sf):
    df = cleaning.distinct_texts(
        S.merge_corpora(corpora(spark, sf)), order_by=["source_pos", "row_key"]
    )
    return df.select("source", "row_key", F.col("generated").cast("int").alias("generated"))


@query(
    "add_unique_id",
    f"""SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS id FROM documents
    WHERE len({SQL_SPACE_WORDS}) BETWEEN 100 AND 1000""",
)
def _(spark, sf):
    kept = cleaning.filter_word_count(documents(spark, sf)).select("doc_id")
    return cleaning.add_unique_id(kept, order_by="doc_id")


@query(
    "add_unique_id_hashed",
    "SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42')) - 1 AS id FROM documents",
)
def _(spark, sf):
    order = cleaning.order_hash("doc_id", seed=schema.SEED)
    df = S.scan_table(spark, sf, "documents").select("doc_id")
    return cleaning.add_unique_id(df, order_hash_hex=order)


@query("sample_n", "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || ':42') LIMIT 150")
def _(spark, sf):
    df = S.scan_table(spark, sf, "documents").select("doc_id", "lang")
    return cleaning.sample_n(df, 150, key="doc_id")


# -- chunks ----------------------------------------------------------------------


@query(
    "chunk_by_tokens",
    f"SELECT doc_id, chunk_idx, text FROM ({sql_chunks('SELECT doc_id, text FROM documents', 'doc_id')})",
)
def _(spark, sf):
    df = chunk_by_tokens(documents(spark, sf).select("doc_id", "text"))
    return df.select("doc_id", "chunk_idx", "text")


@query(
    "chunk_by_tokens_dropping",
    "SELECT doc_id, chunk_idx, md5(text) AS text_md5 FROM ("
    + sql_chunks("SELECT doc_id, text FROM documents", "doc_id", 100, 80)
    + ")",
)
def _(spark, sf):
    df = chunk_by_tokens(documents(spark, sf).select("doc_id", "text"), 100, 80)
    return df.select("doc_id", "chunk_idx", F.md5("text").alias("text_md5"))


# -- scalar text functions ---------------------------------------------------------


def measure(name, expr, kind, sql):
    """One query per scalar function, over all documents."""
    value = f"round({sql}, 8)" if kind == "double" else f"({sql})::{kind}"
    source = sql_measures("SELECT doc_id, text FROM documents", "doc_id, text")

    @query(name, f"SELECT doc_id, {value} AS {name} FROM ({source})")
    def _(spark, sf):
        result = expr("text")
        result = rounded(result) if kind == "double" else result.cast(kind)
        return documents(spark, sf).select("doc_id", result.alias(name))


measure("ws_word_count", X.ws_word_count, "int", f"len({SQL_SPACE_WORDS})")
measure("word_count", X.word_count, "int", "wc")
measure("character_count", X.character_count, "int", "cc")
measure("byte_length", X.byte_length, "int", "strlen(text)")
measure("sentence_count", X.sentence_count, "int", "sc")
measure("words_per_sentence", X.words_per_sentence, "double", "CASE WHEN sc > 0 THEN wc::DOUBLE / sc END")
measure("paragraph_count", X.paragraph_count, "double", "pp::DOUBLE")
measure("words_per_paragraph", X.words_per_paragraph, "double", "CASE WHEN pp > 0 THEN wc::DOUBLE / pp END")
measure("syllable_count", X.syllable_count, "double", "coalesce(syl, 0)::DOUBLE")
measure("syllables_per_word", X.syllables_per_word, "double", "CASE WHEN wc > 0 THEN syl::DOUBLE / wc END")
measure("lexical_diversity", X.lexical_diversity, "double", SQL_FEATURES["lexical_diversity"])
measure("avg_sentence_length", X.avg_sentence_length, "double", SQL_FEATURES["avg_sentence_length"])
measure("avg_word_length", X.avg_word_length, "double", SQL_FEATURES["avg_word_length"])
measure("gunning_fog", X.gunning_fog, "double", SQL_FEATURES["gunning_fog_index"])
measure("flesch_reading_ease", X.flesch_reading_ease, "double", SQL_FEATURES["flesch_reading_ease"])
measure("punctuation_ratio", X.punctuation_ratio, "double", SQL_FEATURES["punctuation_ratio"])


def _rounded_features(df, *keys):
    ratios = schema.NUMERIC_COLS[2:]
    return df.select(*keys, "word_count", "character_count", *(rounded(c).alias(c) for c in ratios))


@query("text_features", sql_features("SELECT doc_id, text FROM documents", "doc_id"))
def _(spark, sf):
    return _rounded_features(X.text_features(documents(spark, sf).select("doc_id", "text")), "doc_id")


@query("with_features", sql_features(SQL_LABELLED, "doc_id, generated"))
def _(spark, sf):
    return _rounded_features(X.text_features(labelled(spark, sf)), "doc_id", "generated")


_STYLE = [
    "CASE WHEN sc > 0 THEN wc::DOUBLE / sc END",
    "CASE WHEN pp > 0 THEN wc::DOUBLE / pp END",
    "CASE WHEN wc > 0 THEN syl::DOUBLE / wc END",
    *(
        SQL_FEATURES[c]
        for c in (
            "lexical_diversity",
            "avg_sentence_length",
            "avg_word_length",
            "flesch_reading_ease",
            "gunning_fog_index",
        )
    ),
]


@query(
    "style_vector",
    "SELECT doc_id, "
    + ", ".join(f"round({e}, 8) AS style_{i}" for i, e in enumerate(_STYLE))
    + f" FROM ({sql_measures('SELECT doc_id, text FROM documents', 'doc_id')})",
)
def _(spark, sf):
    df = X.style_vector(documents(spark, sf).select("doc_id", "text"))
    return df.select("doc_id", *(rounded(F.col("style")[i]).alias(f"style_{i}") for i in range(8)))


# -- embedding and composites ------------------------------------------------------


@query(
    "embed_text",
    f"""WITH w AS (SELECT doc_id, md5(unnest({SQL_LOWER_WORDS})) AS h FROM documents),
    cells AS (SELECT doc_id, ('0x' || substr(h, 1, 8))::BIGINT % 384 AS dim,
              sum(CASE WHEN substr(h, 9, 1) >= '8' THEN 1 ELSE -1 END)::DOUBLE AS v FROM w GROUP BY ALL)
    SELECT doc_id, dim::INT AS dim, round((v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE, 6) AS value
    FROM cells WHERE v <> 0""",
)
def _(spark, sf):
    df = embed_text(documents(spark, sf).select("doc_id", "text"), HashingEncoder(384))
    cells = df.select("doc_id", F.posexplode("embedding").alias("dim", "value"))
    return cells.where(F.col("value") != 0).select("doc_id", "dim", rounded("value", 6).alias("value"))


@query(
    "prepare_corpus",
    "SELECT *, 384 AS dims, 1.0::DOUBLE AS norm FROM ("
    + sql_features(sql_chunks(SQL_CLEANED, "id, generated"), "id, generated, chunk_idx", 5, "FLOAT")
    + ")",
)
def _(spark, sf):
    # the whole job: clean, write the CSV copy, chunk, measure, embed, write and read back
    path = scratch_path(spark, "processed")
    df = prepare_corpus(corpora(spark, sf), path, cleaned_path=scratch_path(spark, "merged.csv"))
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    return df.select(
        "id",
        F.col("generated").cast("int").alias("generated"),
        F.col("chunk_idx").cast("bigint").cast("int").alias("chunk_idx"),
        "word_count",
        "character_count",
        *(rounded(c, 5).alias(c) for c in schema.NUMERIC_COLS[2:]),
        F.array_size("embedding").alias("dims"),
        rounded(length, 4).alias("norm"),
    )


SQL_ADDED = f"""
SELECT text, generated, row_number() OVER (ORDER BY part, md5(source_pos || ':' || row_key || ':42')) - 1 AS id
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY part, source_pos, row_key) AS copy
      FROM (SELECT *, row_key % 2 AS part FROM ({SQL_MERGED})) WHERE len({SQL_SPACE_WORDS}) BETWEEN 100 AND 1000)
WHERE copy = 1
"""


@query(
    "add_to_corpus",
    sql_features(sql_chunks(SQL_ADDED, "id, generated"), "id, generated, chunk_idx", 5, "FLOAT"),
)
def _(spark, sf):
    # the rows arrive in two parts: even keys, then odd keys
    store = scratch_path(spark, "store")
    for part in (0, 1):
        add_to_corpus([replace(c, df=c.df.where(F.col(c.key) % 2 == part)) for c in corpora(spark, sf)], store)
    return stored(spark, store, "processed").select(
        "id",
        F.col("generated").cast("int").alias("generated"),
        F.col("chunk_idx").cast("int").alias("chunk_idx"),
        "word_count",
        "character_count",
        *(rounded(c, 5).alias(c) for c in schema.NUMERIC_COLS[2:]),
    )


@query(
    "prepare_corpus_chunks",
    sql_features(sql_chunks(SQL_CLEANED, "id, generated"), "id, generated, chunk_idx, text").replace(
        "SELECT id, generated, chunk_idx, text, wc", "SELECT id, generated, chunk_idx, md5(text) AS text_md5, wc", 1
    ),
)
def _(spark, sf):
    cleaned = written(clean_corpus(corpora(spark, sf)), "cleaned")
    df = chunk_features(cleaned).withColumns(
        {"generated": F.col("generated").cast("int"), "text_md5": F.md5("text")}
    )
    return _rounded_features(df, "id", "generated", "chunk_idx", "text_md5")


@query(
    "prepare_corpus_small",
    f"""SELECT source, row_key, row_number() OVER (ORDER BY md5(source_pos || ':' || row_key || ':42')) - 1 AS id
    FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY source_pos, row_key) AS copy
      FROM (SELECT * FROM ({SQL_MERGED}) ORDER BY md5(source_pos || ':' || row_key || ':42') LIMIT 100)
      WHERE len({SQL_SPACE_WORDS}) BETWEEN 100 AND 1000) WHERE copy = 1""",
)
def _(spark, sf):
    # the feature is the small mode: 100 rows drawn from the whole merged corpus
    return clean_corpus(corpora(spark, sf), sample=100).select("source", "row_key", "id")


@query(
    "corpus_subset",
    f"SELECT id, generated::INT AS generated, md5(text) AS text_md5 FROM ({SQL_CLEANED}) ORDER BY md5(id || ':42') LIMIT 100",
)
def _(spark, sf):
    path = scratch_path(spark, "whole") + ".csv"
    S.write_cleaned(clean_corpus(corpora(spark, sf)), path)
    back = S.scan_csv(spark, corpus_subset(spark, path), schema.CLEANED_SCHEMA)
    return back.select(
        "id", F.col("generated").cast("int").alias("generated"), F.md5("text").alias("text_md5")
    )
