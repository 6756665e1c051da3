"""Queries on statistics, splits, votes and quality measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions import text as X
from inkgauge.operators import evaluation as E
from inkgauge.operators import splits, stats
from inkgauge.plans.corpus import chunk_features, clean_corpus
from inkgauge.plans.statistics import corpus_statistics, long_form
from inkgauge.registry.base import *  # noqa: F403
from inkgauge.session import arrow_batches, written
from inkgauge.sources.corpus import scan_table


def _sql_describe(source, cols, by=""):
    key = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"""SELECT {key}'{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS nulls,
        round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c})::DOUBLE, 6) AS min,
        round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS q50,
        round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75, round(max({c})::DOUBLE, 6) AS max FROM {source}{group}"""
        for c in cols
    )


def _rounded_stats(df):
    return df.withColumns({c: rounded(c, 6) for c in stats.STAT_COLS[2:]})


@query(
    "describe_raw",
    f"""WITH s AS ({SQL_CLEANED})
    SELECT *, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM ({_sql_describe("s", ["generated", "id"])})
    UNION ALL SELECT 'text', count(text), count(*) - count(text), NULL, NULL, NULL, NULL, NULL, NULL, NULL, min(text), max(text) FROM s""",
)
def _(spark, sf):
    cleaned = written(clean_corpus(corpora(spark, sf)), "cleaned")
    return _rounded_stats(stats.describe(cleaned, schema.RAW_COLS))


@query(
    "describe_by_label",
    f"WITH s AS ({SQL_CHUNK_FEATURES}) {_sql_describe('s', schema.NUMERIC_COLS, 'generated')}",
)
def _(spark, sf):
    cleaned = written(clean_corpus(corpora(spark, sf)), "cleaned")
    df = written(chunk_features(cleaned).drop("text"), "features")
    df = df.withColumn("generated", F.col("generated").cast("int"))
    return _rounded_stats(stats.describe(df, schema.NUMERIC_COLS, by="generated"))


@query(
    "describe_orders",
    "WITH s AS (SELECT o_orderstatus AS status, o_totalprice::DOUBLE AS price FROM orders) "
    + _sql_describe("s", ["price"], "status"),
)
def _(spark, sf):
    df = scan_table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("double").alias("price")
    )
    return _rounded_stats(stats.describe(df, ["price"], by="status"))


@query(
    "describe_many_groups",
    "WITH s AS (SELECT o_custkey AS customer, o_totalprice::DOUBLE AS price FROM orders) "
    + _sql_describe("s", ["price"], "customer"),
)
def _(spark, sf):
    df = scan_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer"), F.col("o_totalprice").cast("double").alias("price")
    )
    return _rounded_stats(stats.describe(df, ["price"], by="customer"))


@query(
    "split_stratified_many",
    """SELECT id, CASE WHEN rn <= n - ceil(0.2::DOUBLE * n) THEN 'train'
      WHEN rn <= n - ceil(0.5::DOUBLE * ceil(0.2::DOUBLE * n)) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(o_orderkey || ':42')) AS rn,
          count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)""",
)
def _(spark, sf):
    rows = scan_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"))
    return splits.split_stratified(rows, "customer").select("id", "split")


@query(
    "split_stratified_groups",
    """WITH counts AS (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY ALL),
    classes AS (SELECT conv_id, string_agg(role || ':' || n, ',' ORDER BY role || ':' || n) AS cls FROM counts GROUP BY conv_id),
    ranked AS (SELECT conv_id, row_number() OVER (ORDER BY cls, md5(conv_id || ':42')) - 1 AS r FROM classes),
    dealt AS (SELECT *, r * 200000 // 1000000 AS q FROM ranked)
    SELECT conv_id, turn, role, CASE WHEN (r + 1) * 200000 // 1000000 = q THEN 'train'
      WHEN (q + 1) * 100000 // 200000 > q * 100000 // 200000 THEN 'test' ELSE 'val' END AS split
    FROM conversations JOIN dealt USING (conv_id)""",
)
def _(spark, sf):
    # the turns of a conversation stay together, as the chunks of a document must
    rows = scan_table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return splits.split_stratified(rows, "role", group_col="conv_id")


@query(
    "label_distribution",
    f"""SELECT generated AS label, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentage
    FROM ({SQL_LABELLED}) GROUP BY generated""",
)
def _(spark, sf):
    return stats.label_distribution(labelled(spark, sf))


@query("class_counts", f"SELECT generated AS label, count(*) AS n FROM ({SQL_LABELLED}) GROUP BY 1")
def _(spark, sf):
    return stats.class_counts(labelled(spark, sf))


_LENGTHS = f"SELECT len({SQL_SPACE_WORDS}) AS x FROM documents"


@query(
    "text_length_histogram",
    f"""WITH l AS ({_LENGTHS}), r AS (SELECT min(x) AS lo, max(x) AS hi FROM l)
    SELECT b.range::INT AS bin, round(lo + b.range * (hi - lo) / 50.0::DOUBLE, 8) AS bin_start,
           round(lo + (b.range + 1) * (hi - lo) / 50.0::DOUBLE, 8) AS bin_end, count(x) AS n
    FROM range(50) b, r LEFT JOIN l ON least(49, (x - lo) * 50 // (hi - lo)) = b.range
    GROUP BY b.range, lo, hi""",
)
def _(spark, sf):
    df = stats.text_length_histogram(documents(spark, sf))
    return df.withColumns({c: rounded(c) for c in ("bin_start", "bin_end")})


@query(
    "text_length_kde",
    f"""WITH l AS ({_LENGTHS}),
    r AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h FROM l),
    g AS (SELECT range AS point, lo + range * (hi - lo) / 199.0::DOUBLE AS gx, n, h FROM range(200), r)
    SELECT point::INT AS point, round(gx, 6) AS x,
           round(sum(exp(-0.5::DOUBLE * pow((gx - l.x) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 10) AS density
    FROM g, l GROUP BY point, gx""",
)
def _(spark, sf):
    df = stats.text_length_kde(documents(spark, sf))
    return df.select("point", rounded("x", 6).alias("x"), rounded("density", 10).alias("density"))


@query(
    "length_cutoff_counts",
    f"""SELECT z.zone, count(x) AS n FROM (VALUES ('below'), ('inside'), ('above')) z(zone)
    LEFT JOIN ({_LENGTHS}) ON CASE WHEN x < 100 THEN 'below' WHEN x > 1000 THEN 'above' ELSE 'inside' END = z.zone
    GROUP BY z.zone""",
)
def _(spark, sf):
    return stats.length_cutoff_counts(documents(spark, sf))


@query(
    "corpus_statistics",
    f"""WITH c AS ({SQL_CLEANED}), f AS ({SQL_CHUNK_FEATURES})
    SELECT 'labels_before' AS report, generated::INT AS label, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentage FROM c GROUP BY generated
    UNION ALL
    SELECT 'labels_after', generated::INT, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) FROM f GROUP BY generated""",
)
def _(spark, sf):
    cleaned = cleaned_corpus(spark, sf)
    tables = corpus_statistics(cleaned, processed(spark, sf))
    return (
        tables["labels_before"]
        .select(F.lit("labels_before").alias("report"), F.col("label").cast("int"), "percentage")
        .unionByName(
            tables["labels_after"].select(
                F.lit("labels_after").alias("report"), F.col("label").cast("int"), "percentage"
            )
        )
    )


@query("corpus_statistics_full")
def _(spark, sf):
    # all nine tables, cell by cell; SQL cannot express the two of the PCA
    cleaned = cleaned_corpus(spark, sf)
    cleaned = cleaned.withColumn("generated", F.col("generated").cast("int"))
    # a document has several chunks: the row key names the chunk
    after = processed(spark, sf).withColumn("generated", F.col("generated").cast("int"))
    after = after.withColumn("id", F.concat_ws(":", "id", "chunk_idx"))
    tables = corpus_statistics(cleaned, after)
    with arrow_batches(spark):  # as in pca_fit_full
        tables["pca_projection"] = written(tables["pca_projection"], "projection")
    cells = long_form(tables)
    digits = F.when(F.col("report") == "length_density", rounded("number", 10)).otherwise(rounded("number", 6))
    return cells.withColumn("number", digits)


# -- splits ------------------------------------------------------------------------


@query(
    "split_random", f"SELECT id, split FROM ({sql_split('SELECT vec_id AS id FROM embeddings')})"
)
def _(spark, sf):
    df = scan_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    return splits.split_random(df)


@query(
    "split_random_grouped",
    f"""SELECT conv_id, turn, split FROM conversations JOIN (SELECT id AS conv_id, split FROM
    ({sql_split("SELECT DISTINCT conv_id AS id FROM conversations")})) USING (conv_id)""",
)
def _(spark, sf):
    df = scan_table(spark, sf, "conversations").select("conv_id", "turn")
    return splits.split_random(df, group_col="conv_id")


@query(
    "split_stratified",
    """SELECT id, label, CASE WHEN rn <= n - ceil(0.2::DOUBLE * n) THEN 'train'
      WHEN rn <= n - ceil(0.5::DOUBLE * ceil(0.2::DOUBLE * n)) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT vec_id AS id, label, row_number() OVER (PARTITION BY label ORDER BY md5(vec_id || ':42')) AS rn,
          count(*) OVER (PARTITION BY label) AS n FROM embeddings)""",
)
def _(spark, sf):
    df = scan_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return splits.split_stratified(df, "label")


# -- votes and measures --------------------------------------------------------------


def _clustered(spark, sf):
    return scan_table(spark, sf, "labels").select(
        "doc_id", (F.col("doc_id") % 97).cast("int").alias("cluster"), F.col("quality").alias("label")
    )


def _scored(spark, sf):
    df = _clustered(spark, sf)
    return E.apply_cluster_map(df, E.cluster_majority(df))


_VOTES = """WITH c AS (SELECT doc_id, (doc_id % 97)::INT AS cluster, quality AS label FROM labels),
m AS (SELECT cluster, count(*) AS n, avg(label) AS share, CASE WHEN avg(label) >= 0.5 THEN 1 ELSE 0 END AS class FROM c GROUP BY cluster),
s AS (SELECT doc_id, c.cluster, label, class AS predicted FROM c JOIN m USING (cluster))
"""


@query("cluster_majority", _VOTES + "SELECT cluster, n, round(share, 8) AS share, class::INT AS class FROM m")
def _(spark, sf):
    return E.cluster_majority(_clustered(spark, sf)).withColumn("share", rounded("share"))


@query("apply_cluster_map", _VOTES + "SELECT doc_id, cluster, label, predicted::INT AS predicted FROM s")
def _(spark, sf):
    return _scored(spark, sf)


@query(
    "accuracy",
    _VOTES
    + """SELECT round(avg((label = predicted)::INT), 8) AS accuracy,
    count(*) FILTER (label = predicted) AS correct, count(*) AS total FROM s""",
)
def _(spark, sf):
    return E.accuracy(_scored(spark, sf)).withColumn("accuracy", rounded("accuracy"))


@query(
    "f1_positive",
    _VOTES
    + """SELECT round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + wrong, 0), 0), 8) AS f1 FROM (
    SELECT count(*) FILTER (label = 1 AND predicted = 1) AS tp, count(*) FILTER (label <> predicted) AS wrong FROM s)""",
)
def _(spark, sf):
    return E.f1_positive(_scored(spark, sf)).select(rounded("f1").alias("f1"))


@query(
    "confusion_matrix",
    _VOTES
    + """SELECT a.x::INT AS actual, p.x::INT AS predicted, count(s.doc_id) AS n
    FROM (VALUES (0), (1)) a(x) CROSS JOIN (VALUES (0), (1)) p(x)
    LEFT JOIN s ON s.label = a.x AND s.predicted = p.x GROUP BY a.x, p.x""",
)
def _(spark, sf):
    return E.confusion_matrix(_scored(spark, sf))


@query(
    "best_config",
    _VOTES
    + """SELECT cluster AS grid_pos, n, round(share, 8) AS accuracy FROM m ORDER BY share DESC, cluster LIMIT 1""",
)
def _(spark, sf):
    results = E.cluster_majority(_clustered(spark, sf)).select(
        F.col("cluster").alias("grid_pos"), "n", F.col("share").alias("accuracy")
    )
    return E.best_config(results).withColumn("accuracy", rounded("accuracy"))


@query("label_cast", "SELECT doc_id, quality::DOUBLE AS label FROM labels")
def _(spark, sf):
    from inkgauge.functions.vectors import label_cast

    return scan_table(spark, sf, "labels").select("doc_id", label_cast("quality").alias("label"))
