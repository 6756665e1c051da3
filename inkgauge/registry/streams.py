"""Queries that run as streams over files, checked by the SQL of the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.operators.kmeans import nearest_centroid
from inkgauge.registry.base import *  # noqa: F403
from inkgauge.session import scratch_path
from inkgauge.streaming.corpus import prepare_available, scan_stream, score_available, stream_features


def _arrivals(rows, key, path):
    """Append the rows to ``path`` in two parts; after each one, what has arrived is there."""
    for part in (0, 1):
        rows.where(F.abs(F.xxhash64(key)) % 2 == part).write.mode("append").parquet(path)
        yield part


SQL_TEXTS = f"""SELECT text, md5(text) AS doc FROM (SELECT DISTINCT text FROM documents
    WHERE len({SQL_SPACE_WORDS}) BETWEEN {schema.MIN_WORDS} AND {schema.MAX_WORDS})"""


@query("stream_features", sql_features(sql_chunks(SQL_TEXTS, "doc"), "doc, chunk_idx", cast="FLOAT"))
def _(spark, sf):
    rows = documents(spark, sf).select("doc_id", "text")
    source, out, checkpoint = (scratch_path(spark, name) for name in ("arrivals", "features", "progress"))
    for _ in _arrivals(rows, "doc_id", source):
        arrived = scan_stream(spark, source, rows.schema).withColumn("doc", F.md5("text"))
        found = prepare_available(stream_features(arrived), out, checkpoint)
    numbers = [F.col(c) if c.endswith("_count") else rounded(c).alias(c) for c in schema.NUMERIC_COLS]
    return found.select("doc", "chunk_idx", *numbers)


@query(
    "stream_scores",
    """SELECT vec_id AS id, (list_position(d, list_min(d)) - 1)::INT AS cluster FROM (
        SELECT v.vec_id, list(round(list_distance(v.embedding::DOUBLE[], c.embedding::DOUBLE[]) ** 2
            - list_dot_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9) ORDER BY c.vec_id) AS d
        FROM embeddings v, (SELECT * FROM embeddings ORDER BY vec_id LIMIT 5) c GROUP BY v.vec_id)""",
)
def _(spark, sf):
    # the nearest of five given vectors, for vectors that arrive in two parts
    rows = vectors(spark, sf).select("id", "features")
    centroids = [r["features"] for r in rows.orderBy("id").limit(5).collect()]
    source, out, checkpoint = (scratch_path(spark, name) for name in ("arrivals", "scores", "progress"))
    for _ in _arrivals(rows, "id", source):
        arrived = scan_stream(spark, source, rows.schema, files_per_batch=2)
        found = score_available(arrived, lambda b: nearest_centroid(b, centroids).select("id", "cluster"), out, checkpoint)
    return found
