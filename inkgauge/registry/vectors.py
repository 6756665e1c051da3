"""Queries on vectors, scaling, nearest neighbours."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions import vectors as V
from inkgauge.operators import evaluation as E
from inkgauge.operators.kmeans import nearest_centroid as assign_nearest
from inkgauge.operators.lsh import (
    HyperplaneLsh,
    LshModel,
    _vote_class,
    lsh_grid_search as search_grid,
    random_hyperplanes as draw_planes,
)
from inkgauge.operators.scaling import Standardizer
from inkgauge.plans.models import lsh_run as run_lsh
from inkgauge.registry.base import *  # noqa: F403
from inkgauge.session import scratch_path, written

TABLES, BITS, TOP_K = 16, 8, 10


def _exploded(df, features="features", digits=6):
    return df.select("id", F.posexplode(features).alias("dim", "value")).withColumn(
        "value", rounded("value", digits)
    )


@query(
    "assemble_features",
    f"""WITH f AS ({SQL_CHUNK_FEATURES})
    SELECT id, chunk_idx, generated::DOUBLE AS label, 392 AS dims,
    round(word_count::DOUBLE, 4) AS v384, round(character_count::DOUBLE, 4) AS v385,
    round(punctuation_ratio::FLOAT::DOUBLE, 6) AS v391 FROM f""",
)
def _(spark, sf):
    df = processed(spark, sf).withColumn("id", F.struct("id", "chunk_idx"))
    v = F.col("features")
    return V.assemble_features(df).select(
        F.col("id")["id"].alias("id"),
        F.col("id")["chunk_idx"].alias("chunk_idx"),
        "label",
        F.array_size(v).alias("dims"),
        rounded(v[384], 4).alias("v384"),
        rounded(v[385], 4).alias("v385"),
        rounded(v[391], 6).alias("v391"),
    )


@query(
    "standardize",
    f"""WITH x AS (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM ({SQL_VECTORS})),
    s AS (SELECT pos, avg(x) AS m, stddev_pop(x) AS s FROM x GROUP BY pos)
    SELECT id, (pos - 1)::INT AS dim, round(CASE WHEN s = 0 THEN 0 ELSE (x - m) / s END, 6) + 0.0::DOUBLE AS value
    FROM x JOIN s USING (pos)""",
)
def _(spark, sf):
    df = vectors(spark, sf)
    return _exploded(Standardizer().fit(df).transform(df))


@query(
    "cosine_similarity",
    """WITH f AS (SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS r FROM embeddings GROUP BY label)
    SELECT vec_id AS id, round(list_cosine_similarity(embedding::DOUBLE[], r), 8) AS similarity
    FROM embeddings JOIN f USING (label)""",
)
def _(spark, sf):
    # every vector against the first one of its label
    rows = scan_table(spark, sf, "embeddings")
    first = rows.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("first"))
    joined = rows.join(first, "label")
    return joined.select(
        F.col("vec_id").alias("id"),
        rounded(V.cosine_similarity(F.col("embedding"), F.col("first"))).alias("similarity"),
    )


@query(
    "random_hyperplanes",
    sql_lsh(4, 8)
    + """SELECT t::INT AS table_idx, b::INT AS bit, count(*) FILTER (list_dot_product(v, p) > 0) AS n_positive
    FROM planes, parts GROUP BY t, b""",
)
def _(spark, sf):
    # how many of the table's vectors lie on the positive side of each plane
    rows = vectors(spark, sf)
    dim = rows.select(F.max(F.array_size("features"))).first()[0]
    planes = draw_planes(4, 8, dim, kind="md5")
    model = LshModel(4, 8, planes, None, rows, rows)
    keys = rows.select(F.posexplode(model.keys_column()).alias("table_idx", "key"))
    bits = keys.select(
        "table_idx",
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(b).alias("bit"), F.expr(f"(key >> {7 - b}) & 1").alias("on"))
                    for b in range(8)
                )
            )
        ),
    )
    return bits.groupBy("table_idx", "bit").agg(F.sum("on").alias("n_positive"))


def _model(spark, sf, tables=TABLES, bits=BITS, planes="md5"):
    train, _, test = vector_parts(spark, sf)
    return HyperplaneLsh(tables, bits, planes=planes).fit(train), test


@query(
    "lsh_signature",
    sql_lsh(TABLES, BITS)
    + "SELECT id, (t)::INT AS table_idx, key AS hash_key FROM keys WHERE split = 'test'",
)
def _(spark, sf):
    model, test = _model(spark, sf)
    return model.signatures(test).select("id", F.posexplode("hash_keys").alias("table_idx", "hash_key"))


@query(
    "lsh_fit",
    sql_lsh(TABLES, BITS)
    + "SELECT (t)::INT AS table_idx, key AS hash_key, id FROM keys WHERE split = 'train'",
)
def _(spark, sf):
    return _model(spark, sf)[0].index()


@query(
    "lsh_candidates",
    sql_lsh(TABLES, BITS)
    + """SELECT q AS query_id, t::INT AS table_idx, key AS hash_key, count(*) AS n FROM pairs GROUP BY q, t, key""",
)
def _(spark, sf):
    model, test = _model(spark, sf)
    return model.bucket_hits(test)


@query(
    "candidate_union",
    sql_lsh(TABLES, BITS)
    + """, best AS (SELECT *, row_number() OVER (PARTITION BY q, t ORDER BY sim DESC, c) AS place FROM pairs)
    SELECT q AS query_id, c AS id, min(t)::INT AS table_idx, max(sim) AS similarity
    FROM best WHERE place <= 10 GROUP BY q, c""",
)
def _(spark, sf):
    model, test = _model(spark, sf)
    return model.table_neighbours(test, TOP_K).select(
        "query_id", "id", "table_idx", rounded("similarity", 9).alias("similarity")
    )


@query(
    "lsh_query",
    sql_lsh(TABLES, BITS)
    + """SELECT q AS query_id, rank::INT AS rank, c AS id, sim AS similarity, label
    FROM nearest WHERE rank <= 10""",
)
def _(spark, sf):
    model, test = _model(spark, sf)
    return model.query(test, TOP_K)


@query(
    "top_k_neighbors",
    sql_lsh(TABLES, BITS)
    + "SELECT q AS query_id, max(rank) AS n, min(CASE WHEN rank = 1 THEN c END) AS nearest FROM nearest WHERE rank <= 5 GROUP BY q",
)
def _(spark, sf):
    model, test = _model(spark, sf)
    found = model.query(test, 5)
    return found.groupBy("query_id").agg(
        F.max("rank").cast("bigint").alias("n"), F.min_by("id", "rank").alias("nearest")
    )


@query(
    "neighbor_votes",
    sql_lsh(TABLES, BITS)
    + "SELECT q AS query_id, c AS id, label AS vote FROM nearest WHERE rank <= 10",
)
def _(spark, sf):
    model, test = _model(spark, sf)
    return model.query(test, TOP_K).select("query_id", "id", F.col("label").alias("vote"))


@query(
    "neighbor_probability",
    sql_lsh(TABLES, BITS)
    + "SELECT query_id, round(share, 8) AS share FROM votes WHERE share IS NOT NULL",
)
def _(spark, sf):
    model, test = _model(spark, sf)
    met = model.votes(test, TOP_K).where(F.col("n") > 0)
    return met.select("query_id", rounded("share").alias("share"))


_PREDICT = "SELECT query_id, (CASE WHEN share IS NULL OR share >= 0.5 THEN 1 ELSE 0 END)::INT AS predicted FROM votes"
_PROBABILITY = "SELECT query_id, round(coalesce(share, 0.75::DOUBLE), 8) AS probability FROM votes"


@query("lsh_predict", sql_lsh(TABLES, BITS) + _PREDICT)
def _(spark, sf):
    model, test = _model(spark, sf)
    return model.predict(test, TOP_K)


@query("lsh_predict_probability", sql_lsh(TABLES, BITS) + _PROBABILITY)
def _(spark, sf):
    model, test = _model(spark, sf)
    return model.predict_probability(test, TOP_K).withColumn("probability", rounded("probability"))


@query("lsh_predict_probability_sparse", sql_lsh(32, 16) + _PROBABILITY)
def _(spark, sf):
    # long keys: most queries meet no bucket and get the default
    model, test = _model(spark, sf, 32, 16)
    return model.predict_probability(test, TOP_K).withColumn("probability", rounded("probability"))


@query(
    "lsh_evaluate",
    sql_lsh(TABLES, BITS)
    + """SELECT round(avg(hit::INT), 8) AS accuracy, count(*) FILTER (hit) AS correct, count(*) AS total
    FROM (SELECT (CASE WHEN share IS NULL OR share >= 0.5 THEN 1 ELSE 0 END) = label AS hit FROM votes)""",
)
def _(spark, sf):
    model, test = _model(spark, sf)
    return model.evaluate(test, TOP_K).withColumn("accuracy", rounded("accuracy"))


def _sql_grid(tables, bits, ks):
    """Every configuration on its own, from keys cut to size."""
    head = sql_lsh(max(tables), max(bits), "val")
    values = ", ".join(
        f"({i}, {t}, {b}, {k})"
        for i, (t, b, k) in enumerate((t, b, k) for t in tables for b in bits for k in ks)
    )
    return (
        head
        + f""", grid(grid_pos, num_hash_tables, num_hash_bits, top_k) AS (VALUES {values}),
    met AS (
      SELECT DISTINCT g.num_hash_tables AS nt, g.num_hash_bits AS nb, q.id AS q, c.id AS c
      FROM (SELECT DISTINCT num_hash_tables, num_hash_bits FROM grid) g
      JOIN keys q ON q.t < g.num_hash_tables AND q.split = 'val'
      JOIN keys c ON c.t = q.t AND c.split = 'train' AND c.key[1:g.num_hash_bits] = q.key[1:g.num_hash_bits]
    ),
    placed AS (
      SELECT nt, nb, q, zc.label, row_number() OVER (PARTITION BY nt, nb, q
        ORDER BY round(list_cosine_similarity(zq.z, zc.z), 9) DESC, c) AS rank
      FROM met JOIN z zq ON zq.id = q JOIN z zc ON zc.id = c
    ),
    shares AS (
      SELECT grid_pos, q, avg(label) AS share FROM grid JOIN placed
      ON nt = num_hash_tables AND nb = num_hash_bits AND rank <= top_k GROUP BY grid_pos, q
    ),
    results AS (
      SELECT g.grid_pos, g.num_hash_tables, g.num_hash_bits, g.top_k,
        avg(((CASE WHEN share IS NULL OR share >= 0.5 THEN 1 ELSE 0 END) = z.label)::INT) AS accuracy
      FROM grid g JOIN z ON z.split = 'val' LEFT JOIN shares s ON s.grid_pos = g.grid_pos AND s.q = z.id GROUP BY ALL
    )
    """
    )


_GRID_COLS = """SELECT grid_pos::INT AS grid_pos, num_hash_tables::INT AS num_hash_tables,
    num_hash_bits::INT AS num_hash_bits, top_k::INT AS top_k, round(accuracy, 8) AS accuracy FROM results"""


def _grid(spark, sf, tables, bits, ks):
    train, val, _ = vector_parts(spark, sf)
    _, results = search_grid(train, val, tables, bits, ks, planes="md5")
    return results.drop("correct", "total").withColumn("accuracy", rounded("accuracy"))


@query(
    "lsh_grid_search",
    _sql_grid(schema.TABLES_GRID, schema.BITS_GRID, schema.TOP_K_GRID) + _GRID_COLS,
)
def _(spark, sf):
    return _grid(spark, sf, schema.TABLES_GRID, schema.BITS_GRID, schema.TOP_K_GRID)


@query("hyperparameter_grid", _sql_grid([4, 8, 16], [6, 8], [5, 10]) + _GRID_COLS)
def _(spark, sf):
    # short keys, so that every configuration meets candidates
    return _grid(spark, sf, [4, 8, 16], [6, 8], [5, 10])


@query(
    "lsh_run",
    _sql_grid([8, 16], [6, 8], [5, 10])
    + """SELECT grid_pos::INT AS grid_pos, round(accuracy, 8) AS accuracy FROM results ORDER BY accuracy DESC, grid_pos LIMIT 1""",
)
def _(spark, sf):
    path = scratch_path(spark, "lsh")
    _, best, results, _ = run_lsh(vectors(spark, sf), path, [8, 16], [6, 8], [5, 10], "md5")
    chosen = results.where(F.col("grid_pos") == best["grid_pos"])
    return chosen.select("grid_pos", rounded("accuracy").alias("accuracy"))


_CELLS = [(a, p) for a in (0, 1) for p in (0, 1)]  # actual, predicted


@query(
    "lsh_run_full",
    _sql_grid(schema.TABLES_GRID, schema.BITS_GRID, schema.TOP_K_GRID)
    + f""", best AS (SELECT * FROM results ORDER BY round(accuracy, 12) DESC, grid_pos LIMIT 1),
    tested AS (
      SELECT DISTINCT q.id AS q, c.id AS c FROM best b
      JOIN keys q ON q.t < b.num_hash_tables AND q.split = 'test'
      JOIN keys c ON c.t = q.t AND c.split = 'train' AND c.key[1:b.num_hash_bits] = q.key[1:b.num_hash_bits]
    ),
    ranked AS (
      SELECT q, zc.label, row_number() OVER (PARTITION BY q
        ORDER BY round(list_cosine_similarity(zq.z, zc.z), 9) DESC, c) AS rank
      FROM tested JOIN z zq ON zq.id = q JOIN z zc ON zc.id = c
    ),
    tally AS (SELECT q, avg(label) AS share FROM ranked, best WHERE rank <= top_k GROUP BY q),
    scored AS (
      SELECT z.label, CASE WHEN share IS NULL OR share >= 0.5 THEN 1 ELSE 0 END AS predicted
      FROM z LEFT JOIN tally ON q = z.id WHERE z.split = 'test'
    )
    SELECT b.grid_pos::INT AS grid_pos, b.num_hash_tables::INT AS num_hash_tables, b.num_hash_bits::INT AS num_hash_bits,
      b.top_k::INT AS top_k, round(b.accuracy, 8) AS accuracy, t.* FROM best b,
      (SELECT round(avg((label = predicted)::INT), 8) AS test_accuracy, count(*) FILTER (label = predicted) AS correct, count(*) AS total,
       {", ".join(f"count(*) FILTER (label = {a} AND predicted = {p}) AS actual_{a}_predicted_{p}" for a, p in _CELLS)} FROM scored) t""",
)
def _(spark, sf):
    # the job's own grid, and every row of the test part
    _, best, results, predictions = run_lsh(vectors(spark, sf), scratch_path(spark, "lsh"), planes="md5")
    predictions = written(predictions.select("label", "predicted"), "predictions")
    chosen = results.where(F.col("grid_pos") == best["grid_pos"]).select(
        "grid_pos", "num_hash_tables", "num_hash_bits", "top_k", rounded("accuracy").alias("accuracy")
    )
    tested = E.accuracy(predictions).select(rounded("accuracy").alias("test_accuracy"), "correct", "total")
    cells = E.confusion_matrix(predictions).agg(
        *(
            F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n"))).alias(f"actual_{a}_predicted_{p}")
            for a, p in _CELLS
        )
    )
    return chosen.crossJoin(tested).crossJoin(cells)


@query("lsh_model_io", sql_lsh(TABLES, BITS) + _PROBABILITY)
def _(spark, sf):
    # predictions of a model that was saved and loaded
    model, test = _model(spark, sf)
    path = scratch_path(spark, "lsh_model")
    model.save(path)
    back = LshModel.load(spark, path)
    return back.predict_probability(test, TOP_K).withColumn("probability", rounded("probability"))


@query(
    "nearest_centroid",
    """WITH x AS (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
    c AS (SELECT label, list(m ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS m FROM x GROUP BY ALL) GROUP BY label)
    SELECT vec_id AS id, arg_min(c.label, round(list_dot_product(c, c) - 2 * list_dot_product(embedding::DOUBLE[], c), 9) + c.label * 1e-12)::INT AS cluster
    FROM embeddings e, c GROUP BY vec_id""",
)
def _(spark, sf):
    # centroids: the mean vector of each of the ten labels
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    rows = scan_table(spark, sf, "embeddings")
    means = (
        rows.groupBy("label")
        .agg(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))).alias("m"))
        .orderBy("label")
        .collect()
    )
    df = vectors(spark, sf)
    return assign_nearest(df, np.array([r["m"].toArray() for r in means])).select("id", "cluster")
