"""Queries on fitted models.

The ``_full`` queries fit the models in their real size; tests check them by
property. The others fit the same operators where SQL can compute the result: two
columns for principal components, nested groups for clusters, small
nets over whole vectors and one full-batch step for the perceptron.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.operators.kmeans import (
    KMeansClassifier,
    kmeans_assign,
    kmeans_fit,
    kmeans_fit_all,
)
from inkgauge.operators.kmeans import kmeans_grid_search as search_clusters
from inkgauge.operators.mlp import MlpClassifier, MlpModel, initial_parameters, place_in_epoch
from inkgauge.operators.pca import PcaReport
from inkgauge.operators.scaling import Standardizer
from inkgauge.operators.splits import split_random, split_stratified
from inkgauge.plans import models as P
from inkgauge.registry.base import *  # noqa: F403
from inkgauge.session import arrow_batches, scratch_path
from inkgauge.sources.corpus import scan_csv


def _model_rows(spark, sf):
    return P.model_rows(processed(spark, sf))


# -- principal components ------------------------------------------------------------


def _pca(spark, sf):
    rows = _model_rows(spark, sf)
    return rows, PcaReport(5).fit(rows)


@query("pca_fit_full")
def _(spark, sf):
    rows, model = _pca(spark, sf)
    scored = model.transform(rows).select("label", F.posexplode("pca").alias("component", "score"))
    means = scored.groupBy("label", "component").agg(
        F.count("*").alias("n"), rounded(F.avg("score"), 4).alias("mean_score")
    )
    with arrow_batches(spark):  # vectors of 10,000 rows at once take hundreds of MB beside the heap
        return written(means, "scores")


@query("pca_variance_table_full")
def _(spark, sf):
    return _pca(spark, sf)[1].variance_table(spark)


@query("pca_projection_full")
def _(spark, sf):
    rows, model = _pca(spark, sf)
    return model.projection(rows)


# -- clusters ------------------------------------------------------------------------


def _cluster_parts(spark, sf):
    rows = split_stratified(vectors(spark, sf), "label")
    return P.parts(Standardizer().fit(rows).transform(rows))


@query("kmeans_fit_assign_full")
def _(spark, sf):
    train, val, _ = _cluster_parts(spark, sf)
    return kmeans_assign(kmeans_fit(train, 10), val).select("id", "cluster")


@query("kmeans_grid_search_full")
def _(spark, sf):
    train, val, _ = _cluster_parts(spark, sf)
    return search_clusters(train, val)[1]


@query("cluster_classifier_full")
def _(spark, sf):
    train, _, test = _cluster_parts(spark, sf)
    model = KMeansClassifier(10).fit(train)
    return model.transform(test).select("id", "label", "cluster", "predicted")


@query("kmeans_model_io_full")
def _(spark, sf):
    train, _, test = _cluster_parts(spark, sf)
    path = scratch_path(spark, "clusters")
    KMeansClassifier(10).fit(train).save(path)
    back = KMeansClassifier.load(spark, path)
    return back.transform(test).select("id", "cluster", "predicted")


def _clustering(spark, sf):
    path = scratch_path(spark, "clustering")
    # scale on all rows and name clusters by the scored rows, so accuracy is purity
    P.clustering_run(vectors(spark, sf), path, fit_on="all", label_source="eval")
    return path


@query("clustering_report_full")
def _(spark, sf):
    return scan_csv(
        spark,
        _clustering(spark, sf) + "/report",
        "best_n_clusters int, validation_accuracy double, test_accuracy double, test_f1_score double",
    )


@query("write_predictions_full")
def _(spark, sf):
    return spark.read.parquet(_clustering(spark, sf) + "/predictions")


@query("kmeans_run_full")
def _(spark, sf):
    rows = _model_rows(spark, sf)
    _, _, report = P.clustering_run(rows)
    return report


# -- perceptron ------------------------------------------------------------------------


@query("mlp_forward_full")
def _(spark, sf):
    model = MlpModel(schema.LAYERS, initial_parameters(schema.LAYERS, schema.SEED))
    return model.transform(_model_rows(spark, sf)).select("id", "probability", "predicted")


def _trained(spark, sf, epochs=schema.EPOCHS):
    train, val, test = P.parts(split_random(_model_rows(spark, sf)))
    model = MlpClassifier(epochs=epochs).fit(train, val)
    return model, val, test


@query("mlp_train_full")
def _(spark, sf):
    return _trained(spark, sf)[0].history.select("epoch", "train_loss", "train_accuracy")


@query("training_history_full")
def _(spark, sf):
    return _trained(spark, sf)[0].history


@query("epoch_loss_full")
def _(spark, sf):
    return _trained(spark, sf, epochs=1)[0].history.select("train_loss", "train_accuracy")


@query("mlp_validate_full")
def _(spark, sf):
    model, val, _ = _trained(spark, sf)
    return model.validate(val)


@query("mlp_evaluate_full")
def _(spark, sf):
    model, _, test = _trained(spark, sf)
    return model.transform(test).select("id", "label", "predicted")


@query("mlp_run_full")
def _(spark, sf):
    _, _, matrix = P.mlp_run(_model_rows(spark, sf))
    return matrix


@query(
    "shuffle_rows",
    """SELECT epoch::INT AS epoch, vec_id AS id,
              row_number() OVER (PARTITION BY epoch ORDER BY md5(vec_id || ':' || epoch || ':42'))::INT AS place
       FROM embeddings, (SELECT unnest([1, 2]) AS epoch)""",
)
def _(spark, sf):
    # place of each row in the training order of two epochs, by the function training calls
    rows = vectors(spark, sf).select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("epoch"))
    placed = place_in_epoch(rows, F.col("epoch"), schema.SEED)
    return placed.select("epoch", "id", (F.col("place") + 1).cast("int").alias("place"))


# -- principal components of two columns -----------------------------------------------

# with two standardised columns of correlation r the components are their sum and
# difference; the stronger one is the sum where r is positive
SQL_TWO = f"""WITH f AS ({SQL_CHUNK_FEATURES}),
z AS (SELECT id * (max(chunk_idx) OVER () + 1) + chunk_idx AS id, generated::DOUBLE AS label,
        (word_count - avg(word_count) OVER ()) / stddev_pop(word_count) OVER () AS a,
        (character_count - avg(character_count) OVER ()) / stddev_pop(character_count) OVER () AS b,
        corr(word_count, character_count) OVER () AS r FROM f),
p AS (SELECT *, abs(CASE WHEN r >= 0 THEN a + b ELSE a - b END) / sqrt(2) AS pc1,
        abs(CASE WHEN r >= 0 THEN a - b ELSE a + b END) / sqrt(2) AS pc2 FROM z)"""


def _two_columns(spark, sf):
    rows = processed(spark, sf)
    chunks = rows.agg(F.max("chunk_idx").cast("bigint") + 1).scalar()
    return rows.select(
        (F.col("id") * chunks + F.col("chunk_idx")).alias("id"),
        F.array(F.col("word_count").cast("double"), F.col("character_count").cast("double")).alias("features"),
        F.col("generated").cast("double").alias("label"),
    )


def _two_components(spark, sf):
    rows = _two_columns(spark, sf)
    return rows, PcaReport(2).fit(rows)


@query(
    "pca_fit",
    SQL_TWO + """ SELECT label, count(*) AS n, round(avg(pc1), 5) AS mean_pc1, round(avg(pc2), 5) AS mean_pc2
    FROM p GROUP BY label""",
)
def _(spark, sf):
    rows, model = _two_components(spark, sf)
    sizes = [rounded(F.avg(F.abs(F.col("pca")[i])), 5).alias(f"mean_pc{i + 1}") for i in range(2)]
    return model.transform(rows).groupBy("label").agg(F.count("*").alias("n"), *sizes)


@query(
    "pca_variance_table",
    SQL_TWO + """ SELECT 'PC1' AS pc, round(50 * (1 + abs(any_value(r))), 2) AS explained_variance_pct,
      round(50 * (1 + abs(any_value(r))), 2) AS cumulative_variance_pct FROM z
    UNION ALL SELECT 'PC2', round(50 * (1 - abs(any_value(r))), 2), 100.0::DOUBLE FROM z""",
)
def _(spark, sf):
    return _two_components(spark, sf)[1].variance_table(spark)


@query("pca_projection", SQL_TWO + " SELECT id, round(pc1, 5) AS pc1, round(pc2, 5) AS pc2, label FROM p")
def _(spark, sf):
    rows, model = _two_components(spark, sf)
    sizes = (rounded(F.abs(c), 5).alias(c) for c in ("pc1", "pc2"))
    return model.projection(rows).select("id", *sizes, "label")


# -- principal components of all features by their properties ---------------------------

# Scores are the principal components' if and only if they are a rotation of the
# standardised features (lengths stay), uncorrelated, and of falling variance.
_Z = {c: f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()" for c in schema.NUMERIC_COLS}
SQL_PROPERTIES = f"""WITH f AS (SELECT id, chunk_idx, {', '.join(f'{c}::FLOAT::DOUBLE AS {c}' for c in _Z)} FROM ({SQL_CHUNK_FEATURES})), z AS (SELECT id * (max(chunk_idx) OVER () + 1) + chunk_idx AS id,
    {', '.join(f'{e} AS {c}' for c, e in _Z.items())} FROM f)
SELECT 'squared length' AS property, id AS key, round({' + '.join(f'{c}^2' for c in _Z)}, 5) AS value FROM z
UNION ALL SELECT 'covariance', 10 * i + j, 0.0::DOUBLE FROM range({len(_Z)}) a(i), range({len(_Z)}) b(j) WHERE i < j
UNION ALL SELECT 'variance falls', i, 1.0::DOUBLE FROM range(1, {len(_Z)}) t(i)
UNION ALL SELECT 'percent explained', 0, 100.0::DOUBLE"""


@query("pca_properties", SQL_PROPERTIES)
def _(spark, sf):
    rows = processed(spark, sf)
    chunks = rows.agg(F.max("chunk_idx").cast("bigint") + 1).scalar()
    n = len(schema.NUMERIC_COLS)
    rows = rows.select(
        (F.col("id") * chunks + F.col("chunk_idx")).alias("id"),
        F.array(*(F.col(c).cast("double") for c in schema.NUMERIC_COLS)).alias("features"),
    )
    model = PcaReport(n).fit(rows)
    scored = model.transform(rows)
    score = [F.col("pca")[i] for i in range(n)]
    lengths = scored.select("id", rounded(sum(x * x for x in score), 5).alias("value"))
    pairs = [(10 * i + j, F.covar_pop(score[i], score[j])) for i in range(n) for j in range(i + 1, n)]
    falls = [(i, (F.var_pop(score[i - 1]) >= F.var_pop(score[i])).cast("double")) for i in range(1, n)]

    def cells(name, found):
        return F.array(*(F.struct(F.lit(name).alias("property"), F.lit(k).cast("bigint").alias("key"), rounded(v, 5).alias("value")) for k, v in found))

    measured = scored.agg(
        F.concat(
            cells("covariance", pairs),
            cells("variance falls", falls),
            cells("percent explained", [(0, F.lit(100.0 * float(model.explained.sum())))]),
        ).alias("cells")
    )
    return lengths.select(F.lit("squared length").alias("property"), F.col("id").alias("key"), "value").unionAll(
        measured.select(F.inline("cells"))
    )


# -- clusters of nested groups --------------------------------------------------------

# labelled documents in two halves of two languages each, a language in two groups by
# the parity of its length: 2, 4 and 8 clusters are the three levels. Two columns
# scatter the rows of a group; a cluster is named by its least id.
SQL_LEVELS = """nested AS (SELECT doc_id AS id, quality AS label, (lang IN ('de', 'en'))::INT::VARCHAR AS g2, lang AS g4,
        lang || n_chars % 2 AS g8 FROM documents JOIN labels USING (doc_id)),
parts AS (SELECT *, CASE WHEN rn <= n - ceil(0.2::DOUBLE * n) THEN 'train'
      WHEN rn <= n - ceil(0.5::DOUBLE * ceil(0.2::DOUBLE * n)) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(id || ':42')) AS rn,
          count(*) OVER (PARTITION BY label) AS n FROM nested)),
leveled AS (SELECT id, split, label, k, CASE k WHEN 2 THEN g2 WHEN 4 THEN g4 ELSE g8 END AS g
    FROM parts, (SELECT unnest([2, 4, 8]) AS k)),
votes AS (SELECT k, g, (avg(label) >= 0.5)::INT AS predicted FROM leveled WHERE split = 'train' GROUP BY k, g),
scored AS (SELECT id, split, label, k, g, coalesce(predicted, 1) AS predicted FROM leveled LEFT JOIN votes USING (k, g)),
grid AS (SELECT k, avg((label = predicted)::INT)::DOUBLE AS accuracy, count_if(label = predicted)::BIGINT AS correct,
    count(*) AS total FROM scored WHERE split = 'val' GROUP BY k),
best AS (SELECT k FROM grid ORDER BY accuracy DESC, k LIMIT 1)"""
LANGS = ("de", "en", "es", "fr")
LEVELS = [2, 4, 8]
HALF, LANG, PARITY = 48, 16, 6  # columns of each level, so that it outweighs the next


def _nested(spark, sf):
    labels = scan_table(spark, sf, "labels").select("doc_id", "quality")
    rows = scan_table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(labels, "doc_id")
    half = F.array_repeat(F.col("lang").isin("de", "en").cast("double"), HALF)
    langs = [F.array_repeat((F.col("lang") == x).cast("double"), LANG) for x in LANGS]
    parity = F.array_repeat((F.col("n_chars") % 2).cast("double"), PARITY)
    scatter = F.array((F.col("n_chars") % 97) / 97.0, (F.col("doc_id") % 89) / 89.0)
    features = F.concat(half, *langs, parity, scatter)
    return rows.select(F.col("doc_id").alias("id"), features.alias("features"), F.col("quality").cast("double").alias("label"))


def _nested_parts(spark, sf):
    return P.parts(split_stratified(_nested(spark, sf), "label"))


def _named(df):
    """Clusters by their least id, so that numbering does not matter."""
    least = df.groupBy("cluster").agg(F.min("id").alias("least"))
    return df.join(F.broadcast(least), "cluster").drop("cluster").withColumnRenamed("least", "cluster")


def _votes(df):
    return _named(df).select("id", F.col("label").cast("int"), "cluster", "predicted")


SQL_VOTES = f"""WITH {SQL_LEVELS} SELECT id, label, min(id) OVER (PARTITION BY g) AS cluster, predicted
    FROM scored WHERE split = 'test' AND k = 4"""


@query(
    "kmeans_fit_assign",
    f"""WITH {SQL_LEVELS} SELECT k AS n_clusters, id, min(id) OVER (PARTITION BY k, g) AS cluster FROM leveled""",
)
def _(spark, sf):
    # three models fitted in the same passes
    rows = _nested(spark, sf)
    models = kmeans_fit_all(rows, LEVELS)
    named = (_named(kmeans_assign(models[k], rows).select("id", "cluster")).withColumn("n_clusters", F.lit(k)) for k in LEVELS)
    return reduce(DataFrame.unionByName, named)


@query("cluster_classifier", SQL_VOTES)
def _(spark, sf):
    train, _, test = _nested_parts(spark, sf)
    return _votes(KMeansClassifier(len(LANGS)).fit(train).transform(test))


@query("kmeans_model_io", SQL_VOTES)
def _(spark, sf):
    train, _, test = _nested_parts(spark, sf)
    path = scratch_path(spark, "clusters")
    KMeansClassifier(len(LANGS)).fit(train).save(path)
    return _votes(KMeansClassifier.load(spark, path).transform(test))


@query(
    "kmeans_grid_search",
    f"""WITH {SQL_LEVELS} SELECT (row_number() OVER (ORDER BY k) - 1)::INT AS grid_pos, k AS n_clusters, accuracy, correct, total
    FROM grid""",
)
def _(spark, sf):
    train, val, _ = _nested_parts(spark, sf)
    return search_clusters(train, val, LEVELS, label_source="train")[1]


SQL_REPORT = f"""WITH {SQL_LEVELS}, tested AS (SELECT * FROM scored JOIN best USING (k) WHERE split = 'test')
SELECT k AS best_n_clusters, round(accuracy, 8) AS validation_accuracy,
    round((SELECT avg((label = predicted)::INT)::DOUBLE FROM tested), 8) AS test_accuracy,
    round((SELECT coalesce(2.0::DOUBLE * count_if(label = 1 AND predicted = 1)
            / nullif(count_if(label = 1) + count_if(predicted = 1), 0), 0) FROM tested), 8) AS test_f1_score
FROM grid JOIN best USING (k)"""


def _report(df):
    scores = ("validation_accuracy", "test_accuracy", "test_f1_score")
    return df.select("best_n_clusters", *(rounded(c).alias(c) for c in scores))


@query("kmeans_run", SQL_REPORT)
def _(spark, sf):
    return _report(P.clustering_run(_nested(spark, sf), grid=LEVELS)[2])


def _written_run(spark, sf):
    path = scratch_path(spark, "clustering")
    P.clustering_run(_nested(spark, sf), path, LEVELS)
    return path


@query("clustering_report", SQL_REPORT)
def _(spark, sf):
    columns = "best_n_clusters int, validation_accuracy double, test_accuracy double, test_f1_score double"
    return _report(scan_csv(spark, _written_run(spark, sf) + "/report", columns))


@query(
    "write_predictions",
    f"""WITH {SQL_LEVELS} SELECT id, label AS y_true, predicted AS y_pred, min(id) OVER (PARTITION BY g) AS cluster
    FROM scored JOIN best USING (k) WHERE split = 'test'""",
)
def _(spark, sf):
    found = spark.read.parquet(_written_run(spark, sf) + "/predictions")
    return _named(found).select("id", "y_true", "y_pred", "cluster")


# -- a small perceptron -----------------------------------------------------------------

# weights from the first hex digit of md5('42|i'), between -1 and 1
SQL_W = "(((strpos('0123456789abcdef', substr(md5('42|' || {i}), 1, 1)) - 1) - 7.5::DOUBLE) / 7.5)"


def _start(n):
    return np.array([(int(hashlib.md5(f"42|{i}".encode()).hexdigest()[0], 16) - 7.5) / 7.5 for i in range(n)])


def sql_w(i):
    return SQL_W.format(i=i)


DIMS = 64  # numbers in a vector of the embeddings table
SQL_DIMS = f"""vecs AS (SELECT id, label, split, v FROM ({sql_split(SQL_VECTORS)}))"""
# one output unit: p = s(w . v + c)
SQL_LINEAR = f"""WITH {SQL_DIMS},
net AS (SELECT list({sql_w('i')} ORDER BY i) AS w, {sql_w(DIMS)} AS c FROM range({DIMS}) AS t(i)),
start AS (SELECT *, 1 / (1 + exp(-(list_dot_product(v, w) + c))) AS p FROM vecs, net),
grad AS (SELECT pos, avg((p - label) * x) AS g FROM
    (SELECT p, label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM start WHERE split = 'train') GROUP BY pos),
step AS (SELECT list(net.w[pos] - {schema.LEARNING_RATE}::DOUBLE * g / (abs(g) + 1e-8) ORDER BY pos) AS w,
    any_value(net.c) - any_value({schema.LEARNING_RATE}::DOUBLE * gc / (abs(gc) + 1e-8)) AS c
    FROM grad, net, (SELECT avg(p - label) AS gc FROM start WHERE split = 'train')),
after AS (SELECT id, label, split, 1 / (1 + exp(-(list_dot_product(v, step.w) + step.c))) AS p FROM vecs, step)"""
SQL_LOSS = "round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 8)"
SQL_RIGHT = "round(avg(((p > 0.5)::INT = label)::INT)::DOUBLE, 8)"


def _one_step(spark, sf):
    """A net of one unit after one full-batch epoch from the given start."""
    train, val, test = P.parts(split_random(vectors(spark, sf)))
    trainer = MlpClassifier([DIMS, 1], epochs=1, batch_size=None, start=_start(DIMS + 1))
    return trainer.fit(train, val), val, test


def _rounded(df, *columns):
    return df.select(*(rounded(c).alias(c) if c in columns else F.col(c) for c in df.columns))


@query(
    "mlp_forward",
    f"""WITH {SQL_DIMS}, net AS (SELECT list({sql_w('2 * i')} ORDER BY i) AS w, list({sql_w('(2 * i + 1)')} ORDER BY i) AS u
        FROM range({DIMS}) AS t(i)),
    hidden AS (SELECT id, greatest(0, list_dot_product(v, w) + {sql_w(2 * DIMS)}) AS g,
        greatest(0, list_dot_product(v, u) + {sql_w(2 * DIMS + 1)}) AS h FROM vecs, net),
    p AS (SELECT id, 1 / (1 + exp(-(g * {sql_w(2 * DIMS + 2)} + h * {sql_w(2 * DIMS + 3)} + {sql_w(2 * DIMS + 4)}))) AS p FROM hidden)
    SELECT id, round(p, 8) AS probability, (p > 0.5)::INT AS predicted FROM p""",
)
def _(spark, sf):
    model = MlpModel([DIMS, 2, 1], _start(2 * DIMS + 5))
    return _rounded(model.transform(vectors(spark, sf)).select("id", "probability", "predicted"), "probability")


@query(
    "mlp_validate",
    SQL_LINEAR + f" SELECT {SQL_LOSS} AS loss, {SQL_RIGHT} AS accuracy, count(*) AS total FROM start WHERE split = 'val'",
)
def _(spark, sf):
    _, val, _ = P.parts(split_random(vectors(spark, sf)))
    return _rounded(MlpModel([DIMS, 1], _start(DIMS + 1)).validate(val), "loss", "accuracy")


@query("epoch_loss", SQL_LINEAR + f" SELECT {SQL_LOSS} AS train_loss, {SQL_RIGHT} AS train_accuracy FROM start WHERE split = 'train'")
def _(spark, sf):
    history = _one_step(spark, sf)[0].history
    return _rounded(history.select("train_loss", "train_accuracy"), "train_loss", "train_accuracy")


SQL_HISTORY = f"""{SQL_LINEAR} SELECT 1 AS epoch, t.*, v.* FROM
    (SELECT {SQL_LOSS} AS train_loss, {SQL_RIGHT} AS train_accuracy FROM start WHERE split = 'train') t,
    (SELECT {SQL_LOSS} AS val_loss, {SQL_RIGHT} AS val_accuracy FROM after WHERE split = 'val') v"""
MEASURED = ("train_loss", "train_accuracy", "val_loss", "val_accuracy")


@query("training_history", SQL_HISTORY)
def _(spark, sf):
    return _rounded(_one_step(spark, sf)[0].history, *MEASURED)


@query("mlp_train", SQL_LINEAR + " SELECT id, round(p, 8) AS probability FROM after")
def _(spark, sf):
    model = _one_step(spark, sf)[0]
    return _rounded(model.transform(vectors(spark, sf)).select("id", "probability"), "probability")


@query("mlp_evaluate", SQL_LINEAR + " SELECT id, label, (p > 0.5)::INT AS predicted FROM after WHERE split = 'test'")
def _(spark, sf):
    model, _, test = _one_step(spark, sf)
    return model.transform(test).select("id", "label", "predicted")


@query(
    "mlp_run",
    SQL_LINEAR
    + """, s AS (SELECT label, (p > 0.5)::INT AS predicted, id FROM after WHERE split = 'test')
    SELECT a.x::INT AS actual, p.x::INT AS predicted, count(s.id) AS n
    FROM (VALUES (0), (1)) a(x) CROSS JOIN (VALUES (0), (1)) p(x)
    LEFT JOIN s ON s.label = a.x AND s.predicted = p.x GROUP BY a.x, p.x""",
)
def _(spark, sf):
    net = {"layers": [DIMS, 1], "batch_size": None, "start": _start(DIMS + 1)}
    return P.mlp_run(vectors(spark, sf), epochs=1, **net)[2]
