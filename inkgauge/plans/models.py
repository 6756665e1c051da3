"""The three model runs over a table of (id, features, label).

Rows need a unique ``id``: several chunks of a document share the document's id,
so ``model_rows`` derives one per chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.functions.vectors import assemble_features
from inkgauge.operators.evaluation import best_config, confusion_matrix
from inkgauge.operators.kmeans import (
    KMeansClassifier,
    clustering_report,
    kmeans_grid_search,
)
from inkgauge.operators.lsh import LshModel, best_lsh, lsh_grid_search
from inkgauge.operators.mlp import MlpClassifier, MlpModel
from inkgauge.operators.scaling import Standardizer
from inkgauge.operators.splits import split_random, split_stratified
from inkgauge.session import written
from inkgauge.sources.corpus import write_csv


def model_rows(processed: DataFrame) -> DataFrame:
    """(id, features, label) of a processed table, one id per chunk.

    Ids are packed with the table's own largest chunk number, so they are unique for
    any number of chunks; an id beyond 64 bits is an error.
    """
    chunks = processed.agg(F.max("chunk_idx").cast("bigint") + 1).scalar()
    unique = F.col("id").cast("bigint") * chunks + F.col("chunk_idx")
    return assemble_features(processed.withColumn("id", unique))


def parts(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows of a table with a ``split`` column."""
    return tuple(df.where(F.col("split") == name).drop("split") for name in ("train", "val", "test"))


def clustering_run(
    rows: DataFrame,
    out_dir: str | None = None,
    grid: list[int] = schema.CLUSTER_GRID,
    n_init: int = 10,
    fit_on: str = "train",
    label_source: str = "train",
    seed: int = schema.SEED,
) -> tuple[KMeansClassifier, DataFrame, DataFrame]:
    """Scale, split by label, search the grid, score the test rows.

    ``fit_on="all"`` scales with the statistics of all rows and ``label_source="eval"``
    names clusters by the rows being scored; the defaults use training rows only.
    Returns the best classifier, the scored test rows and the one-row report.
    """
    rows = written(split_stratified(rows, "label", seed=seed), "split")
    train = parts(rows)[0]
    scaler = Standardizer().fit(rows if fit_on == "all" else train)
    train, val, test = parts(scaler.transform(rows))
    fitted, results = kmeans_grid_search(train, val, grid, n_init, seed, label_source)
    best = fitted[best_config(results).first()["n_clusters"]]
    scored = best.transform(test).select(
        "id", F.col("label").cast("int"), "predicted", "cluster"
    )
    report = clustering_report(results, scored)
    if out_dir:
        out_dir = out_dir.rstrip("/")
        scored.select(
            "id", F.col("label").alias("y_true"), F.col("predicted").alias("y_pred"), "cluster"
        ).write.mode("overwrite").parquet(f"{out_dir}/predictions")
        best.save(f"{out_dir}/model", test if label_source == "eval" else None)
        write_csv(report, f"{out_dir}/report")
    return best, scored, report


def lsh_run(
    rows: DataFrame,
    model_path: str | None = None,
    tables: list[int] = schema.TABLES_GRID,
    bits: list[int] = schema.BITS_GRID,
    top_k: list[int] = schema.TOP_K_GRID,
    planes: str = "gaussian",
    seed: int = schema.SEED,
) -> tuple[LshModel, dict, DataFrame, DataFrame]:
    """Split, search the grid, evaluate the best configuration on the test rows.

    Returns the best model, its configuration, the grid results and the test predictions.
    """
    train, val, test = parts(written(split_random(rows, seed=seed), "split"))
    largest, results = lsh_grid_search(train, val, tables, bits, top_k, seed, planes)
    results = written(results, "grid")
    model, best = best_lsh(largest, results)
    if model_path:
        model.save(model_path)
    return model, best, results, model.predictions(test, best["top_k"])


def mlp_run(
    rows: DataFrame,
    epochs: int = schema.EPOCHS,
    standardize: bool = False,
    seed: int = schema.SEED,
    shards: int = schema.SHARDS,
    **net,
) -> tuple[MlpModel, DataFrame, DataFrame]:
    """Split, train and score the test rows: the model, the scored rows, the confusion matrix.

    ``net`` has further settings of ``MlpClassifier``.
    """
    train, val, test = parts(written(split_random(rows, seed=seed), "split"))
    trainer = MlpClassifier(epochs=epochs, standardize=standardize, seed=seed, shards=shards, **net)
    model = trainer.fit(train, val)
    scored = model.transform(test).select("id", "label", "probability", "predicted")
    return model, scored, confusion_matrix(scored)
