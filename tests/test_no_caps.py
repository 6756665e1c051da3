"""Results that must not depend on caps, cores or the layout of the input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkgauge import session
from inkgauge.operators.cleaning import distinct_texts, sample_n
from inkgauge.operators.kmeans import KMeansClassifier
from inkgauge.operators.lsh import LshModel, HyperplaneLsh
from inkgauge.operators.mlp import MlpClassifier
from inkgauge.operators.splits import split_stratified
from inkgauge.operators.stats import describe
from inkgauge.plans.corpus import clean_corpus
from inkgauge.plans.models import model_rows
from inkgauge.sources.corpus import Corpus, merge_corpora, subset_path


def test_any_number_of_classes(spark):
    rows = spark.range(15_000).select("id", (F.col("id") % 1500).alias("label"))
    got = split_stratified(rows, "label").groupBy("label", "split").count().collect()
    assert {(r.split, r["count"]) for r in got} == {("train", 8), ("val", 1), ("test", 1)}
    assert len(got) == 3 * 1500


def test_any_number_of_groups(spark):
    rows = spark.range(31_500).select((F.col("id") % 10_500).alias("g"), F.col("id").cast("double").alias("v"))
    got = describe(rows, ["v"], by="g").collect()
    assert len(got) == 10_500
    assert all(r.q50 == r.g + 10_500 and r.q25 == r.g + 5250 for r in got)


def test_groups_with_odd_values_stay_apart(spark):
    rows = [("a\x01", "b", 1.0), ("a", "\x01b", 2.0), (None, "b", 3.0), ("\x02", "b", 4.0)]
    df = spark.createDataFrame(rows, "g string, h string, v double")
    got = {(r.g, r.h): r.q50 for r in describe(df, ["v"], by=["g", "h"]).collect()}
    assert got == {(g, h): v for g, h, v in rows}


def test_nan_is_missing_in_every_measure(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    row = describe(df, ["v"]).first()
    assert (row["count"], row["nulls"], row["mean"], row["min"], row["max"], row["q50"]) == (2, 2, 2.0, 1.0, 3.0, 2.0)


def test_ids_of_chunks_are_unique(spark):
    df = spark.range(6).select(
        (F.col("id") % 2).alias("id"),
        (F.col("id") * 700_000).alias("chunk_idx"),
        F.array(F.lit(0.0)).alias("embedding"),
        F.lit(1).alias("generated"),
        *(F.lit(1.0).alias(c) for c in __import__("inkgauge.schema", fromlist=["x"]).NUMERIC_COLS),
    )
    assert model_rows(df).select("id").distinct().count() == 6


def test_keyless_corpora_do_not_depend_on_the_layout(spark):
    texts = [(" ".join(f"w{(i * 7 + j) % 90}" for j in range(120)), i % 2) for i in range(40)] * 2
    df = spark.createDataFrame(texts, "text string, generated int")
    found = []
    for parts in (3, 5):
        corpus = [Corpus("a", df.repartition(parts))]
        sampled = sorted(r.text for r in sample_n(merge_corpora(corpus), 5, key=["source_pos", "row_key"]).collect())
        cleaned = sorted((r.id, r.text) for r in clean_corpus(corpus).collect())
        found.append((sampled, cleaned))
        assert len(cleaned) == len({t for t, _ in texts}) and len(sampled) == 5
    assert found[0] == found[1]


def test_cleaning_does_not_sort_texts(spark):
    df = spark.createDataFrame([(i, f"text {i % 7} " * 60, i % 2) for i in range(50)], "key bigint, text string, generated int")
    cleaned = clean_corpus([Corpus("a", df, key="key")])
    cleaned.collect()
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan
    assert not [line for line in plan.splitlines() if ("Sort " in line or "SortAggregate" in line) and "text#" in line]
    keyed = distinct_texts(df, "key", unique_key="key")
    keyed.collect()
    assert "SortMergeJoin" not in keyed._jdf.queryExecution().executedPlan().toString()


def test_training_does_not_depend_on_cores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    df = spark.createDataFrame(
        [(i, v.tolist(), float(v[0] > 0)) for i, v in enumerate(x)], "id bigint, features array<double>, label double"
    )
    a = MlpClassifier(epochs=2).fit(df.repartition(2)).weights
    b = MlpClassifier(epochs=2).fit(df.repartition(7)).weights
    assert np.allclose(a, b, atol=1e-9)
    with pytest.raises(ValueError, match="empty"):
        MlpClassifier(epochs=1).fit(df.limit(0))


def test_sample_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id bigint")
    with pytest.raises(Exception, match="cannot sample 5 rows out of 0"):
        sample_n(empty, 5, key="id").collect()
    assert sample_n(empty, 5, key="id", clamp=True).count() == 0


def test_cluster_model_keeps_its_settings(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, [float(i % 2), 1.0], float(i % 2)) for i in range(20)], "id bigint, features array<double>, label double"
    )
    model = KMeansClassifier(2, 1, seed=9, label_source="eval", threshold=0.4).fit(df)
    with pytest.raises(ValueError, match="scored"):
        model.save(str(tmp_path / "m"))
    model.save(str(tmp_path / "m"), df)
    back = KMeansClassifier.load(spark, str(tmp_path / "m"))
    assert (back.k, back.n_init, back.seed, back.label_source, back.threshold) == (2, 1, 9, "eval", 0.4)
    assert back.transform(df).where("predicted <> label").count() == 0


def test_a_loaded_lsh_model_is_not_saved_over_itself(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, [float(i), 1.0, -1.0], float(i % 2)) for i in range(20)], "id bigint, features array<double>, label double"
    )
    HyperplaneLsh(2, 2).fit(df).save(str(tmp_path / "m"))
    back = LshModel.load(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="another path"):
        back.save(str(tmp_path / "m"))
    back.save(str(tmp_path / "n"))
    assert LshModel.load(spark, str(tmp_path / "n")).base.count() == 20


def test_copies_are_removed(spark):
    df = session.written(spark.range(5), "gone")
    assert df.count() == 5
    kept = session._COPIES.pop(spark.sparkContext.applicationId)
    session._COPIES[spark.sparkContext.applicationId] = kept[-1:]
    assert session.remove_copies(spark) == 1
    session._COPIES[spark.sparkContext.applicationId] = kept[:-1]
    with pytest.raises(Exception, match="(?i)not exist"):
        spark.read.parquet(kept[-1])


def test_subset_paths():
    assert subset_path("a/data.csv") == "a/data_subset.csv"
    assert subset_path("a.b/data/") == "a.b/data_subset"
