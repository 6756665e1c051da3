import math

import pytest
from pyspark.sql import functions as F

from inkgauge.operators import evaluation as E
from inkgauge.operators.ranking import hash_cutoffs, order_hash
from inkgauge.operators.splits import split_random, split_stratified


def sizes(df, *by):
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*by, "split").count().collect()}


@pytest.mark.parametrize("n", [10, 11, 101, 1000])
def test_split_random_sizes(spark, n):
    got = sizes(split_random(spark.range(n)))
    held = math.ceil(0.2 * n)
    test = math.ceil(0.5 * held)
    want = {("train",): n - held, ("val",): held - test, ("test",): test}
    assert got == {k: v for k, v in want.items() if v}


def test_split_is_deterministic_and_moves_no_rows(spark):
    a = {r.id: r.split for r in split_random(spark.range(200).repartition(3)).collect()}
    b = {r.id: r.split for r in split_random(spark.range(200).repartition(11)).collect()}
    c = {r.id: r.split for r in split_random(spark.range(200), seed=1).collect()}
    assert a == b != c
    assert len(a) == 200


def test_split_by_group(spark):
    df = spark.range(300).withColumn("doc", F.col("id") % 50)
    got = split_random(df, group_col="doc")
    assert got.groupBy("doc").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert sizes(got.select("doc", "split").distinct()) == {("train",): 40, ("val",): 5, ("test",): 5}


@pytest.mark.parametrize("shares", [(0.8, 0.1, 0.1), (0.5, 0.3, 0.2), (1.0, 0.0, 0.0)])
def test_groups_stay_whole_and_labels_keep_their_shares(spark, shares):
    # documents of one to three chunks; a third of all rows in one document, some without any
    rows = [(i // 2, i % 2) for i in range(400)] + [(1000 + i, 1) for i in range(90)]
    rows += [(2000 + i // 3, int(i % 3 == 0)) for i in range(300)] + [(5000, 0)] * 400 + [(None, 1)] * 5 + [(6000, None)]
    df = spark.createDataFrame(rows, "doc int, y int").repartition(4)
    got = split_stratified(df, "y", shares=shares, group_col="doc")
    assert got.columns == ["doc", "y", "split"] and got.count() == len(rows)
    found = {}
    for r in got.collect():
        found.setdefault(r.doc, set()).add(r.split)
    assert all(len(parts) == 1 for parts in found.values())
    for lo, hi in ((0, 200), (1000, 1090), (2000, 2100)):  # one class of equal documents each
        docs = [d for d in found if d is not None and lo <= d < hi]
        for part, share in zip(("train", "val", "test"), shares, strict=True):
            assert abs(sum(part in found[d] for d in docs) - share * len(docs)) <= 1 + 1e-9
    again = split_stratified(df.repartition(2), "y", shares=shares, group_col="doc").collect()
    assert {r.doc: r.split for r in again} == {d: next(iter(p)) for d, p in found.items()}
    assert split_stratified(df.limit(0), "y", group_col="doc").count() == 0


def test_split_stratified(spark):
    df = spark.range(205).withColumn("y", F.when(F.col("id") < 1, 2).when(F.col("id") < 55, 1).otherwise(0))
    got = sizes(split_stratified(df, "y"), "y")
    # 150 of class 0, 54 of class 1, one row of class 2
    assert [got[(0, s)] for s in ("train", "val", "test")] == [120, 15, 15]
    assert [got[(1, s)] for s in ("train", "val", "test")] == [43, 5, 6]
    assert sum(v for (y, _), v in got.items() if y == 2) == 1
    with pytest.raises(ValueError, match="sum to 1"):
        split_stratified(df, "y", shares=(0.8, 0.1, 0.2))


def test_many_classes_are_cut_without_a_list_of_prefixes(spark, capsys):
    df = spark.range(3000).withColumn("y", F.col("id") % 700)
    got = split_stratified(df, "y")
    assert sum(sizes(got).values()) == 3000 and min(sizes(got, "y").values()) > 0
    held = got.where("split <> 'train'").groupBy("y").count().collect()
    assert {r["count"] for r in held} == {1} and len(held) == 700  # of 4 or 5 rows
    cuts = hash_cutoffs(df, order_hash("id", seed=42), {"half": lambda n: n / 2}, by=F.col("y"))
    capsys.readouterr()
    cuts.explain()
    plan = capsys.readouterr().out
    assert "array_contains" not in plan and "LeftSemi" in plan  # each row looked its prefix up in a list of 65,536


def test_votes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 0), (1, 1), (2, 1)], "cluster int, label int")
    classes = E.cluster_majority(df)
    assert {r.cluster: r["class"] for r in classes.collect()} == {0: 1, 1: 0, 2: 1}
    extra = spark.createDataFrame([(0,), (7,)], "cluster int")
    assert {r.cluster: r.predicted for r in E.apply_cluster_map(extra, classes).collect()} == {0: 1, 7: None}
    assert {r["class"] for r in E.cluster_majority(df, threshold=0.9).where("cluster < 2").collect()} == {0}


def test_measures(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "label int, predicted int")
    row = E.accuracy(df).first()
    assert (row.accuracy, row.correct, row.total) == (0.6, 3, 5)
    assert E.f1_positive(df).first().f1 == pytest.approx(2 / 3)
    cells = {(r.actual, r.predicted): r.n for r in E.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    none = spark.createDataFrame([(0, 0)], "label int, predicted int")
    assert E.f1_positive(none).first().f1 == 0.0
    assert sum(r.n for r in E.confusion_matrix(none).collect()) == 1
    nothing = E.accuracy(none.where("false")).first()
    assert (nothing.accuracy, nothing.correct, nothing.total) == (None, 0, 0)


def test_best_config(spark):
    def best(*shares):
        df = spark.createDataFrame(list(enumerate(shares)), "grid_pos int, accuracy double")
        return E.best_config(df).first().grid_pos

    assert best(0.0, 0.0) == 0
    assert best(0.1, 0.7, 0.7) == 1
    assert best(None, 0.0) == 1
