import numpy as np
import pandas as pd
import pytest

from inkgauge.operators import stats


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame(
        {"g": rng.integers(0, 2, 501), "a": rng.integers(0, 7, 501), "b": rng.normal(size=501)}
    )
    df = spark.createDataFrame(frame)
    for row in stats.describe(df, ["a", "b"], by="g").collect():
        want = frame[frame.g == row.g][row.column].describe()
        got = [row["count"], row["mean"], row["std"], row["min"], row.q25, row.q50, row.q75, row["max"]]
        assert got == pytest.approx(want.to_list())


def test_quantiles_beyond_the_sketch(spark):
    # more rows than the sketch resolves, a third of them one value
    values = np.concatenate([np.random.default_rng(1).normal(size=60_000), np.full(30_000, 0.25)])
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    probs = {"a": 0.1, "b": 0.5, "c": 0.6, "d": 0.99}
    got = {r.q: r.value for r in stats.exact_quantiles(df, ["v"], [], probs, accuracy=500).collect()}
    assert got == pytest.approx({q: np.quantile(values, p) for q, p in probs.items()})


@pytest.mark.parametrize("n", [1, 2, 5, 7, 10])
def test_quantiles_of_few_rows(spark, n):
    values = [float(i * i) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = stats.describe(df, ["v"]).first()
    assert [row.q25, row.q50, row.q75] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_describe_text_nulls_and_approx(spark):
    df = spark.createDataFrame([("b", 1), ("a", None), (None, 3)], "text string, n int")
    rows = {r.column: r for r in stats.describe(df, ["text", "n"]).collect()}
    assert (rows["text"]["count"], rows["text"].nulls) == (2, 1)
    assert (rows["text"].min_text, rows["text"].max_text, rows["text"]["mean"]) == ("a", "b", None)
    assert (rows["n"].nulls, rows["n"]["mean"], rows["n"].q50) == (1, 2.0, 2.0)
    assert {r.column: r.q50 for r in stats.describe(df, ["n"], approx=True).collect()} == {"n": 1.0}
    empty = stats.describe(df.where("false"), ["n"]).first()
    assert (empty["count"], empty.q50) == (0, None)


def test_histogram(spark):
    df = spark.createDataFrame([(" ".join(["w"] * n),) for n in (1, 1, 2, 51, 100, 101)], "text string")
    bins = stats.text_length_histogram(df).orderBy("bin").collect()
    want, edges = np.histogram([1, 1, 2, 51, 100, 101], bins=50)
    assert [b.n for b in bins] == want.tolist()
    assert [b.bin_start for b in bins] == pytest.approx(edges[:-1].tolist())
    same = spark.createDataFrame([("a b",), ("c d",)], "text string")
    assert [b.n for b in stats.text_length_histogram(same).orderBy("bin").collect()] == [2] + [0] * 49
    assert stats.text_length_histogram(df.where("false")).count() == 0


def test_kde(spark):
    lengths = [3, 5, 5, 8, 20]
    df = spark.createDataFrame([(" ".join(["w"] * n),) for n in lengths], "text string")
    rows = stats.text_length_kde(df, grid=20).orderBy("point").collect()
    x = np.linspace(3, 20, 20)
    h = np.std(lengths, ddof=1) * 5 ** (-0.2)
    want = [np.mean(np.exp(-0.5 * ((p - np.array(lengths)) / h) ** 2)) / (h * np.sqrt(2 * np.pi)) for p in x]
    assert [r.x for r in rows] == pytest.approx(x.tolist())
    assert [r.density for r in rows] == pytest.approx(want)
    same = spark.createDataFrame([("a b",), ("c d",)], "text string")
    assert stats.text_length_kde(same).count() == 0


def test_cutoffs_and_labels(spark):
    df = spark.createDataFrame(
        [(" ".join(["w"] * n), g) for n, g in ((99, 0), (100, 1), (1000, 1), (1001, 1))],
        "text string, generated int",
    )
    assert {r.zone: r.n for r in stats.length_cutoff_counts(df).collect()} == {"below": 1, "inside": 2, "above": 1}
    assert {r.label: r.percentage for r in stats.label_distribution(df).collect()} == {0: 25.0, 1: 75.0}
    assert {r.label: r.n for r in stats.class_counts(df).collect()} == {0: 1, 1: 3}
