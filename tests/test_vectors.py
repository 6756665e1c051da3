import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkgauge.functions import vectors as V
from inkgauge.operators import mlp
from inkgauge.operators.embedding import BatchModelEncoder, HashingEncoder, _runs, embed_text
from inkgauge.operators.kmeans import nearest_centroid
from inkgauge.operators.pca import PcaReport
from inkgauge.operators.scaling import Standardizer


def frame(spark, rows, labels=None):
    labels = labels if labels is not None else [0.0] * len(rows)
    data = [(i, [float(x) for x in r], float(y)) for i, (r, y) in enumerate(zip(rows, labels))]
    return spark.createDataFrame(data, "id long, features array<double>, label double")


def collected(df, column):
    return np.array([r[column] for r in df.orderBy("id").collect()])


def test_standardize(spark):
    x = np.random.default_rng(0).normal(3, 5, size=(50, 4))
    x[:, 2] = 0.1  # constant
    model = Standardizer().fit(frame(spark, x))
    z = collected(model.transform(frame(spark, x)), "features")
    want = np.divide(x - x.mean(0), x.std(0), out=np.zeros_like(x), where=np.arange(4) != 2)
    assert z == pytest.approx(want, abs=1e-9)
    assert (z[:, 2] == 0).all()
    with pytest.raises(ValueError, match="empty"):
        Standardizer().fit(frame(spark, x).where("false"))


def test_cosine(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(V.cosine_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([0.96, 0.0])


def test_assemble_features(spark):
    df = spark.createDataFrame([(5, [0.5, 0.25], 7, True)], "id long, embedding array<float>, n int, generated boolean")
    row = V.assemble_features(df, numeric=["n"]).first()
    assert (row.id, row.features, row.label) == (5, [0.5, 0.25, 7.0], 1.0)


def test_hashing_encoder(spark):
    texts = ["one two two", "", None, "Two ONE two", "ünï don't"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = collected(embed_text(df, HashingEncoder(16)), "embedding")
    for text, vector in zip(texts, got):
        want = np.zeros(16)
        for word in re.findall(r"\w+", (text or "").lower()):
            h = hashlib.md5(word.encode()).hexdigest()
            want[int(h[:8], 16) % 16] += 1 if h[8] >= "8" else -1
        norm = np.linalg.norm(want)
        assert vector == pytest.approx(want / norm if norm else want, abs=1e-6)
    assert (got[0] == got[3]).all()
    assert "text" not in embed_text(df).columns and "text" in embed_text(df, keep_text=True).columns


def test_batch_model_encoder(spark):
    def make():
        def predict(texts):
            return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

        return predict

    df = spark.createDataFrame([(0, "abc"), (1, "")], "id int, text string")
    got = collected(embed_text(df, BatchModelEncoder(make, 2), batch_size=2), "embedding")
    assert got.tolist() == [[3.0, 1.0], [0.0, 1.0]]


def test_nearest_centroid(spark):
    x = np.random.default_rng(1).normal(size=(60, 3))
    centres = np.vstack([x[:5], x[:1]])  # the last equals the first: the lower number wins
    got = collected(nearest_centroid(frame(spark, x), centres), "cluster")
    want = ((x[:, None] - centres[None]) ** 2).sum(-1).round(9).argmin(1)
    assert got.tolist() == want.tolist()


def test_pca_against_svd(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 6)) @ rng.normal(size=(6, 6))
    df = frame(spark, x)
    model = PcaReport(3).fit(df)
    z = (x - x.mean(0)) / x.std(0)
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    assert model.explained == pytest.approx((s**2 / (s**2).sum())[:3])
    scores = collected(model.transform(df), "pca")
    assert np.abs(scores) == pytest.approx(np.abs(z @ vt[:3].T), abs=1e-6)
    biggest = np.abs(model.components).argmax(1)
    assert (model.components[np.arange(3), biggest] > 0).all()
    table = model.variance_table(spark).collect()
    assert [r.pc for r in table] == ["PC1", "PC2", "PC3"]
    assert table[2].cumulative_variance_pct == pytest.approx((s**2 / (s**2).sum())[:3].sum() * 100, abs=0.006)
    assert model.projection(df).columns == ["id", "pc1", "pc2", "label"]


def test_encoding_runs_do_not_follow_the_batch():
    sizes = np.array([0, 5, 3 << 20, *[2000] * 9000, 0])
    runs = list(_runs(sizes))
    assert [at for at, _ in runs] == np.cumsum([0, *(n for _, n in runs)])[:-1].tolist() and sum(n for _, n in runs) == len(sizes)
    assert all(n == 1 or (n <= 512 and sizes[at : at + n].sum() <= 1 << 20) for at, n in runs)
    assert list(_runs(sizes[:0])) == []


def test_long_batches_are_encoded_and_scored_in_runs(spark):
    # more rows in one Arrow batch than a slice, some of them without a word
    df = spark.range(3000).coalesce(1).withColumn("text", F.expr("repeat(concat(' w', id % 70), int(id % 5))"))
    got = collected(embed_text(df, HashingEncoder(8)), "embedding")
    assert len(got) == 3000 and not got[::5].any() and np.linalg.norm(got[1::5], axis=1) == pytest.approx(1)
    assert (got[1] == got[71]).all()
    net = mlp.MlpModel([8, 3, 1], mlp.initial_parameters([8, 3, 1], 1))
    rows = embed_text(df, HashingEncoder(8)).withColumn("features", F.col("embedding").cast("array<double>"))
    want = mlp.forward(net.weights, net.layers, got)[-1][:, 0]
    assert collected(net.transform(rows), "probability") == pytest.approx(want, abs=1e-6)
