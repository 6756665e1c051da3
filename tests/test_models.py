import hashlib
import weakref

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from inkgauge import schema
from inkgauge.operators import kmeans, mlp
from inkgauge.operators.kmeans import (
    KMeansClassifier,
    clustering_report,
    kmeans_assign,
    kmeans_fit,
    kmeans_fit_all,
    kmeans_grid_search,
)
from inkgauge.plans import models as P
from inkgauge.registry import QUERIES
from tests.test_vectors import collected, frame


def blobs(n=60, seed=0):
    rng = np.random.default_rng(seed)
    centres = np.array([[0.0, 0.0], [8.0, 0.0], [0.0, 8.0]])
    which = np.arange(n) % 3
    return centres[which] + rng.normal(scale=0.3, size=(n, 2)), which


def test_kmeans_finds_blobs(spark):
    x, which = blobs()
    df = frame(spark, x)
    model = kmeans_fit(df, 3, n_init=2)
    got = collected(kmeans_assign(model, df), "cluster")
    assert len({(w, c) for w, c in zip(which, got)}) == 3
    one, three = (kmeans_fit(df, k, n_init=1).cost for k in (2, 12))
    assert one > model.cost > three
    centres = model.centroids[got]
    assert model.cost == pytest.approx(((x - centres) ** 2).sum())


def test_kmeans_does_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(700, 5)) * [1, 10, 0.1, 1e3, 1] + 50, 3)
    x[100:200] = x[:100]  # repeated rows
    df = frame(spark, x).cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    fits = []
    try:
        for layout, shuffles in ((df.repartition(3), 8), (df.repartition(5, "id"), 3), (df.coalesce(1).orderBy(F.desc("id")), 1)):
            spark.conf.set("spark.sql.shuffle.partitions", shuffles)
            fits.append(kmeans_fit_all(layout, [2, 7], n_init=3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for k in (2, 7):
        assert len(fits[0][k].centroids) == k
        assert all((f[k].centroids == fits[0][k].centroids).all() and f[k].cost == fits[0][k].cost for f in fits)


def test_kmeans_ends_where_plain_lloyd_stands_still(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    model = kmeans_fit(frame(spark, x), 6, n_init=4, tol=0.0)
    distances = ((x[:, None] - model.centroids[None]) ** 2).sum(axis=2)
    means = np.array([x[distances.argmin(axis=1) == c].mean(axis=0) for c in range(6)])
    assert model.centroids == pytest.approx(means, abs=1e-12)
    assert model.cost == pytest.approx(distances.min(axis=1).sum())


def test_one_pass_serves_all_models_and_restarts(spark, monkeypatch):
    x, _ = blobs()
    passes = []
    add = kmeans._cluster_sums
    monkeypatch.setattr(kmeans, "_cluster_sums", lambda rows, centres, *a, **b: passes.append(len(centres)) or add(rows, centres, *a, **b))
    found = kmeans_fit_all(frame(spark, x), [2, 3, 5], n_init=4, max_iter=9)
    assert passes[:2] == [12, 12] and len(passes) <= 10  # the candidates' weights, then the iterations
    assert all(a >= b for a, b in zip(passes, passes[1:], strict=False))
    assert {k: len(m.centroids) for k, m in found.items()} == {2: 2, 3: 3, 5: 5}


def test_fewer_rows_than_clusters_and_no_rows(spark):
    df = frame(spark, np.array([[1.0, 2.0], [1.0, 2.0], [3.0, 4.0]]))
    model = kmeans_fit(df, 5, n_init=2)
    assert sorted(model.centroids.tolist()) == [[1.0, 2.0], [3.0, 4.0]] and model.cost == 0.0
    assert kmeans_fit(frame(spark, np.zeros((4, 2))), 2, n_init=1).centroids.tolist() == [[0.0, 0.0]]
    with pytest.raises(ValueError):
        kmeans_fit(df.limit(0), 2)


def test_equal_distances_go_to_the_lower_number():
    centres = np.array([[1.0, 0.0], [-1.0, 0.0], [0.0, 1.0], [0.0, 1.0]])
    assert kmeans.nearest(np.array([[0.0, 0.0], [0.0, 3.0], [-2.0, 0.0]]), centres).tolist() == [0, 2, 1]


@pytest.mark.parametrize("source", ["train", "eval"])
def test_cluster_classifier(spark, source, tmp_path):
    x, which = blobs()
    df = frame(spark, x, which == 1)
    model = KMeansClassifier(3, n_init=2, label_source=source).fit(df)
    scored = model.transform(df)
    assert collected(scored, "predicted").tolist() == (which == 1).astype(int).tolist()
    model.save(str(tmp_path), None if source == "train" else df)
    back = KMeansClassifier.load(spark, str(tmp_path))
    assert collected(back.transform(df), "predicted").tolist() == collected(scored, "predicted").tolist()


def test_grid_and_report(spark):
    x, which = blobs()
    df = frame(spark, x, which == 1)
    fitted, results = kmeans_grid_search(df, df, [2, 3, 5], n_init=1)
    rows = results.orderBy("grid_pos").collect()
    assert [r.n_clusters for r in rows] == [2, 3, 5]
    assert all(r.total == 60 for r in rows) and max(r.accuracy for r in rows) == 1.0
    best = min(r.n_clusters for r in rows if r.accuracy == 1.0)
    report = clustering_report(results, fitted[best].transform(df)).first()
    assert tuple(report) == (best, 1.0, 1.0, 1.0)


def test_clustering_run(spark, tmp_path):
    x, which = blobs(100)
    best, scored, report = P.clustering_run(frame(spark, x, which == 1), str(tmp_path), [3], n_init=2)
    assert best.k == 3 and report.first().test_accuracy == 1.0
    assert spark.read.parquet(str(tmp_path / "predictions")).count() == scored.count() > 0


LAYERS = [4, 5, 3, 1]


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(0)
    w = mlp.initial_parameters(LAYERS, 1)
    x, y = rng.normal(size=(7, 4)), (rng.random((7, 1)) < 0.5).astype(float)

    def mean_loss(weights):
        return mlp.loss_sum(mlp.forward(weights, LAYERS, x)[-1], y) / len(y)

    grad = mlp.gradient(w, LAYERS, mlp.forward(w, LAYERS, x), y)
    step = 1e-6
    want = [(mean_loss(w + d) - mean_loss(w - d)) / (2 * step) for d in np.eye(len(w)) * step]
    assert grad == pytest.approx(np.array(want), abs=1e-6)


def test_parameter_count():
    # 392-128-64-32-1
    assert mlp.n_parameters([392, 128, 64, 32, 1]) == 60673


def moons(spark, n=400):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 4))
    return frame(spark, x, x[:, 0] + x[:, 1] > 0)


def test_one_shard_is_plain_adam(spark):
    df = moons(spark, 90)
    trainer = mlp.MlpClassifier(LAYERS, epochs=1, batch_size=32, shards=1)
    got = trainer.fit(df).weights
    order = df.selectExpr("id", "features", "label", "md5(concat_ws(':', id, 1, 42)) AS o").orderBy("o", "id").collect()
    x, y = np.array([r.features for r in order]), np.array([[r.label] for r in order])
    w = mlp.initial_parameters(LAYERS, 42)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step, at in enumerate(range(0, 90, 32), 1):
        bx, by = x[at : at + 32], y[at : at + 32]
        g = mlp.gradient(w, LAYERS, mlp.forward(w, LAYERS, bx), by)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        w = w - 1e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    assert got == pytest.approx(w, abs=1e-12)


def plain_training(df, layers, epochs, batch, rate=1e-3):
    """A loop over the batches of each epoch's order."""
    rows = df.collect()
    state = mlp._State(mlp.initial_parameters(layers, 42), *np.zeros((2, mlp.n_parameters(layers))), 0)
    losses = []
    for epoch in range(1, epochs + 1):
        rows.sort(key=lambda r: (hashlib.md5(f"{r.id}:{epoch}:42".encode()).hexdigest(), r.id))
        x, y = np.array([r.features for r in rows]), np.array([[r.label] for r in rows])
        loss = 0.0
        for at in range(0, len(y), batch):
            steps = mlp.forward(state.weights, layers, x[at : at + batch])
            loss += mlp.loss_sum(steps[-1], y[at : at + batch])
            state.update(mlp.gradient(state.weights, layers, steps, y[at : at + batch]), rate)
        losses.append(loss / len(y))
    return state.weights, losses


@pytest.mark.parametrize(
    "batch, rows, partitions, epochs",
    [(16, 64, 5, 3), (24, 50, 2, 2), (64, 1 << 14, 3, 25), (60, 25, 4, 2)],  # the last: batches larger than a range
)
def test_synchronous_training_is_a_plain_loop(spark, monkeypatch, batch, rows, partitions, epochs):
    monkeypatch.setattr(mlp, "RANGE_ROWS", rows)
    df = moons(spark, 150)
    got = mlp.MlpClassifier(LAYERS, epochs=epochs, batch_size=batch).fit(df.repartition(partitions))
    weights, losses = plain_training(df, LAYERS, epochs, batch)
    assert got.weights == pytest.approx(weights, abs=1e-9)
    assert [h.train_loss for h in got.history.orderBy("epoch").collect()] == pytest.approx(losses, abs=1e-9)


def test_places_are_the_order_of_training(spark):
    df = moons(spark, 90).select("id")
    order = [r.id for r in df.orderBy(mlp.epoch_order("id", 2, 42), "id").collect()]
    placed = mlp.place_in_epoch(df.repartition(3), 2, 42).orderBy("place").collect()
    assert [(r.id, r.place) for r in placed] == list(zip(order, range(90)))


@pytest.mark.parametrize("shards", [1, 3])
def test_replicas_are_averaged(spark, shards):
    df = moons(spark)
    trainer = mlp.MlpClassifier([4, 16, 8, 1], epochs=12, batch_size=16, rate=1e-2, shards=shards, synchronous=False)
    assert trainer.fit(df, df).validate(df).first().accuracy > 0.9


@pytest.mark.parametrize("shards", [1, 3])
def test_full_batch_is_one_step_for_any_shards(spark, shards):
    df = moons(spark, 90)
    got = mlp.MlpClassifier(LAYERS, epochs=2, batch_size=None, shards=shards).fit(df)
    rows = df.collect()
    x, y = np.array([r.features for r in rows]), np.array([[r.label] for r in rows])
    state = mlp._State(mlp.initial_parameters(LAYERS, 42), *np.zeros((2, mlp.n_parameters(LAYERS))), 0)
    losses = []
    for _ in range(2):
        steps = mlp.forward(state.weights, LAYERS, x)
        losses.append(mlp.loss_sum(steps[-1], y) / len(y))
        state.update(mlp.gradient(state.weights, LAYERS, steps, y), 1e-3)
    assert got.weights == pytest.approx(state.weights, abs=1e-9)
    assert [h.train_loss for h in got.history.orderBy("epoch").collect()] == pytest.approx(losses)


def test_full_batch_shard_drops_batches_it_has_seen():
    held = []

    def batches():
        for i in range(5):
            batch = pa.RecordBatch.from_pydict({"features": [[float(i), 1.0]] * 1000, "label": [1.0] * 1000})
            held.append(weakref.ref(batch))
            yield batch
            del batch
            assert sum(b() is not None for b in held) <= 1

    out = list(mlp._shard_gradient(np.zeros(3), [2, 1], None)(batches()))
    assert len(out) == 1 and out[0].column("n").to_pylist() == [5000]
    assert out[0].column("values").to_pylist()[0] == pytest.approx([-5000.0, -2500.0, -2500.0])


@pytest.mark.parametrize("name", ["mlp_train", "training_history", "epoch_loss", "mlp_evaluate", "mlp_run"])
def test_full_batch_queries_use_all_shards(spark, name, monkeypatch):
    fit, seen = mlp.MlpClassifier.fit, []
    monkeypatch.setattr(mlp.MlpClassifier, "fit", lambda self, *a: seen.append(self) or fit(self, *a))
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert [(t.shards, t.batch_size) for t in seen] == [(schema.SHARDS, None)]


@pytest.mark.parametrize("shards", [1, 3])
def test_learns_separable_data(spark, shards, tmp_path):
    df = moons(spark)
    model = mlp.MlpClassifier([4, 16, 8, 1], epochs=12, batch_size=16, rate=1e-2, shards=shards).fit(df, df)
    history = model.history.orderBy("epoch").collect()
    assert [h.epoch for h in history] == list(range(1, 13))
    assert history[-1].val_accuracy > 0.95
    assert history[-1].train_loss < history[0].train_loss
    seen = model.validate(df).first()
    p, y = collected(model.transform(df), "probability"), collected(df, "label")
    assert seen.loss == pytest.approx(mlp.loss_sum(p[:, None], y[:, None]) / len(y))
    assert seen.accuracy == pytest.approx(np.mean((p > 0.5) == y))
    model.save(spark, str(tmp_path / "mlp"))
    back = mlp.MlpModel.load(spark, str(tmp_path / "mlp"))
    assert (collected(back.transform(df), "probability") == p).all()


def test_half_is_class_zero(spark):
    model = mlp.MlpModel([1, 1], np.zeros(2))
    row = model.transform(frame(spark, [[3.0]])).first()
    assert (row.probability, row.predicted) == (0.5, 0)


def test_saturated_loss_is_finite(spark):
    model = mlp.MlpModel([1, 1], np.array([1e6, 0.0]))
    assert model.validate(frame(spark, [[1.0]], [0])).first().loss == 100.0


def test_sums_of_clusters_take_one_integer_a_number():
    x = np.random.default_rng(3).normal(size=(1024, 5)) * [1, 1e-9, 1e6, 0, -3]
    x[0] = -1e7
    scale = np.abs(x).max()
    whole = kmeans._whole(x, scale)
    assert whole.shape == x.shape and np.abs(whole).max() <= 2**53
    limbs, halves = kmeans._limbs(x, scale).sum(axis=0), kmeans._halves(whole.sum(axis=0, keepdims=True))[0]
    assert (kmeans._number(limbs, scale) == kmeans._number(halves, scale)).all()
    centres = x[:7]
    assert (kmeans.nearest(x, centres) == kmeans.nearest(x, centres, (x**2).sum(axis=1))).all()


def test_a_step_makes_no_new_state():
    state = mlp._State(np.ones(3), np.zeros(3), np.zeros(3), 0)
    held = [state.weights, state.first, state.second]
    before, copy = state.weights.copy(), state.copy()
    state.update(np.array([1.0, -2.0, 0.0]), 0.1)
    assert all(a is b for a, b in zip(held, [state.weights, state.first, state.second], strict=True))
    assert state.weights == pytest.approx([0.9, 1.1, 1.0]) and (copy.weights == before).all()


def test_products_in_single_precision_find_what_nearest_finds():
    rng = np.random.default_rng(8)
    for scale in (1.0, 1e-30, 1e30):
        x = rng.normal(size=(600, 9)) * scale
        x[100:200] = x[:100] * (1 + 1e-9)  # closer together than single precision tells
        x[200] = 0.0
        models = [x[[0, 100, 1, 101]], x[[5]], x[[0, 0, 300]], np.zeros((2, 9)), np.vstack([x[400:440], x[:20] * (1 + 3e-9)])]
        squares = (x**2).sum(axis=1)
        found = kmeans._Nearest(models, np.abs(x).max())(x, squares)
        for known, (at, _) in zip(models, found, strict=True):
            assert (at == kmeans.nearest(x, known, squares)).all()


def test_rows_within_the_margin_are_where_they_were():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(800, 6)) + 6 * rng.integers(0, 3, size=(800, 1))
    squares, scale = (x**2).sum(axis=1), np.abs(x).max()
    for step in (0.0, 1e-9, 1e-3, 0.1, 3.0):
        before = [x[:3].copy(), x[10:40].copy(), x[50:51].copy()]
        now = [c + rng.normal(size=c.shape) * step for c in before]
        drifts = [np.sqrt(((a - b) ** 2).sum(axis=1)) / scale for a, b in zip(now, before, strict=True)]
        were = kmeans._Nearest(before, scale).were(x, squares, list(kmeans._Nearest(now, scale)(x, squares, drifts)))
        assert all((at == kmeans.nearest(x, c)).all() for at, c in zip(were, before, strict=True))


def test_later_passes_sum_only_rows_that_changed_their_cluster(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(500, 4))
    rows = kmeans._blocks(kmeans.kmeans_rows(frame(spark, x)), 3, 4)
    scale = np.abs(x).max()
    before = [x[:5], x[5:7]]
    now = [c + 0.05 for c in before]
    _, counts, sums, lengths = kmeans._cluster_sums(rows, before, scale)
    _, more, added, _ = kmeans._cluster_sums(rows, now, scale, before=before)
    _, want, total, _ = kmeans._cluster_sums(rows, now, scale)
    moved = sum((kmeans.nearest(x, a) != kmeans.nearest(x, b)).sum() for a, b in zip(before, now, strict=True))
    assert 0 < np.abs(more).sum() <= 2 * moved < 200  # the rows of a pass were 1,000 before
    assert (counts + more == want).all() and lengths == pytest.approx((x**2).sum())
    assert (kmeans._number(sums + added, scale) == kmeans._number(total, scale)).all()


def test_arrow_batches_are_small_only_meanwhile(spark):
    from inkgauge.session import ARROW_BYTES, arrow_batches

    before = spark.conf.get(ARROW_BYTES, None)
    with pytest.raises(KeyError), arrow_batches(spark, 1234):
        assert spark.conf.get(ARROW_BYTES) == "1234"
        raise KeyError
    assert spark.conf.get(ARROW_BYTES, None) == before


@pytest.mark.parametrize("batch", [32, None])
def test_training_sends_small_batches_and_vectors_without_lists(spark, batch, monkeypatch):
    from inkgauge.session import ARROW_BYTES, BATCH_BYTES

    seen, validate = [], mlp.MlpModel.validate
    monkeypatch.setattr(mlp.MlpModel, "validate", lambda self, df: seen.append(spark.conf.get(ARROW_BYTES)) or validate(self, df))
    df = moons(spark, 90)
    mlp.MlpClassifier(LAYERS, epochs=2, batch_size=batch).fit(df, df)
    assert seen == [str(BATCH_BYTES)] * 2
    for n in (1, mlp.BLOCK, mlp.BLOCK + 1, 2 * mlp.BLOCK):
        vector = np.arange(float(n))
        found = mlp._blocks(vector, 3, 1, 0.5, 2)
        assert [len(v) for v in found.column("values").to_pylist()] == [min(mlp.BLOCK, n - at) for at in range(0, n, mlp.BLOCK)]
        assert (found.column("values").flatten().to_numpy() == vector).all() and set(found.column("n").to_pylist()) == {3}
