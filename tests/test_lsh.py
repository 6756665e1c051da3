"""Nearest-neighbour search against brute force, with hot buckets and copies."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkgauge.operators import lsh
from inkgauge.operators.lsh import HyperplaneLsh, LshModel, best_lsh, lsh_grid_search
from tests.test_vectors import frame


def brute_force(train, labels, queries, tables, bits, k, planes):
    """Candidates by keys, cosine over all of them, lower id first among equals."""
    mean, std = train.mean(0), train.std(0)
    std = np.where(std > 0, std, np.inf)
    a, q = (train - mean) / std, (queries - mean) / std

    def keys(x):
        return np.einsum("tbd,nd->ntb", planes[:tables, :bits], x) > 0

    def unit(x):
        n = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, n, out=np.zeros_like(x), where=n > 0)

    same = (keys(q)[:, None] == keys(a)[None]).all(-1).any(-1)
    sims = np.round(unit(q) @ unit(a).T, 9)
    found = []
    for row in range(len(q)):
        ids = np.flatnonzero(same[row])
        ids = ids[np.lexsort((ids, -sims[row, ids]))][:k]
        found.append([(int(i), sims[row, i], labels[i]) for i in ids])
    return found


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    train = rng.normal(size=(300, 6))
    train[100:200] = train[7]  # a third of the table are copies
    train[200:290] = train[8] + 1e-3 * rng.normal(size=(90, 6))  # and near copies
    labels = (rng.random(300) < 0.5).astype(float)
    queries = np.vstack([rng.normal(size=(30, 6)), train[7:9], np.repeat(train[8:9], 8, axis=0)])
    return train, labels, queries


def neighbours(model, queries, k):
    found = {}
    for r in model.query(queries, k).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.id, r.similarity, r.label))
    return found


def assert_same(got, want):
    for i, w in enumerate(want):
        g = got.get(i, [])
        assert [x[0] for x in g] == [x[0] for x in w], i
        assert [x[1:] for x in g] == [pytest.approx(x[1:], abs=2e-9) for x in w]


@pytest.mark.parametrize("kind", ["gaussian", "md5"])
def test_query(spark, data, kind):
    train, labels, queries = data
    model = HyperplaneLsh(6, 5, planes=kind).fit(frame(spark, train, labels))
    want = brute_force(train, labels, queries, 6, 5, 4, model.planes)
    assert_same(neighbours(model, frame(spark, queries), 4), want)


def test_split_and_hot_buckets_change_nothing(spark, data, monkeypatch):
    train, labels, queries = data
    for name, value in (("QUERY_BLOCK", 3), ("BASE_BLOCK", 5), ("HOT_ROWS", 1), ("HOT_SHARE", 20)):
        monkeypatch.setattr(lsh, name, value)
    model = HyperplaneLsh(4, 3).fit(frame(spark, train, labels))
    want = brute_force(train, labels, queries, 4, 3, 7, model.planes)
    assert_same(neighbours(model, frame(spark, queries), 7), want)
    hits = {(r.query_id, r.table_idx): r.n for r in model.bucket_hits(frame(spark, queries)).collect()}
    index = model.index().groupBy("table_idx", "hash_key").count().collect()
    size = {(r.table_idx, r.hash_key): r["count"] for r in index}
    keys = model.signatures(frame(spark, queries)).collect()
    expect = {
        (r.id, t): size[t, key]
        for r in keys
        for t, key in enumerate(r.hash_keys)
        if (t, key) in size
    }
    assert hits == expect


def test_one_bit_tables_give_exact_neighbours(spark):
    rng = np.random.default_rng(5)
    train, queries = rng.normal(size=(80, 5)), rng.normal(size=(10, 5))
    model = HyperplaneLsh(40, 1, normalize=False).fit(frame(spark, train))
    sims = (queries / np.linalg.norm(queries, axis=1, keepdims=True)) @ (
        train / np.linalg.norm(train, axis=1, keepdims=True)
    ).T
    got = neighbours(model, frame(spark, queries), 3)
    for i, row in enumerate(sims):
        assert [x[0] for x in got[i]] == np.argsort(-row)[:3].tolist()


def test_votes_and_defaults(spark):
    train = np.array([[1.0, 0.0], [1.0, 0.0], [1.0, 0.0], [0.0, 0.0]])
    model = HyperplaneLsh(2, 12, normalize=False).fit(frame(spark, train, [1, 0, 0, 1]))
    # a copy, the opposite direction (no bucket in common), the zero vector
    asked = frame(spark, [[2.0, 0.0], [-1.0, 0.0], [0.0, 0.0]], [1, 1, 0])
    predicted = {r.query_id: r.predicted for r in model.predict(asked, 2).collect()}
    share = {r.query_id: r.probability for r in model.predict_probability(asked, 2).collect()}
    assert share == {0: 0.5, 1: 0.75, 2: 1.0}
    assert predicted == {0: 1, 1: 1, 2: 1}
    row = model.evaluate(asked, 2).first()
    assert (row.correct, row.total) == (2, 3)
    zero = [r for r in model.query(asked, 2).collect() if r.query_id == 2]
    assert [(r.id, r.similarity) for r in zero] == [(3, 0.0)]


def test_cell_streams_in_chunks(data):
    train, labels, _ = data
    rng = np.random.default_rng(0)
    unit = train / np.linalg.norm(train, axis=1, keepdims=True)
    hashes = rng.integers(0, 4, len(train))
    results = []
    for chunk in (7, 10_000):
        cell = lsh._Cell((0, 0, 0, 0), 5, {1: 1, 2: 0}, chunk)
        ids = np.arange(len(train))
        side = np.zeros(20, dtype=int)
        cell.add(side, ids[:20], hashes[:20], labels[:20], unit[:20])
        for at in range(0, len(train), 50):
            p = slice(at, at + 50)
            cell.add(np.ones(50, dtype=int), ids[p], hashes[p], labels[p], unit[p])
        results.append([tuple(map(list, rows)) for rows in cell.found()])
    assert results[0] == results[1]


def test_grid_equals_separate_models(spark, data):
    train, labels, queries = data
    truth = (np.arange(len(queries)) % 2).astype(float)
    val = frame(spark, queries, truth)
    model, results = lsh_grid_search(frame(spark, train, labels), val, [2, 5], [3, 9], [1, 6])
    rows = results.orderBy("grid_pos").collect()
    assert len(rows) == 8
    for r in rows:
        found = brute_force(
            train, labels, queries, r.num_hash_tables, r.num_hash_bits, r.top_k, model.planes
        )
        guess = [1 if not f or np.mean([x[2] for x in f]) >= 0.5 else 0 for f in found]
        assert r.accuracy == pytest.approx(np.mean(np.array(guess) == truth)), r
    smaller, best = best_lsh(model, results)
    top = max(rows, key=lambda r: (r.accuracy, -r.grid_pos))
    assert best["grid_pos"] == top.grid_pos
    assert smaller.evaluate(val, best["top_k"]).first().accuracy == pytest.approx(top.accuracy)


def test_save_and_load(spark, data, tmp_path):
    train, labels, queries = data
    asked = frame(spark, queries)
    model = HyperplaneLsh(5, 4).fit(frame(spark, train, labels))
    model.save(str(tmp_path / "model"))
    back = LshModel.load(spark, str(tmp_path / "model"))
    key = F.col("query_id")
    assert back.predict_probability(asked).orderBy(key).collect() == model.predict_probability(asked).orderBy(key).collect()
    assert (back.tables, back.bits) == (5, 4)


def test_planes_nest():
    big = lsh.random_hyperplanes(4, 5, 3)
    assert (lsh.random_hyperplanes(2, 3, 3) == big[:2, :3]).all()
    with pytest.raises(ValueError, match="unknown"):
        lsh.random_hyperplanes(1, 1, 1, kind="x")
