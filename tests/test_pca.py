"""Randomised components against exact ones."""

import numpy as np
import pytest

from inkgauge.operators import pca
from inkgauge.operators.pca import PcaReport
from inkgauge.registry import QUERIES, learning, reports
from inkgauge.session import ARROW_BYTES, BATCH_BYTES
from tests.test_vectors import frame


def exact(x, k):
    std = x.std(axis=0)
    z = np.divide(x - x.mean(axis=0), std, out=np.zeros_like(x), where=std > 0)
    _, sizes, turn = np.linalg.svd(z, full_matrices=False)
    signs = np.sign(turn[np.arange(k), np.abs(turn[:k]).argmax(axis=1)])
    return turn[:k] * signs[:, None], sizes[:k] ** 2 / (sizes**2).sum()


def factors(rng, n, d, strong=6):
    return rng.normal(size=(n, strong)) @ rng.normal(size=(strong, d)) + 2.0 * rng.normal(size=(n, d)) + 5.0


def test_components_of_392_columns_are_exact(spark):
    x = factors(np.random.default_rng(1), 900, 392)
    x[:, 7] = 3.0  # a constant column
    found = PcaReport(5).fit(frame(spark, x).repartition(7))
    components, explained = exact(x, 5)
    assert found.components == pytest.approx(components, abs=1e-7)
    assert found.explained == pytest.approx(explained, abs=1e-12)


def test_a_slowly_falling_spectrum(spark):
    x = np.random.default_rng(2).normal(size=(500, 60))
    found = PcaReport(3).fit(frame(spark, x))
    components, explained = exact(x, 3)
    assert found.components == pytest.approx(components, abs=1e-6)
    assert found.explained == pytest.approx(explained, abs=1e-12)


def test_20000_columns_without_a_square_matrix(spark, monkeypatch):
    x = factors(np.random.default_rng(3), 60, 20_000, strong=3)
    seen = []
    times = pca._covariance_times
    monkeypatch.setattr(pca, "_covariance_times", lambda r, s, block: seen.append(block.shape) or times(r, s, block))
    found = PcaReport(2).fit(frame(spark, x))
    components, explained = exact(x, 2)
    assert found.components == pytest.approx(components, abs=1e-7)
    assert found.explained == pytest.approx(explained, abs=1e-10)
    assert all(width <= 2 + pca.OVERSAMPLED for _, width in seen) and len(seen) < 10


def test_a_deep_tree_of_triangles(spark, monkeypatch):
    monkeypatch.setattr(pca, "FAN_IN", 2)
    x = factors(np.random.default_rng(4), 200, 12)
    found = PcaReport(4).fit(frame(spark, x).repartition(9))
    assert found.explained == pytest.approx(exact(x, 4)[1], abs=1e-12)


@pytest.mark.parametrize("x", [np.ones((5, 3)), np.array([[1.0, 2.0], [3.0, 5.0]]), np.array([[4.0]])])
def test_few_rows_few_columns_and_constants(spark, x):
    found = PcaReport(5).fit(frame(spark, x))
    assert found.components.shape == (min(5, x.shape[1]), x.shape[1])
    assert np.isfinite(found.components).all() and (found.explained >= 0).all()
    assert found.explained.sum() == pytest.approx(1.0 if x.std() > 0 else 0.0)


def test_rows_are_kept_on_disk_in_blocks_of_bounded_size(spark, monkeypatch):
    x = factors(np.random.default_rng(5), 700, 30)
    levels, sizes = [], []
    times = pca._covariance_times

    def seen(rows, scaler, block):
        levels.append(rows.storageLevel)
        sizes.extend(len(r.features) for r in rows.collect())
        return times(rows, scaler, block)

    monkeypatch.setattr(pca, "_covariance_times", seen)
    monkeypatch.setattr(pca, "BLOCK_BYTES", 8 * 30 * 100)
    found = PcaReport(3).fit(frame(spark, x).repartition(2))
    assert found.explained == pytest.approx(exact(x, 3)[1], abs=1e-12)
    assert all(level.useDisk and not level.useMemory for level in levels) and max(sizes) <= pca.BLOCK_BYTES


@pytest.mark.parametrize("name, module", [("pca_fit_full", learning), ("corpus_statistics_full", reports)])
def test_scores_of_the_full_queries_come_in_small_batches(spark, name, module, monkeypatch):
    seen = []

    def held(df, kind, real=module.written):
        seen.append((kind, spark.conf.get(ARROW_BYTES)))
        return real(df, kind)

    monkeypatch.setattr(module, "written", held)
    before = spark.conf.get(ARROW_BYTES, None)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert [size for kind, size in seen if kind in ("scores", "projection")] == [str(BATCH_BYTES)]
    assert spark.conf.get(ARROW_BYTES, None) == before
