"""All restarts of K-means in the same passes: equal to a loop, defined on odd vectors."""

import numpy as np
import pytest

from tessera.operators import cluster


def _points(spark, n=400):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(m, 1.0, (n // 4, 3)) for m in (0, 6, 12, 18)])
    return x, spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(5)


def _loop(x, centers, steps):
    for _ in range(steps):
        near = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([x[near == j].mean(axis=0) if (near == j).any() else centers[j] for j in range(len(centers))])
    return centers, ((x[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.mark.parametrize("direct", [0, 1 << 24])
def test_models_equal_separate_loops(spark, monkeypatch, direct):
    monkeypatch.setattr(cluster, "DIRECT_BYTES", direct)
    x, df = _points(spark)
    starts = np.stack([x[:4], x[[0, 100, 200, 300]], np.vstack([x[:3], [[1e6, 1e6, 1e6]]])])
    vectors = cluster.finite_vectors(df, "v")
    for steps in (1, 4):
        centers, costs = cluster.lloyd(vectors, starts, max_iter=steps, tol=-1.0)
        for m in range(3):
            want, cost = _loop(x, starts[m], steps)
            assert np.allclose(centers[m], want) and costs[m] == pytest.approx(cost)
    assert (centers[2][3] == 1e6).all()  # a centre without rows stays


def test_best_restart_finds_the_groups_whatever_the_partitions(spark):
    x, df = _points(spark)
    centers, cost, _ = cluster.kmeans_best(df, "v", 4, restarts=6, seed=2)
    assert np.allclose(np.sort(centers[:, 0]), [0, 6, 12, 18], atol=0.5)
    assert cost == pytest.approx(((x[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum())
    again, cost2, _ = cluster.kmeans_best(df.repartition(2), "v", 4, restarts=6, seed=2)
    assert np.allclose(centers, again) and cost == pytest.approx(cost2)


def test_odd_vectors(spark):
    rows = [([1.0, 2.0],), (None,), ([None, 1.0],), ([float("nan"), 1.0],), ([1.0, 2.0],), ([float("inf"), 0.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    centers, cost, _ = cluster.kmeans_best(df, "v", 2, restarts=3)
    assert cost == 0.0 and (centers == [1.0, 2.0]).all()
    with pytest.raises(ValueError):
        cluster.kmeans_best(df.limit(0), "v", 2)
    with pytest.raises(ValueError):
        cluster.kmeans_best(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>"), "v", 2)
