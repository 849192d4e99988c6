"""Property tests for the fitting operators (no SQL oracle exists for them)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sf_paths import SF_MID, SF_SMALL
from tessera.operators import cluster, decompose, logistic, stats
from tessera.operators.gaussian import fit_gaussian, gaussian_logit
from tessera.operators.linear import fit_bagged, fit_ridge_cv, ridge_solve
from tessera.operators.split import with_folds
from tessera.session import table


@pytest.fixture(scope="module")
def reg_data(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(400, 3))
    y = X @ np.array([1.5, -2.0, 0.5]) + 0.3 + rng.normal(scale=0.1, size=400)
    rows = [(i, 1.0, *map(float, X[i]), float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, c double, a double, b double, d double, y double")
    return df, np.column_stack([np.ones(400), X]), y


def test_gram_methods_agree(spark, reg_data):
    df, X, y = reg_data
    cols = ["c", "a", "b", "d"]
    g1 = stats.gram(df, cols, "y", method="sql")[()]
    g2 = stats.gram(df, cols, "y", method="partition")[()]
    assert np.allclose(g1.xx, X.T @ X) and np.allclose(g2.xx, X.T @ X)
    assert np.allclose(g1.xy, X.T @ y) and np.allclose(g2.xy, X.T @ y)
    assert g1.n == g2.n == 400


def test_ridge_cv_normal_equations(spark, reg_data):
    df, X, y = reg_data
    df = with_folds(df, "k", 5)
    coef, best, report = fit_ridge_cv(df, ["c", "a", "b", "d"], "y", [0.0, 1.0, 100.0])
    lam = report[best][1]
    assert np.allclose(coef, np.linalg.solve(X.T @ X + lam * np.eye(4), X.T @ y))
    # CV error by brute force for lambda = 1
    folds = {r["k"]: r["fold"] for r in df.select("k", "fold").collect()}
    f = np.array([folds[i] for i in range(400)])
    sse = 0.0
    for k in range(5):
        tr, va = f != k, f == k
        b = np.linalg.solve(X[tr].T @ X[tr] + np.eye(4), X[tr].T @ y[tr])
        sse += ((X[va] @ b - y[va]) ** 2).sum()
    assert report[1][2] == pytest.approx(np.sqrt(sse / 400), rel=1e-9)


def test_logistic_newton_stationary(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(500, 2))
    p = 1 / (1 + np.exp(-(X @ [1.0, -1.0] + 0.2)))
    y = (rng.random(500) < p).astype(float)
    df = spark.createDataFrame([(1.0, float(a), float(b), float(t)) for (a, b), t in zip(X, y)], "c double, a double, b double, y double")
    w = logistic.fit_logistic(df, ["c", "a", "b"], "y", reg=0.5, solver="newton", conv_norm=1e-8)
    Z = np.column_stack([np.ones(500), X])
    s = 1 / (1 + np.exp(-Z @ w))
    grad = Z.T @ (s - y) + 2 * 0.5 * w
    assert np.linalg.norm(grad) < 1e-6


def test_logistic_folds_match_single(spark):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(300, 1))
    y = (X[:, 0] + rng.normal(size=300) > 0).astype(float)
    df = spark.createDataFrame([(i, 1.0, float(X[i, 0]), float(y[i])) for i in range(300)], "k long, c double, a double, y double")
    df = with_folds(df, "k", 3)
    W, _ = logistic.logistic_steps(df, ["c", "a"], "y", reg=0.1, solver="newton", fold="fold", conv_norm=1e-9)
    for k in range(3):
        single = logistic.fit_logistic(df.filter(F.col("fold") != k), ["c", "a"], "y", reg=0.1, conv_norm=1e-9)
        assert np.allclose(W[k], single, atol=1e-7)


def test_pca_properties(spark):
    e = table(spark, SF_SMALL, "embeddings")
    model = decompose.pca(e, "embedding", 6, whiten=True)
    C = model.components
    assert np.allclose(C @ C.T, np.eye(6), atol=1e-10)
    assert np.all(np.diff(model.variance) <= 1e-12)
    assert np.all(np.diff(model.cumulative_ratio) >= 0)
    pcs = np.array([r["pcs"] for r in decompose.pca_transform(e, "embedding", model).collect()])
    assert np.allclose(np.cov(pcs.T), np.eye(6), atol=1e-8)


def test_wide_svd_matches_numpy(spark):
    e = table(spark, SF_SMALL, "embeddings").orderBy("vec_id")
    A = np.array([r["embedding"] for r in e.collect()], dtype=float).T  # d x N
    U, s, v = decompose.wide_svd(e, "embedding", 3)
    U2, s2, _ = np.linalg.svd(A - A.mean(axis=0), full_matrices=False)
    assert np.allclose(s, s2[:3], rtol=1e-8)
    for j in range(3):
        assert min(np.abs(U[:, j] - U2[:, j]).max(), np.abs(U[:, j] + U2[:, j]).max()) < 1e-6


def test_kmeans_assignment_is_nearest(spark):
    e = table(spark, SF_SMALL, "embeddings")
    centres, cost, _ = cluster.kmeans_best(e, "embedding", k=3, restarts=2, seed=1)
    rows = cluster.assign(e, "embedding", centres.tolist()).collect()
    for r in rows:
        x = np.array(r["embedding"], dtype=float)
        d = ((centres - x) ** 2).sum(axis=1)
        assert r["cluster"] == int(np.argmin(d))


def test_bagging_mean_of_models(spark, reg_data):
    df, X, y = reg_data
    mean, coefs = fit_bagged(df, ["c", "a", "b", "d"], "y", "k", times=4)
    assert len(coefs) == 4
    assert np.allclose(mean, np.mean(coefs, axis=0))
    assert np.allclose(mean, [0.3, 1.5, -2.0, 0.5], atol=0.1)


def test_gaussian_linear_equals_quadratic(spark):
    e = table(spark, SF_MID, "embeddings").select(
        F.col("embedding")[0].cast("double").alias("a"), F.col("embedding")[1].cast("double").alias("b"),
        (F.col("label") >= 5).cast("int").alias("y"))
    m = fit_gaussian(e, ["a", "b"], "y", shared=True)
    inv = np.linalg.inv(m.cov)
    lin = e.select(gaussian_logit(["a", "b"], m).alias("z"), "a", "b").collect()
    for r in lin[:50]:
        x = np.array([r["a"], r["b"]])
        q = -0.5 * ((x - m.mu1) @ inv @ (x - m.mu1) - (x - m.mu0) @ inv @ (x - m.mu0)) + np.log(m.n1 / m.n0)
        assert r["z"] == pytest.approx(q, abs=1e-9)


ORDER_SENSITIVE = ["q_lags", "q_filter_vocab", "q_ffill", "q_event_lags", "q_dictionary_encode", "q_union_split",
                   "q_repair_zeros_carry", "q_pad"]


def test_same_result_any_partitioning(spark):
    from tessera.plans.registry import QUERIES, load_all

    load_all()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = {n: sorted(map(tuple, QUERIES[n](spark, SF_SMALL).collect())) for n in ORDER_SENSITIVE}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        many = {n: sorted(map(tuple, QUERIES[n](spark, SF_SMALL).collect())) for n in ORDER_SENSITIVE}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for n in ORDER_SENSITIVE:
        assert one[n] == many[n], n


def test_mllib_paths_match_own_solvers(spark, reg_data):
    from tessera.operators.linear import fit_ridge_mllib
    from tessera.operators.logistic import fit_logistic_mllib

    df, X, y = reg_data
    # ridge without a constant column: every coefficient penalised in both
    _, b = fit_ridge_mllib(df, ["a", "b", "d"], "y", lam=5.0, fit_intercept=False)
    Z = X[:, 1:]
    assert np.allclose(b, np.linalg.solve(Z.T @ Z + 5.0 * np.eye(3), Z.T @ y), atol=1e-8)
    yb = (y > 0).astype(float)
    d2 = spark.createDataFrame([(float(r[1]), float(r[2]), float(r[3]), float(t)) for r, t in zip(X, yb)],
                               "a double, b double, d double, y double")
    _, w_ml = fit_logistic_mllib(d2, ["a", "b", "d"], "y", reg=0.5, fit_intercept=False)
    w_own = logistic.fit_logistic(d2, ["a", "b", "d"], "y", reg=0.5, solver="newton", conv_norm=1e-10)
    assert np.allclose(w_ml, w_own, atol=1e-5)


def test_bootstrap_weights_poisson(spark):
    from tessera.operators.split import bootstrap

    df = spark.range(20000).withColumnRenamed("id", "k")
    out = bootstrap(df, "k", 3, seed=5)
    total = out.agg(F.sum("w")).first()[0]
    assert abs(total / 60000 - 1.0) < 0.02           # E[w] = 1
    kept = out.count() / 60000
    assert abs(kept - (1 - np.exp(-1))) < 0.01        # P(w > 0) = 1 - 1/e
    again = bootstrap(df, "k", 3, seed=5)
    assert sorted(map(tuple, out.collect()))[:50] == sorted(map(tuple, again.collect()))[:50]


def test_grouped_threshold_and_all_rows_model(spark):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(600, 1))
    y = (X[:, 0] + rng.normal(size=600) > 0.3).astype(float)
    df = spark.createDataFrame([(i, 1.0, float(X[i, 0]), float(y[i])) for i in range(600)],
                               "k long, c double, a double, y double")
    df = with_folds(df, "k", 4)
    W, _ = logistic.logistic_steps(df, ["c", "a"], "y", reg=0.1, solver="newton", fold="fold",
                                   folds=[0, 1, 2, 3], conv_norm=1e-9, include_all=True)
    single = logistic.fit_logistic(df, ["c", "a"], "y", reg=0.1, conv_norm=1e-9)
    assert np.allclose(W[logistic.ALL_ROWS], single, atol=1e-7)
    grouped = logistic.best_threshold_by_fold(df, ["c", "a"], "y", W, "fold")
    for m in range(4):
        scored = logistic.predict_proba(df.filter(F.col("fold") != m), ["c", "a"], W[m], "p")
        assert grouped[m] == logistic.best_threshold(scored, "p", "y")


def test_explained_variance_monotone(spark):
    from tessera.plans.registry import QUERIES, load_all

    load_all()
    rows = QUERIES["q_explained_variance"](spark, SF_SMALL).orderBy("component").collect()
    cum = [r["cumulative"] for r in rows]
    var = [r["variance"] for r in rows]
    assert all(b >= a for a, b in zip(cum, cum[1:])) and cum[-1] <= 1.0 + 1e-12
    assert all(b <= a + 1e-15 for a, b in zip(var, var[1:]))


def test_missing_values_count_alike_on_both_gram_paths(spark):
    rows = [(float(i % 7), float(i * i % 11), float(i)) for i in range(60)] + [(None, 1.0, 2.0), (3.0, 1.0, None)]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "a double, b double, y double").repartition(parts)
        sql, partition = (stats.gram(df, ["a", "b"], "y", method=m)[()] for m in ("sql", "partition"))
        assert sql.n == partition.n == 60
        assert np.allclose(sql.xx, partition.xx) and np.allclose(sql.xy, partition.xy) and np.isclose(sql.yy, partition.yy)


def test_covariance_of_large_values(spark):
    rng = np.random.default_rng(1)
    x = 1e8 + rng.standard_normal((2000, 2))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double")
    g = stats.centred_gram(df, ["a", "b"])[()]
    assert np.allclose(g.covariance(1), np.cov(x.T), rtol=1e-6) and np.allclose(g.mean(), x.mean(0))


def test_arrays_of_differing_length_are_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0],)], "v array<double>")
    with pytest.raises(ValueError):
        decompose.array_gram(df, "v")


def test_poisson_weights_equal_the_bootstrap_expression(spark):
    from tessera.operators.split import bootstrap, poisson_weights

    keys = [0, 1, 7, 2**31, 2**40 + 3, 123456789]
    rows = bootstrap(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 12, seed=3).collect()
    want = np.zeros((len(keys), 12), int)
    for r in rows:
        want[keys.index(r["k"]), r["bag"] - 1] = r["w"]
    assert np.array_equal(poisson_weights(keys, 12, seed=3), want)


def test_fold_fits_hold_one_copy_of_the_rows(spark):
    """Persisted rows don't grow with the number of models, and odd rows are in none of them."""
    rng = np.random.default_rng(4)
    rows = [(int(i % 6), 1.0, float(a), float(b), float(a + b + e > 0)) for i, (a, b, e) in enumerate(rng.normal(size=(600, 3)))]
    odd = [(0, 1.0, None, 1.0, 1.0), (1, 1.0, 1.0, 1.0, None), (None, 1.0, 1.0, 1.0, 1.0)]
    schema = "f int, c double, a double, b double, y double"
    df = spark.createDataFrame(rows + odd, schema).repartition(3)
    seen = []
    persist = type(df).persist
    try:
        type(df).persist = lambda self, *a: (seen.append(self.count()), persist(self, *a))[1]
        w, _ = logistic.logistic_steps(df, ["c", "a", "b"], "y", reg=0.5, fold="f", folds=range(6), include_all=True, conv_norm=1e-8)
    finally:
        type(df).persist = persist
    assert seen == [len(rows) + len(odd)]
    for m in [0, 5]:
        alone, _ = logistic.logistic_steps(spark.createDataFrame([r for r in rows if r[0] != m], schema), ["c", "a", "b"], "y", reg=0.5, conv_norm=1e-8)
        assert np.allclose(w[m], alone[None], atol=1e-9)
    whole, _ = logistic.logistic_steps(spark.createDataFrame(rows, schema), ["c", "a", "b"], "y", reg=0.5, conv_norm=1e-8)
    assert np.allclose(w[-1], whole[None], atol=1e-9)


def test_bagging_reads_its_rows_once(spark):
    from tessera.operators.linear import bagged_grams
    from tessera.operators.split import bootstrap
    from tessera.operators.stats import gram

    rng = np.random.default_rng(5)
    rows = [(i, 1.0, float(a), float(2 * a + e)) for i, (a, e) in enumerate(rng.normal(size=(300, 2)))] + [(None, 1.0, 1.0, 1.0), (900, 1.0, None, 1.0)]
    df = spark.createDataFrame(rows, "k long, c double, a double, y double").repartition(4)
    got = bagged_grams(df, ["c", "a"], "y", "k", 9, seed=2)
    want = gram(bootstrap(df.filter("k is not null"), "k", 9, 2), ["c", "a"], "y", by=["bag"], weight="w")
    for b in range(9):
        assert np.allclose(got[b].xx, want[(b + 1,)].xx) and np.allclose(got[b].xy, want[(b + 1,)].xy)
