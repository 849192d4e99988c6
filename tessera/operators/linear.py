"""Linear models: quadratic minimiser, ridge CV on fold-keyed Gram, bagging (M4-M7).

The data pass is one Spark aggregation keyed by fold (or bag); the k x k algebra
runs on the driver. Nothing row-sized ever leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import dot_literal
from tessera.operators.split import poisson_weights
from tessera.operators.stats import Gram, complete_rows, gram, sum_partition_rows


def minimize_quadratic(Q, p, x0=None, step="best", conv_norm: float = 0.1, max_iter: int = 100,
                       ada: bool = False) -> np.ndarray:
    """argmin 0.5 b'Qb + p'b (M4): ``'analytic'`` solves Qb = -p, other modes descend.

    ``step='best'`` moves to the minimum along the gradient, a number is a fixed rate;
    ``ada`` divides each coordinate by the root of its squared gradients so far (Adagrad).
    """
    Q, p = np.asarray(Q, float), np.asarray(p, float)
    if step == "analytic":  # minimum-norm solution where Q is singular (collinear features, lambda 0)
        return np.linalg.lstsq(Q, -p, rcond=None)[0] if np.linalg.matrix_rank(Q) < len(p) else np.linalg.solve(Q, -p)

    def rate(g):
        if step != "best":
            return float(step)
        curvature = g @ Q @ g
        return g @ g / curvature if curvature > 0 else 0.0

    b, squares = np.zeros(len(p)) if x0 is None else np.array(x0, float), np.zeros(len(p))
    for _ in range(max_iter + 1):
        g = Q @ b + p
        if np.linalg.norm(g) < conv_norm:
            break
        squares += g * g
        b = b - rate(g) * (g / np.sqrt(np.maximum(squares, np.finfo(float).tiny)) if ada else g)
    return b


def ridge_solve(g: Gram, lam: float, step="analytic", **kw) -> np.ndarray:
    """argmin |Xb - y|^2 + lam |b|^2 (every coefficient penalised, the constant too),
    i.e. the quadratic 0.5 b'Qb + p'b with Q = 2(X'X + lam I), p = -2X'y (M4)."""
    Q = 2.0 * (g.xx + lam * np.eye(g.k))
    return minimize_quadratic(Q, -2.0 * g.xy, step=step, **kw)


def fold_sse(g: Gram, b: np.ndarray) -> float:
    """Sum of squared errors of b on the rows summarised by g: y'y - 2b'X'y + b'X'Xb."""
    return float(g.yy - 2.0 * b @ g.xy + b @ g.xx @ b)


def fit_ridge_cv(df: DataFrame, x: Sequence[str], y: str, lambdas: Sequence[float], fold: str = "fold"):
    """Ridge over a lambda grid with k-fold CV, refit on all rows.

    One aggregation pass keyed by fold gives G_k; the training Gram of fold k is
    G - G_k, and fold k's SSE comes from its own sums. Returns
    ``(coef, best_index, report)`` with report rows (lambda_index, lambda, rmse,
    coefficients refitted on all rows with that lambda).
    """
    per_fold = gram(df, x, y, by=[fold])
    total = Gram(len(x))
    for g in per_fold.values():
        total = total + g
    report = []
    for m, lam in enumerate(lambdas):
        sse = 0.0
        for g_k in per_fold.values():
            b = ridge_solve(total - g_k, lam)
            sse += fold_sse(g_k, b)
        report.append((m, float(lam), float(np.sqrt(sse / total.n)), ridge_solve(total, lam)))
    best = min(report, key=lambda r: (r[2], r[0]))[0]
    return report[best][3], best, report


def predict_linear(df: DataFrame, x: Sequence[str], coef: Sequence[float], out: str = "prediction") -> DataFrame:
    """w'x with literal coefficients (M6): one unrolled codegen expression."""
    return df.withColumn(out, dot_literal(x, coef))


def bagged_grams(df: DataFrame, x: Sequence[str], y: str, key: str, times: int, seed: int = 0) -> list[Gram]:
    """The Gram matrices of ``times`` bootstrap samples from one read of the rows.

    Each batch draws its rows' multiplicities for all bags (the draws of ``bootstrap``) and one
    product of (bags x rows) by (rows x pairs of columns) adds it to every bag's matrix; no row is
    copied per bag. A partition emits one row a bag, summed in two levels. Rows with a NULL in the design, target or key are left out.
    """
    import pandas as pd

    x = list(x)
    k = len(x)
    i, j = np.triu_indices(k + 2)
    packed = complete_rows(df, [*x, y]).filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("__key"), F.array(*[F.col(v).cast("double") for v in [*x, y]]).alias("__z"))

    def run(batches):
        total = np.zeros((times, len(i)))
        for pdf in batches:
            if pdf.empty:
                continue
            z = np.vstack(pdf["__z"].to_numpy())
            z = np.column_stack([z, np.ones(len(z))])
            total += poisson_weights(pdf["__key"].to_numpy(), times, seed).T.astype(float) @ (z[:, i] * z[:, j])
        yield pd.DataFrame({"__i": np.arange(times, dtype=np.int32), "__row": list(total)})

    sums = sum_partition_rows(packed.mapInPandas(run, "__i int, __row array<double>"), [], times, len(i)).get((), np.zeros((times, len(i))))
    out = []
    for row in sums:
        m = np.zeros((k + 2, k + 2))
        m[i, j] = m[j, i] = row
        out.append(Gram(k, m[k + 1, k + 1], m[k + 1, :k], m[:k, :k], m[:k, k], m[k + 1, k], m[k, k]))
    return out


def fit_bagged(df: DataFrame, x: Sequence[str], y: str, key: str, times: int, lam: float = 0.0,
               seed: int = 0) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bagged ridge (M7): ``times`` bootstrap fits from one pass over the rows. The mean of linear
    models is one linear model, so scoring uses the averaged coefficients. Returns (mean
    coefficients, per-bag coefficients)."""
    coefs = [ridge_solve(g, lam) for g in bagged_grams(df, x, y, key, times, seed)]
    return np.mean(coefs, axis=0), coefs


def bagging_curve(coefs: list[np.ndarray]) -> list[np.ndarray]:
    """Averaged coefficients after the first b bags, b = 1..B (scores RMSE per b)."""
    cs = np.cumsum(np.asarray(coefs), axis=0)
    return [cs[i] / (i + 1) for i in range(len(coefs))]


def linear_term(x: Sequence[str], coef: Sequence[float]) -> Column:
    return dot_literal(x, coef)


def fit_ridge_mllib(df: DataFrame, x: Sequence[str], y: str, lam: float, fit_intercept: bool = True):
    """MLlib path (unpenalised intercept): ``regParam = lam * stddev_pop(y) / n`` with no
    standardisation reproduces ``|Xb - y|^2 + lam |b|^2`` on the non-intercept coefficients
    (MLlib scales the label internally). Returns (intercept, coefficients)."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    n, sd = df.agg(F.count(F.lit(1)), F.stddev_pop(y)).first()
    data = df.select(array_to_vector(F.array(*[F.col(v).cast("double") for v in x])).alias("features"),
                     F.col(y).cast("double").alias("label"))
    lr = LinearRegression(regParam=lam * sd / n, elasticNetParam=0.0, standardization=False,
                          fitIntercept=fit_intercept, solver="normal")
    m = lr.fit(data)
    return float(m.intercept), np.array(m.coefficients.toArray())
