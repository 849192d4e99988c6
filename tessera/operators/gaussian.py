"""Gaussian discriminants.

One aggregation pass keyed by class gives counts, sums and X'X per class; means,
the total covariance (shared model) or per-class covariances (own model) follow
on the driver (k x k). Scoring with a shared covariance is linear (the quadratic
terms cancel), so it is one literal dot product; own covariances give a quadratic
form, evaluated as literal expressions for small k and with NumPy per Arrow
batch (mapInPandas) for large k.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import c, dot_literal, sigmoid
from tessera.operators.stats import centred_gram

QUAD_EXPR_MAX_K = 16


@dataclass
class GaussianModel:
    shared: bool
    n0: float
    n1: float
    mu0: np.ndarray
    mu1: np.ndarray
    cov: np.ndarray | None = None
    cov0: np.ndarray | None = None
    cov1: np.ndarray | None = None

    def linear(self) -> tuple[np.ndarray, float]:
        """Shared covariance: z = w'x + b."""
        inv = np.linalg.inv(self.cov)
        w = inv @ (self.mu1 - self.mu0)
        b = -0.5 * (self.mu1 @ inv @ self.mu1 - self.mu0 @ inv @ self.mu0) + np.log(self.n1 / self.n0)
        return w, float(b)


def fit_gaussian(df: DataFrame, x: Sequence[str], y: str, shared: bool = True) -> GaussianModel:
    """Class-conditional Gaussians for y in {0, 1}.

    The shared matrix is the covariance of all rows (n-1), not the pooled
    within-class one, as in the original.
    """
    per = centred_gram(df, x, by=[y])
    g0, g1 = per[(0,)], per[(1,)]
    mu0, mu1 = g0.mean(), g1.mean()
    if shared:
        return GaussianModel(True, g0.n, g1.n, mu0, mu1, cov=(g0 + g1).covariance(1))
    return GaussianModel(False, g0.n, g1.n, mu0, mu1, cov0=g0.covariance(1), cov1=g1.covariance(1))


def _quad_expr(x: Sequence[str], A: np.ndarray, mu: np.ndarray) -> Column:
    d = [c(v) - F.lit(float(m)) for v, m in zip(x, mu)]
    out = None
    for i in range(len(x)):
        inner = None
        for j in range(len(x)):
            t = d[j] * F.lit(float(A[i, j]))
            inner = t if inner is None else inner + t
        term = d[i] * inner
        out = term if out is None else out + term
    return out


def gaussian_logit(x: Sequence[str], model: GaussianModel) -> Column:
    if model.shared:
        w, b = model.linear()
        return dot_literal(x, w, b)
    i0, i1 = np.linalg.inv(model.cov0), np.linalg.inv(model.cov1)
    _, ld0 = np.linalg.slogdet(model.cov0)
    _, ld1 = np.linalg.slogdet(model.cov1)
    const = 0.5 * (ld0 - ld1) + np.log(model.n1 / model.n0)
    return F.lit(float(const)) - F.lit(0.5) * (_quad_expr(x, i1, model.mu1) - _quad_expr(x, i0, model.mu0))


def predict_gaussian(df: DataFrame, x: Sequence[str], model: GaussianModel, out: str = "p1") -> DataFrame:
    """P(y = 1 | x)."""
    if model.shared or len(x) <= QUAD_EXPR_MAX_K:
        return df.withColumn(out, sigmoid(gaussian_logit(x, model)))
    i0, i1 = np.linalg.inv(model.cov0), np.linalg.inv(model.cov1)
    _, ld0 = np.linalg.slogdet(model.cov0)
    _, ld1 = np.linalg.slogdet(model.cov1)
    const = 0.5 * (ld0 - ld1) + np.log(model.n1 / model.n0)
    cols = list(x)
    mu0, mu1 = model.mu0, model.mu1

    def score(batches):
        for pdf in batches:
            X = pdf[cols].to_numpy(dtype=float)
            d0, d1 = X - mu0, X - mu1
            z = const - 0.5 * (np.einsum("ij,jk,ik->i", d1, i1, d1) - np.einsum("ij,jk,ik->i", d0, i0, d0))
            yield pdf.assign(**{out: 1.0 / (1.0 + np.exp(-z))})

    from pyspark.sql import types as T

    schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.DoubleType())])
    return df.mapInPandas(score, schema)
