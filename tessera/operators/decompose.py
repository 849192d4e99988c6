"""PCA, wide low-rank bases and reconstruction.

The data pass is always one Gram aggregation (d x d, partial per partition);
the eigen-decomposition of that d x d matrix runs on the driver, and the
projection of every row is a literal matrix product evaluated on executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import c
from tessera.operators.stats import Gram, centred_gram, gram


def _array_cols(df: DataFrame, arr: str, d: int) -> tuple[DataFrame, list[str]]:
    names = [f"__e{i}" for i in range(d)]
    return df.select(*[c(arr)[i].cast("double").alias(n) for i, n in enumerate(names)]), names


def array_gram(df: DataFrame, arr: str, d: int | None = None) -> Gram:
    d = d or array_length(df, arr)
    cols, names = _array_cols(df, arr, d)
    return gram(cols, names)[()]


def array_length(df: DataFrame, arr: str) -> int:
    """The one length of all arrays of a column; differing lengths are an error."""
    lo, hi = df.agg(F.min(F.size(arr)), F.max(F.size(arr))).first()
    if lo != hi or not lo:
        raise ValueError(f"{arr} has arrays of {lo} to {hi} values")
    return lo


@dataclass
class PCAModel:
    mean: np.ndarray
    components: np.ndarray  # k x d, rows orthonormal
    variance: np.ndarray  # eigenvalues (n-1 normalised), descending
    total_variance: float
    whiten: bool

    @property
    def explained_ratio(self) -> np.ndarray:
        return self.variance / self.total_variance

    @property
    def cumulative_ratio(self) -> np.ndarray:
        """Cumulative explained variance."""
        return np.cumsum(self.explained_ratio)


def pca(df: DataFrame, arr: str, k: int, whiten: bool = False) -> PCAModel:
    """Principal components of an array column."""
    cols, names = _array_cols(df, arr, array_length(df, arr))
    g = centred_gram(cols, names)[()]
    cov = g.covariance(1)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    # deterministic sign: largest-magnitude entry of each component positive
    signs = np.sign(vecs[np.abs(vecs).argmax(axis=0), range(vecs.shape[1])])
    vecs = vecs * np.where(signs == 0, 1, signs)
    return PCAModel(g.mean(), vecs[:, :k].T, vals[:k], float(vals.sum()), whiten)


def project(arr, mean: np.ndarray, basis: np.ndarray, scale: np.ndarray | None = None) -> Column:
    """Array column -> array of basis coordinates ((x - mean) . b_j [/ scale_j])."""
    x = c(arr)
    comps = []
    for j in range(basis.shape[0]):
        w = F.array(*[F.lit(float(v)) for v in basis[j]])
        m = F.array(*[F.lit(float(v)) for v in mean])
        z = F.aggregate(F.zip_with(F.zip_with(x, m, lambda a, b: a.cast("double") - b), w, lambda a, b: a * b),
                        F.lit(0.0), lambda acc, v: acc + v)
        if scale is not None:
            z = z / F.lit(float(scale[j]))
        comps.append(z)
    return F.array(*comps)


def pca_transform(df: DataFrame, arr: str, model: PCAModel, out: str = "pcs") -> DataFrame:
    scale = np.sqrt(model.variance) if model.whiten else None
    return df.withColumn(out, project(arr, model.mean, model.components, scale))


def _centred_rows(df: DataFrame, arr: str) -> DataFrame:
    """df with __a: each row's values less their mean, in time linear in the row.

    The mean is an element of an array that is generated and exploded, so it is a value of the row
    when the values are looped over; as an expression it would be summed up again for each of them.
    """
    mean = F.aggregate(c(arr), F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(c(arr))
    with_mean = df.select("*", F.explode(F.array(mean)).alias("__mean"))
    return with_mean.withColumn("__a", F.transform(c(arr), lambda v: v.cast("double") - F.col("__mean"))).drop("__mean")


def wide_svd(df: DataFrame, arr: str, k: int):
    """Low-rank basis of a wide matrix A (d x N) stored as N rows of length d.

    The d values of a row are one pixel of d images; the mean image, so each row's own
    mean, is taken off first. Dual form: A A' (d x d) is a sum over rows, built in one Gram pass; its
    eigenvectors are the left singular vectors U and s = sqrt(eigenvalues). The
    right singular vectors V = A'U / s are per-row projections, so they are a
    column computed on executors. Returns (U d x k, s, per-row V DataFrame).
    """
    rows = _centred_rows(df, arr)
    g = array_gram(rows.select("__a"), "__a")
    vals, vecs = np.linalg.eigh(g.xx)
    order = np.argsort(vals)[::-1][:k]
    vals, U = np.clip(vals[order], 0, None), vecs[:, order]
    signs = np.sign(U[np.abs(U).argmax(axis=0), range(U.shape[1])])
    U = U * np.where(signs == 0, 1, signs)
    s = np.sqrt(vals)
    v = rows.withColumn("v", project("__a", np.zeros(U.shape[0]), U.T, np.where(s > 0, s, 1.0))).drop("__a")
    return U, s, v


def reconstruct(df: DataFrame, arr: str, mean: np.ndarray, basis: np.ndarray, out: str = "recon") -> DataFrame:
    """x_hat = mean + sum_j ((x - mean) . b_j) b_j, each row stretched by its own extremes to 0..255.

    One array expression per basis vector; a row without spread is 0.
    """
    tmp = df.withColumn("__z", project(arr, mean, basis))
    image = F.array(*[F.lit(float(m)) for m in mean])
    for j, b in enumerate(basis):
        image = F.zip_with(image, F.array(*[F.lit(float(v)) for v in b]), _add_scaled(F.col("__z")[j]))
    tmp = tmp.withColumn("__r", image).withColumn("__lo", F.array_min("__r")).withColumn("__span", F.array_max("__r") - F.col("__lo"))
    stretched = F.transform("__r", lambda v: F.coalesce(F.floor(F.try_divide(v - F.col("__lo"), F.col("__span")) * 255), F.lit(0)).cast("int"))
    return tmp.withColumn(out, stretched).drop("__z", "__r", "__lo", "__span")


def _add_scaled(factor: Column):
    return lambda a, b: a + factor * b
