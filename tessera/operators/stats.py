"""One-pass aggregates.

Everything here is a partial + final aggregation: map tasks combine their rows
first, so a group holding a third of the table costs one partial row per task,
not a third of the table in one task. Results that are k x k matrices or
parameter vectors come back to the driver (their size is bounded by k, not by rows).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import c

# Above this many features the Gram matrix is built per partition with NumPy
# (mapInPandas) instead of k(k+1)/2 SQL sum expressions. Measured: at k = 23 the
# generated aggregate takes ~2 s to compile (and iterative fits recompile it every
# step, since weights enter as literals) against ~0.4 s for the NumPy path.
GRAM_SQL_MAX_K = 8


def moments(df: DataFrame, cols: Sequence[str], sample: bool = True) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation of each column in one job (A1 n-1, A2 n)."""
    sd = F.stddev_samp if sample else F.stddev_pop
    aggs = []
    for i, x in enumerate(cols):
        aggs += [F.avg(c(x)).alias(f"m{i}"), sd(c(x)).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {x: (row[f"m{i}"], row[f"s{i}"]) for i, x in enumerate(cols)}


def class_priors(df: DataFrame, y: str) -> DataFrame:
    """Class counts (A4)."""
    return df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))


def class_means(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Per-class mean of each feature (A5)."""
    return df.groupBy(y).agg(*[F.avg(c(x)).alias(x) for x in cols])


def complete_rows(df: DataFrame, cols: Sequence, y=None, weight=None) -> DataFrame:
    """Rows without a missing feature, target or weight: only these count in any Gram statistic, n included."""
    present = F.lit(True)
    for x in [*cols, *(v for v in (y, weight) if v is not None)]:
        present = present & c(x).isNotNull()
    return df.filter(present)


def gram_sql(df: DataFrame, cols: Sequence[str], y: str | None = None, by: Sequence[str] = (),
             weight: str | Column | None = None, weight_y: bool = True, exact: str | None = None) -> DataFrame:
    """Sufficient statistics per group as columns: n, s_i, ss_i_j (i<=j), sy_i, syy, sy.

    ``exact`` (a decimal type such as ``decimal(18,2)``) sums exact products of
    fixed-point inputs instead of doubles.

    With ``weight_y=False`` the weight applies to X'X only and X'y stays unweighted
    (a Newton step needs X'WX and X'r from the same pass).
    """
    w = (c(weight) if weight is not None else None)
    xs = [c(x).cast(exact or "double") for x in cols]

    def wsum(e):
        return F.sum(e * w if w is not None else e)

    def ysum(e):
        return wsum(e) if weight_y else F.sum(e)

    df = complete_rows(df, cols, y, weight)
    aggs = [(F.sum(w) if w is not None else F.count(F.lit(1)).cast("double")).alias("n")]
    aggs += [wsum(xs[i]).alias(f"s_{i}") for i in range(len(xs))]
    aggs += [wsum(xs[i] * xs[j]).alias(f"ss_{i}_{j}") for i in range(len(xs)) for j in range(i, len(xs))]
    if y is not None:
        yy = c(y).cast(exact or "double")
        aggs += [ysum(xs[i] * yy).alias(f"sy_{i}") for i in range(len(xs))]
        aggs += [ysum(yy).alias("sy"), ysum(yy * yy).alias("syy")]
    return df.groupBy(*by).agg(*aggs)


def covariance_sql(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sample covariance of every pair (A7) with the numerically stable built-in
    ``covar_samp``; one grouped aggregation."""
    aggs = [F.covar_samp(c(cols[i]), c(cols[j])).alias(f"cov_{i}{j}")
            for i in range(len(cols)) for j in range(i, len(cols))]
    return df.groupBy(*by).agg(*aggs)


class Gram:
    """Sufficient statistics of one group: n, sum x, X'X, X'y, sum y, y'y."""

    def __init__(self, k: int, n=0.0, sx=None, xx=None, xy=None, sy=0.0, yy=0.0, shift=0.0):
        self.k = k
        self.shift = shift  # what was taken off the features before summing
        self.n = float(n)
        self.sx = np.zeros(k) if sx is None else np.asarray(sx, float)
        self.xx = np.zeros((k, k)) if xx is None else np.asarray(xx, float)
        self.xy = np.zeros(k) if xy is None else np.asarray(xy, float)
        self.sy = float(sy)
        self.yy = float(yy)

    def __add__(self, o: "Gram") -> "Gram":
        return Gram(self.k, self.n + o.n, self.sx + o.sx, self.xx + o.xx, self.xy + o.xy, self.sy + o.sy, self.yy + o.yy, self.shift)

    def __sub__(self, o: "Gram") -> "Gram":
        return Gram(self.k, self.n - o.n, self.sx - o.sx, self.xx - o.xx, self.xy - o.xy, self.sy - o.sy, self.yy - o.yy, self.shift)

    def mean(self) -> np.ndarray:
        return self.sx / self.n + self.shift

    def covariance(self, ddof: int = 1) -> np.ndarray:
        """Covariance (A7); exact to rounding only for sums of shifted features (``centred_gram``)."""
        mu = self.sx / self.n
        return (self.xx - self.n * np.outer(mu, mu)) / (self.n - ddof)


def _row_to_gram(row, k: int, has_y: bool) -> Gram:
    xx = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            xx[i, j] = xx[j, i] = row[f"ss_{i}_{j}"] or 0.0
    sx = [row[f"s_{i}"] or 0.0 for i in range(k)]
    if has_y:
        return Gram(k, row["n"] or 0.0, sx, xx, [row[f"sy_{i}"] or 0.0 for i in range(k)], row["sy"] or 0.0, row["syy"] or 0.0)
    return Gram(k, row["n"] or 0.0, sx, xx)


def gram(df: DataFrame, cols: Sequence[str], y: str | None = None, by: Sequence[str] = (),
         weight: str | None = None, method: str = "auto", weight_y: bool = True) -> dict[tuple, Gram]:
    """X'X, X'y and sums per group, collected as k x k NumPy matrices.

    ``method='sql'``: one aggregate with k(k+1)/2 sum columns (codegen, partial agg).
    ``method='partition'``: each partition builds its matrices with NumPy on Arrow
    batches (mapInPandas) and emits one row per (group, matrix row); a final
    grouped element-wise sum combines partitions.
    """
    k = len(cols)
    by = list(by)
    if method == "auto":
        method = "sql" if k <= GRAM_SQL_MAX_K else "partition"
    if method == "sql":
        rows = gram_sql(df, cols, y, by, weight, weight_y).collect()
        return {tuple(r[b] for b in by): _row_to_gram(r, k, y is not None) for r in rows}
    return _gram_partition(df, cols, y, by, weight, weight_y)


def _gram_partition(df, cols, y, by, weight, weight_y=True):
    k = len(cols)
    has_y = y is not None
    df = complete_rows(df, cols, y, weight)
    width = k + 2  # [x..., y, 1]; row i of the augmented (k+2) x (k+2) matrix
    sel = [F.col(b).alias(f"__g{i}") for i, b in enumerate(by)]
    sel += [F.array(*[c(x).cast("double") for x in cols]).alias("__x")]
    sel += [(c(y).cast("double") if has_y else F.lit(0.0)).alias("__y")]
    sel += [(c(weight).cast("double") if weight else F.lit(1.0)).alias("__w")]
    src = df.select(*sel)
    gcols = [f"__g{i}" for i in range(len(by))]

    def partial(batches):
        acc: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            keys = [tuple(r) for r in pdf[gcols].itertuples(index=False)] if gcols else [()] * len(pdf)
            z = np.column_stack([np.vstack(pdf["__x"].to_numpy()), pdf["__y"].to_numpy(), np.ones(len(pdf))])
            w = pdf["__w"].to_numpy()
            kser = pd.Series(keys)
            for key, idx in kser.groupby(kser).groups.items():
                zi, wi = z[idx], w[idx]
                m = (zi * wi[:, None]).T @ zi
                if not weight_y:
                    m[:, k] = zi.T @ zi[:, k]
                    m[k, :] = m[:, k]
                acc[key] = acc.get(key, 0) + m
        for key, m in acc.items():
            yield pd.DataFrame({
                **{g: [key[i]] * width for i, g in enumerate(gcols)},
                "__i": np.arange(width, dtype=np.int32),
                "__row": list(m),
            })

    schema = T.StructType(
        [T.StructField(g, df.schema[b].dataType) for g, b in zip(gcols, by)]
        + [T.StructField("__i", T.IntegerType()), T.StructField("__row", T.ArrayType(T.DoubleType()))]
    )
    parts = src.mapInPandas(partial, schema)
    mats = sum_partition_rows(parts, gcols, width, width)
    out = {}
    for key, m in mats.items():
        out[key] = Gram(k, m[k + 1, k + 1], m[k + 1, :k], m[:k, :k], m[:k, k] if has_y else None,
                        m[k + 1, k] if has_y else 0.0, m[k, k] if has_y else 0.0)
    return out


def centred_gram(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> dict[tuple, Gram]:
    """Gram matrices of the features less their overall means: means and covariances that don't cancel."""
    rows = complete_rows(df, cols)
    first = rows.agg(*[F.avg(c(x).cast("double")).alias(f"m{i}") for i, x in enumerate(cols)]).first()
    shift = np.array([v or 0.0 for v in first], float)
    names = [f"__c{i}" for i in range(len(cols))]
    moved = rows.select(*by, *[(c(x).cast("double") - F.lit(float(m))).alias(n) for x, m, n in zip(cols, shift, names)])
    out = gram(moved, names, by=by)
    for g in out.values():
        g.shift = shift
    return out


def sum_partition_rows(parts: DataFrame, gcols: Sequence[str], n_rows: int, width: int) -> dict[tuple, np.ndarray]:
    """Combine per-partition matrices emitted as rows (group..., ``__i``, ``__row``).

    Element-wise sums in two levels: first within buckets of partitions (the whole root of the
    partition id), then across buckets, so of P partitions no task ever holds more than about
    2 sqrt(P) arrays of one row; only the final n_rows x width matrix per group reaches the driver.
    """
    zero = F.array_repeat(F.lit(0.0), width)

    def vsum(col):
        return F.aggregate(F.collect_list(col), zero, lambda a, r: F.zip_with(a, r, lambda p, q: p + q))

    salted = parts.withColumn("__s", F.floor(F.sqrt(F.spark_partition_id())))
    level1 = salted.groupBy(*gcols, "__i", "__s").agg(vsum("__row").alias("__row"))
    summed = level1.groupBy(*gcols, "__i").agg(vsum("__row").alias("__row"))
    mats: dict[tuple, np.ndarray] = {}
    for r in summed.collect():
        key = tuple(r[g] for g in gcols)
        mats.setdefault(key, np.zeros((n_rows, width)))[r["__i"]] = r["__row"]
    return mats


def sse(df: DataFrame, pred: str, y: str) -> Column:
    return F.sum(F.pow(c(pred) - c(y), 2))


def rmse(df: DataFrame, pred: str, y: str) -> float:
    return df.agg(F.sqrt(F.avg(F.pow(c(pred) - c(y), 2)))).first()[0]


def accuracy(df: DataFrame, pred: str, y: str) -> float:
    return df.agg(F.avg((c(pred) == c(y)).cast("double"))).first()[0]


def pick_best(report: DataFrame, score: str, index: str, minimize: bool = True) -> DataFrame:
    """Arg-min (arg-max) over candidates; ties go to the lowest index."""
    key = F.struct(c(score) if minimize else -c(score), c(index))
    return report.agg(F.min_by(F.struct(*[c(x) for x in report.columns]), key).alias("best")).select("best.*")


def cv_report(scored: DataFrame, model: str, fold: str, pred: str, y: str) -> DataFrame:
    """Per (model, fold) SSE and counts, combined to RMSE = sqrt(sum SSE / n) per model."""
    per_fold = scored.groupBy(model, fold).agg(
        F.sum(F.pow(c(pred) - c(y), 2)).alias("sse"), F.count(F.lit(1)).alias("n")
    )
    return per_fold.groupBy(model).agg(F.sqrt(F.sum("sse") / F.sum("n")).alias("rmse"))


def mean_vector(df: DataFrame, arr: str, out: str = "mean") -> DataFrame:
    """Average of an array column per position (A19): posexplode + grouped avg."""
    return df.select(F.posexplode(F.col(arr)).alias("pos", "v")).groupBy("pos").agg(F.avg("v").alias(out))


def mean_vector_np(df: DataFrame, arr: str) -> np.ndarray:
    rows = mean_vector(df, arr).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r["pos"]] = r["mean"]
    return out
