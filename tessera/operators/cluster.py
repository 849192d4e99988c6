"""Clustering: nearest-centre assignment, K-means with restarts, pair lookups."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import c
from tessera.operators.stats import sum_partition_rows

#: Tasks' sums of at most so many bytes in all go straight to the driver; more are added up by two shuffles first.
DIRECT_BYTES = 1 << 24


def sq_distance(arr, center: Sequence[float]) -> Column:
    """Squared Euclidean distance of an array column to a literal centre."""
    lit = F.array(*[F.lit(float(v)) for v in center])
    return F.aggregate(F.zip_with(c(arr), lit, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)),
                       F.lit(0.0), lambda acc, v: acc + v)


def assign(df: DataFrame, arr: str, centers: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """Index of the nearest centre (M17); ties go to the lowest index. Row-wise, no shuffle."""
    dists = F.array(*[sq_distance(arr, ctr) for ctr in centers])
    return df.withColumn(out, (F.array_position(dists, F.array_min(dists)) - 1).cast("int"))


def finite_vectors(df: DataFrame, arr: str) -> DataFrame:
    """The usable vectors as ``__v``: not null, without null, NaN or infinite elements."""
    v = F.transform(c(arr), lambda x: x.cast("double"))
    return df.select(v.alias("__v")).filter(
        F.col("__v").isNotNull() & F.forall("__v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))


def lloyd_step(vectors: DataFrame, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass for all models: counts (models, k), sums (models, k, d), costs (models, k).

    ``centers`` is (models, k, d); a row adds to the nearest centre of every model (ties to the lower
    index), inside its Arrow batch, so no row is copied per model. A task sends models x k rows.
    """
    models, k, d = centers.shape

    def run(batches):
        total = np.zeros((models * k, d + 2))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for m in range(models):
                distance = np.stack([((x - centre) ** 2).sum(axis=1) for centre in centers[m]], axis=1)
                near = distance.argmin(axis=1)
                best = distance[np.arange(len(x)), near]
                for j in range(k):
                    mine = near == j
                    total[m * k + j] += [np.count_nonzero(mine), *x[mine].sum(axis=0), best[mine].sum()]
        yield pa.RecordBatch.from_pydict({"__i": pa.array(np.arange(models * k), pa.int32()), "__row": total.tolist()})

    parts = vectors.mapInArrow(run, "__i int, __row array<double>")
    if vectors.rdd.getNumPartitions() * models * k * (d + 2) * 8 <= DIRECT_BYTES:
        sums = np.zeros((models * k, d + 2))
        for i, row in parts.collect():
            sums[i] += row
    else:
        sums = sum_partition_rows(parts, [], models * k, d + 2).get((), np.zeros((models * k, d + 2)))
    sums = sums.reshape(models, k, d + 2)
    return sums[:, :, 0], sums[:, :, 1:-1], sums[:, :, -1]


def lloyd(vectors: DataFrame, starts: np.ndarray, max_iter: int = 20, tol: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Lloyd's iterations of all models at once from given starts (models, k, d): (centres, costs).

    One Spark job a step, until no centre of any model moves by more than ``tol``; a centre without
    rows stays, and so does a model that has settled.
    """
    centers = np.array(starts, float)
    settled = np.zeros(len(centers), bool)
    for _ in range(max_iter):
        counts, sums, _ = lloyd_step(vectors, centers)
        means = np.where(counts[:, :, None] > 0, sums / np.maximum(counts, 1)[:, :, None], centers)
        moved = np.sqrt(((means - centers) ** 2).sum(axis=2)).max(axis=1)
        centers = np.where(settled[:, None, None], centers, means)
        settled |= moved <= tol
        if settled.all():
            break
    return centers, lloyd_step(vectors, centers)[2].sum(axis=1)


def _starts(sample: np.ndarray, k: int, restarts: int, seed: int) -> np.ndarray:
    """k-means++ starts of each restart from a sample; copies where it has fewer than k points."""
    out = []
    for r in range(restarts):
        rng = np.random.default_rng(seed + r)
        picked = [sample[rng.integers(len(sample))]]
        gap = ((sample - picked[0]) ** 2).sum(axis=1)
        while len(picked) < k:
            weight = gap / gap.sum() if gap.sum() > 0 else None
            picked.append(sample[rng.choice(len(sample), p=weight)])
            gap = np.minimum(gap, ((sample - picked[-1]) ** 2).sum(axis=1))
        out.append(picked)
    return np.array(out)


def kmeans_best(df: DataFrame, arr: str, k: int, restarts: int = 10, seed: int = 0, max_iter: int = 20,
                sample_rows: int = 4096):
    """K-means restarted with ``restarts`` seeds; the lowest within-cluster cost wins.

    All restarts run in the same passes (see ``lloyd``). Only their starts come from a sample: about
    ``sample_rows`` distinct vectors chosen by hash, on which k-means++ draws each restart's centres.
    Returns (centres as NumPy array, cost, seed used); of equal costs the lowest seed wins. Rows whose
    vector is null or holds null or non-finite elements count nowhere; vectors of several lengths, or
    none at all, are an error.
    """
    vectors = finite_vectors(df, arr).persist()
    try:
        n, low, high = vectors.agg(F.count("*"), F.min(F.size("__v")), F.max(F.size("__v"))).first()
        if not n or low != high:
            raise ValueError("K-means needs vectors of one length")
        buckets = 1 << 40
        chosen = F.pmod(F.xxhash64("__v", F.lit(seed)), F.lit(buckets)) < F.lit(math.ceil(min(1.0, sample_rows / n) * buckets))
        sample = vectors.filter(chosen).distinct().collect() or [vectors.first()]
        starts = _starts(np.array(sorted(list(r[0]) for r in sample)), k, restarts, seed)
        centers, costs = lloyd(vectors, starts, max_iter)
    finally:
        vectors.unpersist()
    best = int(costs.argmin())
    return centers[best], float(costs[best]), seed + best
