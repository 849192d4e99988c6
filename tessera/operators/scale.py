"""Standardisation with whole-table statistics.

The statistics are one aggregate job; they return as a small dict and enter the
projection as literals, so scoring data can reuse training statistics
(``stats=``) or recompute its own (``stats=None``, the original behaviour).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import c
from tessera.operators.stats import moments


def standardize(df: DataFrame, cols: Sequence[str], stats: dict | None = None):
    """(x - mean) / sample std, NULL where the column is constant; returns (df, stats)."""
    stats = stats or moments(df, cols, sample=True)
    out = df.select(*[F.try_divide(c(n) - F.lit(stats[n][0]), F.lit(stats[n][1])).alias(n) if n in stats else c(n)
                      for n in df.columns])
    return out, stats


def znorm(df: DataFrame, cols: Sequence[str], eps: float = 1e-4, stats: dict | None = None):
    """(x - mean) / (population std + eps); returns (df, stats)."""
    stats = stats or moments(df, cols, sample=False)
    out = df.select(*[((c(n) - F.lit(stats[n][0])) / (F.lit(stats[n][1]) + F.lit(eps))).alias(n)
                      if n in stats else c(n) for n in df.columns])
    return out, stats


def unstandardize(df: DataFrame, col: str, mean: float, std: float) -> DataFrame:
    """p * std + mean (F32)."""
    return df.withColumn(col, c(col) * F.lit(float(std)) + F.lit(float(mean)))
