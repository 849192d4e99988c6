"""Cleaning operators on whole DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators.ranges import with_range


def _apply(df: DataFrame, cols: Sequence[str], fn) -> DataFrame:
    """Replace several columns in one projection (no withColumn loop)."""
    cols = set(cols)
    return df.select(*[fn(n).alias(n) if n in cols else S.c(n) for n in df.columns])


def to_numeric(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    return _apply(df, cols, lambda n: S.to_numeric(n, to))


def strip(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _apply(df, cols, S.strip)


def replace_value(df: DataFrame, col: str, old, new) -> DataFrame:
    return _apply(df, [col], lambda n: S.replace_value(n, old, new))


def floor_at(df: DataFrame, cols: Sequence[str], lo=0) -> DataFrame:
    return _apply(df, cols, lambda n: S.floor_at(n, lo))


def null_if(df: DataFrame, col: str, cond: Column) -> DataFrame:
    """Set ``col`` to NULL where ``cond`` holds (C5; a two-column ``cond`` is C6)."""
    return _apply(df, [col], lambda n: S.null_if(n, cond))


def clip(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return _apply(df, [col], lambda n: S.clip(n, lo, hi))


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(cols) if cols else None)


def filter_contrast(df: DataFrame, col: str, min_range: float = 50) -> DataFrame:
    """Keep rows whose array range is strictly above ``min_range``."""
    return df.filter(S.contrast(col) > min_range)


def with_row_id(df: DataFrame, order: Sequence[str], name: str = "row_id", start: int = 1,
                ranges: int | None = None) -> DataFrame:
    """Dense 1-based (or ``start``-based) row numbers in ``order`` (C12), without a
    single-partition window: rows are dealt to ranges by literal bounds, numbered inside
    their range, and the row count of all earlier ranges is added (one small row per range).

    Nulls come first; rows tied in ``order`` are numbered by a hash of the whole row, so the
    numbers depend on the rows alone and survive lost executors. An empty table stays empty.
    """
    from pyspark.sql import Window

    ranged = with_range(df, order, ranges)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")) \
        .select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy("__key"))
    # one row per range: bounded by MAX_RANGES, safe to broadcast
    out = ranged.withColumn("__local", inside).join(F.broadcast(offsets), "__range")
    return out.withColumn(name, F.col("__off") + F.col("__local") + F.lit(start - 1)) \
        .drop("__range", "__key", "__local", "__off")


def split_at(df: DataFrame, n: int, order: Sequence[str], name: str = "row_id"):
    """Positional slice (O4): the first ``n`` rows in ``order`` and the rest, as two
    DataFrames, numbered without a single-partition window."""
    numbered = with_row_id(df, order, name=name)
    return numbered.filter(F.col(name) <= n), numbered.filter(F.col(name) > n)
