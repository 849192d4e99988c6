"""Long/wide reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import c


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "variable",
            value: str = "value", drop_missing: bool = True) -> DataFrame:
    """Unpivot ``cols`` to rows (P1). ``stack`` semantics drop missing values."""
    out = df.unpivot(list(ids), list(cols), name, value)
    return out.filter(F.col(value).isNotNull()) if drop_missing else out


def to_wide(df: DataFrame, keys: Sequence[str], item: str, value: str, levels: Sequence,
            agg: str = "first") -> DataFrame:
    """Pivot ``item`` values to columns.

    ``levels`` fixes the schema (no distinct-values job). Written as one conditional
    aggregate per level rather than ``pivot()``: Spark's pivot plans two
    aggregations (two shuffles), this is one partial + final aggregation on ``keys``.
    """
    fn = {"first": lambda v: F.first(v, ignorenulls=True), "sum": F.sum, "max": F.max, "min": F.min,
          "avg": F.avg, "count": F.count}[agg]
    return df.groupBy(*keys).agg(*[fn(F.when(F.col(item) == F.lit(lvl), F.col(value))).alias(str(lvl))
                                   for lvl in levels])


def to_block(df: DataFrame, key: str, hour: str, items: Sequence[str], hours: Sequence[int]) -> DataFrame:
    """(key, hour) x items -> one row per key with ``item_h`` columns (P3), one shuffle."""
    aggs = [F.max(F.when(F.col(hour) == h, c(it))).alias(f"{it}_{h}") for it in items for h in hours]
    return df.groupBy(key).agg(*aggs)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature list -> ``array<double>`` design vector (P5)."""
    return df.withColumn(out, F.array(*[c(x).cast("double") for x in cols]))


def flatten_array(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Nested array -> flat array."""
    return df.withColumn(out or col, F.flatten(F.col(col)))


def reshape_array(df: DataFrame, col: str, width: int, out: str | None = None) -> DataFrame:
    """Flat array -> rows of ``width`` (the inverse of P6)."""
    a = F.col(col)
    rows = F.transform(
        F.sequence(F.lit(0), (F.size(a) / width).cast("int") - 1),
        lambda i: F.slice(a, i * width + 1, width),
    )
    return df.withColumn(out or col, rows)


def with_intercept(df: DataFrame, name: str = "const") -> DataFrame:
    return df.withColumn(name, F.lit(1.0))


def lag_names(items: Sequence[str], n: int = 9) -> list[str]:
    """Programmatic feature list ``item_1..item_n``."""
    return [f"{it}_{i}" for it in items for i in range(1, n + 1)]
