"""Global orders without a one-partition window and without a cache.

A table is cut into ranges of its order by literal bounds. A row's range depends on its values
alone, so a lost task that is run again gives the same ranges, counts and numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import c

#: Rows that a range should hold, and the most ranges that are cut; larger ranges sort with spilling.
ROWS_PER_RANGE = 200_000
MAX_RANGES = 4096
#: Rows looked at for each bound.
SAMPLE_PER_RANGE = 32


def tie_hash(df: DataFrame) -> Column:
    """Hash of the whole row: orders rows that the caller's columns leave tied (map and variant columns can't be hashed)."""
    cols = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(*[c(n) for n in cols]) if cols else F.lit(0).cast("long")


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(value, T.Row):
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields, strict=True)])
    return F.lit(value).cast(kind)


def _bounds(keyed: DataFrame, rows: int, ranges: int) -> list[T.Row]:
    """ranges - 1 order keys at equal distances in a sample chosen by the rows' hash.

    The sample's expected size is SAMPLE_PER_RANGE a range however large the table; equal rows count
    once, so copies can't swell it.
    """
    share = min(1.0, SAMPLE_PER_RANGE * ranges / rows)
    buckets = 1 << 40
    picked = keyed.filter(F.pmod(F.xxhash64(F.lit(7), "__key.__tie"), F.lit(buckets)) < F.lit(math.ceil(share * buckets)))
    found = [r[0] for r in picked.select("__key").distinct().orderBy("__key").collect()]
    step = len(found) / ranges
    return [found[int(i * step)] for i in range(1, ranges)] if found else []


def with_range(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """df with ``__key`` (the order columns and the row's hash as last resort) and ``__range``.

    Ranges ascend with the order, nulls first. Rows tied in ``order`` may lie in neighbouring ranges,
    so a value of a third of the table is split; only rows equal in every column stay together.
    Reads df once for its count and, if more than one range is needed, once more for the bounds.
    """
    keyed = df.withColumn("__key", F.struct(*[c(n).alias(f"__o{i}") for i, n in enumerate(order)], tie_hash(df).alias("__tie")))
    rows = df.count()
    ranges = ranges or min(MAX_RANGES, math.ceil(rows / ROWS_PER_RANGE))
    bounds = _bounds(keyed, rows, ranges) if rows and ranges > 1 else []
    if not bounds:
        return keyed.withColumn("__range", F.lit(0))
    kind = keyed.schema["__key"].dataType
    # bounds in about sqrt(n) groups: a row is compared with the groups' first bounds, then with one group
    width = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    firsts = F.array(*[_literal(g[0], kind) for g in groups])
    nested = F.array(*[F.array(*[_literal(b, kind) for b in g]) for g in groups])
    below = F.size(F.filter(firsts, lambda b: b <= F.col("__key")))
    out = keyed.withColumn("__group", below)
    inside = F.size(F.filter(F.element_at(nested, F.greatest("__group", F.lit(1))), lambda b: b <= F.col("__key")))
    return out.withColumn("__range", (F.greatest(F.col("__group") - 1, F.lit(0)) * width + inside).cast("int")).drop("__group")
