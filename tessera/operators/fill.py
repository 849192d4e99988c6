"""Ordered-window operators: lags, forward/backward fill, zero repair.

Hot keys: a window partitioned by an entity key runs each entity in one task.
``add_lags``, ``ffill`` and ``bfill`` therefore take an optional ``segment`` column
(for example the day): the windows run per (key, segment) in parallel and only a
bounded summary per segment (its last n values, or its edge value) crosses segment
borders, so a key holding a third of the table is still spread over many tasks.
Without ``segment`` they suit bounded series (one row per entity and day after a
pre-aggregation, or per month as in the hourly original).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import c
from tessera.operators.ranges import with_range


def add_lags(df: DataFrame, items: Sequence[str], n: int, part: Sequence[str], order: Sequence[str],
             start: int = 1, segment: str | None = None) -> DataFrame:
    """``item_k = lag(item, k)`` for k in start..n within ``part`` ordered by ``order``.

    All lags share one window spec, so Catalyst plans one sort and one WindowExec.
    With ``segment`` (a coarse ordered column such as the day) the windows run per
    (part, segment): each segment hands its last n values (at most n rows) to the
    segments after it through a window over one row per segment, so a key holding
    a third of the table is still spread over many tasks.
    """
    if segment:
        return _segmented_lags(df, list(items), n, list(part), list(order), start, segment)
    w = Window.partitionBy(*part).orderBy(*order)
    lags = [F.lag(c(it), k).over(w).alias(f"{it}_{k}") for it in items for k in range(start, n + 1)]
    return df.select("*", *lags)


def _segmented_lags(df, items, n, part, order, start, segment):
    keys = part + [segment]
    w = Window.partitionBy(*keys).orderBy(*order)
    w_desc = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    local = df.select("*", F.row_number().over(w).alias("__rn"), F.row_number().over(w_desc).alias("__rd"),
                      *[F.lag(c(it), k).over(w).alias(f"__l_{i}_{k}")
                        for i, it in enumerate(items) for k in range(start, n + 1)])
    # last n rows of every segment, as one small array per (key, segment) and item
    tails = local.filter(F.col("__rd") <= n).groupBy(*keys).agg(*[
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("__rn").alias("r"), c(it).alias("v")))),
                    lambda s: s["v"]).alias(f"__t_{i}") for i, it in enumerate(items)])
    # values before the segment: tails of up to n earlier segments, last n kept
    ws = Window.partitionBy(*part).orderBy(segment).rowsBetween(-n, -1)
    carry = tails.select(*keys, *[F.flatten(F.collect_list(f"__t_{i}").over(ws)).alias(f"__c_{i}")
                                  for i in range(len(items))])
    # keep the last n (a negative slice start past the front would give an empty array)
    carry = carry.select(*keys, *[
        F.coalesce(F.slice(F.col(f"__c_{i}"), F.greatest(F.size(f"__c_{i}") - n + 1, F.lit(1)), n),
                   F.array()).alias(f"__c_{i}")
        for i in range(len(items))])
    out = local.join(carry, keys, "left")
    cols = [c(x) for x in df.columns]
    for i, it in enumerate(items):
        arr = F.col(f"__c_{i}")
        for k in range(start, n + 1):
            back = F.lit(k) - F.col("__rn") + 1  # how many values before the segment start
            from_carry = F.when(F.size(arr) - back >= 0, F.element_at(arr, (F.size(arr) - back + 1).cast("int")))
            cols.append(F.when(F.col("__rn") > k, F.col(f"__l_{i}_{k}")).otherwise(from_carry).alias(f"{it}_{k}"))
    return out.select(*cols)


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[c(o) for o in order])


def ffill(df: DataFrame, cols: Sequence[str], part: Sequence[str], order: Sequence[str],
          segment: str | None = None) -> DataFrame:
    """Forward fill: last non-missing value at or before the row, within ``part``."""
    return _fill(df, cols, list(part), list(order), segment, forward=True)


def bfill(df: DataFrame, cols: Sequence[str], part: Sequence[str], order: Sequence[str],
          segment: str | None = None) -> DataFrame:
    """Backward fill: first non-missing value at or after the row, within ``part``."""
    return _fill(df, cols, list(part), list(order), segment, forward=False)


def _fill(df, cols, part, order, segment, forward):
    cols = list(cols)
    keys = part + ([segment] if segment else [])
    if forward:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        local = {x: F.last(c(x), ignorenulls=True).over(w) for x in cols}
    else:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
        local = {x: F.first(c(x), ignorenulls=True).over(w) for x in cols}
    if not segment:
        return df.select(*[local[n].alias(n) if n in local else c(n) for n in df.columns])

    # one row per (key, segment): its last (first) non-missing value, then carried
    # over earlier (later) segments with a window over that small table
    ordk = _order_struct(order)
    pick = F.max_by if forward else F.min_by
    seg = df.groupBy(*keys).agg(*[pick(c(x), F.when(c(x).isNotNull(), ordk)).alias(f"__edge_{i}")
                                  for i, x in enumerate(cols)])
    if forward:
        ws = Window.partitionBy(*part).orderBy(segment).rowsBetween(Window.unboundedPreceding, -1)
        carry = [F.last(f"__edge_{i}", ignorenulls=True).over(ws).alias(f"__carry_{i}") for i in range(len(cols))]
    else:
        ws = Window.partitionBy(*part).orderBy(segment).rowsBetween(1, Window.unboundedFollowing)
        carry = [F.first(f"__edge_{i}", ignorenulls=True).over(ws).alias(f"__carry_{i}") for i in range(len(cols))]
    seg = seg.select(*keys, *carry)
    filled = df.select(*[local[n].alias(n) if n in local else c(n) for n in df.columns])
    out = filled.join(seg, keys, "left")
    idx = {x: i for i, x in enumerate(cols)}
    return out.select(*[F.coalesce(c(n), F.col(f"__carry_{idx[n]}")).alias(n) if n in idx else c(n)
                        for n in df.columns])


def repair_zeros(df: DataFrame, cols: Sequence[str], key: str, hour: str, last: int = 9,
                 carry_across: bool = False) -> DataFrame:
    """Guarded two-way zero repair inside observation blocks.

    Rows of a block are ordered by hour 1..last (1 = most recent). Per column:
    zeros not in the last hour -> missing; fill from the next (older) hour;
    remaining zeros -> missing; fill from the previous (newer) hour. With
    ``carry_across`` a block left all-missing takes the last value of the preceding
    key in string order (one row per key crosses block borders).
    """
    cols = list(cols)
    w_b = Window.partitionBy(key).orderBy(hour).rowsBetween(0, Window.unboundedFollowing)
    w_f = Window.partitionBy(key).orderBy(hour).rowsBetween(Window.unboundedPreceding, 0)
    step_a = {x: F.when((c(x) == 0) & (F.col(hour) != last), F.lit(None)).otherwise(c(x)) for x in cols}
    a = df.select(*[step_a[n].alias(n) if n in step_a else c(n) for n in df.columns])
    b = a.select(*[F.first(c(n), ignorenulls=True).over(w_b).alias(n) if n in step_a else c(n) for n in a.columns])
    cc = b.select(*[F.when(c(n) == 0, F.lit(None)).otherwise(c(n)).alias(n) if n in step_a else c(n)
                    for n in b.columns])
    d = cc.select(*[F.last(c(n), ignorenulls=True).over(w_f).alias(n) if n in step_a else c(n)
                    for n in cc.columns])
    if not carry_across:
        return d
    # last non-missing value of each block, carried forward over blocks in key order
    per_key = cc.groupBy(key).agg(*[F.max_by(c(x), F.when(c(x).isNotNull(), F.col(hour))).alias(f"__e{i}")
                                    for i, x in enumerate(cols)])
    carried = carry_forward_sorted(per_key, key, [f"__e{i}" for i in range(len(cols))], exclusive=True)
    out = d.join(carried.select(key, *[F.col(f"__e{i}").alias(f"__k{i}") for i in range(len(cols))]), key, "left")
    idx = {x: i for i, x in enumerate(cols)}
    return out.select(*[F.coalesce(c(n), F.col(f"__k{idx[n]}")).alias(n) if n in idx else c(n) for n in df.columns])


def carry_forward_sorted(df: DataFrame, order: str, cols: Sequence[str], exclusive: bool = False,
                         ranges: int | None = None) -> DataFrame:
    """Global forward fill over a table in ``order`` without a one-partition window.

    Rows are dealt to ranges of the order by literal bounds; each range fills locally and
    hands its last non-missing values (one row per range) to the ranges after it. With
    ``exclusive`` a row only sees values strictly before it. Rows tied in ``order`` follow
    each other by a hash of the whole row.
    """
    cols = list(cols)
    s = with_range(df, [order], ranges)
    hi = -1 if exclusive else 0
    w_in = Window.partitionBy("__range").orderBy("__key").rowsBetween(Window.unboundedPreceding, hi)
    local = s.select(*[c(n) for n in df.columns], "__range",
                     *[F.last(c(x), ignorenulls=True).over(w_in).alias(f"__l{i}") for i, x in enumerate(cols)])
    edges = s.groupBy("__range").agg(*[F.max_by(c(x), F.when(c(x).isNotNull(), F.col("__key"))).alias(f"__p{i}")
                                       for i, x in enumerate(cols)])
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: bounded by MAX_RANGES, broadcast
    carry = edges.select("__range", *[F.last(f"__p{i}", ignorenulls=True).over(before).alias(f"__c{i}")
                                      for i in range(len(cols))])
    out = local.join(F.broadcast(carry), "__range", "left")
    idx = {x: i for i, x in enumerate(cols)}
    return out.select(*[F.coalesce(F.col(f"__l{idx[n]}"), F.col(f"__c{idx[n]}")).alias(n) if n in idx else c(n)
                        for n in df.columns])


def with_hour_index(df: DataFrame, col: str, out: str = "hour") -> DataFrame:
    """Hour number parsed from an unpivoted column name such as ``hr_3``."""
    return df.withColumn(out, F.regexp_extract(F.col(col), r"(\d+)$", 1).cast("int"))
