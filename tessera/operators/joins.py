"""Joins: size-checked broadcast lookups, star joins, pair lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: So many of the most frequent keys are broadcast by hot_lookup; every other key has less than one in HOT_KEYS of the rows.
HOT_KEYS = 1000
#: Fact rows that hot_lookup has served travel by so many values of their hash.
SPREADS = 4096


def lookup(facts: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Attach dimension columns.

    Default: a plain equi-join and the size decision is left to the runtime.
    With AQE the dimension's shuffle stage is materialised first and the join is
    re-planned as a broadcast join only if its measured size is below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (a proven bound, no extra
    job); otherwise it stays a sort-merge join, in which AQE splits hot fact partitions
    where the dimension is a stored table. Where it is an aggregate by the key, use ``hot_lookup``.
    """
    return facts.join(dim, on, how)


def hot_lookup(facts: DataFrame, dim: DataFrame, key: str, values: Sequence[str], rows: str, how: str = "inner",
               hot_keys: int = HOT_KEYS) -> DataFrame:
    """``facts`` with ``dim``'s values by key, where a few keys may hold most of the rows.

    ``dim`` has one row a key, with the number of fact rows it has in column ``rows`` (an estimate
    will do: it only decides which way a key goes). The ``hot_keys`` most frequent ones are
    broadcast, a bound that does not grow with the data; the others are joined by shuffle, and fact
    rows already served travel by a hash of their own, so no task gets a hot key. Facts are read
    once. NULL keys find nothing and are dropped by an inner join; in a left join they travel by their own hash too.
    """
    # both uses of dim read the same columns, so its shuffle runs once; hot keys stay in the second, where no row looks for them
    dim = dim.filter(F.col(key).isNotNull() & (F.col(rows) > 0))
    top = dim.orderBy(F.desc(rows), F.asc(key)).limit(hot_keys)
    hot = F.broadcast(top.select(key, F.lit(True).alias("__hot"), *[F.col(v).alias(f"__hot_{v}") for v in values]))
    # 0 for every key; a literal would be folded into a filter and leave the join
    none = F.least(F.col(rows).cast("long"), F.lit(0).cast("long"))
    rest = dim.select(
        key, none.alias("__spread"), F.lit(True).alias("__cold"), *[F.col(v).alias(f"__cold_{v}") for v in values])
    if how == "inner":
        facts = facts.filter(F.col(key).isNotNull())
    # few values, as eight random bytes a row would be most of what is shuffled
    own = F.pmod(F.xxhash64(*facts.columns), F.lit(SPREADS)) + 1
    out = facts.join(hot, key, "left").withColumn("__spread", F.when(F.col("__hot") | F.col(key).isNull(), own).otherwise(F.lit(0).cast("long")))
    out = out.join(rest, [key, "__spread"], "left")
    if how == "inner":
        out = out.filter(F.col("__hot") | F.col("__cold"))
    return out.select(*facts.columns, *[F.when(F.col("__hot"), F.col(f"__hot_{v}")).otherwise(F.col(f"__cold_{v}")).alias(v) for v in values])


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], how: str = "left") -> DataFrame:
    """Fact table joined to several dimensions on their keys."""
    out = fact
    for dim, key in dims:
        out = lookup(out, dim, key, how)
    return out


def same_cluster(pairs: DataFrame, labels: DataFrame, a: str, b: str, key: str, label: str,
                 out: str = "same") -> DataFrame:
    """For pairs (a, b) of ids, 1 if both ids carry the same label."""
    la = labels.select(F.col(key).alias(a), F.col(label).alias("__la"))
    lb = labels.select(F.col(key).alias(b), F.col(label).alias("__lb"))
    joined = pairs.join(la, a, "left").join(lb, b, "left")
    return joined.withColumn(out, F.coalesce(F.col("__la") == F.col("__lb"), F.lit(False)).cast("int")) \
        .drop("__la", "__lb")


def train_of(df: DataFrame, fold_col: str, k: int) -> DataFrame:
    """All rows not in fold k (J6 / U2 on a fold column)."""
    return df.filter(F.col(fold_col) != k)


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Set difference on keys (U2) as a left-anti join."""
    return df.join(other, on, "left_anti")


def attach_labels(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Left join: unlabelled rows get missing labels."""
    return lookup(df, labels, key, "left")
