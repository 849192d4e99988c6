"""Deterministic folds, hold-outs and bootstrap weights (M1-M3).

Randomness comes from hashing a unique key, so a fold is the same on every
recomputation (task retries, executor loss) and in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.clean import with_row_id

# Multiplicative hash (Knuth) on 32 bits.
HASH_MULT = 2654435761
HASH_MOD = 4294967296


def key_hash(key, seed: int = 0) -> Column:
    """((key + seed) * 2654435761) mod 2^32, exact for any non-negative BIGINT key."""
    k = F.col(key) if isinstance(key, str) else key
    prod = (k.cast("decimal(38,0)") + F.lit(seed)) * F.lit(HASH_MULT)
    return F.pmod(prod, F.lit(HASH_MOD)).cast("bigint")


def with_folds(df: DataFrame, key: str, k: int, seed: int = 0, out: str = "fold", exact: bool = False) -> DataFrame:
    """Integer fold 0..k-1 per row (M1).

    Default: hash of the key mod k. ``exact=True`` ranks rows by hash and cuts
    n // k rows per fold, the last fold taking the remainder.
    """
    h = key_hash(key, seed)
    if not exact:
        return df.withColumn(out, F.pmod(h, F.lit(k)).cast("int"))
    n = df.count()
    size = max(n // k, 1)
    ranked = with_row_id(df.withColumn("__h", h), ["__h", key], name="__r", start=0)
    return ranked.withColumn(out, F.least(F.floor(F.col("__r") / size), F.lit(k - 1)).cast("int")).drop("__h", "__r")


def with_holdout(df: DataFrame, key: str, fraction: float, seed: int = 0, out: str = "holdout") -> DataFrame:
    """1 for about ``fraction`` of the rows, chosen by key hash (M2)."""
    u = key_hash(key, seed) / F.lit(float(HASH_MOD))
    return df.withColumn(out, (u < F.lit(fraction)).cast("int"))


# Integer mixing constants of the 32-bit bootstrap hash.
MIX_BAG = 2246822519
MIX_MULT = 73244475


def mix32(h: Column) -> Column:
    """Two rounds of xor-shift-multiply on a 32-bit value held in a BIGINT (exact:
    every product stays below 2^59), then a final xor-shift."""
    for _ in range(2):
        h = F.pmod(F.shiftright(h, 16).bitwiseXOR(h) * F.lit(MIX_MULT), F.lit(HASH_MOD))
    return F.shiftright(h, 16).bitwiseXOR(h)


def bag_uniform(key, bag, seed: int = 0) -> Column:
    """Repeatable uniform in [0, 1) per (key, bag)."""
    b = F.col(bag) if isinstance(bag, str) else bag
    h = F.pmod(key_hash(key, seed) + b.cast("bigint") * F.lit(MIX_BAG), F.lit(HASH_MOD))
    return mix32(h) / F.lit(float(HASH_MOD))


def poisson1_cdf(terms: int = 20) -> list[float]:
    """Cumulative probabilities P(X <= j) of Poisson(1), j = 0..terms-1."""
    import math

    cdf, p, acc = [], math.exp(-1.0), 0.0
    for j in range(terms):
        acc += p
        cdf.append(acc)
        p = p / (j + 1)
    return cdf


def poisson_weights(keys, times: int, seed: int = 0):
    """The multiplicities of ``bootstrap`` for an array of integer keys: rows x bags, bags 1..times."""
    import numpy as np

    # products of two 32-bit values fit into 64 bits, and wrapping keeps the low 32
    mod, mult = np.uint64(HASH_MOD), np.uint64(MIX_MULT)
    base = (np.asarray(keys, np.int64).astype(np.uint64) + np.uint64(seed % (1 << 64))) * np.uint64(HASH_MULT) % mod
    h = (base[:, None] + np.arange(1, times + 1, dtype=np.uint64)[None, :] * np.uint64(MIX_BAG)) % mod
    for _ in range(2):
        h = ((h >> np.uint64(16)) ^ h) * mult % mod
    u = ((h >> np.uint64(16)) ^ h) / float(HASH_MOD)
    return np.searchsorted(np.array(poisson1_cdf()), u.ravel(), side="right").reshape(u.shape)


def bootstrap(df: DataFrame, key: str, times: int, seed: int = 0, bag: str = "bag", weight: str = "w") -> DataFrame:
    """One row per (row, bag) with a Poisson(1) multiplicity (M3).

    Resampling n rows with replacement gives multinomial counts; independent
    Poisson(1) weights are the standard distributed stand-in (a stated deviation).
    The draw is the inverse CDF of a hash-derived uniform, so it is repeatable and
    the same in any engine with 64-bit integers.
    """
    bags = df.withColumn(bag, F.explode(F.sequence(F.lit(1), F.lit(times))))
    u = bag_uniform(key, bag, seed)
    w = sum((u >= F.lit(q)).cast("int") for q in poisson1_cdf())
    return bags.withColumn(weight, w).filter(F.col(weight) > 0)
