"""Dictionaries: sorted distinct values -> dense tokens, and their use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.clean import with_row_id
from tessera.operators.joins import lookup


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of a column (A3), missing values excluded."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct()


def dictionary(df: DataFrame, col: str, token: str | None = None, start: int = 0) -> DataFrame:
    """``(value, token)`` with tokens 0..n-1 in sorted value order.

    The numbering runs over the distinct set with a range sort and per-partition
    offsets, never a single-partition window.
    """
    token = token or f"{col}_token"
    return with_row_id(distinct_sorted(df, col), [col], name=token, start=start)


def encode(df: DataFrame, dict_df: DataFrame, col: str) -> DataFrame:
    """Attach the token of ``col`` (J1): left join, unknown values get NULL."""
    return lookup(df, dict_df, col, "left")


def distinct_elements(df: DataFrame, arr: str, out: str = "element") -> DataFrame:
    """Distinct union of the elements of an array column."""
    return df.select(F.explode(F.col(arr)).alias(out)).distinct()


def encode_array(df: DataFrame, key: str, arr: str, dict_df: DataFrame, value: str, token: str,
                 out: str | None = None) -> DataFrame:
    """Array of values -> array of tokens, order kept.

    Exploded with positions, joined to the (size-checked) dictionary, and regrouped
    per row key; rows with an empty array keep an empty array.
    """
    out = out or f"{arr}_tokens"
    exploded = df.select(key, F.posexplode(F.col(arr)).alias("__pos", value))
    tok = lookup(exploded, dict_df.select(value, token), value, "left")
    regrouped = tok.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__pos", token))), lambda s: s[token]).alias(out)
    )
    return df.join(regrouped, key, "left").withColumn(
        out, F.coalesce(F.col(out), F.array().cast(f"array<{dict_df.schema[token].dataType.simpleString()}>"))
    )
