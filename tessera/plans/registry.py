"""Query registry: every catalogue query is a function (spark, sf_dir) -> DataFrame,
optionally paired with an equivalent DuckDB SQL string over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
OPS: dict[str, str] = {}


def query(name: str, ops: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        OPS[name] = ops
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from tessera.plans import (  # noqa: F401
        q_fits,
        q_models,
        q_ratings,
        q_reshape,
        q_text,
        q_vectors,
        q_windows,
    )
