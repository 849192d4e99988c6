"""Pseudo-labelling and self-training."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.clean import with_row_id
from tessera.operators.split import key_hash
from tessera.session import cut_lineage


def promote(df: DataFrame, p0: str, pool: str = "pool", label: str = "label", threshold: float = 0.87,
            from_pool: str = "semi", to_pool: str = "train") -> DataFrame:
    """Rows of ``from_pool`` with p0 >= t get label '0', with p0 <= 1 - t label '1';
    both move to ``to_pool``; everything else stays (M22, U4). Row-wise, no shuffle."""
    cand = F.col(pool) == from_pool
    zero = cand & (F.col(p0) >= threshold)
    one = cand & (F.col(p0) <= 1.0 - threshold)
    new_label = F.when(zero, F.lit("0")).when(one, F.lit("1")).otherwise(F.col(label))
    new_pool = F.when(zero | one, F.lit(to_pool)).otherwise(F.col(pool))
    return df.withColumn(label, new_label).withColumn(pool, new_pool)


def self_train(df: DataFrame, fit: Callable[[DataFrame], object], score: Callable[[DataFrame, object], DataFrame],
               p0: str = "p0", pool: str = "pool", label: str = "label", threshold: float = 0.87,
               rounds: int = 1):
    """Fit on the labelled pool, score the unlabelled pool, promote confident rows, refit.

    ``fit(train_df) -> model`` and ``score(df, model) -> df with p0`` are the
    caller's learner (for example the logistic solver on document vectors).
    Each round's table is checkpointed into the shared checkpoint folder so the
    lineage stays one round long and survives executor loss.
    """
    state = df
    model = None
    for _ in range(rounds):
        model = fit(state.filter(F.col(pool) == "train"))
        scored = score(state, model)
        state = cut_lineage(promote(scored, p0, pool, label, threshold).drop(p0))
    model = fit(state.filter(F.col(pool) == "train"))
    return state, model


def _finished(spark, path: str) -> bool:
    """Whether a round's folder was committed; a job that died leaves no ``_SUCCESS``."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def next_batch(df: DataFrame, key: str, n: int, seed: int = 0, ranges: int | None = None) -> DataFrame:
    """The first ``n`` rows in the order of their key's hash, with ``place`` 1..n.

    The order rests on the keys alone: a rerun, or a resumed run, takes the same rows.
    """
    hashed = df.withColumn("__hash", key_hash(key, seed))
    return with_row_id(hashed, ["__hash", key], "place", ranges=ranges).filter(F.col("place") <= n).drop("__hash")


def self_train_batches(df: DataFrame, key: str, fit: Callable[[DataFrame, object], object],
                       score: Callable[[DataFrame, object], DataFrame], batch: int, rounds: int, log_path: str,
                       retrain: bool = True, threshold: float = 0.87, seed: int = 0, p0: str = "p0",
                       pool: str = "pool", label: str = "label"):
    """Self-training in batches with a log of promotions (M23): ``(state, log, model)``.

    Each round fits on pool 'train', scores the first ``batch`` rows that remain in pool 'semi' (in the
    order of their key's hash) and promotes the confident ones; the others stay at the head of the pool
    and are scored again. After the last round the model is fitted once more. ``fit(train, model)`` gets
    None with ``retrain``, else the last round's model to go on from. ``score(rows, model)`` adds ``p0``.

    The log (key, label, ``p0``, ``place`` in the batch) is written as ``log_path/round=r`` on shared
    storage, and the state is ``df`` joined with it; the lineage never grows. A run that finds finished
    rounds in ``log_path`` takes them over and goes on behind them; with ``retrain`` it doesn't fit them
    again. Keys are unique and whole numbers from 0; rows with a null key are never promoted, nor are
    rows whose ``p0`` is null. An empty pool writes an empty round. One log serves one ``df``.
    """
    spark = df.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = f"`{key}` {kinds[key]}, `{label}` string, `{p0}` double, place long"

    def promoted(upto: int) -> DataFrame:
        out = spark.createDataFrame([], f"{schema}, round int")
        for r in range(1, upto + 1):
            out = out.unionByName(spark.read.schema(schema).parquet(f"{log_path}/round={r}").withColumn("round", F.lit(r)))
        return out

    def state(upto: int) -> DataFrame:
        log = promoted(upto).select(key, F.col(label).alias("__label"), F.lit(True).alias("__in"))
        out = df.join(log, key, "left")
        moved = F.coalesce(F.col("__in"), F.lit(False))
        new = {label: F.when(moved, F.col("__label")).otherwise(F.col(label)),
               pool: F.when(moved, F.lit("train")).otherwise(F.col(pool))}
        return out.select(*[new[n].alias(n) if n in new else F.col(f"`{n}`") for n in df.columns])

    model = None
    for r in range(1, rounds + 1):
        path = f"{log_path}/round={r}"
        finished = _finished(spark, path)
        if finished and retrain:
            continue
        now = state(r - 1)
        model = fit(now.filter(F.col(pool) == "train"), None if retrain else model)
        if finished:
            continue
        rows = next_batch(now.filter((F.col(pool) == "semi") & F.col(key).isNotNull()), key, batch, seed)
        moved = promote(score(rows, model), p0, pool, label, threshold).filter(F.col(pool) == "train")
        moved.select(key, F.col(label).cast("string").alias(label), F.col(p0).cast("double").alias(p0), "place") \
            .write.mode("overwrite").parquet(path)
    last = state(rounds)
    return last, promoted(rounds), fit(last.filter(F.col(pool) == "train"), None if retrain else model)
