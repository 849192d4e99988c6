"""Self-training in batches: equal to a loop, resumable, defined on empty pools and null keys."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import semi
from tessera.operators.split import HASH_MOD, HASH_MULT


def _rows(n=600):
    rng = random.Random(8)
    return [(i, rng.randrange(12), i % 3 == 0) for i in range(n)]


def _table(spark):
    rng = random.Random(9)
    rows = []
    for i, cell, labelled in _rows():
        truth = "0" if cell < 5 else "1" if cell > 6 else rng.choice("01")
        rows.append((i, cell, truth if labelled else None, "train" if labelled else "semi"))
    return rows, spark.createDataFrame(rows, "k long, cell int, label string, pool string").repartition(4)


def _learner(starts):
    def fit(train, model):
        starts.append(model)
        return {r["cell"]: (r["n0"] + 1) / (r["n"] + 2) for r in train.groupBy("cell").agg(
            F.count("*").alias("n"), F.count(F.when(F.col("label") == "0", 1)).alias("n0")).collect()}

    def score(rows, model):
        p0 = F.lit(0.5)
        for cell, p in model.items():
            p0 = F.when(F.col("cell") == cell, F.lit(p)).otherwise(p0)
        return rows.withColumn("p0", p0)

    return fit, score


def _loop(rows, batch, rounds):
    train = {k: (cell, label) for k, cell, label, pool in rows if pool == "train"}
    left = sorted((k * HASH_MULT % HASH_MOD, k, cell) for k, cell, _, pool in rows if pool == "semi")
    log = set()
    for r in range(1, rounds + 1):
        cells = {}
        for cell, label in train.values():
            n, n0 = cells.get(cell, (0, 0))
            cells[cell] = n + 1, n0 + (label == "0")
        moved = {}
        for place, (_, k, cell) in enumerate(left[:batch], 1):
            n, n0 = cells.get(cell, (0, 0))
            p0 = (n0 + 1) / (n + 2)
            if p0 >= 0.87 or p0 <= 1 - 0.87:
                moved[k] = cell, "0" if p0 >= 0.87 else "1"
                log.add((r, place, k, moved[k][1], p0))
        train.update(moved)
        left = [x for x in left if x[1] not in moved]
    return train, log


def _log(frame):
    return {(r["round"], r["place"], r["k"], r["label"], r["p0"]) for r in frame.collect()}


def test_batches_equal_a_loop_and_resume(spark, tmp_path):
    rows, df = _table(spark)
    train, log = _loop(rows, 150, 3)
    assert {r for r, *_ in log} == {1, 2, 3} and {x[3] for x in log} == {"0", "1"}
    starts = []
    state, got, _ = semi.self_train_batches(df, "k", *_learner(starts), 150, 3, f"file://{tmp_path}/a")
    assert _log(got) == log
    assert {r["k"]: r["label"] for r in state.filter("pool = 'train'").collect()} == {k: v[1] for k, v in train.items()}
    assert state.count() == len(rows) and state.columns == df.columns
    assert starts == [None] * 4

    starts = []
    semi.self_train_batches(df, "k", *_learner(starts), 150, 1, f"file://{tmp_path}/b")
    # a round whose job died: rows without a mark of success are not taken
    df.limit(5).select("k", "label", F.lit(1.0).alias("p0"), F.lit(1).cast("long").alias("place")) \
        .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"file://{tmp_path}/b/round=2")
    starts = []
    _, again, _ = semi.self_train_batches(df, "k", *_learner(starts), 150, 3, f"file://{tmp_path}/b")
    assert _log(again) == log
    assert len(starts) == 3  # rounds 2 and 3, and the last fit


def test_without_retraining_the_model_goes_on(spark, tmp_path):
    _, df = _table(spark)
    starts = []
    semi.self_train_batches(df, "k", *_learner(starts), 100, 2, f"file://{tmp_path}/log", retrain=False)
    assert starts[0] is None and all(isinstance(m, dict) for m in starts[1:]) and len(starts) == 3


@pytest.mark.parametrize("keep", ["pool = 'train'", "k < 0", "pool = 'train' or k is null"])
def test_nothing_to_promote(spark, tmp_path, keep):
    _, df = _table(spark)
    df = df.unionByName(spark.createDataFrame([(None, 1, None, "semi")], df.schema)).filter(keep)
    state, log, _ = semi.self_train_batches(df, "k", *_learner([]), 10, 2, f"file://{tmp_path}/log")
    assert log.count() == 0
    assert sorted(map(str, state.collect())) == sorted(map(str, df.collect()))
