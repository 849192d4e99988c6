"""Biases of ids and attributes: against dense descent, with odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import recsys


def dense(rows, users, items, epochs, reg, own):
    """Predictions by the same steps on plain arrays: levels as columns, one block after the other."""
    rows = [r for r in rows if None not in r]
    mu = np.mean([r[2] for r in rows])
    blocks = ([("u", 0)] if own else []) + [("g", 0), ("a", 0)] + ([("i", 1)] if own else []) + [("e", 1), ("s", 1)]

    def levels(block, row):
        u, i = users.get(row[0]), items.get(row[1])
        got = {"u": [row[0]], "i": [row[1]], "g": [u[0]] if u else [], "a": [u[1]] if u else [], "e": [i[0]] if i else [], "s": sorted({x for x in i[1] or [] if x}) if i else []}[block]
        return [x for x in got if x is not None]

    bias = {b: {} for b, _ in blocks}
    left = np.array([r[2] - mu for r in rows])
    errors = []
    for _ in range(epochs):
        for b, _ in blocks:
            found = [levels(b, r) for r in rows]
            total, weight = {}, {}
            for x, ls in zip(left, found, strict=True):
                for k in ls:
                    total[k] = total.get(k, 0) + x
                    weight[k] = weight.get(k, 0) + len(ls)
            step = {k: (total[k] - reg * bias[b].get(k, 0)) / (weight[k] + reg) for k in total}
            for k, v in step.items():
                bias[b][k] = bias[b].get(k, 0) + v
            left = left - np.array([sum(step[k] for k in ls) for ls in found])
            errors.append((left**2).sum() + reg * sum(v * v for t in bias.values() for v in t.values()))
    return mu, bias, left, errors


@pytest.mark.parametrize("own", [True, False])
def test_biases_equal_dense_descent(spark, own):
    rng = random.Random(3)
    users = {f"u{i}": (rng.choice(["f", "m", None]), rng.randrange(4)) for i in range(30)}
    items = {2**40 + i: (rng.choice([70, 80, 90]), rng.choice([["a"], ["a", "b", "b"], ["b", "c", None], [], None])) for i in range(20)}
    pairs = rng.sample([(u, i) for u in users for i in items], 250) + [("stranger", 2**40), ("u1", 7)]
    rows = [(u, i, float(rng.randrange(1, 6))) for u, i in pairs] + [(None, 2**40, 3.0), ("u1", None, 3.0), ("u2", 2**40 + 1, None)]
    # one user has a third of all ratings
    rows += [("u3", 2**40 + i % 20, float(rng.randrange(1, 6))) for i in range(130)]
    ratings = spark.createDataFrame(rows, "u string, i long, y double")
    user = recsys.Side("u", spark.createDataFrame([(k, *v) for k, v in users.items()], "u string, g string, a int"), one=["g", "a"], own=own)
    item = recsys.Side("i", spark.createDataFrame([(k, *v) for k, v in items.items()], "i long, e int, s array<string>"), one=["e"], many=["s"], own=own)
    fit = recsys.fit_biases(ratings, user, item, "y", epochs=2, reg=0.5)
    mu, bias, left, errors = dense(rows, users, items, 2, 0.5, own)
    assert fit.mu == pytest.approx(mu)
    for block in ("g", "a", "e", "s"):
        got = {r["level"]: r["bias"] for r in fit.blocks[block].collect()}
        assert got == pytest.approx(bias[block])
    assert all(b <= a + 1e-9 for a, b in zip(errors, errors[1:], strict=False))
    sound = [r for r in rows if None not in r]
    scored = recsys.predict_biases(spark.createDataFrame([(*r, k) for k, r in enumerate(sound)], "u string, i long, y double, k int"), fit, user, item, lo=-99.0, hi=99.0)
    got = [r["pred"] for r in scored.orderBy("k").collect()]
    assert got == pytest.approx([r[2] - x for r, x in zip(sound, left, strict=True)])


def test_cold_ids_have_their_attributes_biases(spark):
    ratings = spark.createDataFrame([(1, 1, 5.0), (1, 2, 1.0), (2, 1, 4.0)], "u int, i int, y double")
    user = recsys.Side("u", spark.createDataFrame([(1, "f"), (2, "m"), (3, "m")], "u int, g string"), one=["g"])
    item = recsys.Side("i", spark.createDataFrame([(1, ["x"]), (2, ["y"]), (9, ["x", "z"])], "i int, s array<string>"), many=["s"])
    fit = recsys.fit_biases(ratings, user, item, "y", epochs=1)
    g = {r["level"]: r["bias"] for r in fit.blocks["g"].collect()}
    s = {r["level"]: r["bias"] for r in fit.blocks["s"].collect()}
    out = recsys.predict_biases(spark.createDataFrame([(3, 9), (8, 8)], "u int, i int"), fit, user, item, lo=-9.0, hi=9.0).collect()
    assert {r["u"]: r["pred"] for r in out} == pytest.approx({3: fit.mu + g["m"] + s["x"], 8: fit.mu})


def test_no_ratings(spark):
    ratings = spark.createDataFrame([], "u int, i int, y double")
    side = recsys.Side("u", spark.createDataFrame([(1, "f")], "u int, g string"), one=["g"])
    other = recsys.Side("i", spark.createDataFrame([(1,)], "i int"))
    fit = recsys.fit_biases(ratings, side, other, "y", epochs=1)
    assert fit.mu == 0.0 and fit.user.collect() == [] and fit.blocks["g"].collect() == []


def test_factors_take_ids_of_any_type(spark):
    rng = random.Random(1)
    rows = [(f"user {u}", 2**50 + i, float((u * i) % 5 + 1)) for u in range(12) for i in range(10) if rng.random() < 0.8]
    ratings = spark.createDataFrame(rows, "u string, i long, y double")
    mu, users, items = recsys.fit_factors(ratings, "u", "i", "y", rank=3, max_iter=8)
    scored = recsys.score_factors(ratings, users, items, "u", "i", mu, out="pred").collect()
    assert len(scored) == len(rows)
    assert np.mean([(r["pred"] - r["y"]) ** 2 for r in scored]) < np.var([r[2] for r in rows])


def _exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_dealt_ratings_are_not_shuffled_again(spark):
    """Bias steps, prediction and factor scores look ids up where the dealt ratings are; only the ids' table travels."""
    rng = random.Random(5)
    rows = [(u, i, float(rng.randrange(1, 6))) for u in range(40) for i in range(30) if rng.random() < 0.5]
    ratings = spark.createDataFrame(rows, "u long, i long, y double")
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = recsys.deal(ratings, "u", 3)
        assert spark.conf.get("spark.sql.adaptive.enabled") == before[0]
        ids = spark.range(40).select(F.col("id").alias("u"), F.rand(1).alias("offset"))
        plan = _exchanges(recsys.lookup_dealt(dealt, ids, "u", 3))
        assert len(plan) == 1 and "REPARTITION_BY_NUM" in plan[0]
        assert recsys.lookup_dealt(dealt, ids, "u", 3).count() == len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])


def test_dealt_ratings_give_the_same_fit(spark):
    rng = random.Random(6)
    rows = [(u, i, float(rng.randrange(1, 6))) for u in range(30) for i in range(20) if rng.random() < 0.6]
    rows += [(None, 1, 2.0), (1, None, 3.0), (2, 3, None), (1, 1, 5.0), (1, 1, 5.0)]
    ratings = spark.createDataFrame(rows, "u long, i long, y double")
    user = recsys.Side("u", spark.createDataFrame([(k, "fm"[k % 2]) for k in range(35)], "u long, g string"), one=["g"])
    item = recsys.Side("i", spark.createDataFrame([(k, ["a", "b"][: k % 3]) for k in range(25)], "i long, s array<string>"), many=["s"])
    found = []
    for parts in (None, 4):
        facts = recsys.deal(ratings, "u", parts) if parts else ratings
        fit = recsys.fit_biases(facts, user, item, "y", epochs=2, parts=parts)
        scored = recsys.predict_biases(facts, fit, user, item, parts=parts)
        found.append(sorted((str((r["u"], r["i"], r["y"])), round(r["pred"], 9)) for r in scored.collect()))
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_factors_are_fitted_in_blocks_of_bounded_size(spark, monkeypatch):
    """Before, ten blocks held all ratings and the residuals were kept in the executors' heap."""
    from pyspark.ml.recommendation import ALS

    seen, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, df: (seen.append((self.getNumUserBlocks(), self.getNumItemBlocks(), df.storageLevel.useMemory)), fit(self, df))[1])
    ratings = spark.createDataFrame([(i % 20, i % 17, float(1 + i % 5)) for i in range(340)], "u int, i int, y double")
    monkeypatch.setattr(recsys, "BLOCK_ROWS", 25)
    few = recsys.fit_factors(ratings, "u", "i", "y", rank=2, max_iter=3)
    assert seen == [(14, 14, False)]
    assert few[1].filter("u_vec is null").count() == few[2].filter("i_vec is null").count() == 0
    monkeypatch.setattr(recsys, "BLOCK_ROWS", 1000)
    recsys.fit_factors(ratings, "u", "i", "y", rank=2, max_iter=1)
    assert seen[1] == (10, 10, False)
