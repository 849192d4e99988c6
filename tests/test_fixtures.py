"""Inline fixtures: missing-value, ordering and edge semantics of the row-wise and window operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.functions.text import glue_apostrophes, pad_sequence, tokenize
from tessera.operators import clean, fill, images, logistic, semi, split, text
from tessera.operators.linear import minimize_quadratic


def col(df, name, order="i"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_coerce(spark):
    df = spark.createDataFrame([(0, "NR"), (1, " 3 "), (2, "x"), (3, "-2"), (4, "nan"), (5, None)], "i int, v string")
    df = clean.replace_value(df, "v", "NR", "0")
    df = clean.to_numeric(df, ["v"])
    df = clean.floor_at(df, ["v"], 0)
    assert col(df, "v") == [0, 3, None, 0, None, None]


def test_flag_null(spark):
    df = spark.createDataFrame([(0, None), (1, -1.0), (2, 0.0), (3, 1.0)], "i int, x double")
    assert col(df.select("i", S.flag(F.col("x") >= 0).alias("f")), "f") == [0, 0, 1, 1]


def test_wind(spark):
    df = spark.createDataFrame([(0, 2.0, 90.0), (1, 2.0, 0.0), (2, 2.0, 180.0), (3, 2.0, 270.0)], "i int, s double, d double")
    x, y = S.polar_to_xy("s", "d")
    rows = df.select("i", x.alias("x"), y.alias("y")).orderBy("i").collect()
    want = [(2, 0), (0, 2), (0, -2), (-2, 0)]
    for r, (wx, wy) in zip(rows, want):
        assert abs(r["x"] - wx) < 1e-12 and abs(r["y"] - wy) < 1e-12


def _block(spark, values, key="id_1"):
    return spark.createDataFrame([(key, h + 1, float(v) if v is not None else None) for h, v in enumerate(values)],
                                 "id string, hour int, v double")


def test_repair_middle_and_last(spark):
    out = fill.repair_zeros(_block(spark, [5, 0, 0, 7, 8, 9, 1, 2, 3]), ["v"], "id", "hour")
    assert col(out, "v", "hour") == [5, 7, 7, 7, 8, 9, 1, 2, 3]
    out = fill.repair_zeros(_block(spark, [5, 6, 7, 8, 9, 1, 2, 0, 0]), ["v"], "id", "hour")
    assert col(out, "v", "hour") == [5, 6, 7, 8, 9, 1, 2, 2, 2]


def test_repair_block_carry(spark):
    prev = _block(spark, [1, 2, 3, 4, 4, 4, 4, 4, 4], "id_0")
    zero = _block(spark, [0] * 9, "id_1")
    df = prev.unionByName(zero)
    default = fill.repair_zeros(df, ["v"], "id", "hour").filter("id = 'id_1'")
    assert col(default, "v", "hour") == [None] * 9
    carried = fill.repair_zeros(df, ["v"], "id", "hour", carry_across=True).filter("id = 'id_1'")
    assert col(carried, "v", "hour") == [4.0] * 9


def test_lag_month(spark):
    rows = [(1, d, float(d)) for d in range(12)] + [(2, d, float(d)) for d in range(10)]
    df = spark.createDataFrame(rows, "month int, hour int, v double")
    lagged = clean.drop_missing(fill.add_lags(df, ["v"], 9, ["month"], ["hour"]))
    counts = {r["month"]: r["count"] for r in lagged.groupBy("month").count().collect()}
    assert counts == {1: 3, 2: 1}


def test_mean_null(spark):
    vals = [1.0] * 8 + [None]
    df = spark.createDataFrame([tuple(vals)], ", ".join(f"v_{i} double" for i in range(1, 10)))
    assert df.select(S.lag_mean("v", 9).alias("m")).first()["m"] is None


def test_cut_edges(spark):
    edges = [0, 32.5, 37.5, 42.5, 47.5, 52.5, 57.5, 62.5, 67.5, 100]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.0, 1.0, 32.5, 32.6, 100.0, 101.0, None])], "i int, h double")
    assert col(df.select("i", S.cut("h", edges).alias("b")), "b") == [None, "c1", "c1", "c2", "c9", None, None]


def test_onehot_absent(spark):
    df = spark.createDataFrame([(0, "a"), (1, None)], "i int, v string")
    out = df.select("i", *[e.alias(n) for n, e in S.one_hot("v", ["a", "zz"], "v")])
    assert [tuple(r) for r in out.orderBy("i").collect()] == [(0, 1, 0), (1, 0, 0)]


def test_contradiction(spark):
    df = spark.createDataFrame([(0, "Male", "Wife"), (1, "Female", "Husband"), (2, "Male", "Husband")], "i int, sex string, rel string")
    cond = ((F.col("sex") == "Male") & (F.col("rel") == "Wife")) | ((F.col("sex") == "Female") & (F.col("rel") == "Husband"))
    out = clean.drop_missing(clean.null_if(df, "rel", cond))
    assert col(out, "i") == [2]


@pytest.mark.parametrize("src,want", [
    ("can ' t", ["cant"]), ("' a", ["a"]), ("a '", ["a"]), ("'", []), ("a ' ' b", ["a'", "b"]), ("a ' b ' c", ["abc"]),
])
def test_glue(spark, src, want):
    df = spark.createDataFrame([(src.split(" "),)], "t array<string>")
    assert df.select(glue_apostrophes("t").alias("g")).first()["g"] == want


def test_glue_properties(spark):
    rng = np.random.default_rng(0)
    seqs = [[str(x) for x in rng.choice(["a", "b", "'"], size=rng.integers(0, 7))] for _ in range(300)]

    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, t array<string>")
    got = {r["i"]: r["g"] for r in df.select("i", glue_apostrophes("t").alias("g")).collect()}
    for i, s in enumerate(seqs):
        letters = [w for w in s if w != "'"]
        # no mark stands alone, the letters keep their order, and only neighbours of a mark are glued
        assert "'" not in got[i] and "".join(got[i]).replace("'", "") == "".join(letters), s
        if "'" not in s[1:-1]:
            assert got[i] == letters, s
        assert len(got[i]) >= len(letters) - s.count("'"), s


def test_tokenise(spark):
    df = spark.createDataFrame([("Hi, (You) #1!\ta_b",)], "t string")
    assert df.select(tokenize("t").alias("k")).first()["k"] == ["hi,", "you", "1!", "a", "b"]


def test_vocab_empty(spark):
    df = spark.createDataFrame([(1, ["rare", "words"]), (2, ["x", "x", "x"])], "d int, tokens array<string>")
    vocab = text.vocabulary(df, "d", "tokens", 3)
    out = text.filter_vocab(df, "d", "tokens", vocab)
    assert {r["d"]: r["tokens"] for r in out.collect()} == {1: [], 2: ["x", "x", "x"]}


def test_pad(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b", "c", "d", "e"],)], "t array<string>")
    got = [r["p"] for r in df.select(pad_sequence("t", 4, "0").alias("p")).collect()]
    assert got == [["0", "0", "a", "b"], ["a", "b", "c", "d"]]


def test_genre_pad(spark):
    df = spark.createDataFrame([([3, 1],), ([1, 2, 3, 4, 5, 6, 7],)], "g array<int>")
    got = [r["p"] for r in df.select(S.left_pad("g", 6, 18).alias("p")).collect()]
    assert got == [[18, 18, 18, 18, 3, 1], [1, 2, 3, 4, 5, 6, 7]]


def test_title_and_era(spark):
    df = spark.createDataFrame([("Toy (x) (1995)",), ("No year",)], "t string")
    assert [r["y"] for r in df.select(S.title_year("t").alias("y")).collect()] == [1995, None]
    ys = spark.createDataFrame([(y,) for y in [1919, 1930, 1931, 1940, 1980, 1981]], "y int")
    assert [r["e"] for r in ys.select(S.bucket_ceiling("y").alias("e")).collect()] == [1930, 1930, 1940, 1940, 1980, 1981]


def test_clip(spark):
    df = spark.createDataFrame([(0, 5.2), (1, 0.3), (2, 3.1), (3, None)], "i int, r double")
    assert col(df.select("i", S.clip("r", 1.0, 5.0).alias("c")), "c") == [5.0, 1.0, 3.1, None]


def test_promote(spark):
    df = spark.createDataFrame([(0, 0.87), (1, 0.8699), (2, 0.13 - 1e-9), (3, 0.5)], "i int, p0 double") \
        .withColumn("pool", F.lit("semi")).withColumn("label", F.lit(None).cast("string"))
    out = semi.promote(df, "p0", threshold=0.87)
    assert col(out, "label") == ["0", None, "1", None]
    assert col(out, "pool") == ["train", "semi", "train", "semi"]


def test_ordinal(spark):
    df = spark.createDataFrame([(0.0,)], "z double")
    p = df.select(S.ordinal_probs("z", [0.2, 0.4, 0.6, 0.8]).alias("p")).first()["p"]
    assert all(v > 0 for v in p) and abs(sum(p) - 1.0) < 1e-12


def test_best_threshold_tie(spark):
    # every threshold in [0.4, 0.5) separates the data equally well: the lowest wins
    df = spark.createDataFrame([(0.3, 0), (0.35, 0), (0.55, 1), (0.7, 1)], "p double, y int")
    t, correct = logistic.best_threshold(df, "p", "y", 0.4, 0.6, 0.001)
    assert t == pytest.approx(0.4) and correct == 4


def test_folds_exact(spark):
    df = spark.range(11).withColumnRenamed("id", "k")
    out = split.with_folds(df, "k", 5, exact=True)
    sizes = sorted(r["count"] for r in out.groupBy("fold").count().collect())
    assert sizes == [2, 2, 2, 2, 3]
    assert out.select("k").distinct().count() == 11


def test_folds_disjoint_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    out = split.with_folds(df, "k", 7)
    assert out.count() == 1000 and out.select("k").distinct().count() == 1000
    assert set(r["fold"] for r in out.select("fold").distinct().collect()) == set(range(7))


def test_quadratic():
    Q, p = np.diag([2.0, 4.0]), np.array([-2.0, -8.0])
    assert np.allclose(minimize_quadratic(Q, p, step="analytic"), [1, 2])
    for kw in [dict(step="best"), dict(step=0.1), dict(step=0.5, ada=True)]:
        x = minimize_quadratic(Q, p, conv_norm=0.1, max_iter=5000, **kw)
        assert np.linalg.norm(Q @ x + p) < 0.1


def test_denoise(spark):
    img = [9] * 9
    img[4] = 255
    df = spark.createDataFrame([(img,)], "a array<int>")
    assert images.denoise(df, "a", 3, 3).first()["a"] == [9] * 9


def test_contrast(spark):
    df = spark.createDataFrame([(0, [0, 50]), (1, [0, 51])], "i int, a array<int>")
    assert col(clean.filter_contrast(df, "a", 50), "i") == [1]


def test_flip_shift(spark):
    df = spark.createDataFrame([(list(range(6)),)], "a array<int>")
    r = df.select(images.flip_horizontal("a", 2, 3).alias("f")).first()["f"]
    assert r == [2, 1, 0, 5, 4, 3]


def test_row_id_dense(spark):
    df = spark.range(0, 5000, 1, numPartitions=13).withColumn("k", (F.col("id") * 7919) % 5003)
    out = clean.with_row_id(df, ["k"]).orderBy("row_id").collect()
    assert [r["row_id"] for r in out] == list(range(1, 5001))
    ks = [r["k"] for r in out]
    assert ks == sorted(ks)


def test_ffill_segment_equals_plain(spark):
    rng = np.random.default_rng(1)
    rows = [(int(u), int(t), int(t // 10), None if rng.random() < 0.4 else float(rng.integers(100)))
            for u in range(5) for t in range(60)]
    df = spark.createDataFrame(rows, "u int, t int, seg int, v double")
    for fn in (fill.ffill, fill.bfill):
        a = {(r["u"], r["t"]): r["v"] for r in fn(df, ["v"], ["u"], ["t"]).collect()}
        b = {(r["u"], r["t"]): r["v"] for r in fn(df, ["v"], ["u"], ["t"], segment="seg").collect()}
        assert a == b


def test_carry_forward_sorted(spark):
    rows = [(i, None if i % 3 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(7)
    out = {r["k"]: r["v"] for r in fill.carry_forward_sorted(df, "k", ["v"]).collect()}
    assert all(out[i] == float(i - i % 3) for i in range(200))


def test_segmented_lags_equal_plain(spark):
    rng = np.random.default_rng(2)
    rows = [(int(u), int(t), int(t // 7), float(rng.integers(100))) for u in range(4) for t in range(50)
            if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "u int, t int, seg int, v double")
    a = {(r["u"], r["t"]): tuple(r[f"v_{k}"] for k in range(1, 10))
         for r in fill.add_lags(df, ["v"], 9, ["u"], ["t"]).collect()}
    b = {(r["u"], r["t"]): tuple(r[f"v_{k}"] for k in range(1, 10))
         for r in fill.add_lags(df, ["v"], 9, ["u"], ["t"], segment="seg").collect()}
    assert a == b


def test_best_threshold_brute_force(spark):
    rng = np.random.default_rng(4)
    grid = np.arange(0.4, 0.6, 0.001)
    p = np.concatenate([rng.uniform(0.3, 0.7, 400), grid[rng.integers(0, 200, 100)]])  # include exact grid values
    y = (rng.random(len(p)) < p).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, y int")
    t, correct = logistic.best_threshold(df, "p", "y", 0.4, 0.6, 0.001)
    acc = np.array([(((p > g).astype(int)) == y).sum() for g in grid])
    assert correct == acc.max() and t == grid[acc.argmax()]


def test_split_at(spark):
    df = spark.range(0, 100, 1, numPartitions=7).withColumn("k", (F.col("id") * 37) % 101)
    head, rest = clean.split_at(df, 10, ["k"])
    ks = sorted(r["k"] for r in df.collect())
    assert sorted(r["k"] for r in head.collect()) == ks[:10]
    assert sorted(r["k"] for r in rest.collect()) == ks[10:]


def test_standardize_reuses_training_stats(spark):
    from tessera.operators.scale import standardize, znorm

    train = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    score = spark.createDataFrame([(10.0,)], "x double")
    _, st = standardize(train, ["x"])
    assert st["x"] == pytest.approx((2.0, 1.0))
    applied, _ = standardize(score, ["x"], stats=st)
    assert applied.first()["x"] == pytest.approx(8.0)          # training statistics
    own, own_st = standardize(score.union(spark.createDataFrame([(12.0,)], "x double")), ["x"])
    assert own_st["x"][0] == pytest.approx(11.0)                # its own statistics when none are given
    z, zst = znorm(train, ["x"], eps=1e-4)
    assert zst["x"][1] == pytest.approx(np.sqrt(2.0 / 3.0))     # population std
    assert z.orderBy("x").first()["x"] == pytest.approx(-1.0 / (np.sqrt(2.0 / 3.0) + 1e-4))
