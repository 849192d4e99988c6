"""Row numbers and carries over literal ranges: equal to a plain sort, no cache, hot values split."""

import random

from pyspark.sql import functions as F

from tessera.operators.clean import split_at, with_row_id
from tessera.operators.fill import carry_forward_sorted
from tessera.operators.ranges import with_range


def _table(spark, n=3000):
    rng = random.Random(4)
    rows = [(None if rng.random() < 0.02 else "hot" if rng.random() < 0.4 else f"k{rng.randrange(500):03d}",
             None if rng.random() < 0.1 else rng.uniform(-5, 5), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, x double, i long").repartition(5)


def test_row_ids_equal_a_sort(spark):
    rows, df = _table(spark)
    for ranges in (1, 2, 7, 40):
        got = with_row_id(df, ["k", "x", "i"], ranges=ranges).collect()
        want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0.0, r[2]))
        assert [r["i"] for r in sorted(got, key=lambda r: r["row_id"])] == [r[2] for r in want]
        assert sorted(r["row_id"] for r in got) == list(range(1, len(rows) + 1))


def test_ties_and_equal_rows_get_dense_numbers(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [("a", 2)] * 3 + [(None, None)], "k string, v int")
    got = with_row_id(df, ["k"], start=0, ranges=4).collect()
    assert sorted(r["row_id"] for r in got) == list(range(54))
    assert min(got, key=lambda r: r["row_id"])["k"] is None
    assert got[0].asDict().keys() == {"k", "v", "row_id"}


def test_hot_value_is_split_and_nothing_is_cached(spark):
    _, df = _table(spark)
    sizes = [r["count"] for r in with_range(df, ["k"], ranges=10).groupBy("__range").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * sum(sizes) / 10
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    numbered = with_row_id(df, ["k"], ranges=10)
    assert sorted(r["row_id"] for r in numbered.select("row_id").collect()) == list(range(1, 3001))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    # the same rows dealt to other partitions keep their numbers
    again = with_row_id(df.repartition(3, "x"), ["k"], ranges=10)
    assert numbered.join(again, ["i", "row_id"]).count() == 3000


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert with_row_id(df, ["k"]).collect() == []
    head, tail = split_at(df, 3, ["k"])
    assert head.count() == tail.count() == 0
    assert carry_forward_sorted(df, "k", ["v"], ranges=3).collect() == []


def test_carry_equals_a_loop(spark):
    rng = random.Random(5)
    rows = [(i, None if rng.random() < 0.8 else rng.randrange(9), None if i < 700 else i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, a int, b int").repartition(4)
    for exclusive in (False, True):
        got = {r["k"]: (r["a"], r["b"]) for r in carry_forward_sorted(df, "k", ["a", "b"], exclusive, ranges=13).collect()}
        last = [None, None]
        for k, *vals in rows:
            before = tuple(last)
            last = [v if v is not None else w for v, w in zip(vals, last, strict=True)]
            assert got[k] == (before if exclusive else tuple(last)), k


def test_plan_has_no_single_partition_window_over_rows(spark):
    _, df = _table(spark, 200)
    plan = with_row_id(df, ["k"], ranges=5)._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in plan
    assert plan.count("Exchange SinglePartition") == 1  # the offsets, one row a range
    assert with_row_id(df.withColumn("m", F.create_map(F.lit(1), F.lit(2))), ["k"], ranges=5).count() == 200
