"""Spark helpers shared by the operators: stored tables and joins that hot keys can't hurt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.token_files import new_folder

#: A key is hot if more than one in HOT_SHARE of the rows has it; so there are fewer hot keys than this.
HOT_SHARE = 1000
#: Tables of at most so many rows of a few numbers each are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


#: Rows of an Arrow batch where rows are whole texts: 10,000, as Spark has it, take a task 64 MB and more on either side.
TEXTS_PER_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to TEXTS_PER_BATCH rows; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXTS_PER_BATCH:
        spark.conf.set(key, str(TEXTS_PER_BATCH))


def stored(df: DataFrame, kind: str) -> DataFrame:
    """df written as a table to the cluster's shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = f"{new_folder(spark, 'tables')}/{kind}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hot_lookup(left: DataFrame, right: DataFrame, key: str, values: list[str], count: str, total: int, inner: bool = False) -> DataFrame:
    """left with right's values for its long key; right has one row a key, and how many rows of left have it.

    total is at least left's number of rows, so right has no more rows either and is broadcast where
    total is small enough. Else keys with more than total / HOT_SHARE rows, which are fewer than
    HOT_SHARE, are broadcast. The others are joined by shuffle, in which the rows already served are
    dealt by a hash of their own.
    """
    if total <= BROADCAST_ROWS:
        return left.join(F.broadcast(right.select(key, *values)), key, "inner" if inner else "left").select(*left.columns, *values)
    share = max(1, total // HOT_SHARE)
    hot = right.filter(F.col(count) > share).select(key, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values])
    rest = right.filter(F.col(count) <= share).select(F.col(key).alias("_key"), F.lit(False).alias("_served"), F.lit(True).alias("_cold"), *[F.col(v).alias(f"_cold_{v}") for v in values])
    out = left.join(F.broadcast(hot), key, "left").withColumn("_served", F.coalesce("_hot", F.lit(False)))
    out = out.withColumn("_key", F.when(F.col("_served"), F.xxhash64(*left.columns)).otherwise(F.col(key)))
    # the key itself travels only where it is not the key of the join
    out = out.withColumn("_own", F.when(F.col("_served"), F.col(key))).drop(key, "_hot")
    out = out.join(rest, ["_key", "_served"], "left").withColumn(key, F.coalesce("_own", "_key"))
    if inner:
        out = out.filter(F.col("_served") | F.col("_cold").isNotNull())
    return out.select(*left.columns, *[F.when(F.col("_served"), F.col(f"_hot_{v}")).otherwise(F.col(f"_cold_{v}")).alias(v) for v in values])


def connected(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of the edges (a, b: long) can reach.

    Alternating large-star and small-star steps; each is one grouped minimum and one lookup, so the
    edges of a node are never together. Stops when a pair of steps changes no edge, as two 64-bit
    sums over the edges tell.
    """

    def star(pairs: DataFrame, n: int) -> DataFrame:
        least = pairs.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n"))
        out = hot_lookup(pairs, least, "a", ["least"], "n", n)
        return out.withColumn("least", F.least("least", "a"))

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a").cast("decimal(20,0)")).alias("y")).first()

    def edge(a: str, b: str):
        return F.struct(F.col(a).alias("a"), F.col(b).alias("b"))

    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    was = state(edges)
    while was["n"]:
        both = edges.select(F.explode(F.array(edge("a", "b"), edge("b", "a"))).alias("e")).select("e.*")
        large = star(both, 2 * was["n"]).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = star(large, was["n"]).select(F.explode(F.array(edge("b", "least"), edge("a", "least"))).alias("e")).select("e.*")
        edges = stored(small.filter("a != b").distinct(), "edges")
        now = state(edges)
        if now == was:
            break
        was = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))

