"""Rare words without a join by word, and lookups where a few keys hold most of the rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import tokenize
from tessera.operators import joins, text


def corpus():
    rng = random.Random(6)
    docs = [(i, [rng.choice(["the", "of", f"w{rng.randrange(80)}", f"x{rng.randrange(4000)}"]) for _ in range(rng.randrange(60))]) for i in range(200)]
    return docs + [(900, None), (901, []), (902, ["only", None, "the", None]), (903, ["once"] * 2), (904, ["thrice"] * 3)]


@pytest.mark.parametrize("min_count", [1, 2, 3, 7])
@pytest.mark.parametrize("rows", [10_000, 9])
def test_rare_words(spark, min_count, rows):
    """Also where a word is rare in each Arrow batch but not in all."""
    docs = corpus()
    n = Counter(w for _, ws in docs for w in ws or [] if w is not None)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc long, toks array<string>, pos string").repartition(3)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        got = {r["doc"]: r["toks"] for r in text.drop_rare(df, "doc", "toks", min_count).collect()}
        with_rare = {r["doc"] for r in text.rare_docs(df, "doc", "toks", min_count).collect()}
    finally:
        spark.conf.set(key, before)
    assert got == {d: [w for w in ws or [] if w is not None and n[w] >= min_count] for d, ws in docs}
    assert with_rare == {d for d, ws in docs if any(w is not None and n[w] < min_count for w in ws or [])}


def test_rare_words_of_no_documents(spark):
    df = spark.createDataFrame([], "doc long, toks array<string>")
    assert text.drop_rare(df, "doc", "toks").collect() == [] and text.rare_docs(df, "doc", "toks").collect() == []


def test_rare_words_need_no_join_by_word(spark):
    df = spark.createDataFrame(corpus(), "doc long, toks array<string>")
    plan = text.drop_rare(df, "doc", "toks")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Join LeftOuter, (doc#" in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_lookup_equals_a_join(spark, how):
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot", "hot", "hot", f"k{rng.randrange(300)}", None])) for i in range(3000)]
    facts = spark.createDataFrame(rows, "i int, k string")
    counts = facts.groupBy("k").agg(F.count("*").alias("n")).filter("k <> 'k7' or k is null").withColumn("v", F.length("k") + F.col("n"))
    got = joins.hot_lookup(facts, counts, "k", ["v"], "n", how, hot_keys=2)
    want = facts.join(counts.select("k", "v"), "k", how).select("i", "k", "v")
    assert got.columns == ["i", "k", "v"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_a_hot_word_is_in_no_single_task(spark):
    """One word holds 97 % of the tokens; after the lookup no task has twice the mean."""
    facts = spark.range(60_000).select("id", F.when(F.col("id") % 100 < 97, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id") % 997)).alias("word"))
    dim = facts.groupBy("word").agg(F.count("*").alias("n"))
    keys = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k in keys:
            spark.conf.set(k, {"spark.sql.adaptive.enabled": "false"}.get(k, "-1"))
        out = joins.hot_lookup(facts, dim, "word", ["n"], "n")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 60_000 and max(sizes) <= 2 * 60_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for k, v in keys.items():
            spark.conf.set(k, v)


def test_tokens_are_cut_at_filters(spark):
    filters = '"#$%&()*+-/<=>@[\\]^_`{|}~\t\n'
    texts = ["A-b  c\t\n", "", "   ", None, "don't stop, now!", "[x]\\^y", "É|世 ~", "a\rb"]
    got = [r["t"] for r in spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "s string, i int").orderBy("i").select(tokenize("s").alias("t")).collect()]
    table = str.maketrans(filters, " " * len(filters))
    assert got == [None if t is None else [w for w in t.lower().translate(table).split(" ") if w] for t in texts]


@pytest.mark.parametrize("known", [200_000, 5, 0])
@pytest.mark.parametrize("repeats", [False, True])
def test_a_given_vocabulary(spark, monkeypatch, known, repeats):
    """Whether a word is broadcast or looked up; rows that repeat an id are one document, rows without one keep nothing."""
    monkeypatch.setattr(text, "KNOWN_WORDS", known)
    monkeypatch.setattr(text, "SLICE_TOKENS", 100)
    docs = corpus() + ([(1, ["the", "w1", "other"]), (903, ["once", "of"]), (None, ["the"])] if repeats else [])
    vocab = {"the", "of", "once", *[f"w{i}" for i in range(0, 80, 2)]}
    df = spark.createDataFrame(docs, "doc long, toks array<string>").repartition(3)
    given = spark.createDataFrame([(w, 1) for w in vocab] + [(None, 1)], "word string, n int")
    got = text.filter_vocab(df, "doc", "toks", given, rows="n").collect()
    assert len(got) == len(docs)
    for row in got:
        mine = sorted((p, w) for d, ws in docs if d == row["doc"] and d is not None for p, w in enumerate(ws or []) if w in vocab)
        # of words at one position, the smaller comes first
        assert row["toks"] == [w for _, w in mine]
    oov = {r["doc"] for r in text.oov_docs(df, "doc", "toks", given).collect()}
    assert oov == {d for d, ws in docs if any(w is not None and w not in vocab for w in ws or [])}


def test_a_given_vocabulary_shuffles_no_known_word(spark):
    """One row a batch and unknown word is looked up, not one a token."""
    df = spark.createDataFrame([(i, ["the"] * 50 + [f"x{i % 2}"]) for i in range(40)], "doc long, toks array<string>").coalesce(1)
    given = spark.createDataFrame([("the", 2000)], "word string, n int")
    plan = text.unknown_words(df, "doc", "toks", given, rows="n")
    assert plan.count() == 40
    tree = plan._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("Generate") < tree.index("LeftAnti") < tree.index("MapInArrow")
