"""The corpus pipeline: documents through five of the training-data operators.

Each stage takes the rows its predecessor kept, written as Parquet and read again. Null and empty
texts pass the filters unless a copy of them was seen, repeated rows leave one row at the
near-duplicate stage, an empty table gives an empty result, and columns that documents do not have
are not carried. Stages that change a text set n_chars to its new length.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import pii, toxicity
from tessera.llm._spark import small_batches, stored
from tessera.llm.decontaminate import decontaminate
from tessera.llm.jaccard_join import jaccard_components
from tessera.llm.queries import VOCABULARY, bpe_digests, table, toxicity_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not scored as toxic (operator 5)."""
    small_batches(spark)
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).filter("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each connected group of near duplicates the document with the smallest id (operator 8).

    Rows without an id take a negative one from their text for this stage; rows that repeat an
    id and text leave one row; texts without words are no duplicates of each other's documents.
    """
    small_batches(spark)
    own = F.coalesce("doc_id", -F.shiftrightunsigned(F.xxhash64("text"), 1) - 1)
    rows = docs.select(*COLUMNS).withColumn("own", own)
    first = jaccard_components(rows, id_col="own").filter("doc_id = component_id").select(F.col("doc_id").alias("own")).distinct()
    return rows.join(first, "own", "left_semi").withColumn("hash", F.xxhash64("text")).dropDuplicates(["own", "hash"]).select(*COLUMNS)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages they share with the benchmark (operator 1)."""
    small_batches(spark)
    return _measured(decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind (operator 10)."""
    small_batches(spark)
    return _measured(pii.redact(docs.select(*COLUMNS), pii.fit(docs)))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text (operator 2)."""
    small_batches(spark)
    return bpe_digests(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark_passages),
    ("personal_data", redact_personal_data),
    ("bpe", encode_tokens),
]

#: Neighbour votes, boosted trees and BPE can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
