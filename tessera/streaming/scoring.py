"""Structured Streaming: row-wise feature and scoring operators on a stream.

The expression operators (cleaning, features, linear/logistic/Gaussian scoring,
nearest-centre assignment, thresholds, pseudo-label promotion) use no
whole-table state, so the same functions apply to ``readStream`` DataFrames;
operators that need a statistic take it as an argument (``stats=``) computed
once on the batch data. Dimension lookups are stream-static joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def open_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_scoring(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
                fmt: str = "parquet", available_now: bool = True):
    """Apply ``transform`` to every micro-batch and append to ``sink``.

    The checkpoint folder (shared storage on a cluster) records progress, so a
    restarted query resumes where it stopped and the file sink stays exactly-once.
    """
    out = transform(stream)
    w = out.writeStream.format(fmt).option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
