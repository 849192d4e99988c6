"""Sources and sinks (S1-S16): delimited files, line-oriented text, images, parameter tables.

All readers take an explicit schema or read every field as a string and let
the cleaning operators coerce (no schema inference job over the data).
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: What Spark's own readers decode in any session.
SPARK_ENCODINGS = {"utf-8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be", "utf-16le", "utf-32"}


def decoded_lines(spark: SparkSession, path: str, encoding: str, out: str = "value") -> DataFrame:
    """Lines of text files in any single- or multi-byte encoding that keeps ASCII line ends.

    Files are split and cut into lines as bytes; tasks decode them, so no session setting is needed.
    Undecodable bytes become U+FFFD; carriage returns at line ends go.
    """
    raw = spark.read.text(path).select(F.col("value").cast("binary").alias("line"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [None if v is None else v.decode(encoding, "replace").rstrip("\r") for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=[out])

    return raw.mapInArrow(decode, f"{out} string")


def _csv(spark: SparkSession, path: str, schema: T.StructType | str | None, header: bool, sep: str = ",",
         encoding: str | None = None) -> DataFrame:
    if encoding is None or encoding.lower() in SPARK_ENCODINGS:
        r = spark.read.option("header", header).option("sep", sep)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
        return (r.option("encoding", encoding) if encoding else r).csv(path)
    lines = decoded_lines(spark, path, encoding).filter(F.length(F.trim("value")) > 0)
    if header:
        # the first line of every file, as all have one header
        first = lines.first()
        if first is None:
            return spark.createDataFrame([], schema if schema is not None else T.StructType([]))
        if schema is None:
            schema = _string_schema(next(csv.reader([first["value"]], delimiter=sep)))
        lines = lines.filter(F.col("value") != first["value"])
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return lines.select(F.from_csv("value", kind, {"sep": sep}).alias("r")).select("r.*")


def read_block_csv(spark: SparkSession, path: str, names: Sequence[str], encoding: str | None = None) -> DataFrame:
    """Header-less CSV, columns named by position, every field a string."""
    return _csv(spark, path, _string_schema(names), header=False, encoding=encoding)


def read_string_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Header CSV, every field a string (S2); no inference pass."""
    return _csv(spark, path, None, header=True, encoding=encoding)


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
                   encoding: str | None = None, header: bool = True) -> DataFrame:
    """Typed CSV (S3); any encoding (S4, e.g. big5) and multi-character separators such as '::' (S5, S13)."""
    return _csv(spark, path, schema, header, sep, encoding)


def read_labeled_text(spark: SparkSession, path: str, sep: str = "+++$+++") -> DataFrame:
    """Lines ``label <sep> text`` -> (label, text)."""
    parts = F.split(F.col("value"), re.escape(sep), 2)
    return spark.read.text(path).select(F.trim(parts.getItem(0)).alias("label"),
                                        F.trim(F.try_element_at(parts, F.lit(2))).alias("text"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One text per line."""
    return spark.read.text(path).select(F.trim("value").alias("text"))


def read_id_text(spark: SparkSession, path: str, header: str = "id") -> DataFrame:
    """``id,text`` split at the first comma only.

    The header line (its first cell is ``header``) drops out; a row whose id is no integer stays, with a NULL id.
    """
    parts = F.split(F.col("value"), ",", 2)
    rows = spark.read.text(path).filter(F.lower(F.trim(parts.getItem(0))) != header)
    return rows.select(F.trim(parts.getItem(0)).try_cast("bigint").alias("id"),
                       F.try_element_at(parts, F.lit(2)).alias("text"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Already-tokenised text, space separated (S9); an empty line gives ``[""]``."""
    return spark.read.text(path).select(F.split(F.col("value"), " ").alias("tokens"))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Dense vector table ``(id, array)`` stored as Parquet."""
    return spark.read.parquet(path)


def read_image_dir(spark: SparkSession, path: str) -> DataFrame:
    """Image directory -> (origin, height, width, channels, pixels array<int>, error).

    Spark's image source decodes files in parallel; ``image.data`` is BGR bytes, row-major. A file that is no
    image keeps its row, with an error and NULL for everything else but its origin.
    """
    img = spark.read.format("image").option("dropInvalid", False).load(path).select("image.*")
    sound = F.col("height") >= 0
    flat = img.select("origin", *[F.when(sound, F.col(a)).alias(b) for a, b in (("height", "height"), ("width", "width"), ("nChannels", "channels"), ("data", "__data"))],
                      F.when(~sound, F.lit("not an image that can be decoded")).alias("error"))
    return image_bytes_to_pixels(flat, "__data", "pixels").select("origin", "height", "width", "channels", "pixels", "error")


def image_bytes_to_pixels(df: DataFrame, data: str = "__data", out: str = "pixels") -> DataFrame:
    """Binary pixel data -> array<int> 0..255, a batch's bytes widened at once; NULL stays NULL."""
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c != out])
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(data).cast(pa.large_binary())
            known = column.is_valid().to_numpy(zero_copy_only=False)
            _, at, raw = column.buffers()
            at = np.frombuffer(at, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
            values = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
            bounds = pa.array((at - at[0]).astype(np.int32), mask=np.append(~known, False))
            pixels = pa.ListArray.from_arrays(bounds, pa.array(values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pixels], names=[*batch.schema.names, out])

    return kept.mapInArrow(widen, schema)


def write_predictions(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite") -> None:
    """Prediction sink ``id,label`` (S14): header CSV, the real key kept."""
    df.select(*cols).write.mode(mode).option("header", True).csv(path)


def checkpoint_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write an intermediate table to (shared) storage and read it back (S15):
    cuts lineage and survives executor loss."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def save_params(spark: SparkSession, path: str, model: str, params: dict[str, object], mode: str = "append") -> None:
    """Parameters as a Parquet table (model, name, idx, value)."""
    rows = []
    for name, v in params.items():
        arr = np.atleast_1d(np.asarray(v, dtype=float)).ravel()
        rows += [(model, name, i, float(x)) for i, x in enumerate(arr)]
    spark.createDataFrame(rows, "model string, name string, idx int, value double").write.mode(mode).parquet(path)


def load_params(spark: SparkSession, path: str, model: str) -> dict[str, np.ndarray]:
    rows = spark.read.parquet(path).filter(F.col("model") == model).orderBy("name", "idx").collect()
    out: dict[str, list] = {}
    for r in rows:
        out.setdefault(r["name"], []).append(r["value"])
    return {k: np.array(v) for k, v in out.items()}
