"""Image rows as flat arrays: parsing, augmentation, salt-and-pepper denoise.

An image is one row (``array`` of h*w values, row-major). Everything row-wise is
a higher-order array expression; the 3x3 median filter runs with NumPy on Arrow
batches of rows (mapInPandas), so images are spread over all tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import c


def parse_pixels(df: DataFrame, col: str, n: int | None = None, out: str = "pixels") -> DataFrame:
    """Space-separated integers -> ``array<int>`` (S10); rows of the wrong size get NULL."""
    arr = F.split(F.trim(c(col)), " +").cast("array<int>")
    if n is not None:
        arr = F.when(F.size(arr) == n, arr)
    return df.withColumn(out, arr)


def flip_horizontal(arr, h: int, w: int) -> Column:
    """Reverse every image row: reshape to h rows of w (P6 inverse), reverse, flatten."""
    a = c(arr)
    rows = F.transform(F.sequence(F.lit(0), F.lit(h - 1)), lambda i: F.slice(a, i * w + 1, w))
    return F.flatten(F.transform(rows, lambda r: F.reverse(r)))


def shift_right(arr, h: int, w: int, s: int, fill=0.0) -> Column:
    """Shift every row s pixels to the right, filling with ``fill``."""
    a = c(arr)
    return F.transform(F.sequence(F.lit(0), F.lit(h * w - 1)),
                       lambda p: F.when(p % w >= s, F.element_at(a, (p - s + 1).cast("int")))
                       .otherwise(F.lit(fill).cast("float")))


def brighten(arr, delta: float) -> Column:
    return F.transform(c(arr), lambda v: v + F.lit(delta))


def augment(df: DataFrame, arr: str, h: int, w: int, shift: int = 1, delta: float | None = None,
            variant: str = "variant") -> DataFrame:
    """One row per (image, variant): original, horizontal flip, shift (, brightness)."""
    variants = [F.struct(F.lit("orig").alias("v"), c(arr).alias("a")),
                F.struct(F.lit("flip").alias("v"), flip_horizontal(arr, h, w).alias("a")),
                F.struct(F.lit("shift").alias("v"), shift_right(arr, h, w, shift).alias("a"))]
    if delta is not None:
        variants.append(F.struct(F.lit("bright").alias("v"), brighten(arr, delta).alias("a")))
    ex = df.withColumn("__var", F.explode(F.array(*variants)))
    return ex.withColumn(variant, F.col("__var.v")).withColumn(arr, F.col("__var.a")).drop("__var")


def denoise(df: DataFrame, arr: str, h: int, w: int, low: float = 0, high: float = 255, out: str | None = None) -> DataFrame:
    """Pixels equal to ``low`` or ``high`` take the median of their 3x3 neighbourhood.

    Edges repeat the border pixel. Runs per Arrow batch: the batch becomes an
    (n, h, w) NumPy array, the nine shifted views are stacked and reduced.
    """
    out = out or arr
    elem = df.schema[arr].dataType.elementType

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                yield pdf
                continue
            imgs = np.stack(pdf[arr].to_numpy()).astype(float).reshape(-1, h, w)
            pad = np.pad(imgs, ((0, 0), (1, 1), (1, 1)), mode="edge")
            views = np.stack([pad[:, i:i + h, j:j + w] for i in range(3) for j in range(3)], axis=0)
            med = np.median(views, axis=0)
            noisy = (imgs == low) | (imgs == high)
            res = np.where(noisy, med, imgs).reshape(len(pdf), h * w)
            if isinstance(elem, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
                res = np.floor(res).astype(np.int64)
            pdf = pdf.copy()
            pdf[out] = list(res)
            yield pdf

    schema = df.schema if out in df.columns else T.StructType(
        list(df.schema.fields) + [T.StructField(out, T.ArrayType(elem))])
    return df.mapInPandas(run, schema)


def to_pixels(df: DataFrame, arr: str, lo: float, hi: float, out: str = "pixels") -> DataFrame:
    """Linear map [lo, hi] -> integers 0..255 (floor), for image-style operators."""
    return df.withColumn(out, F.transform(c(arr), lambda v: F.floor((v.cast("double") - lo) * 255.0 / (hi - lo))
                                          .cast("int")))
