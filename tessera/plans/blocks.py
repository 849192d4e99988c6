"""Block-scoring plan in the shape of the hourly air-quality scorer, on the events stand-in.

Each (user, day) is an observation block; its 3-hour slots 1..8 (1 = most recent) are
the "hours" and the event types are the measured items.

  long (block, item, slot, value) [P1]  ->  wide items per (block, slot) [P2]
  -> clean: sentinel, floor, coercion [C3, C4, C1]  ->  wind-style vector features [F3, F4]
  -> two-way zero repair inside the block [W4]  ->  one row per block, item_slot columns [P3]
  -> squares, slot means, all-zero flag, interactions [F5-F8]  ->  design vector [P5, P7]
  -> linear score with coefficients from a fold-keyed ridge fit on the same blocks [M5, M6]

Shuffles: the slot aggregation (partial, keyed by block and slot), then everything keyed
by block: the repair window and the block pivot share the block partitioning, and the
Gram pass is a partial aggregation to one row per fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import clean, fill, reshape
from tessera.operators.linear import fit_ridge_cv, predict_linear
from tessera.operators.split import with_folds
from tessera.plans.activity import EVENT_TYPES
from tessera.session import table

SLOTS = list(range(1, 9))


def block_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    block = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.to_date("ts").cast("string"))
    slot = (F.lit(23) - F.hour("ts")) / 3
    long = ev.select(block.alias("block"), (F.floor(slot) + 1).cast("int").alias("slot"),
                     F.col("event_type").alias("item"),
                     # errors carry the sentinel text of a missing reading
                     F.when(F.col("event_type") == "error", F.lit("NR")).otherwise(F.col("value").cast("string"))
                     .alias("raw"))
    long = clean.replace_value(long, "raw", "NR", "0")
    long = clean.to_numeric(long, ["raw"])
    # Items to columns per (block, slot), one conditional aggregate per item
    wide = reshape.to_wide(long, ["block", "slot"], "item", "raw", EVENT_TYPES, agg="sum")
    wide = clean.floor_at(wide, EVENT_TYPES, 0.0)
    x, y = S.polar_to_xy("click", F.col("view") * 10.0)
    wide = wide.select("*", F.abs(x).alias("xvec"), F.abs(y).alias("yvec"), S.flag(x >= 0).alias("East"))
    items = EVENT_TYPES + ["xvec", "yvec", "East"]
    # Zero repair inside each block (slots are complete only where events exist)
    repaired = fill.repair_zeros(wide, ["click", "view", "purchase", "xvec", "yvec"], "block", "slot", last=8)
    # One row per block with item_slot columns (missing slots stay NULL)
    blocks = reshape.to_block(repaired, "block", "slot", items, SLOTS)
    feats = blocks.select(
        "block", F.lit(1.0).alias("const"),
        *[F.coalesce(F.col(f"{it}_{h}"), F.lit(0.0)).alias(f"{it}_{h}") for it in items for h in SLOTS])
    feats = feats.select(
        "*",
        *[e.alias(n) for n, e in S.powers([f"{it}_1" for it in ["click", "view"]], [2])],
        S.lag_mean("view", 8).alias("view_mean"), S.lag_mean("click", 8).alias("click_mean"),
        S.all_zero_flag("error", 8).alias("no_error"),
        *[e.alias(n) for n, e in S.interact("click_1", ["xvec_1", "yvec_1"], "click_x_")],
        # target: purchases in the most recent slot
        F.col("purchase_1").alias("target"),
    )
    return feats


def block_scoring(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    feats = block_features(spark, sf_dir)
    x = ["const", "click_2", "view_2", "click_1_p2", "view_1_p2", "view_mean", "click_mean", "no_error",
         "click_x_xvec_1", "click_x_yvec_1", "East_2", "purchase_2", "purchase_3"]
    feats = with_folds(feats.withColumn("__key", F.pmod(F.xxhash64("block"), F.lit(1 << 62))), "__key", k).cache()
    coef, _, _ = fit_ridge_cv(feats, x, "target", [1.0, 10.0, 100.0])
    scored = predict_linear(feats, x, coef, "score")
    return scored.select("block", "fold", "target", F.round("score", 6).alias("score"))
