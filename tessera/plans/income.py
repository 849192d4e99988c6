"""Classification plan in the shape of the income scripts, on the customer/orders stand-in.

customer -> level map + one-hot (segment, region via a star join) -> per-customer order
aggregates (one partial aggregation, joined on the key) -> right-closed bins, flags,
powers, interactions -> standardisation (one stats job, literals) -> hash folds ->
logistic CV (every fold's Newton step in one aggregation job) -> threshold chosen on the
training part -> final fit -> classification of every customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import logistic
from tessera.operators.joins import lookup
from tessera.operators.scale import standardize
from tessera.operators.split import with_folds
from tessera.session import table

# Fixed values for the stand-in: market segments clustered into levels.
SEGMENT_LEVELS = {"AUTOMOBILE": "c1", "MACHINERY": "c1", "BUILDING": "c2", "FURNITURE": "c3", "HOUSEHOLD": "c3"}
ORDER_BINS = [0, 5, 10, 15, 20, 1000]


def income_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    na = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_totalprice", "o_orderpriority")
    per_cust = orders.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("o_totalprice").alias("spent"),
        F.avg(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double")).alias("urgent_share"))
    base = lookup(lookup(cu, na, "c_nationkey"), per_cust, "c_custkey")
    base = base.select(
        "c_custkey", (F.col("c_acctbal") > 0).cast("double").alias("y"),
        S.map_levels("c_mktsegment", SEGMENT_LEVELS).alias("seg"), "n_regionkey",
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("double").alias("n_orders"),
        F.coalesce(F.col("spent"), F.lit(0.0)).alias("spent"),
        F.coalesce(F.col("urgent_share"), F.lit(0.0)).alias("urgent_share"))
    seg_hot = S.one_hot("seg", ["c1", "c2", "c3"], "seg")
    reg_hot = S.one_hot("n_regionkey", [0, 1, 2, 3, 4], "region")
    bins = S.one_hot(S.cut("n_orders", ORDER_BINS), [f"c{i}" for i in range(1, len(ORDER_BINS))], "orders")
    feats = base.select(
        "c_custkey", "y", F.lit(1.0).alias("const"),
        *[e.alias(n) for n, e in seg_hot], *[e.alias(n) for n, e in reg_hot], *[e.alias(n) for n, e in bins],
        S.flag(F.col("n_orders") > 0).alias("has_orders"),
        S.flag(F.col("n_orders") > 15).alias("many_orders"),
        "n_orders", S.power("n_orders", 2).alias("n_orders_p2"), "spent", "urgent_share",
        *[(F.col(n) * F.col("urgent_share")).alias(f"{n}_x_urgent") for n, _ in seg_hot],
    )
    numeric = ["n_orders", "n_orders_p2", "spent", "urgent_share"]
    feats, _ = standardize(feats, numeric)
    names = [c for c in feats.columns if c not in ("c_custkey", "y")]
    return feats, names


def income_classification(spark: SparkSession, sf_dir: str, k: int = 5, reg: float = 0.5) -> DataFrame:
    feats, names = income_features(spark, sf_dir)
    feats = with_folds(feats, "c_custkey", k).cache()
    # every fold model and the final all-rows model share each Newton pass
    W, _ = logistic.logistic_steps(feats, names, "y", reg=reg, solver="newton", fold="fold",
                                   folds=list(range(k)), conv_norm=1e-6, max_iter=25, include_all=True)
    # threshold per fold from that fold's training rows (one grouped job); the final
    # threshold is their mean
    per_fold = logistic.best_threshold_by_fold(feats, names, "y", W, "fold")
    ts = [t for t, _ in per_fold.values()]
    w_all = W[logistic.ALL_ROWS]
    scored = logistic.predict_proba(feats, names, w_all, "p")
    out = logistic.classify(scored, "p", float(sum(ts) / len(ts)), "label")
    return out.select("c_custkey", "fold", "y", "p", "label")
