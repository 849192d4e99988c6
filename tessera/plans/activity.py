"""Flagship plan: daily activity forecast (the hourly-forecast scripts in miniature).

events -> (user, day) aggregate with per-type columns -> lags 1..3 per user ->
lag mean, calendar features -> drop incomplete rows -> hash folds ->
one fold-keyed Gram pass -> ridge CV over a lambda grid -> literal-coefficient scoring.

Shuffles: one for the daily aggregate (partial aggregation first, so a hot user
costs one partial row per map task), one for the per-user lag window over the
daily table (bounded: at most one row per user and day). The Gram pass is a
partial aggregation to one row per fold; coefficients return as literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators.clean import drop_missing
from tessera.operators.fill import add_lags
from tessera.operators.linear import fit_ridge_cv, predict_linear
from tessera.operators.split import with_folds
from tessera.session import table

# Event types of the events table, in a fixed order (fixed schema).
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
FEATURES = ["const", "y_1", "y_2", "y_mean", "n_events_1", "weekend"]
LAMBDAS = [0.0, 1.0, 10.0, 100.0, 1000.0, 10000.0]


def daily_activity(events: DataFrame) -> DataFrame:
    """(user_id, day) -> total value y, event count, value per event type."""
    ev = events.select("user_id", F.to_date("ts").alias("day"), "event_type", "value")
    per_type = [F.sum(F.when(F.col("event_type") == t, F.col("value")).otherwise(F.lit(0.0))).alias(f"v_{t}")
                for t in EVENT_TYPES]
    return ev.groupBy("user_id", "day").agg(
        F.sum("value").alias("y"), F.count(F.lit(1)).alias("n_events"), *per_type
    )


def activity_features(events: DataFrame) -> DataFrame:
    daily = daily_activity(events)
    lagged = add_lags(daily, ["y", "n_events"], 3, part=["user_id"], order=["day"])
    feats = lagged.select(
        "user_id", "day", "y",
        F.lit(1.0).alias("const"),
        "y_1", "y_2", "y_3",
        S.lag_mean("y", 3).alias("y_mean"),
        F.col("n_events_1").cast("double").alias("n_events_1"),
        F.dayofweek("day").isin(1, 7).cast("double").alias("weekend"),
        (F.col("user_id") * 100000 + F.datediff("day", F.lit("2000-01-01").cast("date"))).alias("row_key"),
    )
    return drop_missing(feats, ["y_1", "y_2", "y_3"])


def activity_forecast(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    events = table(spark, sf_dir, "events")
    feats = with_folds(activity_features(events), "row_key", k).cache()
    coef, best, _ = fit_ridge_cv(feats, FEATURES, "y", LAMBDAS, fold="fold")
    scored = predict_linear(feats, FEATURES, coef)
    return scored.select("user_id", "day", "y", F.round("prediction", 6).alias("prediction"), "fold")
