"""Catalogue: ordered-window operators (lags, fills, zero repair) on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import fill
from tessera.plans.registry import query
from tessera.session import table

_DAILY_SQL = """
daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM events GROUP BY 1, 2)"""


def _daily(spark, d):
    ev = table(spark, d, "events")
    return ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("y"))


@query("q_lags", "W1, F6, F7", f"""
WITH {_DAILY_SQL},
l AS (
  SELECT user_id, day, y,
         lag(y, 1) OVER w AS y_1, lag(y, 2) OVER w AS y_2, lag(y, 3) OVER w AS y_3
  FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day))
SELECT user_id, day, y, y_1, y_2, y_3, (y_1 + y_2 + y_3) / 3.0 AS y_mean,
       CAST(COALESCE(y_1 + y_2 + y_3 = 0, false) AS INTEGER) AS quiet
FROM l
""")
def q_lags(spark, d):
    lagged = fill.add_lags(_daily(spark, d), ["y"], 3, part=["user_id"], order=["day"])
    return lagged.select("user_id", "day", "y", "y_1", "y_2", "y_3",
                         S.lag_mean("y", 3).alias("y_mean"), S.all_zero_flag("y", 3).alias("quiet"))


_MISSING_SQL = "CASE WHEN event_type = 'error' THEN NULL ELSE value END"


def _with_missing(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", "user_id", "ts", F.to_date("ts").alias("day"),
                     F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("v"))


@query("q_ffill", "W2", f"""
SELECT event_id, last_value({_MISSING_SQL} IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
FROM events
""")
def q_ffill(spark, d):
    # segment by day: per-(user, day) fills in parallel, one row per day carries across
    out = fill.ffill(_with_missing(spark, d), ["v"], part=["user_id"], order=["ts"], segment="day")
    return out.select("event_id", "v")


@query("q_bfill", "W3", f"""
SELECT event_id, first_value({_MISSING_SQL} IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v
FROM events
""")
def q_bfill(spark, d):
    out = fill.bfill(_with_missing(spark, d), ["v"], part=["user_id"], order=["ts"], segment="day")
    return out.select("event_id", "v")


_BLOCK_SQL = """
b AS (
  SELECT CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS block, CAST(24 - hour(ts) AS INTEGER) AS hour,
         CAST(SUM(CASE WHEN event_type = 'error' THEN 0 ELSE CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS v
  FROM events GROUP BY 1, 2),
a AS (SELECT block, hour, CASE WHEN v = 0 AND hour <> 24 THEN NULL ELSE v END AS v FROM b),
bb AS (SELECT block, hour, first_value(v IGNORE NULLS) OVER (
         PARTITION BY block ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM a),
cc AS (SELECT block, hour, CASE WHEN v = 0 THEN NULL ELSE v END AS v FROM bb),
dd AS (SELECT block, hour, last_value(v IGNORE NULLS) OVER (
         PARTITION BY block ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM cc)"""


def _blocks(spark, d):
    ev = table(spark, d, "events")
    block = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.to_date("ts").cast("string"))
    v = F.when(F.col("event_type") == "error", F.lit(0).cast("decimal(18,2)")).otherwise(
        F.col("value").cast("decimal(18,2)"))
    return ev.groupBy(block.alias("block"), (24 - F.hour("ts")).alias("hour")).agg(F.sum(v).cast("double").alias("v"))


@query("q_repair_zeros", "W4", f"""
WITH {_BLOCK_SQL}
SELECT block, hour, v FROM dd
""")
def q_repair_zeros(spark, d):
    return fill.repair_zeros(_blocks(spark, d), ["v"], key="block", hour="hour", last=24)


@query("q_repair_zeros_carry", "W4 (carry_across)", f"""
WITH {_BLOCK_SQL},
lastv AS (SELECT block, max_by(v, hour) FILTER (WHERE v IS NOT NULL) AS e FROM cc GROUP BY block),
carry AS (SELECT block, last_value(e IGNORE NULLS) OVER (
            ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k FROM lastv)
SELECT dd.block, dd.hour, COALESCE(dd.v, carry.k) AS v FROM dd LEFT JOIN carry ON dd.block = carry.block
""")
def q_repair_zeros_carry(spark, d):
    return fill.repair_zeros(_blocks(spark, d), ["v"], key="block", hour="hour", last=24, carry_across=True)


@query("q_event_lags", "W1 (segmented, raw events)", """
SELECT event_id, lag(value, 1) OVER w AS value_1, lag(value, 2) OVER w AS value_2, lag(value, 3) OVER w AS value_3
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
""")
def q_event_lags(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts", F.to_date("ts").alias("day"), "value")
    # per-(user, day) windows; each day hands its last 3 values to the following days
    out = fill.add_lags(ev, ["value"], 3, part=["user_id"], order=["ts"], segment="day")
    return out.select("event_id", "value_1", "value_2", "value_3")
