"""Catalogue: reshaping, cleaning, joins and scalar features on the testdata tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import clean, dictionary, joins, reshape
from tessera.operators.split import with_folds, with_holdout
from tessera.plans.activity import EVENT_TYPES
from tessera.plans.registry import query
from tessera.session import table


def dec(col: str):
    """Money-like doubles with two decimals, summed exactly."""
    return F.col(col).cast("decimal(18,2)")


@query("q_unpivot_measures", "P1", """
WITH per AS (
  SELECT l_orderkey,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
         CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS sum_disc,
         CAST(COUNT(*) AS DOUBLE) AS n_lines
  FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, 'sum_qty' AS measure, sum_qty AS value FROM per
UNION ALL SELECT l_orderkey, 'sum_price', sum_price FROM per
UNION ALL SELECT l_orderkey, 'sum_disc', sum_disc FROM per
UNION ALL SELECT l_orderkey, 'n_lines', n_lines FROM per
""")
def q_unpivot_measures(spark, d):
    li = table(spark, d, "lineitem")
    per = li.groupBy("l_orderkey").agg(
        F.sum(dec("l_quantity")).cast("double").alias("sum_qty"),
        F.sum(dec("l_extendedprice")).cast("double").alias("sum_price"),
        F.sum(dec("l_discount")).cast("double").alias("sum_disc"),
        F.count(F.lit(1)).cast("double").alias("n_lines"),
    )
    return reshape.to_long(per, ["l_orderkey"], ["sum_qty", "sum_price", "sum_disc", "n_lines"], "measure", "value")


_PIVOT_SQL = ",\n".join(
    f"  CAST(SUM(CASE WHEN event_type = '{t}' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS {t}"
    for t in EVENT_TYPES
)


@query("q_pivot_event_type", "P2", f"""
SELECT user_id, CAST(ts AS DATE) AS day,
{_PIVOT_SQL}
FROM events GROUP BY user_id, CAST(ts AS DATE)
""")
def q_pivot_event_type(spark, d):
    ev = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "event_type",
                                          dec("value").alias("v"))
    wide = reshape.to_wide(ev, ["user_id", "day"], "event_type", "v", EVENT_TYPES, agg="sum")
    return wide.select("user_id", "day", *[F.col(t).cast("double").alias(t) for t in EVENT_TYPES])


_BLOCK_SQL = ",\n".join(
    f"  MAX(CASE WHEN dow = {h} THEN v END) AS v_{h},\n  MAX(CASE WHEN dow = {h} THEN n END) AS n_{h}"
    for h in range(1, 8)
)


@query("q_hour_block", "P3, P8", f"""
WITH per AS (
  SELECT user_id, CAST(dayofweek(ts) AS INTEGER) + 1 AS dow,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v, COUNT(*) AS n
  FROM events GROUP BY 1, 2)
SELECT user_id,
{_BLOCK_SQL}
FROM per GROUP BY user_id
""")
def q_hour_block(spark, d):
    ev = table(spark, d, "events")
    per = ev.groupBy("user_id", F.dayofweek("ts").alias("dow")).agg(
        F.sum(dec("value")).cast("double").alias("v"), F.count(F.lit(1)).alias("n"))
    blk = reshape.to_block(per, "user_id", "dow", ["v", "n"], range(1, 8))
    order = reshape.lag_names(["v", "n"], 7)
    return blk.select("user_id", *sorted(order, key=lambda s: (int(s.split("_")[1]), s)))


@query("q_numeric_coerce", "C1, C2, C3", r"""
WITH raw AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN 'NR' ELSE regexp_extract(props, ':(.*)\}', 1) END AS raw
  FROM events)
SELECT event_id, TRY_CAST(trim(CASE WHEN raw = 'NR' THEN '0' ELSE raw END) AS DOUBLE) AS k
FROM raw
""")
def q_numeric_coerce(spark, d):
    ev = table(spark, d, "events")
    raw = F.when(F.col("event_type") == "error", F.lit("NR")).otherwise(F.regexp_extract("props", r":(.*)\}", 1))
    df = ev.select("event_id", raw.alias("k"))
    df = clean.replace_value(df, "k", "NR", "0")
    df = clean.strip(df, ["k"])
    return clean.to_numeric(df, ["k"])


@query("q_floor_null_clip", "C4, C5, C10", """
SELECT c_custkey,
       CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS floored,
       CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS nulled,
       CASE WHEN c_acctbal < -500 THEN -500.0 WHEN c_acctbal > 5000 THEN 5000.0 ELSE c_acctbal END AS clipped
FROM customer
""")
def q_floor_null_clip(spark, d):
    cu = table(spark, d, "customer")
    b = F.col("c_acctbal")
    return cu.select(
        "c_custkey",
        S.floor_at(b, 0.0).alias("floored"),
        S.null_if(b, b > 9000).alias("nulled"),
        S.clip(b, -500.0, 5000.0).alias("clipped"),
    )


@query("q_contradiction_dropna", "C6, C7", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM (
  SELECT o_orderkey, o_orderstatus,
         CASE WHEN (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
                OR (o_orderstatus = 'O' AND o_orderpriority = '5-LOW') THEN NULL
              ELSE o_orderpriority END AS o_orderpriority
  FROM orders) t
WHERE o_orderpriority IS NOT NULL
""")
def q_contradiction_dropna(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    o = clean.null_if(o, "o_orderpriority", ((st == "F") & (pr == "1-URGENT")) | ((st == "O") & (pr == "5-LOW")))
    return clean.drop_missing(o)


@query("q_dictionary_encode", "W5, A3, J1", """
WITH d AS (
  SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS p_brand_token
  FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL) t)
SELECT p.p_partkey, p.p_brand, d.p_brand_token
FROM part p LEFT JOIN d ON p.p_brand = d.p_brand
""")
def q_dictionary_encode(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    dic = dictionary.dictionary(part, "p_brand")
    return dictionary.encode(part, dic, "p_brand").select("p_partkey", "p_brand", "p_brand_token")


@query("q_star_join_score", "J2, F26, C10", """
SELECT o.o_orderkey,
       CASE WHEN z < 1 THEN 1.0 WHEN z > 5 THEN 5.0 ELSE z END AS score
FROM (
  SELECT o.o_orderkey,
         ((0.0 + (o.o_totalprice / 100000.0) * 1.5) + (c.c_acctbal / 1000.0) * 0.4)
           + CAST(n.n_regionkey AS DOUBLE) * 0.3 AS z
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey) o
""")
def q_star_join_score(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cu = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_nationkey")
    na = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    fact = joins.star_join(o, [(cu, "o_custkey")])
    fact = joins.star_join(fact, [(na, "c_nationkey")])
    x = F.array(F.col("o_totalprice") / 100000.0, F.col("c_acctbal") / 1000.0, F.col("n_regionkey").cast("double"))
    z = S.dot_array_literal(x, [1.5, 0.4, 0.3])
    # plain IEEE arithmetic in a fixed order: identical in both engines, no rounding needed
    return fact.select("o_orderkey", S.clip(z, 1.0, 5.0).alias("score"))


@query("q_date_season", "F1, F2", """
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
       CAST(month(o_orderdate) BETWEEN 3 AND 5 AS INTEGER) AS spring,
       CAST(month(o_orderdate) BETWEEN 6 AND 8 AS INTEGER) AS summer,
       CAST(month(o_orderdate) BETWEEN 9 AND 11 AS INTEGER) AS fall,
       CAST(month(o_orderdate) IN (12, 1, 2) AS INTEGER) AS winter,
       CASE WHEN month(o_orderdate) BETWEEN 3 AND 5 THEN 1 WHEN month(o_orderdate) BETWEEN 6 AND 8 THEN 2
            WHEN month(o_orderdate) BETWEEN 9 AND 11 THEN 3 ELSE 4 END AS season
FROM orders
""")
def q_date_season(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    parts = S.date_parts("o_orderdate")
    o = o.select("o_orderkey", *[e.alias(n) for n, e in parts])
    return o.select("o_orderkey", "month", "day", *[e.alias(n) for n, e in S.season("month")])


_DEG = "CAST(event_id % 360 AS DOUBLE)"
_THETA = f"((90.0 - {_DEG}) * 0.017453292519943295)"


@query("q_polar_features", "F3, F4", f"""
WITH v AS (SELECT event_id, value * cos({_THETA}) AS x, value * sin({_THETA}) AS y FROM events)
SELECT event_id,
       CAST(COALESCE(x >= 0, false) AS INTEGER) AS East,
       CAST(COALESCE(y <= 0, false) AS INTEGER) AS South,
       round(abs(x), 6) AS xvec, round(abs(y), 6) AS yvec,
       round(abs(x) * CAST(COALESCE(x >= 0, false) AS INTEGER), 6) AS xvec_E,
       round(abs(y) * CAST(COALESCE(y <= 0, false) AS INTEGER), 6) AS yvec_S
FROM v
""")
def q_polar_features(spark, d):
    ev = table(spark, d, "events").select("event_id", "value",
                                          (F.col("event_id") % 360).cast("double").alias("deg"))
    feats = S.xy_features("value", "deg")
    out = ev.select("event_id", *[e.alias(n) for n, e in feats])
    return out.select("event_id", "East", "South",
                      *[F.round(n, 6).alias(n) for n in ["xvec", "yvec", "xvec_E", "yvec_S"]])


@query("q_powers_interact", "F5, F8, F13, F14, F15", """
SELECT p_partkey,
       CAST(p_size * p_size AS BIGINT) AS p_size_p2,
       CAST(p_size * p_size * p_size AS BIGINT) AS p_size_p3,
       round(p_retailprice * p_retailprice, 6) AS p_retailprice_p2,
       round(p_size * p_retailprice, 6) AS size_x_price,
       CAST(COALESCE(p_size > 25, false) AS INTEGER) AS big,
       round(p_size + p_retailprice, 6) AS size_plus_price,
       CAST(COALESCE(p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p_type = 'ECONOMY', false) AS INTEGER) AS premium
FROM part
""")
def q_powers_interact(spark, d):
    p = table(spark, d, "part")
    pw = dict(S.powers(["p_size", "p_retailprice"], [2, 3]))
    inter = dict(S.interact("p_size", ["p_retailprice"], "size_x_"))
    return p.select(
        "p_partkey",
        pw["p_size_p2"].cast("bigint").alias("p_size_p2"),
        pw["p_size_p3"].cast("bigint").alias("p_size_p3"),
        F.round(pw["p_retailprice_p2"], 6).alias("p_retailprice_p2"),
        F.round(inter["size_x_p_retailprice"], 6).alias("size_x_price"),
        S.flag(F.col("p_size") > 25).alias("big"),
        F.round(F.col("p_size") + F.col("p_retailprice"), 6).alias("size_plus_price"),
        S.flag(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3") & (F.col("p_type") == "ECONOMY")).alias("premium"),
    )


# Fixed values for the stand-in: part types clustered into levels (PROMO has none).
TYPE_LEVELS = {"ECONOMY": "c1", "STANDARD": "c1", "SMALL": "c2", "MEDIUM": "c2", "LARGE": "c3"}


@query("q_levels_onehot", "F9, F10, J7", """
WITH m AS (
  SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'c1' WHEN 'STANDARD' THEN 'c1' WHEN 'SMALL' THEN 'c2'
                    WHEN 'MEDIUM' THEN 'c2' WHEN 'LARGE' THEN 'c3' END AS type2
  FROM part)
SELECT p_partkey, type2,
       CAST(COALESCE(type2 = 'c1', false) AS INTEGER) AS type_c1,
       CAST(COALESCE(type2 = 'c2', false) AS INTEGER) AS type_c2,
       CAST(COALESCE(type2 = 'c3', false) AS INTEGER) AS type_c3,
       CAST(COALESCE(type2 = 'c4', false) AS INTEGER) AS type_c4
FROM m
""")
def q_levels_onehot(spark, d):
    p = table(spark, d, "part").select("p_partkey", S.map_levels("p_type", TYPE_LEVELS).alias("type2"))
    return p.select("p_partkey", "type2", *[e.alias(n) for n, e in S.one_hot("type2", ["c1", "c2", "c3", "c4"], "type")])


@query("q_label_map", "F16", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS urgent FROM orders
""")
def q_label_map(spark, d):
    o = table(spark, d, "orders")
    lab = S.map_levels("o_orderpriority", {"1-URGENT": 1, "2-HIGH": 1, "3-MEDIUM": 0, "4-NOT SPECIFIED": 0, "5-LOW": 0})
    return o.select("o_orderkey", F.coalesce(lab, F.lit(0)).alias("urgent"))


# Hours-per-week bin edges of the income features.
HOUR_EDGES = [0, 32.5, 37.5, 42.5, 47.5, 52.5, 57.5, 62.5, 67.5, 100]
_HR_SQL = " ".join(
    f"WHEN p_size > {lo} AND p_size <= {hi} THEN 'c{i}'" for i, (lo, hi) in enumerate(zip(HOUR_EDGES[:-1], HOUR_EDGES[1:]), 1)
)
PRICE_EDGES = [900, 925, 950, 975, 1000]
_PR_SQL = " ".join(
    f"WHEN p_retailprice > {lo} AND p_retailprice <= {hi} THEN 'c{i}'"
    for i, (lo, hi) in enumerate(zip(PRICE_EDGES[:-1], PRICE_EDGES[1:]), 1)
)


@query("q_cut_right_closed", "F11", f"""
SELECT p_partkey, CASE {_HR_SQL} END AS size_bin, CASE {_PR_SQL} END AS price_bin FROM part
""")
def q_cut_right_closed(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", S.cut("p_size", HOUR_EDGES).alias("size_bin"),
                    S.cut("p_retailprice", PRICE_EDGES).alias("price_bin"))


_YEAR = "(1925 + ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1) % 76)"


@query("q_year_bucket", "F12, C11", f"""
SELECT o_orderkey, CAST({_YEAR} AS INTEGER) AS year_shift,
       CAST(CASE WHEN {_YEAR} <= 1930 THEN 1930 WHEN {_YEAR} <= 1980 THEN CAST(ceil({_YEAR} / 10.0) AS INTEGER) * 10
            ELSE {_YEAR} END AS INTEGER) AS era
FROM orders
""")
def q_year_bucket(spark, d):
    o = table(spark, d, "orders")
    y = (F.lit(1925) + F.pmod((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1, F.lit(76))).cast("int")
    o = o.select("o_orderkey", y.alias("year_shift"))
    return o.select("o_orderkey", "year_shift", S.bucket_ceiling("year_shift").cast("int").alias("era"))


@query("q_title_year", "F18, F34", """
WITH t AS (SELECT p_partkey, p_name || ' (' || CAST(1900 + 2 * p_size AS VARCHAR) || ')' AS title FROM part)
SELECT p_partkey, title,
       CASE WHEN strpos(title, '(') > 0 THEN
         TRY_CAST(substr(string_split(title, '(')[-1], 1, length(string_split(title, '(')[-1]) - 1) AS INTEGER)
       END AS year
FROM t
""")
def q_title_year(spark, d):
    p = table(spark, d, "part")
    t = p.select("p_partkey", F.concat("p_name", F.lit(" ("), (1900 + 2 * F.col("p_size")).cast("string"),
                                       F.lit(")")).alias("title"))
    return t.select("p_partkey", "title", S.title_year("title").alias("year"))


@query("q_standardize", "F21, A1", """
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd FROM customer)
SELECT c_custkey, round((c_acctbal - s.m) / s.sd, 6) AS z FROM customer, s
""")
def q_standardize(spark, d):
    cu = table(spark, d, "customer")
    from tessera.operators.scale import standardize

    out, _ = standardize(cu, ["c_acctbal"])
    return out.select("c_custkey", F.round("c_acctbal", 6).alias("z"))


@query("q_znorm", "F22, A2", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders)
SELECT o_orderkey, round((o_totalprice - s.m) / (s.sd + 0.0001), 6) AS z FROM orders, s
""")
def q_znorm(spark, d):
    o = table(spark, d, "orders")
    from tessera.operators.scale import znorm

    out, _ = znorm(o, ["o_totalprice"], eps=1e-4)
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("z"))


@query("q_folds", "M1", """
SELECT c_custkey, CAST((CAST(c_custkey AS HUGEINT) * 2654435761) % 4294967296 % 10 AS INTEGER) AS fold FROM customer
""")
def q_folds(spark, d):
    cu = table(spark, d, "customer").select("c_custkey")
    return with_folds(cu, "c_custkey", 10)


@query("q_fold_sizes", "M1, J6, U2", """
WITH f AS (SELECT CAST((CAST(c_custkey AS HUGEINT) * 2654435761) % 4294967296 % 10 AS INTEGER) AS fold FROM customer)
SELECT fold, COUNT(*) AS n_val, (SELECT COUNT(*) FROM f) - COUNT(*) AS n_train FROM f GROUP BY fold
""")
def q_fold_sizes(spark, d):
    cu = with_folds(table(spark, d, "customer").select("c_custkey"), "c_custkey", 10)
    folds = cu.groupBy("fold").agg(F.count(F.lit(1)).alias("n_val"))
    # training part of fold k = every row outside it (J6), counted as total - fold
    total = cu.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return folds.select("fold", "n_val", (F.lit(total) - F.col("n_val")).alias("n_train"))


@query("q_holdout", "M2", """
SELECT o_orderkey,
       CAST(CAST((CAST(o_orderkey AS HUGEINT) * 2654435761) % 4294967296 AS BIGINT) / 4294967296.0 < 0.2 AS INTEGER) AS holdout
FROM orders
""")
def q_holdout(spark, d):
    return with_holdout(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.2)


@query("q_natural_order", "O1, O2, O3, W6, P4", """
WITH t AS (SELECT 'id_' || CAST(c_custkey AS VARCHAR) AS id, c_name FROM customer)
SELECT id, c_name, row_number() OVER (ORDER BY CAST(split_part(id, '_', 2) AS INTEGER)) AS rank,
       CAST(regexp_extract(id, '(\\d+)$', 1) AS INTEGER) AS hour
FROM t
""")
def q_natural_order(spark, d):
    cu = table(spark, d, "customer")
    t = cu.select(F.concat(F.lit("id_"), F.col("c_custkey").cast("string")).alias("id"), "c_name")
    t = t.withColumn("__n", F.split("id", "_").getItem(1).cast("int"))
    from tessera.operators.fill import with_hour_index

    out = clean.with_row_id(t, ["__n"], name="rank").drop("__n")
    return with_hour_index(out, "id", "hour")


@query("q_union_split", "U1, O4, C12", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders),
n AS (SELECT COUNT(*) / 10 AS cut FROM orders)
SELECT o_orderkey, row_id, 'head' AS part FROM r, n WHERE row_id <= cut
UNION ALL
SELECT o_orderkey, row_id, 'rest' AS part FROM r, n WHERE row_id > cut
""")
def q_union_split(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    cut = o.count() // 10
    head, rest = clean.split_at(o, cut, ["o_orderdate", "o_orderkey"])
    head = head.select("o_orderkey", "row_id", F.lit("head").alias("part"))
    rest = rest.select("o_orderkey", "row_id", F.lit("rest").alias("part"))
    return head.unionByName(rest)


@query("q_top_orders", "O5", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def q_top_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
