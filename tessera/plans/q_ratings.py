"""Catalogue: rating models with biases of ids and of their attributes (customers rate parts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import recsys
from tessera.plans.q_fits import _ratings
from tessera.plans.registry import query
from tessera.session import table

EPOCHS, REG = 3, 1.0
USER_ONE, ITEM_ONE, ITEM_MANY = ["segment", "wealth", "nation"], ["era"], ["genres"]

_RATINGS_SQL = """
j AS (SELECT o.o_custkey AS "user", l.l_partkey AS item, l.l_quantity FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
r AS MATERIALIZED (SELECT "user", item, 1.0 + CAST(CAST(SUM(l_quantity) AS BIGINT) % 5 AS DOUBLE) AS rating FROM j GROUP BY "user", item),
m AS MATERIALIZED (SELECT avg(rating) AS mu FROM r),
ua AS (SELECT c_custkey AS id, c_mktsegment AS segment, CAST(floor(c_acctbal / 1000) AS INTEGER) AS wealth, c_nationkey AS nation FROM customer),
ia AS (SELECT p_partkey AS id, CAST(floor(p_size / 10) AS INTEGER) AS era, list_distinct(string_split(p_name, ' ') || [p_type]) AS genres FROM part),
u0 AS MATERIALIZED (SELECT t.*, a.* EXCLUDE (id), 0.0::DOUBLE AS off, 0.0::DOUBLE AS own
       FROM (SELECT "user" AS id, count(*) AS n, sum(rating - mu) AS s FROM r, m GROUP BY 1) t LEFT JOIN ua a USING (id)),
i0 AS MATERIALIZED (SELECT t.*, a.* EXCLUDE (id), 0.0::DOUBLE AS off, 0.0::DOUBLE AS own
       FROM (SELECT item AS id, count(*) AS n, sum(rating - mu) AS s FROM r, m GROUP BY 1) t LEFT JOIN ia a USING (id))"""


def _descent_sql(own: bool) -> tuple[str, dict[str, str]]:
    """The steps of the fit as a chain of tables; the last names of both sides and of the blocks."""
    sql, last, blocks = [_RATINGS_SQL], {"u": "u0", "i": "i0"}, {}
    for epoch in range(EPOCHS):
        for side, other, key, seen, one, many in (("u", "i", '"user"', "item", USER_ONE, []), ("i", "u", "item", '"user"', ITEM_ONE, ITEM_MANY)):
            name = f"{side}{epoch}own"
            d = f"((s - c.carried - n * off) - {REG} * own) / (n + {REG})" if own else "0.0"
            sql.append(f"""{name} AS MATERIALIZED (SELECT t.* EXCLUDE (off, own), off + {d} AS off, own + {d} AS own,
  s - c.carried - n * off - n * ({d}) AS r{epoch}_0 FROM {last[side]} t
  JOIN (SELECT r.{key} AS id, sum(o.off) AS carried FROM r JOIN {last[other]} o ON o.id = r.{seen} GROUP BY 1) c USING (id))""")
            for k, col in enumerate([*one, *many]):
                res, new, block, step = f"r{epoch}_{k}", f"{side}{epoch}{col}", f"b{epoch}{col}", f"d{epoch}{col}"
                levels = f"SELECT id, {res} AS r, n * len({col}) AS w, unnest({col}) AS level FROM {name}" if col in many else f"SELECT id, {res} AS r, n AS w, {col} AS level FROM {name}"
                bias = f"(SELECT b.bias FROM {blocks[col]} b WHERE b.level = x.level)" if col in blocks else "0.0"
                sql.append(f"""{step} AS MATERIALIZED (SELECT level, bias, (r - {REG} * bias) / (w + {REG}) AS d
  FROM (SELECT level, r, w, {bias} AS bias FROM (SELECT level, sum(r) AS r, sum(w) AS w FROM ({levels}) l WHERE level IS NOT NULL GROUP BY level) x) y)""")
                sql.append(f"{block} AS MATERIALIZED (SELECT level, bias + d AS bias FROM {step})")
                moved = f"(SELECT id, sum(d) AS d FROM ({levels}) l JOIN {step} USING (level) GROUP BY id)" if col in many else f"(SELECT id, d FROM ({levels}) l JOIN {step} USING (level))"
                sql.append(f"""{new} AS MATERIALIZED (SELECT t.* EXCLUDE (off), off + coalesce(v.d, 0.0) AS off, {res} - n * coalesce(v.d, 0.0) AS r{epoch}_{k + 1}
  FROM {name} t LEFT JOIN {moved} v USING (id))""")
                name, blocks[col] = new, block
            last[side] = name
    return "WITH " + ",\n".join(sql), last | blocks


def _sides(spark, d, own: bool):
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("user"), F.col("c_mktsegment").alias("segment"),
                                                  F.floor(F.col("c_acctbal") / 1000).cast("int").alias("wealth"), F.col("c_nationkey").alias("nation"))
    part = table(spark, d, "part").select(F.col("p_partkey").alias("item"), F.floor(F.col("p_size") / 10).cast("int").alias("era"),
                                          F.concat(F.split("p_name", " "), F.array("p_type")).alias("genres"))
    return recsys.Side("user", customer, one=USER_ONE, own=own), recsys.Side("item", part, one=ITEM_ONE, many=ITEM_MANY, own=own)


def _predicted_sql(own: bool) -> str:
    sql, last = _descent_sql(own)
    return f"""{sql}
SELECT "user", item, rating, round(greatest(1.0, least(5.0, mu + a.off + b.off)), 6) AS pred
FROM r JOIN {last["u"]} a ON a.id = r."user" JOIN {last["i"]} b ON b.id = r.item, m"""


def _fitted(spark, d, own: bool):
    """Ratings dealt by user, both sides, the fit and the number of parts; there are no more ratings than line items."""
    user, item = _sides(spark, d, own)
    parts = recsys.parts_of(table(spark, d, "lineitem").count())
    ratings = recsys.deal(_ratings(spark, d), "user", parts)
    return ratings, user, item, recsys.fit_biases(ratings, user, item, "rating", epochs=EPOCHS, reg=REG, parts=parts), parts


@query("q_bias_blocks", "M20, M21 (all bias blocks), J2, C10, F26", _predicted_sql(True))
def q_bias_blocks(spark, d):
    ratings, user, item, fit, parts = _fitted(spark, d, own=True)
    return recsys.predict_biases(ratings, fit, user, item, parts=parts).withColumn("pred", F.round("pred", 6))


@query("q_attribute_biases", "M21 (without id biases), M20", _predicted_sql(False))
def q_attribute_biases(spark, d):
    ratings, user, item, fit, parts = _fitted(spark, d, own=False)
    return recsys.predict_biases(ratings, fit, user, item, parts=parts).withColumn("pred", F.round("pred", 6))


def _levels_sql() -> str:
    sql, last = _descent_sql(True)
    return sql + "\n" + "\nUNION ALL ".join(f"SELECT '{c}' AS block, CAST(level AS VARCHAR) AS level, round(bias, 6) AS bias FROM {last[c]}" for c in [*USER_ONE, *ITEM_ONE, *ITEM_MANY])


@query("q_bias_levels", "M20 (gender, age, occupation, era and genre biases)", _levels_sql())
def q_bias_levels(spark, d):
    fit = _fitted(spark, d, own=True)[3]
    parts = [b.select(F.lit(c).alias("block"), F.col("level").cast("string").alias("level"), F.round("bias", 6).alias("bias")) for c, b in fit.blocks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("q_factor_score", "M20, M21, J2, C10")
def q_factor_score(spark, d):
    """Biases of ids and attributes, ALS factors on what they leave, score clipped to the rating range."""
    ratings, _, _, fit, parts = _fitted(spark, d, own=True)
    mu, users, items = recsys.fit_factors(ratings, "user", "item", "rating", rank=4, max_iter=10, biases=fit, parts=parts)
    scored = recsys.score_factors(ratings, users, items, "user", "item", mu, out="pred", parts=parts)
    return scored.select("user", "item", "rating", "pred")
