"""Catalogue: array (image / embedding) operators on the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import cluster, images, joins, stats
from tessera.operators.gaussian import fit_gaussian, predict_gaussian
from tessera.operators.scale import standardize, unstandardize
from tessera.plans.registry import query
from tessera.session import table


def emb(spark, d):
    return table(spark, d, "embeddings")


@query("q_array_contrast", "C8, A14, F24", """
WITH e AS (
  SELECT vec_id, embedding, list_max(embedding) - list_min(embedding) AS contrast,
         CAST(list_min(embedding) AS DOUBLE) AS lo, CAST(list_max(embedding) AS DOUBLE) AS hi
  FROM embeddings),
k AS (SELECT * FROM e WHERE CAST(contrast AS DOUBLE) > 0.6),
u AS (
  SELECT vec_id, contrast, unnest(range(len(embedding))) AS pos,
         unnest(list_transform(embedding, lambda x: CASE WHEN hi > lo THEN (CAST(x AS DOUBLE) - lo) * 255.0 / (hi - lo)
                                                    ELSE 0.0 END)) AS sv
  FROM k)
SELECT vec_id, contrast, CAST(pos AS INTEGER) AS pos, round(sv, 6) AS sv FROM u
""")
def q_array_contrast(spark, d):
    e = emb(spark, d).select("vec_id", "embedding", S.contrast("embedding").alias("contrast"))
    e = e.filter(F.col("contrast").cast("double") > 0.6)
    e = e.select("vec_id", "contrast", F.posexplode(S.stretch("embedding")).alias("pos", "sv"))
    return e.select("vec_id", "contrast", "pos", F.round("sv", 6).alias("sv"))


# Three constant centres of the nearest-centre stand-in query.
CENTRE_LEVELS = [0.0, 0.05, -0.05]


def _dist_sql(v: float) -> str:
    return f"list_sum(list_transform(embedding, lambda x: (CAST(x AS DOUBLE) - {v}) * (CAST(x AS DOUBLE) - {v})))"


@query("q_pair_same_cluster", "J3, M17", f"""
WITH c AS (SELECT vec_id, {_dist_sql(0.0)} AS d0, {_dist_sql(0.05)} AS d1, {_dist_sql(-0.05)} AS d2 FROM embeddings),
a AS (SELECT vec_id, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM c),
p AS (SELECT vec_id AS a, vec_id + 1 AS b FROM embeddings)
SELECT p.a, p.b, la.cluster AS cluster_a, lb.cluster AS cluster_b,
       CAST(COALESCE(la.cluster = lb.cluster, false) AS INTEGER) AS same
FROM p LEFT JOIN a la ON p.a = la.vec_id LEFT JOIN a lb ON p.b = lb.vec_id
""")
def q_pair_same_cluster(spark, d):
    e = emb(spark, d)
    dim = len(e.select("embedding").first()[0])
    centres = [[v] * dim for v in CENTRE_LEVELS]
    labels = cluster.assign(e, "embedding", centres).select("vec_id", "cluster")
    pairs = e.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"))
    la = labels.select(F.col("vec_id").alias("a"), F.col("cluster").alias("cluster_a"))
    lb = labels.select(F.col("vec_id").alias("b"), F.col("cluster").alias("cluster_b"))
    out = joins.same_cluster(pairs, labels, "a", "b", "vec_id", "cluster")
    return out.join(la, "a", "left").join(lb, "b", "left").select("a", "b", "cluster_a", "cluster_b", "same")


@query("q_indicator", "F25", """
SELECT doc_id, array_to_string(list_transform(range(2), lambda i: CAST(i = quality AS INTEGER)), ',') AS ind FROM labels
""")
def q_indicator(spark, d):
    lab = table(spark, d, "labels")
    return lab.select("doc_id", F.array_join(S.to_indicator("quality", 2), ",").alias("ind"))


@query("q_argmax", "M29", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS am FROM embeddings
""")
def q_argmax(spark, d):
    return emb(spark, d).select("vec_id", S.argmax("embedding").alias("am"))


#: Pairs i <= j of all 64 values of each embedding.
_PAIRS_SQL = """u AS (SELECT vec_id, label, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
pairs AS (SELECT a.label, a.i, b.i AS j, a.v AS x, b.v AS y FROM u a JOIN u b ON a.vec_id = b.vec_id AND a.i <= b.i)"""


def _wide(spark, d, *keep):
    """Embedding values as columns e0 .. e63, in doubles."""
    names = [f"e{i}" for i in range(64)]
    return emb(spark, d).select(*keep, *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]), names


@query("q_class_cov", "A4, A5, A7 (all 64 values)", f"""
WITH {_PAIRS_SQL}
SELECT label, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, COUNT(*) AS n, round(avg(x), 9) AS mean_i, round(avg(y), 9) AS mean_j,
       round(covar_samp(x, y), 9) AS cov FROM pairs GROUP BY label, i, j
""")
def q_class_cov(spark, d):
    x, names = _wide(spark, d, "label")
    rows = []
    for key, g in stats.centred_gram(x, names, by=["label"]).items():
        mean, cov = g.mean(), g.covariance(1)
        rows += [(key[0], i, j, int(g.n), *(round(float(v), 9) for v in (mean[i], mean[j], cov[i, j]))) for i in range(64) for j in range(i, 64)]
    return spark.createDataFrame(rows, "label int, i int, j int, n bigint, mean_i double, mean_j double, cov double")


@query("q_class_means", "A4, A5 (aggregates)", """
SELECT label, COUNT(*) AS n, round(avg(CAST(embedding[1] AS DOUBLE)), 9) AS mean_0, round(avg(CAST(embedding[64] AS DOUBLE)), 9) AS mean_63,
       round(covar_samp(CAST(embedding[1] AS DOUBLE), CAST(embedding[64] AS DOUBLE)), 9) AS cov_01 FROM embeddings GROUP BY label
""")
def q_class_means(spark, d):
    """The SQL forms of the class statistics, which take a few named columns: the first and last value."""
    x = emb(spark, d).select("label", F.col("embedding")[0].cast("double").alias("x0"), F.col("embedding")[63].cast("double").alias("x1"))
    means = stats.class_means(x, ["x0", "x1"], "label").select("label", F.round("x0", 9).alias("mean_0"), F.round("x1", 9).alias("mean_63"))
    cov = stats.covariance_sql(x, ["x0", "x1"], ["label"]).select("label", F.round("cov_01", 9).alias("cov_01"))
    return stats.class_priors(x, "label").join(means, "label").join(cov, "label")


@query("q_gaussian_score", "M12, M14 (all 64 values)", """
WITH RECURSIVE
u AS (SELECT vec_id, CAST(label >= 5 AS INTEGER) AS y, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
mu AS MATERIALIZED (SELECT i, avg(v) FILTER (WHERE y = 0) AS m0, avg(v) FILTER (WHERE y = 1) AS m1 FROM u GROUP BY i),
n AS (SELECT ln(CAST(count(*) FILTER (WHERE label >= 5) AS DOUBLE) / count(*) FILTER (WHERE label < 5)) AS prior FROM embeddings),
cov AS MATERIALIZED (SELECT a.i, b.i AS j, covar_samp(a.v, b.v) AS s FROM u a JOIN u b ON a.vec_id = b.vec_id GROUP BY a.i, b.i),
-- Gauss-Jordan on [S | m1 - m0 | m1 | m0]
g(k, i, row) AS (
  SELECT 0, cov.i, list_concat(list(s ORDER BY j), [any_value(m1 - m0), any_value(m1), any_value(m0)]) FROM cov JOIN mu ON mu.i = cov.i GROUP BY cov.i
  UNION ALL
  SELECT a.k + 1, a.i, CASE WHEN a.i = a.k THEN list_transform(a.row, lambda v: v / p.row[a.k + 1])
    ELSE list_transform(range(1, len(a.row) + 1), lambda c: a.row[c] - a.row[a.k + 1] / p.row[a.k + 1] * p.row[c]) END
  FROM g a JOIN g p ON p.k = a.k AND p.i = a.k WHERE a.k < 64),
w AS MATERIALIZED (SELECT g.i, row[65] AS w, -0.5 * (mu.m1 * row[66] - mu.m0 * row[67]) AS part FROM g JOIN mu ON mu.i = g.i WHERE k = 64),
z AS (SELECT vec_id, sum(v * w) AS z FROM u JOIN w USING (i) GROUP BY vec_id)
SELECT vec_id, round(1.0 / (1.0 + exp(-(z + (SELECT sum(part) FROM w) + prior))), 6) AS p1 FROM z, n
""")
def q_gaussian_score(spark, d):
    x, names = _wide(spark, d, "vec_id", (F.col("label") >= 5).cast("int").alias("y"))
    model = fit_gaussian(x, names, "y", shared=True)
    return predict_gaussian(x, names, model).select("vec_id", F.round("p1", 6).alias("p1"))


@query("q_mean_vector", "A19", """
WITH u AS (SELECT unnest(range(len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings)
SELECT CAST(pos AS INTEGER) AS pos, round(avg(CAST(v AS DOUBLE)), 9) AS mean FROM u GROUP BY pos
""")
def q_mean_vector(spark, d):
    mv = stats.mean_vector(emb(spark, d).select(F.transform("embedding", lambda v: v.cast("double")).alias("e")), "e")
    return mv.select("pos", F.round("mean", 9).alias("mean"))


@query("q_flip_augment", "M27, P6", """
WITH v AS (
  SELECT vec_id, 'orig' AS variant, CAST(embedding AS DOUBLE[]) AS a FROM embeddings
  UNION ALL
  SELECT vec_id, 'flip', CAST(list_transform(range(64), lambda p: embedding[(p // 8) * 8 + (7 - p % 8) + 1]) AS DOUBLE[])
  FROM embeddings
  UNION ALL
  SELECT vec_id, 'shift', CAST(list_transform(range(64), lambda p: CASE WHEN p % 8 >= 1 THEN embedding[p]
                                                                   ELSE CAST(0.0 AS FLOAT) END) AS DOUBLE[])
  FROM embeddings
  UNION ALL
  SELECT vec_id, 'bright', list_transform(embedding, lambda x: CAST(x AS DOUBLE) + 0.1) FROM embeddings),
u AS (SELECT vec_id, variant, unnest(range(len(a))) AS pos, unnest(a) AS value FROM v)
SELECT vec_id, variant, CAST(pos AS INTEGER) AS pos, value FROM u
""")
def q_flip_augment(spark, d):
    aug = images.augment(emb(spark, d).select("vec_id", "embedding"), "embedding", 8, 8, shift=1, delta=0.1)
    return aug.select("vec_id", "variant", F.posexplode("embedding").alias("pos", "value"))


@query("q_scale_maths", "F23, A10", """
SELECT min(list_min(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / 255.0))) AS min_scaled,
       max(list_max(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / 255.0))) AS max_scaled
FROM embeddings
""")
def q_scale_maths(spark, d):
    s = emb(spark, d).select(S.scale_array("embedding", 255).alias("s"))
    return s.agg(F.min(F.array_min("s")).alias("min_scaled"), F.max(F.array_max("s")).alias("max_scaled"))


@query("q_maths", "F33, F32, F27, F28", """
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd FROM customer),
x AS (SELECT c_custkey, c_acctbal / 1000.0 AS x, (c_acctbal - s.m) / s.sd AS z, s.m, s.sd FROM customer, s)
SELECT c_custkey,
       round(cos(x), 6) AS cos_x, round(sin(x), 6) AS sin_x, abs(x) AS abs_x, round(exp(x), 6) AS exp_x,
       round(CASE WHEN x > 0 THEN ln(x) END, 6) AS log_x, round(CASE WHEN x >= 0 THEN sqrt(x) END, 6) AS sqrt_x,
       round(pow(x, 2), 6) AS pow_x,
       round(1.0 / (1.0 + exp(-x)), 6) AS sig_x, round(1.0 + 4.0 * (1.0 / (1.0 + exp(-x))), 6) AS rating,
       round(z * sd + m, 4) AS restored
FROM x
""")
def q_maths(spark, d):
    cu = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    zdf, st = standardize(cu.withColumn("z", F.col("c_acctbal")), ["z"])
    zdf = unstandardize(zdf, "z", *st["z"])
    x = F.col("c_acctbal") / 1000.0
    return zdf.select(
        "c_custkey",
        F.round(F.cos(x), 6).alias("cos_x"), F.round(F.sin(x), 6).alias("sin_x"), F.abs(x).alias("abs_x"),
        F.round(F.exp(x), 6).alias("exp_x"), F.round(F.log(x), 6).alias("log_x"),
        F.round(F.sqrt(F.when(x >= 0, x)), 6).alias("sqrt_x"), F.round(F.pow(x, 2), 6).alias("pow_x"),
        F.round(S.sigmoid(x), 6).alias("sig_x"), F.round(S.rating_sigmoid(x, 1.0, 5.0), 6).alias("rating"),
        F.round("z", 4).alias("restored"),
    )


@query("q_ordinal_probs", "F29", """
WITH x AS (SELECT c_custkey, c_acctbal / 2000.0 AS z FROM customer),
s AS (SELECT c_custkey, 1.0 / (1.0 + exp(-(-1.0 - z))) AS s1, 1.0 / (1.0 + exp(-(0.0 - z))) AS s2,
             1.0 / (1.0 + exp(-(1.0 - z))) AS s3, 1.0 / (1.0 + exp(-(2.0 - z))) AS s4 FROM x)
SELECT c_custkey, round(s1, 6) AS p0, round(s2 - s1, 6) AS p1, round(s3 - s2, 6) AS p2, round(s4 - s3, 6) AS p3,
       round(1.0 - s4, 6) AS p4
FROM s
""")
def q_ordinal_probs(spark, d):
    cu = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") / 2000.0).alias("z"))
    pr = cu.select("c_custkey", S.ordinal_probs("z", [-1.0, 0.0, 1.0, 2.0]).alias("p"))
    return pr.select("c_custkey", *[F.round(F.col("p")[i], 6).alias(f"p{i}") for i in range(5)])


@query("q_gaussian_own2", "M13, M14 (own covariances)", """
WITH d AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x0, CAST(embedding[2] AS DOUBLE) AS x1,
                  CAST(label >= 5 AS INTEGER) AS y FROM embeddings),
s AS (SELECT y, avg(x0) AS m0, avg(x1) AS m1, var_samp(x0) AS a, covar_samp(x0, x1) AS b, var_samp(x1) AS c,
             CAST(count(*) AS DOUBLE) AS n FROM d GROUP BY y),
p AS (SELECT s0.m0 AS u00, s0.m1 AS u01, s0.a AS a0, s0.b AS b0, s0.c AS c0, s0.a * s0.c - s0.b * s0.b AS det0,
             s0.n AS n0, s1.m0 AS u10, s1.m1 AS u11, s1.a AS a1, s1.b AS b1, s1.c AS c1,
             s1.a * s1.c - s1.b * s1.b AS det1, s1.n AS n1
      FROM s s0 JOIN s s1 ON s0.y = 0 AND s1.y = 1),
q AS (SELECT d.vec_id,
             ((d.x0 - u10) * (c1 * (d.x0 - u10) - b1 * (d.x1 - u11))
               + (d.x1 - u11) * (a1 * (d.x1 - u11) - b1 * (d.x0 - u10))) / det1 AS q1,
             ((d.x0 - u00) * (c0 * (d.x0 - u00) - b0 * (d.x1 - u01))
               + (d.x1 - u01) * (a0 * (d.x1 - u01) - b0 * (d.x0 - u00))) / det0 AS q0,
             0.5 * (ln(det0) - ln(det1)) + ln(n1 / n0) AS k
      FROM d, p)
SELECT vec_id, round(1.0 / (1.0 + exp(-(k - 0.5 * (q1 - q0)))), 6) AS p1 FROM q
""")
def q_gaussian_own2(spark, d):
    x = emb(spark, d).select("vec_id", F.col("embedding")[0].cast("double").alias("x0"),
                             F.col("embedding")[1].cast("double").alias("x1"),
                             (F.col("label") >= 5).cast("int").alias("y"))
    model = fit_gaussian(x, ["x0", "x1"], "y", shared=False)
    return predict_gaussian(x, ["x0", "x1"], model).select("vec_id", F.round("p1", 6).alias("p1"))


@query("q_gram_wide", "A6 (per-partition NumPy path, all 64 values), A7", f"""
WITH {_PAIRS_SQL}
SELECT label, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(SUM(x * y), 9) AS xx FROM pairs GROUP BY label, i, j
""")
def q_gram_wide(spark, d):
    x, names = _wide(spark, d, "label")
    # above the SQL threshold, so partitions build X'X with NumPy and the per-partition matrices
    # are summed in two levels
    g = stats.gram(x, names, by=["label"])
    rows = [(int(key[0]), i, j, round(float(m.xx[i, j]), 9)) for key, m in g.items() for i in range(64) for j in range(i, 64)]
    return spark.createDataFrame(rows, "label int, i int, j int, xx double")


@query("q_gaussian_own_wide", "M13, M14 (own covariances, all 64 values)", """
WITH RECURSIVE
e AS (SELECT vec_id, CAST(label >= 5 AS INTEGER) AS y, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS MATERIALIZED (SELECT vec_id, y, unnest(range(64)) AS i, unnest(x) AS v FROM e),
mu AS MATERIALIZED (SELECT y, list(m ORDER BY i) AS m FROM (SELECT y, i, avg(v) AS m FROM u GROUP BY y, i) t GROUP BY y),
n AS (SELECT y, CAST(count(*) AS DOUBLE) AS n FROM e GROUP BY y),
cov AS MATERIALIZED (SELECT a.y, a.i, b.i AS j, covar_samp(a.v, b.v) AS s FROM u a JOIN u b ON a.vec_id = b.vec_id GROUP BY a.y, a.i, b.i),
-- Gauss-Jordan on [S | 1] of each class; piv is the logarithm of a row's pivot
g(k, y, i, row, piv) AS (
  SELECT 0, y, i, list_concat(list(s ORDER BY j), list_transform(range(64), lambda c: CASE WHEN c = i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)), 0.0::DOUBLE
  FROM cov GROUP BY y, i
  UNION ALL
  SELECT a.k + 1, a.y, a.i, CASE WHEN a.i = a.k THEN list_transform(a.row, lambda v: v / p.row[a.k + 1])
    ELSE list_transform(range(1, 129), lambda c: a.row[c] - a.row[a.k + 1] / p.row[a.k + 1] * p.row[c]) END,
    CASE WHEN a.i = a.k THEN ln(p.row[a.k + 1]) ELSE a.piv END
  FROM g a JOIN g p ON p.k = a.k AND p.y = a.y AND p.i = a.k WHERE a.k < 64),
inv AS MATERIALIZED (SELECT y, i, row[65:128] AS r, piv FROM g WHERE k = 64),
ld AS (SELECT y, sum(piv) AS ld FROM inv GROUP BY y),
dev AS MATERIALIZED (SELECT e.vec_id, mu.y, list_transform(range(1, 65), lambda c: e.x[c] - mu.m[c]) AS d FROM e, mu),
q AS (SELECT dev.vec_id, dev.y, sum(d[inv.i + 1] * list_dot_product(d, inv.r)) AS q FROM dev JOIN inv ON inv.y = dev.y GROUP BY 1, 2),
t AS (SELECT vec_id, sum(CASE WHEN q.y = 1 THEN 1 ELSE -1 END * (ln(n.n) - 0.5 * ld.ld - 0.5 * q.q)) AS z
      FROM q JOIN ld ON ld.y = q.y JOIN n ON n.y = q.y GROUP BY vec_id)
SELECT vec_id, round(1.0 / (1.0 + exp(-z)), 6) AS p1 FROM t
""")
def q_gaussian_own_wide(spark, d):
    x, names = _wide(spark, d, "vec_id", (F.col("label") >= 5).cast("int").alias("y"))
    model = fit_gaussian(x, names, "y", shared=False)
    return predict_gaussian(x, names, model).select("vec_id", F.round("p1", 6).alias("p1"))
