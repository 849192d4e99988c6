"""Catalogue: iterative and model-fitting operators without an SQL oracle (rows-only checks;
their properties are tested in tests/test_models.py)."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import cluster, decompose, images, logistic, recsys, semi, text
from tessera.operators.gaussian import fit_gaussian, predict_gaussian
from tessera.operators.linear import bagging_curve, fit_bagged
from tessera.operators.split import bootstrap, key_hash, with_folds
from tessera.plans.registry import query
from tessera.session import checkpoint_dir, cut_lineage, table


def _bootstrap_sql() -> str:
    from tessera.operators.split import poisson1_cdf

    w = " + ".join(f"CASE WHEN u >= CAST('{q!r}' AS DOUBLE) THEN 1 ELSE 0 END" for q in poisson1_cdf())
    return f"""
WITH b AS (SELECT c_custkey, c_acctbal, bag FROM customer, range(1, 6) r(bag)),
h0 AS (SELECT c_custkey, c_acctbal, bag,
              (CAST(((CAST(c_custkey AS HUGEINT) + 7) * 2654435761) % 4294967296 AS BIGINT) + bag * 2246822519)
                % 4294967296 AS h FROM b),
h1 AS (SELECT *, (xor(h >> 16, h) * 73244475) % 4294967296 AS h1 FROM h0),
h2 AS (SELECT *, (xor(h1 >> 16, h1) * 73244475) % 4294967296 AS h2 FROM h1),
u AS (SELECT c_custkey, c_acctbal, bag, CAST(xor(h2 >> 16, h2) AS DOUBLE) / 4294967296.0 AS u FROM h2),
w AS (SELECT c_custkey, c_acctbal, CAST(bag AS INTEGER) AS bag, CAST({w} AS INTEGER) AS w FROM u)
SELECT * FROM w WHERE w > 0
"""


@query("q_bootstrap", "M3", _bootstrap_sql())
def q_bootstrap(spark, d):
    cu = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return bootstrap(cu, "c_custkey", 5, seed=7)


def _bagged_sql() -> str:
    from tessera.operators.split import poisson1_cdf

    w = " + ".join(f"CASE WHEN u >= CAST('{q!r}' AS DOUBLE) THEN 1 ELSE 0 END" for q in poisson1_cdf())
    return f"""
WITH d AS (
  SELECT o_orderkey, CAST((CAST(o_orderkey AS HUGEINT) * 2654435761) % 4294967296 % 5 AS INTEGER) AS fold,
         1.0 AS x0, CAST(month(o_orderdate) AS DOUBLE) AS x1, o_totalprice / 1000.0 AS y FROM orders),
b AS (SELECT d.*, bag FROM d, range(1, 151) r(bag) WHERE d.fold <> 0),
h0 AS (SELECT *, (CAST((CAST(o_orderkey AS HUGEINT) * 2654435761) % 4294967296 AS BIGINT) + bag * 2246822519)
                   % 4294967296 AS h FROM b),
h1 AS (SELECT *, (xor(h >> 16, h) * 73244475) % 4294967296 AS h1 FROM h0),
h2 AS (SELECT *, (xor(h1 >> 16, h1) * 73244475) % 4294967296 AS h2 FROM h1),
u AS (SELECT bag, x0, x1, y, CAST(xor(h2 >> 16, h2) AS DOUBLE) / 4294967296.0 AS u FROM h2),
w AS (SELECT bag, x0, x1, y, CAST({w} AS DOUBLE) AS w FROM u),
g AS (SELECT bag, SUM(w * x0 * x0) AS s00, SUM(w * x0 * x1) AS s01, SUM(w * x1 * x1) AS s11,
             SUM(w * x0 * y) AS r0, SUM(w * x1 * y) AS r1 FROM w WHERE w > 0 GROUP BY bag),
cf AS (SELECT bag, (s11 * r0 - s01 * r1) / (s00 * s11 - s01 * s01) AS b0,
              (s00 * r1 - s01 * r0) / (s00 * s11 - s01 * s01) AS b1 FROM g),
cum AS (SELECT bag, avg(b0) OVER (ORDER BY bag ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b0,
               avg(b1) OVER (ORDER BY bag ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b1 FROM cf),
v AS (SELECT cum.bag, sqrt(avg((cum.b0 + d.x1 * cum.b1 - d.y) * (cum.b0 + d.x1 * cum.b1 - d.y))) AS val_rmse
      FROM cum, d WHERE d.fold = 0 GROUP BY cum.bag)
SELECT CAST(v.bag AS BIGINT) AS bags, round(v.val_rmse, 6) AS val_rmse, round(cum.b0, 6) AS b0, round(cum.b1, 6) AS b1
FROM v JOIN cum ON v.bag = cum.bag
"""


@query("q_bagged_ridge", "M7, M3", _bagged_sql())
def q_bagged_ridge(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.lit(1.0).alias("x0"), F.month("o_orderdate").cast("double").alias("x1"),
        (F.col("o_totalprice") / 1000.0).alias("y"))
    o = with_folds(o, "o_orderkey", 5).cache()
    train, val = o.filter("fold != 0"), o.filter("fold = 0")
    mean_coef, coefs = fit_bagged(train, ["x0", "x1"], "y", "o_orderkey", times=150)
    curve = bagging_curve(coefs)
    # validation RMSE after the first b bags: one aggregate with one column per b
    e = [(F.lit(float(c[0])) + F.col("x1") * float(c[1]) - F.col("y")) for c in curve]
    row = val.agg(*[F.sqrt(F.avg(x * x)).alias(f"b{i + 1}") for i, x in enumerate(e)]).first()
    rows = [(i + 1, round(float(row[f"b{i + 1}"]), 6), round(float(curve[i][0]), 6), round(float(curve[i][1]), 6))
            for i in range(len(curve))]
    return spark.createDataFrame(rows, "bags bigint, val_rmse double, b0 double, b1 double")


_SIG_CV = "(1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1))))"


@query("q_logistic_cv", "M9, M1, M8, M10, M11, A9", f"""
WITH RECURSIVE
j AS (SELECT l.doc_id, CAST(l.quality AS DOUBLE) AS y, CAST(d.n_chars AS DOUBLE) AS n
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
st AS (SELECT avg(n) AS m, stddev_samp(n) AS s FROM j),
x AS (SELECT doc_id, CAST((CAST(doc_id AS HUGEINT) * 2654435761) % 4294967296 % 5 AS INTEGER) AS fold,
             1.0 AS x0, (n - st.m) / st.s AS x1, y FROM j, st),
folds AS (SELECT DISTINCT fold AS m FROM x),
steps(m, it, w0, w1) AS (
  SELECT m, 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM folds
  UNION ALL
  SELECT m, it + 1, w0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01),
         w1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (SELECT s.m, s.it, s.w0, s.w1,
               SUM(({_SIG_CV} - x.y) * x.x0) + 2.0 * 0.5 * s.w0 AS g0,
               SUM(({_SIG_CV} - x.y) * x.x1) + 2.0 * 0.5 * s.w1 AS g1,
               SUM({_SIG_CV} * (1.0 - {_SIG_CV}) * x.x0 * x.x0) + 2.0 * 0.5 AS h00,
               SUM({_SIG_CV} * (1.0 - {_SIG_CV}) * x.x0 * x.x1) AS h01,
               SUM({_SIG_CV} * (1.0 - {_SIG_CV}) * x.x1 * x.x1) + 2.0 * 0.5 AS h11
        FROM steps s JOIN x ON x.fold <> s.m WHERE s.it < 8 GROUP BY s.m, s.it, s.w0, s.w1) a),
w AS (SELECT m, w0, w1 FROM steps WHERE it = 8),
p AS (SELECT w.m, x.fold, x.y, 1.0 / (1.0 + exp(-(x.x0 * w.w0 + x.x1 * w.w1))) AS p FROM w, x),
g AS (SELECT i, CAST(0.4 AS DOUBLE) + i * ((CAST(0.4 AS DOUBLE) + CAST(0.001 AS DOUBLE)) - CAST(0.4 AS DOUBLE)) AS t
      FROM range(200) r(i)),
acc AS (SELECT p.m, g.i, g.t, SUM(CASE WHEN (p.p > g.t) = (p.y = 1) THEN 1 ELSE 0 END) AS correct
        FROM p, g WHERE p.fold <> p.m GROUP BY p.m, g.i, g.t),
best AS (SELECT m, t FROM (SELECT m, t, row_number() OVER (PARTITION BY m ORDER BY correct DESC, i) AS rn FROM acc) r
         WHERE rn = 1),
val AS (SELECT p.m, avg(CASE WHEN (CASE WHEN p.p >= best.t THEN 1.0 ELSE 0.0 END) = p.y THEN 1.0 ELSE 0.0 END) AS acc
        FROM p JOIN best ON p.m = best.m WHERE p.fold = p.m GROUP BY p.m)
SELECT CAST(w.m AS BIGINT) AS fold, best.t AS threshold, round(val.acc, 6) AS val_accuracy,
       round(w.w0, 6) AS w0, round(w.w1, 6) AS w1
FROM w JOIN best ON w.m = best.m JOIN val ON w.m = val.m
""")
def q_logistic_cv(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").cast("double").alias("x1"))
    j = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("y")).join(docs, "doc_id")
    m, s = j.agg(F.avg("x1"), F.stddev_samp("x1")).first()
    j = j.select("doc_id", F.lit(1.0).alias("x0"), ((F.col("x1") - m) / s).alias("x1"), "y")
    j = with_folds(j, "doc_id", 5).cache()
    W, _ = logistic.logistic_steps(j, ["x0", "x1"], "y", reg=0.5, solver="newton", fold="fold", fixed_steps=8)
    # thresholds from each fold's training rows, in one grouped job
    th = logistic.best_threshold_by_fold(j, ["x0", "x1"], "y", W, "fold")
    # validation accuracy: every row scored by the model that did not see it, one job
    p = S.sigmoid(logistic._score_models(j, ["x0", "x1"], W, "fold"))
    t = None
    for k, (tk, _) in th.items():
        t = F.when(F.col("fold") == k, F.lit(tk)) if t is None else t.when(F.col("fold") == k, F.lit(tk))
    acc = j.groupBy("fold").agg(F.avg(((p >= t).cast("double") == F.col("y")).cast("double")).alias("acc"))
    accs = {r["fold"]: r["acc"] for r in acc.collect()}
    rows = [(int(k), float(th[k][0]), round(float(accs[k]), 6), round(float(w[0]), 6), round(float(w[1]), 6))
            for k, w in sorted(W.items())]
    return spark.createDataFrame(rows, "fold bigint, threshold double, val_accuracy double, w0 double, w1 double")


def _det3(m):
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"(({a}) * (({e}) * ({i}) - ({f}) * ({h})) - ({b}) * (({d}) * ({i}) - ({f}) * ({g}))" \
           f" + ({c}) * (({d}) * ({h}) - ({e}) * ({g})))"


def _gaussian_own4_sql(k: int = 4) -> str:
    """DuckDB oracle: per-class means and covariances, 4x4 inverses by cofactors."""
    def cov(c, i, j):
        return f"s{c}.c{min(i, j)}{max(i, j)}"

    stats = ", ".join([f"avg(x{i}) AS m{i}" for i in range(k)]
                      + [f"covar_samp(x{i}, x{j}) AS c{i}{j}" for i in range(k) for j in range(i, k)]
                      + ["CAST(count(*) AS DOUBLE) AS n"])
    parts = []
    for c in (0, 1):
        cof = {}
        for i in range(k):
            for j in range(k):
                minor = [[cov(c, r, q) for q in range(k) if q != j] for r in range(k) if r != i]
                cof[i, j] = f"({'-' if (i + j) % 2 else ''}{_det3(minor)})"
        det = " + ".join(f"{cov(c, 0, j)} * {cof[0, j]}" for j in range(k))
        parts.append(f"({det}) AS det{c}")
        parts += [f"{cof[j, i]} AS a{c}_{i}{j}" for i in range(k) for j in range(k)]  # adjugate = cof^T
        parts += [f"s{c}.m{i} AS u{c}{i}" for i in range(k)] + [f"s{c}.n AS n{c}"]
    def quad(c):
        dd = [f"(d.x{i} - u{c}{i})" for i in range(k)]
        terms = " + ".join(f"{dd[i]} * a{c}_{i}{j} * {dd[j]}" for i in range(k) for j in range(k))
        return f"(({terms}) / det{c})"
    xs = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(k))
    return f"""
WITH d AS (SELECT vec_id, {xs}, CAST(label >= 5 AS INTEGER) AS y FROM embeddings),
s0 AS (SELECT {stats} FROM d WHERE y = 0),
s1 AS (SELECT {stats} FROM d WHERE y = 1),
p AS (SELECT {", ".join(parts)} FROM s0, s1),
z AS (SELECT d.vec_id, d.y, 1.0 / (1.0 + exp(-(0.5 * (ln(det0) - ln(det1)) + ln(n1 / n0)
                                               - 0.5 * ({quad(1)} - {quad(0)})))) AS p1 FROM d, p)
SELECT vec_id, y, round(p1, 6) AS p1, CAST(p1 >= 0.5 AS INTEGER) AS pred FROM z
"""


@query("q_gaussian_own", "M13, M14", _gaussian_own4_sql())
def q_gaussian_own(spark, d):
    x = table(spark, d, "embeddings").select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(4)],
        (F.col("label") >= 5).cast("int").alias("y"))
    names = [f"x{i}" for i in range(4)]
    model = fit_gaussian(x, names, "y", shared=False)
    out = predict_gaussian(x, names, model)
    return logistic.classify(out, "p1", 0.5, "pred").select("vec_id", "y", F.round("p1", 6).alias("p1"), "pred")


@query("q_pca", "M15, M28, A16")
def q_pca(spark, d):
    e = table(spark, d, "embeddings")
    model = decompose.pca(e, "embedding", 8, whiten=True)
    out = decompose.pca_transform(e, "embedding", model)
    ratio = model.cumulative_ratio
    return out.select("vec_id", "label", *[F.col("pcs")[j].alias(f"pc{j}") for j in range(8)],
                      F.lit(float(ratio[-1])).alias("explained"))


@query("q_kmeans", "M16, M17")
def q_kmeans(spark, d):
    e = table(spark, d, "embeddings")
    centres, cost, _ = cluster.kmeans_best(e, "embedding", k=3, restarts=10, seed=11)
    return cluster.assign(e, "embedding", centres.tolist()).select("vec_id", "label", "cluster",
                                                                    F.lit(float(cost)).alias("cost"))


def _lloyd_sql(restarts: int = 4, k: int = 3, steps: int = 3) -> str:
    """Lloyd's steps written out: model m starts at the m-th k vectors in the order of their ids."""
    near = """SELECT model, vec_id, x, cluster, dist FROM (
    SELECT model, vec_id, x, cluster, list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS dist FROM v, c{s})
  QUALIFY row_number() OVER (PARTITION BY model, vec_id ORDER BY dist, cluster) = 1"""
    parts = [f"""v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL),
r AS (SELECT x, row_number() OVER (ORDER BY vec_id) - 1 AS p FROM v),
c0 AS MATERIALIZED (SELECT p // {k} AS model, p % {k} AS cluster, x AS c FROM r WHERE p < {restarts * k})"""]
    for s in range(1, steps + 1):
        parts.append(f"""n{s} AS MATERIALIZED ({near.format(s=s - 1)}),
e{s} AS (SELECT model, cluster, i, avg(y) AS a FROM (
  SELECT model, cluster, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM n{s}) GROUP BY model, cluster, i),
g{s} AS (SELECT model, cluster, list(a ORDER BY i) AS c FROM e{s} GROUP BY model, cluster),
c{s} AS MATERIALIZED (SELECT model, cluster, coalesce(g{s}.c, old.c) AS c FROM c{s - 1} old LEFT JOIN g{s} USING (model, cluster))""")
    parts.append(f"last AS ({near.format(s=steps)})")
    return f"""WITH {", ".join(parts)}
SELECT CAST(model AS INTEGER) AS model, CAST(cluster AS INTEGER) AS cluster, count(*) AS n, round(sum(dist), 4) AS cost
FROM last GROUP BY ALL"""


@query("q_lloyd_restarts", "M16", _lloyd_sql())
def q_lloyd_restarts(spark, d):
    e = table(spark, d, "embeddings").filter("embedding is not null")
    first = [r[0] for r in e.orderBy("vec_id").limit(12).select("embedding").collect()]
    starts = np.array(first, float).reshape(4, 3, -1)
    vectors = cluster.finite_vectors(e, "embedding")
    centers, _ = cluster.lloyd(vectors, starts, max_iter=3, tol=-1.0)
    counts, _, costs = cluster.lloyd_step(vectors, centers)
    rows = [(m, j, int(counts[m, j]), float(costs[m, j])) for m in range(4) for j in range(3) if counts[m, j]]
    out = spark.createDataFrame(rows, "model int, cluster int, n long, cost double")
    return out.withColumn("cost", F.round("cost", 4))


@query("q_wide_svd", "M18")
def q_wide_svd(spark, d):
    e = table(spark, d, "embeddings")
    U, s, v = decompose.wide_svd(e, "embedding", 4)
    return v.select("vec_id", *[F.col("v")[j].alias(f"v{j}") for j in range(4)])


@query("q_reconstruct", "M19, A10")
def q_reconstruct(spark, d):
    e = table(spark, d, "embeddings")
    model = decompose.pca(e, "embedding", 4)
    out = decompose.reconstruct(e, "embedding", model.mean, model.components)
    return out.select("vec_id", F.array_join("recon", ",").alias("recon"))


def _ratings(spark, d):
    """user = customer, item = part, rating = 1 + (summed quantity mod 5) per pair."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(o, "l_orderkey")
    return j.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg(
        (F.lit(1.0) + F.pmod(F.sum("l_quantity").cast("bigint"), F.lit(5))).alias("rating"))


@query("q_genre_score", "M24, F30, F19, U3, W5", """
WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part),
dict AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS tok FROM (SELECT DISTINCT unnest(words) AS word FROM w) u),
ex AS (SELECT DISTINCT w.p_partkey, dict.tok FROM (SELECT p_partkey, unnest(words) AS word FROM w) w
       JOIN dict ON w.word = dict.word),
pr AS (SELECT p_partkey, SUM(0.25 * sin(tok + 1.0 + 0) + 0.5 * sin(tok + 1.0 + 1) + 0.75 * sin(tok + 1.0 + 2)
                             + 1.0 * sin(tok + 1.0 + 3)) AS s FROM ex GROUP BY p_partkey)
SELECT p_partkey, round(s, 6) AS genre_score FROM pr
""")
def q_genre_score(spark, d):
    p = table(spark, d, "part").select("p_partkey", S.split_array("p_name", " ").alias("words"))
    from tessera.operators import dictionary

    dic = dictionary.dictionary(dictionary.distinct_elements(p, "words", "word"), "word", token="tok").cache()
    n = dic.count()
    enc = dictionary.encode_array(p, "p_partkey", "words", dic, "word", "tok", out="toks")
    hot = enc.withColumn("hot", S.multi_hot("toks", n))
    rank = 4
    W = np.array([[np.sin(i + 1.0 + r) for r in range(rank)] for i in range(n)])  # rule-built genre weights
    hot = hot.withColumn("user_vec", F.array(*[F.lit(0.25 * (r + 1)) for r in range(rank)]))
    return recsys.score_genres(hot, "user_vec", "hot", W).select("p_partkey", F.round("genre_score", 6).alias("genre_score"))


_SELF_TRAIN_SQL = """
WITH RECURSIVE
st AS (SELECT avg(ln(CAST(n_chars AS DOUBLE))) AS m, stddev_samp(ln(CAST(n_chars AS DOUBLE))) AS s FROM documents),
d0 AS (SELECT d.doc_id, 1.0 AS x0, (ln(CAST(d.n_chars AS DOUBLE)) - st.m) / st.s AS x1,
              CAST(l.quality AS VARCHAR) AS label, CASE WHEN l.doc_id IS NULL THEN 'semi' ELSE 'train' END AS pool
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id, st),
t1 AS (SELECT x0, x1, CASE WHEN label = '1' THEN 1.0 ELSE 0.0 END AS y FROM d0 WHERE pool = 'train'),
f1(it, w0, w1) AS (
  SELECT 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)
  UNION ALL
  SELECT it + 1, w0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01),
         w1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (SELECT s.it, s.w0, s.w1,
               SUM(((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) - x.y) * x.x0) + 2.0 * 0.5 * s.w0 AS g0,
               SUM(((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) - x.y) * x.x1) + 2.0 * 0.5 * s.w1 AS g1,
               SUM((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) * (1.0 - (1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1))))) * x.x0 * x.x0) + 2.0 * 0.5 AS h00,
               SUM((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) * (1.0 - (1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1))))) * x.x0 * x.x1) AS h01,
               SUM((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) * (1.0 - (1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1))))) * x.x1 * x.x1) + 2.0 * 0.5 AS h11
        FROM f1 s, t1 x WHERE s.it < 8 GROUP BY s.it, s.w0, s.w1) a),
w1 AS (SELECT w0, w1 FROM f1 WHERE it = 8),
d1 AS (SELECT d0.doc_id, d0.x0, d0.x1, 1.0 - 1.0 / (1.0 + exp(-(d0.x0 * w1.w0 + d0.x1 * w1.w1))) AS p0, d0.label, d0.pool
       FROM d0, w1),
e1 AS (SELECT doc_id, x0, x1,
              CASE WHEN pool = 'semi' AND p0 >= 0.87 THEN '0' WHEN pool = 'semi' AND p0 <= 1.0 - 0.87 THEN '1'
                   ELSE label END AS label,
              CASE WHEN pool = 'semi' AND (p0 >= 0.87 OR p0 <= 1.0 - 0.87) THEN 'train' ELSE pool END AS pool
       FROM d1),
t2 AS (SELECT x0, x1, CASE WHEN label = '1' THEN 1.0 ELSE 0.0 END AS y FROM e1 WHERE pool = 'train'),
f2(it, w0, w1) AS (
  SELECT 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)
  UNION ALL
  SELECT it + 1, w0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01),
         w1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (SELECT s.it, s.w0, s.w1,
               SUM(((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) - x.y) * x.x0) + 2.0 * 0.5 * s.w0 AS g0,
               SUM(((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) - x.y) * x.x1) + 2.0 * 0.5 * s.w1 AS g1,
               SUM((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) * (1.0 - (1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1))))) * x.x0 * x.x0) + 2.0 * 0.5 AS h00,
               SUM((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) * (1.0 - (1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1))))) * x.x0 * x.x1) AS h01,
               SUM((1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1)))) * (1.0 - (1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1))))) * x.x1 * x.x1) + 2.0 * 0.5 AS h11
        FROM f2 s, t2 x WHERE s.it < 8 GROUP BY s.it, s.w0, s.w1) a),
w2 AS (SELECT w0, w1 FROM f2 WHERE it = 8),
d2 AS (SELECT e1.doc_id, 1.0 - 1.0 / (1.0 + exp(-(e1.x0 * w2.w0 + e1.x1 * w2.w1))) AS p0, e1.label, e1.pool FROM e1, w2)
SELECT doc_id,
       CASE WHEN pool = 'semi' AND (p0 >= 0.87 OR p0 <= 1.0 - 0.87) THEN 'train' ELSE pool END AS pool,
       CASE WHEN pool = 'semi' AND p0 >= 0.87 THEN '0' WHEN pool = 'semi' AND p0 <= 1.0 - 0.87 THEN '1'
            ELSE label END AS label
FROM d2
"""


@query("q_self_train", "M23, M22, M8, M11, U4", _SELF_TRAIN_SQL)
def q_self_train(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n"))
    lab = table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    m, s = docs.agg(F.avg(F.log("n")), F.stddev_samp(F.log("n"))).first()
    df = docs.join(lab, "doc_id", "left").select(
        "doc_id", F.lit(1.0).alias("x0"), ((F.log("n") - m) / s).alias("x1"), "label",
        F.when(F.col("label").isNull(), F.lit("semi")).otherwise(F.lit("train")).alias("pool"))

    def fit(train):
        t = train.withColumn("y", (F.col("label") == "1").cast("double"))
        w, _ = logistic.logistic_steps(t, ["x0", "x1"], "y", reg=0.5, solver="newton", fixed_steps=8)
        return w[None]

    def score(frame, w):
        return frame.withColumn("p0", F.lit(1.0) - S.sigmoid(S.dot_literal(["x0", "x1"], w)))

    state, w = semi.self_train(df, fit, score, threshold=0.87, rounds=2)
    return state.select("doc_id", "pool", "label")


def _self_train_batches_sql(rounds: int = 3) -> str:
    """Three rounds, written out: counts per cell, the batch in hash order, the rows that move."""
    parts = ["""base AS (SELECT doc_id, CAST(floor(n_chars / 50) AS BIGINT) AS cell,
  CASE WHEN len(string_split(text, ' ')) >= 60 THEN '1' ELSE '0' END AS truth,
  (CAST(doc_id AS HUGEINT) * 2654435761) % 4294967296 AS h FROM documents WHERE n_chars IS NOT NULL AND text IS NOT NULL),
size AS (SELECT (count(*) + 1) // 2 AS n FROM base WHERE h % 3 != 0),
t0 AS (SELECT doc_id, cell, truth AS label, 0 AS round, CAST(NULL AS DOUBLE) AS p0 FROM base WHERE h % 3 = 0)"""]
    for r in range(1, rounds + 1):
        parts.append(f"""m{r} AS (SELECT cell, count(*) AS n, count(*) FILTER (WHERE label = '0') AS n0 FROM t{r - 1} GROUP BY cell),
b{r} AS (SELECT doc_id, cell FROM base WHERE doc_id NOT IN (SELECT doc_id FROM t{r - 1})
  QUALIFY row_number() OVER (ORDER BY h, doc_id) <= (SELECT n FROM size)),
s{r} AS (SELECT doc_id, cell, (coalesce(n0, 0) + 1.0::DOUBLE) / (coalesce(n, 0) + 2.0::DOUBLE) AS p0 FROM b{r} LEFT JOIN m{r} USING (cell)),
t{r} AS (SELECT * FROM t{r - 1} UNION ALL
  SELECT doc_id, cell, CASE WHEN p0 >= 0.87 THEN '0' ELSE '1' END, {r}, p0 FROM s{r} WHERE p0 >= 0.87 OR p0 <= 1.0::DOUBLE - 0.87::DOUBLE)""")
    return f"""WITH {", ".join(parts)}
SELECT b.doc_id, CASE WHEN t.doc_id IS NULL THEN 'semi' ELSE 'train' END AS pool, t.label, t.p0,
  CASE WHEN t.round > 0 THEN t.round END AS round FROM base b LEFT JOIN t{rounds} t USING (doc_id)"""


@query("q_self_train_batches", "M23, M22, U4", _self_train_batches_sql())
def q_self_train_batches(spark, d):
    """Whether a text has 60 words, learned from bands of its length: a third of the rows is labelled."""
    docs = table(spark, d, "documents").filter("n_chars is not null and text is not null")
    labelled = F.pmod(key_hash("doc_id"), F.lit(3)) == 0
    long_text = F.when(F.size(F.split("text", " ")) >= 60, "1").otherwise("0")
    df = docs.select("doc_id", F.floor(F.col("n_chars") / 50).alias("cell"), F.when(labelled, long_text).alias("label"),
                     F.when(labelled, "train").otherwise("semi").alias("pool"))
    pool = df.filter("pool = 'semi'").count()

    def fit(train, _):
        return train.groupBy("cell").agg(F.count("*").alias("n"), F.count(F.when(F.col("label") == "0", 1)).alias("n0"))

    def score(rows, cells):
        p0 = (F.coalesce("n0", F.lit(0)) + 1.0) / (F.coalesce("n", F.lit(0)) + 2.0)
        return rows.join(cells, "cell", "left").withColumn("p0", p0).drop("n", "n0")

    log_path = f"{checkpoint_dir(spark)}/self_train_{uuid.uuid4().hex}"
    state, log, _ = semi.self_train_batches(df, "doc_id", fit, score, (pool + 1) // 2, 3, log_path)
    return state.join(log.select("doc_id", "p0", "round"), "doc_id", "left").select("doc_id", "pool", "label", "p0", "round")


@query("q_denoise", "M25, S11, A10", """
WITH mm AS (SELECT CAST(min(list_min(embedding)) AS DOUBLE) AS lo, CAST(max(list_max(embedding)) AS DOUBLE) AS hi
            FROM embeddings),
px AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(floor((CAST(v AS DOUBLE) - lo) * 255.0 / (hi - lo))
                                                                AS INTEGER)) AS p
       FROM embeddings, mm),
dn AS (SELECT vec_id, list_transform(range(64), lambda i: CASE WHEN p[i + 1] IN (0, 255)
          THEN list_sort([p[least(greatest(i // 8 + (-1), 0), 7) * 8 + least(greatest(i % 8 + (-1), 0), 7) + 1], p[least(greatest(i // 8 + (-1), 0), 7) * 8 + least(greatest(i % 8 + (0), 0), 7) + 1], p[least(greatest(i // 8 + (-1), 0), 7) * 8 + least(greatest(i % 8 + (1), 0), 7) + 1], p[least(greatest(i // 8 + (0), 0), 7) * 8 + least(greatest(i % 8 + (-1), 0), 7) + 1], p[least(greatest(i // 8 + (0), 0), 7) * 8 + least(greatest(i % 8 + (0), 0), 7) + 1], p[least(greatest(i // 8 + (0), 0), 7) * 8 + least(greatest(i % 8 + (1), 0), 7) + 1], p[least(greatest(i // 8 + (1), 0), 7) * 8 + least(greatest(i % 8 + (-1), 0), 7) + 1], p[least(greatest(i // 8 + (1), 0), 7) * 8 + least(greatest(i % 8 + (0), 0), 7) + 1], p[least(greatest(i // 8 + (1), 0), 7) * 8 + least(greatest(i % 8 + (1), 0), 7) + 1]])[5] ELSE p[i + 1] END) AS c FROM px)
SELECT vec_id, array_to_string(c, ',') AS clean FROM dn
""")
def q_denoise(spark, d):
    e = table(spark, d, "embeddings")
    lo, hi = e.agg(F.min(F.array_min("embedding")), F.max(F.array_max("embedding"))).first()
    px = images.to_pixels(e, "embedding", float(lo), float(hi), "pixels").select("vec_id", "pixels")
    out = images.denoise(px, "pixels", 8, 8, out="clean")
    return out.select("vec_id", F.array_join("clean", ",").alias("clean"))


@query("q_image_classifier", "M26, M15")
def q_image_classifier(spark, d):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    e = table(spark, d, "embeddings")
    model = decompose.pca(e, "embedding", 16)
    feats = decompose.pca_transform(e, "embedding", model).select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector("pcs").alias("features"))
    feats = with_folds(feats, "vec_id", 5)
    train = feats.filter("fold != 0")
    clf = LogisticRegression(family="multinomial", maxIter=50, regParam=0.01).fit(train)
    return clf.transform(feats).select("vec_id", "label", "prediction", "fold")


def _doc_tokens(spark, d):
    return text.tokens_of(table(spark, d, "documents"), "doc_id", "text")


@query("q_word_vectors", "T7")
def q_word_vectors(spark, d):
    return text.word_vectors(_doc_tokens(spark, d), "tokens", size=16, window=5, min_count=3, seed=3)


@query("q_doc_vectors", "T8, J5")
def q_doc_vectors(spark, d):
    t = _doc_tokens(spark, d)
    vecs = text.word_vectors(t, "tokens", size=16, window=5, min_count=3, seed=3)
    return text.doc_vector(t, "doc_id", "tokens", vecs)


@query("q_text_classifier", "T10, T8, M8, M11")
def q_text_classifier(spark, d):
    t = _doc_tokens(spark, d)
    vecs = text.word_vectors(t, "tokens", size=8, window=5, min_count=3, seed=3)
    dv = cut_lineage(text.doc_vector(t, "doc_id", "tokens", vecs))
    feats = dv.select("doc_id", F.lit(1.0).alias("x0"), *[F.col("doc_vec")[i].alias(f"x{i + 1}") for i in range(8)])
    names = [f"x{i}" for i in range(9)]
    lab = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("y"))
    train = feats.join(lab, "doc_id")
    w = logistic.fit_logistic(train, names, "y", reg=0.5, solver="newton", conv_norm=1e-6)
    scored = logistic.predict_proba(feats, names, w, "p")
    return logistic.classify(scored, "p", 0.5, "pred").select("doc_id", "p", "pred")


@query("q_income_plan", "F9, F10, F11, F13, F5, F8, F21, J2, M1, M8, M9, M10, M11 (plan)")
def q_income_plan(spark, d):
    from tessera.plans.income import income_classification

    return income_classification(spark, d)


@query("q_block_scoring", "P1, P2, C1, C3, C4, F3, F4, W4, P3, F5, F6, F7, F8, P5, P7, M5, M6 (plan)")
def q_block_scoring(spark, d):
    from tessera.plans.blocks import block_scoring

    return block_scoring(spark, d)


@query("q_bias_baseline", "M21 (bias part), M20, J2, C10", """
WITH j AS (SELECT o.o_custkey AS "user", l.l_partkey AS item, l.l_quantity
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
r AS (SELECT "user", item, 1.0 + CAST(CAST(SUM(l_quantity) AS BIGINT) % 5 AS DOUBLE) AS rating
      FROM j GROUP BY "user", item),
m AS (SELECT avg(rating) AS mu FROM r),
bu AS (SELECT "user", SUM(rating - m.mu) / (COUNT(*) + 0.0) AS b_user FROM r, m GROUP BY "user"),
bi AS (SELECT r.item, SUM(r.rating - m.mu - bu.b_user) / (COUNT(*) + 0.0) AS b_item
       FROM r JOIN bu ON r."user" = bu."user", m GROUP BY r.item),
s AS (SELECT r."user", r.item, r.rating, m.mu + bu.b_user + bi.b_item AS z
      FROM r JOIN bu ON r."user" = bu."user" JOIN bi ON r.item = bi.item, m)
SELECT "user", item, rating, round(CASE WHEN z < 1.0 THEN 1.0 WHEN z > 5.0 THEN 5.0 ELSE z END, 6) AS pred FROM s
""")
def q_bias_baseline(spark, d):
    from tessera.functions.scalar import clip
    from tessera.operators.joins import lookup

    r = _ratings(spark, d).cache()
    mu, bu, bi = recsys.bias_baseline(r, "user", "item", "rating")
    s = lookup(lookup(r, bu, "user"), bi, "item")
    z = F.lit(float(mu)) + F.col("b_user") + F.col("b_item")
    return s.select("user", "item", "rating", F.round(clip(z, 1.0, 5.0), 6).alias("pred"))


@query("q_explained_variance", "A16, M15")
def q_explained_variance(spark, d):
    e = table(spark, d, "embeddings")
    model = decompose.pca(e, "embedding", 16)
    rows = [(j, float(v), float(r), float(cr)) for j, (v, r, cr) in
            enumerate(zip(model.variance, model.explained_ratio, model.cumulative_ratio))]
    return spark.createDataFrame(rows, "component int, variance double, ratio double, cumulative double")
