"""Catalogue: statistical-learning operators (Gram, ridge CV, logistic, thresholds, scoring)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import logistic, reshape, stats
from tessera.operators.linear import fit_ridge_cv, predict_linear
from tessera.operators.scale import standardize
from tessera.operators.split import with_folds
from tessera.plans.registry import query
from tessera.session import table


@query("q_gram", "A6", """
SELECT o_orderstatus, CAST(COUNT(*) AS DOUBLE) AS n,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS s_0,
       CAST(SUM(CAST(month(o_orderdate) AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS s_1,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS ss_0_0,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(month(o_orderdate) AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS ss_0_1,
       CAST(SUM(CAST(month(o_orderdate) AS DECIMAL(18,2)) * CAST(month(o_orderdate) AS DECIMAL(18,2))) AS DECIMAL(38,4)) AS ss_1_1
FROM orders GROUP BY o_orderstatus
""")
def q_gram(spark, d):
    o = table(spark, d, "orders").select("o_orderstatus", "o_totalprice", F.month("o_orderdate").alias("month"))
    g = stats.gram_sql(o, ["o_totalprice", "month"], by=["o_orderstatus"], exact="decimal(18,2)")
    return g.select("o_orderstatus", F.col("n").cast("double").alias("n"),
                    *[F.col(n).cast("decimal(38,4)").alias(n) for n in ["s_0", "s_1", "ss_0_0", "ss_0_1", "ss_1_1"]])


RIDGE_LAMBDAS = [0.0, 10.0, 100.0, 1000.0]
_LAM_SQL = ", ".join(f"({i}, {v})" for i, v in enumerate(RIDGE_LAMBDAS))


@query("q_ridge_cv", "M4, M5, A17, A11", f"""
WITH d AS (
  SELECT CAST((CAST(o_orderkey AS HUGEINT) * 2654435761) % 4294967296 % 5 AS INTEGER) AS fold,
         1.0 AS x0, CAST(month(o_orderdate) AS DOUBLE) AS x1, o_totalprice / 1000.0 AS y FROM orders),
g AS (SELECT fold, SUM(x0 * x0) AS s00, SUM(x0 * x1) AS s01, SUM(x1 * x1) AS s11, SUM(x0 * y) AS r0,
             SUM(x1 * y) AS r1, COUNT(*) AS n FROM d GROUP BY fold),
t AS (SELECT SUM(s00) AS s00, SUM(s01) AS s01, SUM(s11) AS s11, SUM(r0) AS r0, SUM(r1) AS r1, SUM(n) AS n FROM g),
lam AS (SELECT * FROM (VALUES {_LAM_SQL}) v(lambda_index, lam)),
tr AS (SELECT l.lambda_index, g.fold, t.s00 - g.s00 + l.lam AS a, t.s01 - g.s01 AS b, t.s11 - g.s11 + l.lam AS c,
              t.r0 - g.r0 AS r0, t.r1 - g.r1 AS r1 FROM g, t, lam l),
cf AS (SELECT lambda_index, fold, (c * r0 - b * r1) / (a * c - b * b) AS b0, (a * r1 - b * r0) / (a * c - b * b) AS b1
       FROM tr),
sse AS (SELECT cf.lambda_index, SUM((d.y - cf.b0 * d.x0 - cf.b1 * d.x1) * (d.y - cf.b0 * d.x0 - cf.b1 * d.x1)) AS sse
        FROM cf JOIN d ON cf.fold = d.fold GROUP BY cf.lambda_index),
rep AS (SELECT sse.lambda_index, l.lam, sqrt(sse.sse / t.n) AS rmse FROM sse JOIN lam l ON sse.lambda_index = l.lambda_index, t),
fin AS (SELECT l.lambda_index,
               ((t.s11 + l.lam) * t.r0 - t.s01 * t.r1) / ((t.s00 + l.lam) * (t.s11 + l.lam) - t.s01 * t.s01) AS b0,
               ((t.s00 + l.lam) * t.r1 - t.s01 * t.r0) / ((t.s00 + l.lam) * (t.s11 + l.lam) - t.s01 * t.s01) AS b1
        FROM t, lam l),
best AS (SELECT lambda_index FROM rep ORDER BY rmse, lambda_index LIMIT 1)
SELECT CAST(rep.lambda_index AS BIGINT) AS lambda_index, CAST(rep.lam AS DOUBLE) AS lambda, round(rep.rmse, 4) AS rmse,
       round(fin.b0, 6) AS b0, round(fin.b1, 6) AS b1, CAST(rep.lambda_index = best.lambda_index AS BIGINT) AS best
FROM rep JOIN fin ON rep.lambda_index = fin.lambda_index, best
""")
def q_ridge_cv(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.lit(1.0).alias("x0"), F.month("o_orderdate").cast("double").alias("x1"),
        (F.col("o_totalprice") / 1000.0).alias("y"))
    o = with_folds(o, "o_orderkey", 5)
    _, best, report = fit_ridge_cv(o, ["x0", "x1"], "y", RIDGE_LAMBDAS)
    rows = [(m, lam, round(rmse, 4), round(float(b[0]), 6), round(float(b[1]), 6), int(m == best))
            for m, lam, rmse, b in report]
    return spark.createDataFrame(rows, "lambda_index bigint, lambda double, rmse double, b0 double, b1 double, best bigint")


_LOGIT_DATA_SQL = """
st AS (SELECT avg(CAST(d.n_chars AS DOUBLE)) AS m, stddev_samp(CAST(d.n_chars AS DOUBLE)) AS s
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
x AS (SELECT 1.0 AS x0, (CAST(d.n_chars AS DOUBLE) - st.m) / st.s AS x1, CAST(l.quality AS DOUBLE) AS y
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id, st)"""
_SIG = "(1.0 / (1.0 + exp(-(x.x0 * s.w0 + x.x1 * s.w1))))"


def _logit_data(spark, d):
    lab = table(spark, d, "labels").select("doc_id", "quality")
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").cast("double").alias("x1"))
    j = lab.join(docs, "doc_id").select(F.lit(1.0).alias("x0"), "x1", F.col("quality").cast("double").alias("y"))
    j, _ = standardize(j, ["x1"])
    return j


@query("q_logistic_steps", "M8 (Adagrad)", f"""
WITH RECURSIVE {_LOGIT_DATA_SQL},
steps(it, w0, w1, q0, q1) AS (
  SELECT 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)
  UNION ALL
  SELECT it + 1, w0 - 0.1 * g0 / sqrt(q0 + g0 * g0), w1 - 0.1 * g1 / sqrt(q1 + g1 * g1), q0 + g0 * g0, q1 + g1 * g1
  FROM (SELECT s.it, s.w0, s.w1, s.q0, s.q1,
               SUM(({_SIG} - x.y) * x.x0) + 2.0 * 0.5 * s.w0 AS g0,
               SUM(({_SIG} - x.y) * x.x1) + 2.0 * 0.5 * s.w1 AS g1
        FROM steps s, x WHERE s.it < 5 GROUP BY s.it, s.w0, s.w1, s.q0, s.q1) a)
SELECT round(w0, 6) AS w0, round(w1, 6) AS w1 FROM steps WHERE it = 5
""")
def q_logistic_steps(spark, d):
    w, _ = logistic.logistic_steps(_logit_data(spark, d), ["x0", "x1"], "y", reg=0.5, eta=0.1, solver="adagrad",
                                   fixed_steps=5)
    w = w[None]
    return spark.createDataFrame([(round(float(w[0]), 6), round(float(w[1]), 6))], "w0 double, w1 double")


@query("q_logistic_newton", "M8 (Newton)", f"""
WITH RECURSIVE {_LOGIT_DATA_SQL},
steps(it, w0, w1) AS (
  SELECT 0, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)
  UNION ALL
  SELECT it + 1, w0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), w1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
  FROM (SELECT s.it, s.w0, s.w1,
               SUM(({_SIG} - x.y) * x.x0) + 2.0 * 0.5 * s.w0 AS g0,
               SUM(({_SIG} - x.y) * x.x1) + 2.0 * 0.5 * s.w1 AS g1,
               SUM({_SIG} * (1.0 - {_SIG}) * x.x0 * x.x0) + 2.0 * 0.5 AS h00,
               SUM({_SIG} * (1.0 - {_SIG}) * x.x0 * x.x1) AS h01,
               SUM({_SIG} * (1.0 - {_SIG}) * x.x1 * x.x1) + 2.0 * 0.5 AS h11
        FROM steps s, x WHERE s.it < 8 GROUP BY s.it, s.w0, s.w1) a)
SELECT round(w0, 6) AS w0, round(w1, 6) AS w1 FROM steps WHERE it = 8
""")
def q_logistic_newton(spark, d):
    w, _ = logistic.logistic_steps(_logit_data(spark, d), ["x0", "x1"], "y", reg=0.5, solver="newton", fixed_steps=8)
    w = w[None]
    return spark.createDataFrame([(round(float(w[0]), 6), round(float(w[1]), 6))], "w0 double, w1 double")


_P_SQL = "1.0 / (1.0 + exp(-(ln(CAST(d.n_chars AS DOUBLE)) - 7.5)))"


@query("q_best_threshold", "M10, M11, A9, J8", f"""
WITH d AS (SELECT {_P_SQL} AS p, l.quality AS y FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
g AS (SELECT i, CAST(0.4 AS DOUBLE) + i * ((CAST(0.4 AS DOUBLE) + CAST(0.001 AS DOUBLE)) - CAST(0.4 AS DOUBLE)) AS t
      FROM range(200) r(i)),
acc AS (SELECT g.i, g.t, SUM(CASE WHEN (d.p > g.t) = (d.y = 1) THEN 1 ELSE 0 END) AS correct FROM g, d GROUP BY g.i, g.t),
best AS (SELECT i, t, correct FROM acc ORDER BY correct DESC, i LIMIT 1)
SELECT best.t AS threshold, CAST(best.correct AS BIGINT) AS correct,
       round(avg(CASE WHEN (d.p >= best.t) = (d.y = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM best, d GROUP BY best.t, best.correct
""")
def q_best_threshold(spark, d):
    lab = table(spark, d, "labels").select("doc_id", F.col("quality").alias("y"))
    docs = table(spark, d, "documents").select(
        "doc_id", S.sigmoid(F.log(F.col("n_chars").cast("double")) - 7.5).alias("p"))
    j = lab.join(docs, "doc_id").cache()
    t, correct = logistic.best_threshold(j, "p", "y", 0.4, 0.6, 0.001)
    cls = logistic.classify(j, "p", t, out="pred")
    acc = cls.agg(F.round(F.avg((F.col("pred") == F.col("y")).cast("double")), 6).alias("accuracy"))
    return acc.select(F.lit(t).alias("threshold"), F.lit(correct).cast("bigint").alias("correct"), "accuracy")


_X_SQL = "1.0 AS x0, o_totalprice / 1000.0 AS x1, CAST(month(o_orderdate) AS DOUBLE) AS x2"


@query("q_linear_predict", "M6, P5, P7, P8, A13", f"""
WITH x AS (SELECT o_orderkey, {_X_SQL} FROM orders),
p AS (SELECT o_orderkey, ((0.0 + x0 * 1.0) + x1 * 0.5) + x2 * 0.1 AS p1, (x0 * 2.0 + x1 * 0.45) + x2 * -0.2 AS p2 FROM x)
SELECT o_orderkey, p1, p2, ((0.0 + p1) + p2) / 2 AS pmean FROM p
""")
def q_linear_predict(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000.0).alias("x1"),
                                         F.month("o_orderdate").cast("double").alias("x2"))
    o = reshape.with_intercept(o, "x0")
    names = ["x0", "x1", "x2"]
    o = reshape.assemble(o, names, "features")
    o = o.withColumn("p1", S.dot_array_literal("features", [1.0, 0.5, 0.1]))
    o = predict_linear(o, names, [2.0, 0.45, -0.2], out="p2")
    return o.select("o_orderkey", "p1", "p2", S.row_mean(F.array("p1", "p2")).alias("pmean"))


@query("q_sse_rmse", "A8", f"""
WITH x AS (SELECT {_X_SQL} FROM orders),
p AS (SELECT x1 AS y, ((0.0 + x0 * 1.0) + x1 * 0.5) + x2 * 0.1 AS p1 FROM x)
SELECT round(SUM((p1 - y) * (p1 - y)), 4) AS sse, round(sqrt(avg((p1 - y) * (p1 - y))), 6) AS rmse FROM p
""")
def q_sse_rmse(spark, d):
    o = table(spark, d, "orders").select((F.col("o_totalprice") / 1000.0).alias("x1"),
                                         F.month("o_orderdate").cast("double").alias("x2"))
    o = reshape.assemble(reshape.with_intercept(o, "x0"), ["x0", "x1", "x2"], "features")
    o = o.withColumn("p1", S.dot_array_literal("features", [1.0, 0.5, 0.1]))
    e = (F.col("p1") - F.col("x1"))
    return o.agg(F.round(F.sum(e * e), 4).alias("sse"), F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"))


# Fixed values for the stand-in: two candidate coefficient sets scored by cross-validation.
CV_MODELS = {0: [1.0, 0.5, 0.1], 1: [2.0, 0.45, -0.2]}


@query("q_cv_report", "A17, A11, M1, M6", f"""
WITH x AS (SELECT CAST((CAST(o_orderkey AS HUGEINT) * 2654435761) % 4294967296 % 5 AS INTEGER) AS fold, {_X_SQL}
           FROM orders),
p AS (SELECT 0 AS model, fold, x1 AS y, (x0 * 1.0 + x1 * 0.5) + x2 * 0.1 AS pred FROM x
      UNION ALL
      SELECT 1 AS model, fold, x1 AS y, (x0 * 2.0 + x1 * 0.45) + x2 * -0.2 AS pred FROM x),
f AS (SELECT model, fold, SUM((pred - y) * (pred - y)) AS sse, COUNT(*) AS n FROM p GROUP BY model, fold),
r AS (SELECT model, sqrt(SUM(sse) / SUM(n)) AS rmse FROM f GROUP BY model)
SELECT CAST(model AS INTEGER) AS model, round(rmse, 6) AS rmse,
       CAST(model = (SELECT model FROM r ORDER BY rmse, model LIMIT 1) AS INTEGER) AS best
FROM r
""")
def q_cv_report(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000.0).alias("x1"),
                                         F.month("o_orderdate").cast("double").alias("x2"))
    o = with_folds(reshape.with_intercept(o, "x0"), "o_orderkey", 5)
    # one row per (row, candidate model); the candidates' predictions are literal dot products
    ex = o.withColumn("model", F.explode(F.array(*[F.lit(m) for m in CV_MODELS])))
    pred = None
    for m, coef in CV_MODELS.items():
        z = S.dot_literal(["x0", "x1", "x2"], coef)
        pred = F.when(F.col("model") == m, z) if pred is None else pred.when(F.col("model") == m, z)
    scored = ex.withColumn("pred", pred)
    report = stats.cv_report(scored, "model", "fold", "pred", "x1").cache()
    best = stats.pick_best(report, "rmse", "model").first()["model"]
    return report.select("model", F.round("rmse", 6).alias("rmse"), (F.col("model") == best).cast("int").alias("best"))
