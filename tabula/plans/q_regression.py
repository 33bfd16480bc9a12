"""Queries: Gram-matrix regression family on the whole line-item table
(G1, M2, M3, M4, M5, H7, H8, H9, H12).

Oracles use the closed forms for two or three predictors written with
DuckDB's covariance aggregates; the Spark side uses the general k x k code.
"""

from __future__ import annotations

import numpy as np

from pyspark.sql import Column
from pyspark.sql import functions as F
from tabula.functions.expressions import round_doubles
from tabula.operators import linear as L
from tabula.plans.oracle_sql import f_tail, t_tail
from tabula.plans.registry import register
from tabula.sources.tables import table

X2 = ["l_quantity", "l_discount"]
Y = "l_extendedprice"
RIDGE_ALPHA = 1000.0
LASSO_ALPHA = 100.0
ENET_ALPHA, ENET_RATIO = 100.0, 0.5

_MOM = f"""
WITH m AS (
  SELECT count(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg({Y}) AS my,
         covar_pop(l_quantity, l_quantity) * count(*) AS s11, covar_pop(l_discount, l_discount) * count(*) AS s22,
         covar_pop(l_quantity, l_discount) * count(*) AS s12, covar_pop(l_quantity, {Y}) * count(*) AS s1y,
         covar_pop(l_discount, {Y}) * count(*) AS s2y, covar_pop({Y}, {Y}) * count(*) AS syy
  FROM lineitem),
b AS (
  SELECT *, s11 * s22 - s12 * s12 AS d,
         (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
         (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM m),
f AS (
  SELECT *, my - b1 * m1 - b2 * m2 AS b0, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS sigma2,
         syy - b1 * s1y - b2 * s2y AS sse FROM b)
"""


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@register("ols_coefficients", _MOM + """
SELECT 'Intercept' AS term, round(b0, 4) AS coef,
       round(sqrt(sigma2 * (1.0 / n + (m1 * m1 * s22 + m2 * m2 * s11 - 2 * m1 * m2 * s12) / d)), 4) AS std_err,
       round(b0 / sqrt(sigma2 * (1.0 / n + (m1 * m1 * s22 + m2 * m2 * s11 - 2 * m1 * m2 * s12) / d)), 4) AS t_stat
FROM f
UNION ALL SELECT 'l_quantity', round(b1, 4), round(sqrt(sigma2 * s22 / d), 4), round(b1 / sqrt(sigma2 * s22 / d), 4) FROM f
UNION ALL SELECT 'l_discount', round(b2, 4), round(sqrt(sigma2 * s11 / d), 4), round(b2 / sqrt(sigma2 * s11 / d), 4) FROM f""")
def ols_coefficients(spark, sf_dir):
    """OLS ``price ~ quantity + discount``: one Gram aggregate, k x k solve."""
    fit = L.ols(_lines(spark, sf_dir), X2, Y)
    return round_doubles(fit.table(spark).select("term", "coef", "std_err", "t_stat"), 4)


# the 97.5 % point of t at a high dof is that of the normal plus the first two terms of its expansion
_T975 = ("(1.959963984540054 + (pow(1.959963984540054, 3) + 1.959963984540054) / (4.0 * (n - 3)) + "
         "(5 * pow(1.959963984540054, 5) + 16 * pow(1.959963984540054, 3) + 3 * 1.959963984540054) / (96.0 * pow(n - 3, 2)))")


@register("ols_inference", _MOM + f"""
, t AS (SELECT 'Intercept' AS term, b0 AS b, sqrt(sigma2 * (1.0 / n + (m1 * m1 * s22 + m2 * m2 * s11 - 2 * m1 * m2 * s12) / d)) AS s, n FROM f
  UNION ALL SELECT 'l_quantity', b1, sqrt(sigma2 * s22 / d), n FROM f
  UNION ALL SELECT 'l_discount', b2, sqrt(sigma2 * s11 / d), n FROM f)
SELECT term, round(b, 4) AS coef, round(s, 4) AS std_err, round(b / s, 4) AS t_stat,
       round(CASE WHEN abs(b / s) > 30 THEN 0.0 ELSE {t_tail("(b / s)", "(n - 3)")} END, 6) AS p_value,
       round(b - {_T975} * s, 4) AS ci_lower, round(b + {_T975} * s, 4) AS ci_upper FROM t""")
def ols_inference(spark, sf_dir):
    """Full coefficient table with p-values and 95% intervals (t tails)."""
    t = round_doubles(L.ols(_lines(spark, sf_dir), X2, Y).table(spark).withColumn("p6", F.round("p_value", 6)).drop("p_value"), 6)
    return t.select("term", *[F.round(c, 4).alias(c) for c in ("coef", "std_err", "t_stat")], F.col("p6").alias("p_value"),
                    *[F.round(c, 4).alias(c) for c in ("ci_lower", "ci_upper")])


@register("ols_summary", _MOM + """
SELECT CAST(n AS BIGINT) AS n_obs, 2.0 AS df_model, CAST(n - 3 AS DOUBLE) AS df_resid,
       round(1 - sse / syy, 6) AS r2, round(1 - (sse / syy) * (n - 1) / (n - 3), 6) AS adj_r2,
       round(((syy - sse) / 2) / (sse / (n - 3)), 4) AS f_stat FROM f""")
def ols_summary(spark, sf_dir):
    s = L.ols(_lines(spark, sf_dir), X2, Y).summary(spark)
    s = s.select("n_obs", "df_model", "df_resid", "r2", "adj_r2", "f_stat")
    return round_doubles(round_doubles(s.drop("f_stat"), 6).join(round_doubles(s.select("n_obs", "f_stat"), 4),
                                                                  "n_obs"), 6)


@register("ridge_coefficients", _MOM.replace("FROM m),", "FROM m),", 1) + f"""
, r AS (
  SELECT *, ((s22 + {RIDGE_ALPHA}) * s1y - s12 * s2y) / ((s11 + {RIDGE_ALPHA}) * (s22 + {RIDGE_ALPHA}) - s12 * s12) AS r1,
            ((s11 + {RIDGE_ALPHA}) * s2y - s12 * s1y) / ((s11 + {RIDGE_ALPHA}) * (s22 + {RIDGE_ALPHA}) - s12 * s12) AS r2
  FROM m)
SELECT 'Intercept' AS term, round(my - r1 * m1 - r2 * m2, 4) AS coef FROM r
UNION ALL SELECT 'l_quantity', round(r1, 4) FROM r
UNION ALL SELECT 'l_discount', round(r2, 4) FROM r""")
def ridge_coefficients(spark, sf_dir):
    """Ridge with unpenalised intercept (alpha on the raw sum-of-squares scale)."""
    b0, b = L.ridge(_lines(spark, sf_dir), X2, Y, alpha=RIDGE_ALPHA)
    rows = [("Intercept", float(b0))] + [(n, float(v)) for n, v in zip(X2, b)]
    return round_doubles(spark.createDataFrame(rows, "term string, coef double"), 4)


def _enet_sql(alpha, ratio):
    return f"""
WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS m1, avg({Y}) AS my,
                  covar_pop(l_quantity, l_quantity) * count(*) AS s11,
                  covar_pop(l_quantity, {Y}) * count(*) AS s1y FROM lineitem),
c AS (SELECT *, sign(s1y) * greatest(abs(s1y) - n * {alpha} * {ratio}, 0) / (s11 + n * {alpha} * (1 - {ratio})) AS b1
      FROM m)
SELECT 'Intercept' AS term, round(my - b1 * m1, 4) AS coef FROM c
UNION ALL SELECT 'l_quantity', round(b1, 4) FROM c"""


def _enet_query(alpha, ratio):
    def q(spark, sf_dir):
        b0, b, _ = L.elastic_net(_lines(spark, sf_dir), ["l_quantity"], Y, alpha=alpha, l1_ratio=ratio,
                                 tol=1e-12, max_iter=10000)
        rows = [("Intercept", float(b0)), ("l_quantity", float(b[0]))]
        return round_doubles(spark.createDataFrame(rows, "term string, coef double"), 4)
    return q


register("lasso_coefficients", _enet_sql(LASSO_ALPHA, 1.0))(_enet_query(LASSO_ALPHA, 1.0))
register("elastic_net_coefficients", _enet_sql(ENET_ALPHA, ENET_RATIO))(_enet_query(ENET_ALPHA, ENET_RATIO))

X3 = ["l_quantity", "l_discount", "l_tax"]


@register("vif_table", """
WITH r AS (SELECT corr(l_quantity, l_discount) AS r12, corr(l_quantity, l_tax) AS r13,
                  corr(l_discount, l_tax) AS r23 FROM lineitem),
d AS (SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det FROM r)
SELECT 'l_quantity' AS feature, round((1 - r23 * r23) / det, 6) AS vif FROM d
UNION ALL SELECT 'l_discount', round((1 - r13 * r13) / det, 6) FROM d
UNION ALL SELECT 'l_tax', round((1 - r12 * r12) / det, 6) FROM d""")
def vif_table(spark, sf_dir):
    rows = L.vif(_lines(spark, sf_dir), X3)
    return round_doubles(spark.createDataFrame(rows, "feature string, vif double"), 6)


@register("anova_type1", _MOM + """
, a AS (SELECT 'l_quantity' AS term, 1.0 AS df, s1y * s1y / s11 AS sum_sq, sigma2, true AS tested FROM f
  UNION ALL SELECT 'l_discount', 1.0, b1 * s1y + b2 * s2y - s1y * s1y / s11, sigma2, true FROM f
  UNION ALL SELECT 'Residual', CAST(n - 3 AS DOUBLE), sse, sigma2, false FROM f)
SELECT term, df, CAST(printf('%.9e', sum_sq) AS DOUBLE) AS sum_sq, CAST(printf('%.9e', sum_sq / df) AS DOUBLE) AS mean_sq,
       CASE WHEN tested THEN round(sum_sq / df / sigma2, 4) END AS f_stat FROM a""")
def anova_type1(spark, sf_dir):
    """Sequential sums of squares from nested sub-blocks of one Gram matrix."""
    rows = L.anova_type1(_lines(spark, sf_dir), [["l_quantity"], ["l_discount"]], X2, Y)
    df = spark.createDataFrame(
        [(r[0], float(r[1]), float(r[2]), float(r[3]), None if np.isnan(r[4]) else float(r[4])) for r in rows],
        "term string, df double, sum_sq double, mean_sq double, f_stat double")
    return df.select("term", "df", *[_digits(c) for c in ("sum_sq", "mean_sq")], F.round("f_stat", 4).alias("f_stat"))


def _digits(col: str) -> Column:
    """Ten significant digits: a rounding that does not depend on the size."""
    return F.format_string("%.9e", F.col(col)).cast("double").alias(col)


@register("anova_pvalues", _MOM + f"""
, t AS (SELECT 'l_quantity' AS term, (s1y * s1y / s11) / sigma2 AS f_stat, CAST(n - 3 AS DOUBLE) AS d2 FROM f
  UNION ALL SELECT 'l_discount', (b1 * s1y + b2 * s2y - s1y * s1y / s11) / sigma2, CAST(n - 3 AS DOUBLE) FROM f)
SELECT term, 1.0 AS df, CAST(printf('%.9e', f_stat * sigma2) AS DOUBLE) AS sum_sq, CAST(printf('%.9e', f_stat * sigma2) AS DOUBLE) AS mean_sq,
       round(f_stat, 4) AS f_stat,
       round(CASE WHEN f_stat > 1000 THEN 0.0 ELSE {f_tail("f_stat", "1.0", "d2")} END, 6) AS p_value FROM t, f
UNION ALL SELECT 'Residual', CAST(n - 3 AS DOUBLE), CAST(printf('%.9e', sse) AS DOUBLE), CAST(printf('%.9e', sigma2) AS DOUBLE), NULL, NULL FROM f""")
def anova_pvalues(spark, sf_dir):
    """The ANOVA table: sums of squares, F tests of the terms (upper tails of F) and the residual row."""
    rows = L.anova_type1(_lines(spark, sf_dir), [["l_quantity"], ["l_discount"]], X2, Y)
    number = lambda v: None if np.isnan(v) else float(v)
    df = spark.createDataFrame([(r[0], *map(number, r[1:6])) for r in rows],
                               "term string, df double, sum_sq double, mean_sq double, f_stat double, p_value double")
    return df.select("term", "df", *[_digits(c) for c in ("sum_sq", "mean_sq")], F.round("f_stat", 4).alias("f_stat"),
                     F.round("p_value", 6).alias("p_value"))


_ONE = f"""
WITH c AS (SELECT regr_intercept({Y}, l_quantity) AS a, regr_slope({Y}, l_quantity) AS b,
                  avg(l_quantity) AS m, regr_sxx({Y}, l_quantity) AS sxx, count(*) AS n FROM lineitem),
e AS (SELECT l_quantity AS x, {Y} - a - b * l_quantity AS e, a, b, m, sxx, n FROM lineitem, c)
"""


@register("breusch_pagan", _ONE + """
, s AS (SELECT corr(e * e, x) AS r, max(n) AS n FROM e)
SELECT round(n * r * r, 6) AS lm, round((r * r) / ((1 - r * r) / (n - 2)), 6) AS f_stat FROM s""")
def breusch_pagan(spark, sf_dir):
    """Auxiliary regression of squared residuals on the design (LM = n R2)."""
    li = _lines(spark, sf_dir)
    fit = L.ols(li, ["l_quantity"], Y)
    lm, _, f, _ = L.breusch_pagan(li, fit, ["l_quantity"], Y)
    return round_doubles(spark.createDataFrame([(float(lm), float(f))], "lm double, f_stat double"), 6)


@register("hc3_errors", _ONE + """
, h AS (SELECT *, 1.0 / n + (x - m) * (x - m) / sxx AS lev FROM e)
SELECT 'Intercept' AS term,
       round(sqrt(sum(pow(1.0 / n - m * (x - m) / sxx, 2) * e * e / pow(1 - lev, 2))), 6) AS robust_se FROM h
UNION ALL SELECT 'l_quantity', round(sqrt(sum(pow((x - m) / sxx, 2) * e * e / pow(1 - lev, 2))), 6) FROM h""")
def hc3_errors(spark, sf_dir):
    """HC3 robust standard errors: leverage as a per-row expression, one aggregate."""
    li = _lines(spark, sf_dir)
    fit = L.ols(li, ["l_quantity"], Y)
    cov = L.hc3_cov(li, fit, Y)
    rows = [(n, float(np.sqrt(cov[i, i]))) for i, n in enumerate(fit.names)]
    return round_doubles(spark.createDataFrame(rows, "term string, robust_se double"), 6)
