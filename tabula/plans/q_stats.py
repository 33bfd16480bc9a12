"""Queries: hypothesis tests on the churn-style table (H1-H4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions.expressions import round_doubles
from tabula.operators import stattests as ST
from tabula.plans import churn as CH
from tabula.plans.oracle_sql import chi2_tail, t_tail, union_long, with_churn
from tabula.plans.registry import register

TTEST_COLS = CH.NUMERIC_COLS + CH.ENGINEERED_COLS

_CHI_SQL = with_churn(f"""
cells AS (
  SELECT feature, value, churn, count(*) AS o
  FROM ({union_long(CH.CATEGORICAL_COLS)}) u
  WHERE value IS NOT NULL GROUP BY feature, value, churn),
m AS (
  SELECT *, sum(o) OVER (PARTITION BY feature, value) AS r_tot,
         count(*) OVER (PARTITION BY feature, value) AS k_r,
         sum(o) OVER (PARTITION BY feature, churn) AS c_tot,
         count(*) OVER (PARTITION BY feature, churn) AS k_c,
         sum(o) OVER (PARTITION BY feature) AS n
  FROM cells),
per AS (
  SELECT feature, max(n) AS n, count(DISTINCT value) AS nr, count(DISTINCT churn) AS nc,
         sum(CAST(o AS DOUBLE) * o / (CAST(r_tot AS DOUBLE) * c_tot)) AS q,
         max(abs(o - CAST(r_tot AS DOUBLE) * c_tot / n)) AS d,
         sum(1.0 / (CAST(r_tot AS DOUBLE) * k_r)) AS s_r,
         sum(1.0 / (CAST(c_tot AS DOUBLE) * k_c)) AS s_c
  FROM m GROUP BY feature),
st AS (
  SELECT feature, CAST(n AS BIGINT) AS n, (nr - 1) * (nc - 1) AS dof, least(nr, nc) AS mm,
         CASE WHEN (nr - 1) * (nc - 1) = 0 THEN 0.0
              WHEN (nr - 1) * (nc - 1) = 1 THEN pow(greatest(d - 0.5, 0.0), 2) * n * s_r * s_c
              ELSE greatest(n * q - n, 0.0) END AS chi2
  FROM per)
SELECT feature, n, round(chi2, 6) AS chi2, CAST(dof AS INTEGER) AS dof,
       round(CASE WHEN mm > 1 THEN sqrt(chi2 / (n * (mm - 1))) END, 6) AS cramers_v
FROM st
""")


@register("chi_square", _CHI_SQL)
def chi_square(spark, sf_dir):
    df = CH.churn_table(spark, sf_dir)
    return round_doubles(ST.chi_square_stats(df, CH.CATEGORICAL_COLS, "churn"), 6)


_CHI_TEST_SQL = _CHI_SQL[:_CHI_SQL.rindex("SELECT feature")] + f"""SELECT feature, n, round(chi2, 6) AS chi2, CAST(dof AS INTEGER) AS dof,
       round(CASE WHEN mm > 1 THEN sqrt(chi2 / (n * (mm - 1))) END, 6) AS cramers_v,
       round({chi2_tail("chi2", "dof")}, 6) AS p_value, {chi2_tail("chi2", "dof")} < 0.05 AS significant
FROM st"""


@register("chi_square_test", _CHI_TEST_SQL)
def chi_square_test(spark, sf_dir):
    """Full table with p-values (tail through a pandas UDF on the per-feature rows)."""
    df = CH.churn_table(spark, sf_dir)
    return round_doubles(ST.chi_square_test(df, CH.CATEGORICAL_COLS, "churn"), 6)


_T_SQL = with_churn(f"""
s AS (
  SELECT feature,
         count(CASE WHEN churn = 0 THEN v END) AS n0, count(CASE WHEN churn = 1 THEN v END) AS n1,
         avg(CASE WHEN churn = 0 THEN v END) AS m0, avg(CASE WHEN churn = 1 THEN v END) AS m1,
         var_samp(CASE WHEN churn = 0 THEN v END) AS v0, var_samp(CASE WHEN churn = 1 THEN v END) AS v1,
         corr(CAST(churn AS DOUBLE), v) AS r
  FROM ({union_long(TTEST_COLS, value_expr="CAST({c} AS DOUBLE)").replace(" AS value,", " AS v,")}) u
  GROUP BY feature)
SELECT feature, round(m0, 6) AS mean_no_churn, round(m1, 6) AS mean_churn,
       round((m0 - m1) / sqrt(v0 / n0 + v1 / n1), 6) AS t_stat,
       round(pow(v0 / n0 + v1 / n1, 2) / (pow(v0 / n0, 2) / (n0 - 1) + pow(v1 / n1, 2) / (n1 - 1)), 6) AS welch_df,
       round(r, 6) AS point_biserial_r
FROM s
""")


@register("welch_ttest", _T_SQL)
def welch_ttest(spark, sf_dir):
    df = CH.churn_table(spark, sf_dir)
    return round_doubles(ST.welch_stats(df, TTEST_COLS, "churn"), 6)


_T_TEST_SQL = _T_SQL[:_T_SQL.rindex("SELECT feature, round(m0")] + f"""SELECT *, round({t_tail("t_stat", "welch_df")}, 5) AS p_value FROM (
""" + _T_SQL[_T_SQL.rindex("SELECT feature, round(m0"):] + ")"


@register("welch_ttest_pvalues", _T_TEST_SQL)
def welch_ttest_pvalues(spark, sf_dir):
    df = CH.churn_table(spark, sf_dir)
    t = round_doubles(ST.welch_test(df, TTEST_COLS, "churn"), 6)
    return t.withColumn("p_value", F.round("p_value", 5))


_CLEAN_COLS = ["id", "segment", "region", "senior", "tenure", "monthly", "total_charges", "phone",
               "multi", "security", "backup", "churned", "churn"] + CH.ENGINEERED_COLS + ["tenure_bin"]


@register("churn_features", with_churn(
    "SELECT " + ", ".join(
        f"round({c}, 6) AS {c}" if c in ("monthly", "total_charges", "avg_charge_per_month",
                                          "charge_per_service", "log_tenure", "log_total_charges")
        else c for c in _CLEAN_COLS) + " FROM churn_t"))
def churn_features(spark, sf_dir):
    """Cleaning + feature engineering (P3-P16) over the whole customer table."""
    df = CH.churn_table(spark, sf_dir).select(*_CLEAN_COLS)
    return round_doubles(df, 6)

