"""Queries: profiling aggregates (A1-A10) over the whole tables."""

from __future__ import annotations

from tabula.functions.expressions import round_doubles
from tabula.operators import profile as PR
from tabula.plans import churn as CH
from tabula.plans.oracle_sql import union_long, with_churn
from tabula.plans.registry import register
from tabula.sources.tables import table

LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DESC_COLS = ["tenure", "monthly", "total_charges", "num_services", "avg_charge_per_month",
             "log_total_charges"]
HIST_COLS = ["tenure", "monthly", "total_charges"]
FLAGS = ["is_new_customer", "auto_pay", "senior", "churn"]
PROFILE_COLS = ["id", "segment", "region", "senior", "tenure", "monthly", "total_charges",
                "tenure_bin", "is_new_customer", "log_tenure"]


@register("table_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def table_shape(spark, sf_dir):
    return PR.shape(table(spark, sf_dir, "lineitem"))


_NULL_SQL = with_churn(
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM churn_t"
        for c in PROFILE_COLS))


@register("null_counts", _NULL_SQL)
def null_counts(spark, sf_dir):
    return PR.null_counts(CH.churn_table(spark, sf_dir), PROFILE_COLS)


_INFO_SQL = with_churn(
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, {i} AS position, CAST(count({c}) AS BIGINT) AS non_null FROM churn_t"
        for i, c in enumerate(PROFILE_COLS)))


@register("column_info", _INFO_SQL)
def column_info(spark, sf_dir):
    return PR.column_info(CH.churn_table(spark, sf_dir), PROFILE_COLS).drop("dtype")


def _describe_sql(cols, source):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
        f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
        f"round(quantile_cont({c}, 0.75), 6) AS q75, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {source}"
        for c in cols)


@register("describe_churn", with_churn(_describe_sql(DESC_COLS, "churn_t")))
def describe_churn(spark, sf_dir):
    return round_doubles(PR.describe(CH.churn_table(spark, sf_dir), DESC_COLS), 6)


@register("describe_lineitem", _describe_sql(LINE_NUM, "lineitem"))
def describe_lineitem(spark, sf_dir):
    """Exact quartiles over the largest table (multi-pass interval narrowing)."""
    return round_doubles(PR.describe(table(spark, sf_dir, "lineitem"), LINE_NUM), 6)


@register("value_counts", with_churn("""
SELECT segment, CAST(count(*) AS BIGINT) AS count,
       round(count(*) / (SELECT CAST(count(segment) AS DOUBLE) FROM churn_t), 6) AS share
FROM churn_t WHERE segment IS NOT NULL GROUP BY segment"""))
def value_counts(spark, sf_dir):
    return round_doubles(PR.value_counts(CH.churn_table(spark, sf_dir), "segment"), 6)


@register("sorted_distinct", "SELECT DISTINCT o_orderpriority FROM orders")
def sorted_distinct(spark, sf_dir):
    return PR.sorted_distinct(table(spark, sf_dir, "orders"), "o_orderpriority")


@register("crosstab", with_churn("""
SELECT segment, CAST(sum(CASE WHEN churned = 'No' THEN 1 ELSE 0 END) AS BIGINT) AS "No",
       CAST(sum(CASE WHEN churned = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS "Yes"
FROM churn_t GROUP BY segment"""))
def crosstab(spark, sf_dir):
    return PR.crosstab(CH.churn_table(spark, sf_dir), "segment", "churned", levels=["No", "Yes"])


_GM_COLS = CH.NUMERIC_COLS + ["num_services", "charge_per_service"]


@register("group_means", with_churn(f"""
SELECT feature, churn, round(avg(value), 6) AS mean
FROM ({union_long(_GM_COLS, value_expr="CAST({c} AS DOUBLE)")}) u GROUP BY feature, churn"""))
def group_means(spark, sf_dir):
    return round_doubles(PR.group_means(CH.churn_table(spark, sf_dir), _GM_COLS, "churn"), 6)


@register("density_histogram", with_churn(f"""
long AS ({union_long(HIST_COLS, value_expr="CAST({c} AS DOUBLE)")}),
rng AS (
  SELECT feature, churn,
         CASE WHEN max(value) > min(value) THEN min(value) ELSE min(value) - 0.5 END AS lo,
         CASE WHEN max(value) > min(value) THEN max(value) ELSE max(value) + 0.5 END AS hi,
         count(*) AS n
  FROM long WHERE value IS NOT NULL GROUP BY feature, churn),
b AS (
  SELECT l.feature, l.churn, CAST(least(floor((value - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, lo, hi, n
  FROM long l JOIN rng r ON l.feature = r.feature AND l.churn = r.churn WHERE value IS NOT NULL)
SELECT feature, churn, bin, round(lo + bin * (hi - lo) / 50, 6) AS bin_lo,
       round(lo + (bin + 1) * (hi - lo) / 50, 6) AS bin_hi, CAST(count(*) AS BIGINT) AS count,
       round(count(*) / (n * (hi - lo) / 50), 6) AS density
FROM b GROUP BY feature, churn, bin, lo, hi, n"""))
def density_histogram(spark, sf_dir):
    return round_doubles(PR.density_histogram(CH.churn_table(spark, sf_dir), HIST_COLS, "churn", 50), 6)


@register("on_off_difference", with_churn("\nUNION ALL\n".join(
    f"SELECT '{f}' AS flag, round(avg(CASE WHEN {f} = 1 THEN monthly END), 6) AS mean_on, "
    f"round(avg(CASE WHEN {f} = 0 THEN monthly END), 6) AS mean_off, "
    f"round(avg(CASE WHEN {f} = 1 THEN monthly END) - avg(CASE WHEN {f} = 0 THEN monthly END), 6) AS delta "
    f"FROM churn_t HAVING count(CASE WHEN {f} = 1 THEN 1 END) > 0 AND count(CASE WHEN {f} = 0 THEN 1 END) > 0"
    for f in FLAGS)))
def on_off_difference(spark, sf_dir):
    return round_doubles(PR.on_off_difference(CH.churn_table(spark, sf_dir), FLAGS, "monthly"), 6)

