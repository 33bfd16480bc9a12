"""Churn-style customer table built from the order tables, and its cleaning and
feature-engineering steps.

``customer_frame`` derives one row per customer from ``customer`` x ``orders`` x
``lineitem``: line items are pre-aggregated per order (map-side partial
aggregation) before the join with ``orders``, and orders are aggregated per
customer before the join with ``customer``, so no join ever sees the raw
line-item volume.  Nation and region are fixed-size dimensions; Spark's size
check (``autoBroadcastJoinThreshold``) broadcasts them.

Its columns mirror a telecom churn table: two or three-level Yes/No service
columns, a numeric tenure in months, monthly and total charges (total as text
with blanks, as a CSV would give), a senior flag and a Yes/No label ``churned``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.functions import expressions as X
from tabula.sources.tables import table

# fixed values: column groups of the churn table
SERVICE_COLS = ["phone", "multi", "security", "backup"]
ADDON_COLS = ["security", "backup"]
REPLACE_COLS = ["multi", "security", "backup"]
REPLACE_MAP = {"No internet service": "No", "No phone service": "No"}
CATEGORICAL_COLS = ["segment", "region", "phone", "multi", "security", "backup", "senior"]
NUMERIC_COLS = ["tenure", "monthly", "total_charges"]
TENURE_EDGES = [0, 6, 12, 24, 48, 72]
TENURE_LABELS = ["0-6m", "7-12m", "13-24m", "25-48m", "49-72m"]
AUTO_PAY_LEVELS = ["AUTOMOBILE", "BUILDING"]
ENGINEERED_COLS = ["num_services", "num_addons", "avg_charge_per_month", "charge_per_service",
                   "is_new_customer", "auto_pay", "log_tenure", "log_total_charges"]


def customer_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw churn-like table, one row per customer (key ``id``)."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n_lines"),
             F.sum((F.col("l_returnflag") == "R").cast("int")).alias("n_ret"))
    )
    orders = table(spark, sf_dir, "orders").join(
        lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    per_cust = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.count(F.lit(1)).alias("n_orders"),
        F.avg("o_totalprice").alias("avg_price"),
        F.sum("o_totalprice").alias("sum_price"),
        F.sum((F.col("o_orderstatus") == "O").cast("int")).alias("n_open"),
        F.sum((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("n_urgent"),
        F.sum(F.coalesce("n_ret", F.lit(0))).alias("n_ret"),
        F.sum(F.coalesce("n_lines", F.lit(0))).alias("n_lines"),
    )
    geo = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    c = (
        table(spark, sf_dir, "customer")
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(per_cust, F.col("c_custkey") == F.col("o_custkey"), "left")
    )
    yes_no = lambda cond: F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))
    no_internet = (F.col("c_custkey") % 11) == 0
    phone = yes_no(F.col("n_open") >= 3)
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
        (F.col("c_acctbal") < 0).cast("bigint").alias("senior"),
        F.floor(F.datediff(F.col("last_order"), F.col("first_order")) / 30).cast("bigint").alias("tenure"),
        (F.col("avg_price") / 1000).alias("monthly"),
        F.when((F.col("c_custkey") % 17) == 0, F.lit(" "))
        .otherwise((F.col("sum_price") / 1000).cast("string")).alias("total_charges"),
        phone.alias("phone"),
        F.when(F.col("n_open") < 3, F.lit("No phone service"))
        .otherwise(yes_no(F.col("n_orders") > 10)).alias("multi"),
        F.when(no_internet, F.lit("No internet service"))
        .otherwise(yes_no(F.col("n_urgent") >= 2)).alias("security"),
        F.when(no_internet, F.lit("No internet service"))
        .otherwise(yes_no(F.col("n_ret") * 3 > F.col("n_lines"))).alias("backup"),
        yes_no(F.col("last_order") < F.lit("2001-01-01").cast("timestamp_ntz")).alias("churned"),
    )


def clean(raw: DataFrame, label: str = "churned", positive: str = "Yes") -> DataFrame:
    """Label flag, coercing parse of total charges, drop unparsable rows,
    collapse the 'no service' levels into 'No'."""
    df = raw.withColumn("churn", X.equals_flag(label, positive))
    df = df.withColumn("total_charges", X.coerce_double("total_charges"))
    df = df.dropna(subset=["total_charges"])
    return X.replace_values(df, REPLACE_MAP, REPLACE_COLS)


def engineer(df: DataFrame) -> DataFrame:
    """Derived features: service counts, floor-guarded ratios, right-closed tenure
    bins, flags and log transforms, all as one projection."""
    num_services = X.count_matches(SERVICE_COLS, "Yes")
    return df.select(
        "*",
        num_services.alias("num_services"),
        X.count_matches(ADDON_COLS, "Yes").alias("num_addons"),
        X.floor_ratio("total_charges", "tenure").alias("avg_charge_per_month"),
        X.floor_ratio(F.col("monthly"), num_services).alias("charge_per_service"),
        X.right_closed_bins("tenure", TENURE_EDGES, TENURE_LABELS).alias("tenure_bin"),
        X.threshold_flag("tenure", 6, "<=").alias("is_new_customer"),
        X.membership_flag("segment", AUTO_PAY_LEVELS).alias("auto_pay"),
        F.log1p(F.col("tenure").cast("double")).alias("log_tenure"),
        F.log1p("total_charges").alias("log_total_charges"),
    )


def churn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer(clean(customer_frame(spark, sf_dir)))
