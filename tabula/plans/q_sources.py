"""Queries: sources, sinks and column selection (S2, S3, S5, P1-P3), the metric
suite and the wide confusion matrix (V10, V11, V14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions.expressions import map_values, round_doubles
from tabula.operators import features as FE
from tabula.operators import metrics as ME
from tabula.plans import q_metrics as QM
from tabula.plans.oracle_sql import with_churn
from tabula.plans.registry import SQL, register
from tabula.sources import sinks as SK
from tabula.sources import tables as TB

# fixed values: weight of each order priority
WEIGHTS = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}
_VALUES = ", ".join(f"('{k}', {v})" for k, v in WEIGHTS.items())


@register("priority_weights", f"""
SELECT w AS weight, p AS priority, count(*) AS orders, CAST(sum(w) AS BIGINT) AS total
FROM orders JOIN (VALUES {_VALUES}) AS v(p, w) ON o_orderpriority = p GROUP BY w, p""")
def priority_weights(spark, sf_dir):
    """Strict value map on every order, named again through an inline table."""
    orders = TB.table(spark, sf_dir, "orders").select(map_values("o_orderpriority", WEIGHTS).alias("weight"))
    names = TB.inline_table(spark, list(WEIGHTS.items()), "priority string, weight int")
    per = orders.groupBy("weight").agg(F.count(F.lit(1)).alias("orders"), F.sum("weight").cast("bigint").alias("total"))
    return per.join(names, "weight").select("weight", "priority", "orders", "total")


@register("optional_score_table", """
SELECT 'customer' AS source, count(*) AS n_rows FROM customer UNION ALL SELECT 'absent', NULL""")
def optional_score_table(spark, sf_dir):
    """A score table that may be missing: its rows if it is there, else null."""
    out = None
    for name in ("customer", "absent"):
        found = TB.optional_source(spark, f"{sf_dir}/{name}.parquet")
        n = found.agg(F.count(F.lit(1)).alias("n_rows")) if found is not None else spark.range(1).select(F.lit(None).cast("bigint").alias("n_rows"))
        row = n.select(F.lit(name).alias("source"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


@register("feature_store", with_churn("""
SELECT churn, count(*) AS n_rows, round(sum(tenure), 4) AS sum_tenure, round(sum(monthly), 4) AS sum_monthly FROM churn_t GROUP BY churn"""))
def feature_store(spark, sf_dir):
    """Feature vectors written as Parquet to the shared folder, read back and summed."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from tabula.plans import churn as CH
    made = VectorAssembler(inputCols=["tenure", "monthly"], outputCol="features").transform(CH.churn_table(spark, sf_dir))
    path = SK.write_features(made.select("id", "features", "churn"), SK.scratch_dir(spark, "features"))
    v = vector_to_array("features")
    per = SK.read_features(spark, path).groupBy("churn").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(v[0]).alias("sum_tenure"), F.sum(v[1]).alias("sum_monthly"))
    return round_doubles(per, 4)


@register("numeric_columns", "SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal FROM customer")
def numeric_columns(spark, sf_dir):
    """Columns chosen by type after dropping some, one of which is absent."""
    c = TB.table(spark, sf_dir, "customer").drop("c_name", "no_such_column")
    return round_doubles(c.select(*FE.column_roles(c)["numeric"]), 6)


@register("metric_suite", f"""
SELECT a.*, b.roc_auc, c.log_loss, 1 AS positive
FROM ({SQL["classification_scores"]}) a, ({SQL["roc_auc"]}) b, ({SQL["log_loss"]}) c""")
def metric_suite(spark, sf_dir):
    """Every classification metric in one row, with the label taken as positive."""
    df = QM.scored_churn(spark, sf_dir)
    suite = ME.metric_suite(df, "churn", "pred", "p1")
    return round_doubles(suite.withColumn("positive", F.lit(int(ME.positive_label(df, "churn")))), 6)


@register("confusion_matrix_wide", QM._q("""
SELECT churn AS y, count(*) FILTER (pred = 0) AS "0", count(*) FILTER (pred = 1) AS "1" FROM s2 GROUP BY churn"""))
def confusion_matrix_wide(spark, sf_dir):
    return ME.confusion_matrix(QM.scored_churn(spark, sf_dir), "churn", "pred", [0, 1])
