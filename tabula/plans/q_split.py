"""Queries: hash split, stratified / shuffled / contiguous folds (D1-D4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.operators import split as SP
from tabula.plans import churn as CH
from tabula.plans.oracle_sql import with_churn
from tabula.plans.registry import register
from tabula.sources.tables import table

_BUCKET = "CAST(('0x' || substr(md5(concat(CAST(id AS VARCHAR), ':42')), 1, 8)) AS BIGINT) % 100"


@register("holdout_split", with_churn(
    f"SELECT id, churn, CAST({_BUCKET} < 20 AS INTEGER) AS is_test FROM churn_t"))
def holdout_split(spark, sf_dir):
    df = CH.churn_table(spark, sf_dir).select("id", "churn")
    return SP.with_split_flag(df, "id", 0.2, 42)


@register("split_sizes", with_churn(f"""
SELECT CAST({_BUCKET} < 20 AS INTEGER) AS is_test, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(churn) AS BIGINT) AS positives
FROM churn_t GROUP BY 1"""))
def split_sizes(spark, sf_dir):
    df = SP.with_split_flag(CH.churn_table(spark, sf_dir), "id", 0.2, 42)
    return df.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(F.col("churn").cast("bigint")).alias("positives"))


@register("stratified_folds", with_churn(
    "SELECT id, churn, CAST(ntile(5) OVER (PARTITION BY churn ORDER BY id) - 1 AS INTEGER) AS fold FROM churn_t"))
def stratified_folds(spark, sf_dir):
    df = CH.churn_table(spark, sf_dir).select("id", "churn")
    return SP.kfold(df, "id", 5, label="churn")


@register("shuffled_folds", with_churn(
    "SELECT id, churn, CAST(ntile(5) OVER (PARTITION BY churn ORDER BY md5(concat(CAST(id AS VARCHAR), ':42')), id)"
    " - 1 AS INTEGER) AS fold FROM churn_t"))
def shuffled_folds(spark, sf_dir):
    df = CH.churn_table(spark, sf_dir).select("id", "churn")
    return SP.kfold(df, "id", 5, label="churn", seed=42)


@register("fold_summary", with_churn("""
f AS (SELECT churn, CAST(ntile(5) OVER (PARTITION BY churn ORDER BY md5(concat(CAST(id AS VARCHAR), ':99')), id)
      - 1 AS INTEGER) AS fold FROM churn_t),
t AS (SELECT count(*) AS n, sum(churn) AS p FROM f)
SELECT fold, CAST(count(*) AS BIGINT) AS n_valid, CAST(sum(churn) AS BIGINT) AS pos_valid,
       CAST(max(t.n) - count(*) AS BIGINT) AS n_train, CAST(max(t.p) - sum(churn) AS BIGINT) AS pos_train
FROM f, t GROUP BY fold"""))
def fold_summary(spark, sf_dir):
    df = SP.kfold(CH.churn_table(spark, sf_dir).select("id", "churn"), "id", 5, label="churn", seed=99)
    return SP.fold_summary(df, "fold", "churn")


@register("contiguous_folds", """
SELECT l_orderkey, l_linenumber,
       CAST(ntile(5) OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS INTEGER) AS fold FROM lineitem""")
def contiguous_folds(spark, sf_dir):
    """Unstratified contiguous folds over the whole line-item table (regression CV):
    a global order computed with range partitions, not a single-task window."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    li = li.withColumn("__k", F.struct("l_orderkey", "l_linenumber"))
    return SP.kfold(li, "__k", 5).drop("__k")
