"""Queries: evaluation metrics on a fixed scoring rule (V1-V18, A11, A12).

The churn-style table is scored with a fixed logistic expression so every
metric has an exact SQL counterpart; regression metrics score line items with
a fixed linear rule.  Fitted models reuse the same operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions.expressions import round_doubles
from tabula.operators import metrics as ME
from tabula.operators import split as SP
from tabula.plans import churn as CH
from tabula.plans.oracle_sql import with_churn
from tabula.plans.registry import register
from tabula.sources.tables import table

# fixed values: coefficients of the fixed scoring rules
_Z = "2.0 - 0.05 * tenure + 0.3 * num_services - 0.5 * auto_pay + 0.002 * monthly"
_REG_PRED = "l_quantity * 1500.0 + 2000.0 * l_tax"


def scored_churn(spark, sf_dir):
    df = CH.churn_table(spark, sf_dir)
    p1 = F.round(1.0 / (1.0 + F.exp(-F.expr(_Z))), 6)
    return df.withColumn("p1", p1).withColumn("pred", (F.col("p1") >= 0.5).cast("int"))


def scored_lines(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("pred", F.expr(_REG_PRED))


_SCORED = with_churn(f"""
scored AS (SELECT *, round(1.0 / (1.0 + exp(-({_Z}))), 6) AS p1 FROM churn_t),
s2 AS (SELECT *, CAST(p1 >= 0.5 AS INTEGER) AS pred FROM scored)""")


def _q(body: str) -> str:
    return _SCORED + "\n" + body.strip()


_PER_CLASS = """
cm AS (SELECT churn AS y, pred, count(*) AS c FROM s2 GROUP BY churn, pred),
lab AS (SELECT y AS label FROM cm UNION SELECT pred FROM cm),
pcl AS (
  SELECT label,
         coalesce((SELECT sum(c) FROM cm WHERE cm.y = lab.label AND cm.pred = lab.label), 0) AS tp,
         coalesce((SELECT sum(c) FROM cm WHERE cm.pred = lab.label), 0) AS n_pred,
         coalesce((SELECT sum(c) FROM cm WHERE cm.y = lab.label), 0) AS support
  FROM lab),
pm AS (
  SELECT label, tp, n_pred, support,
         CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS prec,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec
  FROM pcl),
pf AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM pm)
"""


@register("classification_scores", _q(", " + _PER_CLASS.strip() + """
SELECT round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(prec * support) / sum(support), 6) AS precision,
       round(sum(rec * support) / sum(support), 6) AS recall,
       round(sum(f1 * support) / sum(support), 6) AS f1
FROM pf"""))
def classification_scores(spark, sf_dir):
    df = scored_churn(spark, sf_dir)
    return round_doubles(ME.weighted_scores(df, "churn", "pred"), 6)


@register("classification_report", _q(", " + _PER_CLASS.strip() + """
SELECT CAST(label AS VARCHAR) AS label, round(prec, 6) AS precision, round(rec, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pf WHERE support > 0
UNION ALL
SELECT 'macro avg', round(avg(prec), 6), round(avg(rec), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT)
FROM pf WHERE support > 0
UNION ALL
SELECT 'weighted avg', round(sum(prec * support) / sum(support), 6), round(sum(rec * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pf WHERE support > 0
UNION ALL
SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
       round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pf WHERE support > 0"""))
def classification_report(spark, sf_dir):
    df = scored_churn(spark, sf_dir)
    return round_doubles(ME.classification_report(df, "churn", "pred"), 6)


@register("confusion_matrix", _q("SELECT churn AS y, pred, CAST(count(*) AS BIGINT) AS count FROM s2 GROUP BY churn, pred"))
def confusion_matrix(spark, sf_dir):
    return ME.confusion(scored_churn(spark, sf_dir), "churn", "pred")


_AUC_BODY = """,
sc AS (SELECT {keys}p1 AS score, sum(churn) AS pos, sum(1 - churn) AS neg FROM {src} GROUP BY {keys}p1),
cu AS (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
       AS nb FROM sc)"""


@register("roc_auc", _q(_AUC_BODY.format(keys="", src="s2", part="") + """
SELECT round(sum(pos * (nb + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS roc_auc FROM cu"""))
def roc_auc(spark, sf_dir):
    return round_doubles(ME.roc_auc(scored_churn(spark, sf_dir), "churn", "p1"), 6)


@register("log_loss", _q("""
SELECT round(avg(-CASE WHEN churn = 1 THEN ln(least(greatest(p1, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
                       ELSE ln(1 - least(greatest(p1, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) END), 6)
       AS log_loss FROM s2"""))
def log_loss(spark, sf_dir):
    return round_doubles(ME.log_loss(scored_churn(spark, sf_dir), "churn", "p1"), 6)


_CURVE = """,
sc AS (SELECT p1 AS score, sum(churn) AS pos, sum(1 - churn) AS neg FROM s2 GROUP BY p1),
cu AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
              sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
              sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all FROM sc)"""


@register("roc_curve", _q(_CURVE + """
SELECT round(score, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(tp / p_all, 6) AS tpr, round(fp / n_all, 6) AS fpr FROM cu"""))
def roc_curve(spark, sf_dir):
    return round_doubles(ME.roc_points(scored_churn(spark, sf_dir), "churn", "p1"), 6)


@register("pr_curve", _q(_CURVE + """
SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p_all, 6) AS recall
FROM cu"""))
def pr_curve(spark, sf_dir):
    return round_doubles(ME.pr_points(scored_churn(spark, sf_dir), "churn", "p1"), 6)


_FOLD_SCORED = _SCORED + """,
fs AS (SELECT *, CAST(ntile(5) OVER (PARTITION BY churn ORDER BY md5(concat(CAST(id AS VARCHAR), ':99')), id) - 1
       AS INTEGER) AS fold FROM s2)"""


@register("fold_auc_summary", _FOLD_SCORED + _AUC_BODY.format(keys="fold, ", src="fs", part="PARTITION BY fold ") + """,
fa AS (SELECT fold, sum(pos * (nb + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc FROM cu GROUP BY fold)
SELECT CAST(count(*) AS BIGINT) AS n_folds, round(avg(auc), 6) AS cv_mean, round(stddev_pop(auc), 6) AS cv_std FROM fa""")
def fold_auc_summary(spark, sf_dir):
    """Per-fold exact AUC over shuffled stratified folds, then mean and population std."""
    df = SP.kfold(scored_churn(spark, sf_dir), "id", 5, label="churn", seed=99)
    per = ME.roc_auc(df, "churn", "p1", keys=["fold"])
    return round_doubles(per.agg(F.count(F.lit(1)).alias("n_folds"), F.avg("roc_auc").alias("cv_mean"),
                                 F.stddev_pop("roc_auc").alias("cv_std")), 6)


@register("regression_scores", f"""
WITH s AS (SELECT l_extendedprice AS y, {_REG_PRED} AS p FROM lineitem)
SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
       round(sum((y - p) * (y - p)) / count(*), 6) AS mse, round(avg(abs(y - p)), 6) AS mae,
       round(least(min(y), min(p)), 6) AS lower, round(greatest(max(y), max(p)), 6) AS upper FROM s""")
def regression_scores(spark, sf_dir):
    return round_doubles(ME.regression_scores(scored_lines(spark, sf_dir), "l_extendedprice", "pred"), 6)


@register("residual_table", f"""
SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) AS actual, round({_REG_PRED}, 6) AS predicted,
       round(l_extendedprice - ({_REG_PRED}), 6) AS residual FROM lineitem""")
def residual_table(spark, sf_dir):
    df = scored_lines(spark, sf_dir)
    return round_doubles(ME.residuals(df, "l_extendedprice", "pred", keep=["l_orderkey", "l_linenumber"]), 6)


@register("predicted_vs_actual", f"""
SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) AS actual, round({_REG_PRED}, 6) AS predicted,
       round(least(min(l_extendedprice) OVER (), min({_REG_PRED}) OVER ()), 6) AS lower,
       round(greatest(max(l_extendedprice) OVER (), max({_REG_PRED}) OVER ()), 6) AS upper
FROM lineitem""")
def predicted_vs_actual(spark, sf_dir):
    """Plot data for predicted v actual: every line item, with the common axis
    limits of the whole table (A12)."""
    li = scored_lines(spark, sf_dir)
    lim = ME.regression_scores(li, "l_extendedprice", "pred").select("lower", "upper").first()
    out = li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("actual"),
                        F.col("pred").alias("predicted"), F.lit(lim["lower"]).alias("lower"),
                        F.lit(lim["upper"]).alias("upper"))
    return round_doubles(out, 6)
