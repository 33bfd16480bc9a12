"""Queries: formula design matrices and GLM inference on the churn-style table
(F1-F6, G2-G7, H5)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabula.functions.expressions import round_doubles
from tabula.operators import design as DS
from tabula.operators import glm as G
from tabula.operators import metrics as ME
from tabula.operators import split as SP
from tabula.plans import churn as CH
from tabula.plans.oracle_sql import chi2_tail, with_churn
from tabula.plans.registry import register
from tabula.sources.tables import table

# fixed values: the model formulas of the churn analysis
BASELINE = ("churn ~ C(segment) + senior + C(region) + tenure + C(phone) + C(multi) + C(security)"
            " + C(backup) + monthly + total_charges")
ENHANCED = ("churn ~ C(segment) + senior + C(region) + num_services + num_addons + log_tenure"
            " + avg_charge_per_month + charge_per_service + auto_pay + log_tenure:avg_charge_per_month"
            " + senior:C(region)")
COMBINED = BASELINE + " + log_tenure + auto_pay + senior:C(region)"
NULL_MODEL = "churn ~ 1"
DESIGN_FORMULA = "churn ~ C(segment) + tenure + tenure:monthly + I(tenure ** 2) + auto_pay:C(region)"


def _fit(spark, sf_dir, formula):
    t = CH.churn_table(spark, sf_dir)
    d, names, resp, _ = DS.design_frame(t, formula, keep=["id"])
    return d, G.fit_glm(d, names, resp)


_SEGS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _design_sql():
    parts = [f"SELECT id, 'C(segment)[T.{s}]' AS term, CASE WHEN segment = '{s}' THEN 1.0 ELSE 0.0 END AS value "
             "FROM churn_t" for s in _SEGS]
    parts.append("SELECT id, 'tenure', CAST(tenure AS DOUBLE) FROM churn_t")
    parts.append("SELECT id, 'tenure:monthly', CAST(tenure AS DOUBLE) * monthly FROM churn_t")
    parts.append("SELECT id, 'I(tenure ** 2)', pow(CAST(tenure AS DOUBLE), 2) FROM churn_t")
    parts += [f"SELECT id, 'auto_pay:C(region)[{r}]', CAST(auto_pay AS DOUBLE) * "
              f"CASE WHEN region = '{r}' THEN 1.0 ELSE 0.0 END FROM churn_t" for r in _REGIONS]
    return with_churn("d AS (" + "\nUNION ALL\n".join(parts) + ")\n"
                      "SELECT id, term, round(value, 6) AS value FROM d WHERE value <> 0")


@register("formula_design", _design_sql())
def formula_design(spark, sf_dir):
    """Treatment-coded design with numeric x numeric, numeric x categorical (full
    coding: its numeric main effect is absent) and transformed terms; long form
    of the non-zero entries."""
    t = CH.churn_table(spark, sf_dir)
    d, names, _, _ = DS.design_frame(t, DESIGN_FORMULA, keep=["id"])
    parts = ", ".join(f"'{n}', `{n}`" for n in names)
    long = d.select("id", F.expr(f"stack({len(names)}, {parts}) as (term, value)"))
    return round_doubles(long.where(F.col("value") != 0), 6)


def _fold_aucs(spark, sf_dir, formula):
    """Held-out AUC of each of 5 shuffled stratified folds (seed 99)."""
    d, names, resp, _ = DS.design_frame(CH.churn_table(spark, sf_dir), formula, keep=["id"])
    d = SP.kfold(d, "id", 5, label=resp, seed=99).cache()
    out = []
    for k in range(5):
        fit = G.fit_glm(d.where(F.col("fold") != k), names, resp)
        out.append(float(ME.roc_auc(d.where(F.col("fold") == k).withColumn("p1", fit.predict()), resp, "p1").first()[0]))
    d.unpersist()
    return out


@register("logit_coefficients")
def logit_coefficients(spark, sf_dir):
    """Enhanced logit: coefficients, normal-theory errors, z, p, 95% interval."""
    _, fit = _fit(spark, sf_dir, ENHANCED)
    return fit.table(spark)


@register("logit_odds_ratios")
def logit_odds_ratios(spark, sf_dir):
    _, fit = _fit(spark, sf_dir, ENHANCED)
    return fit.odds_ratios(spark).orderBy(F.desc("odds_ratio"))


@register("logit_marginal_effects")
def logit_marginal_effects(spark, sf_dir):
    d, fit = _fit(spark, sf_dir, ENHANCED)
    return G.marginal_effects(d, fit, spark)


@register("model_comparison")
def model_comparison(spark, sf_dir):
    """Baseline, enhanced and combined logit: pseudo R2, AIC, BIC, llf, parameters,
    in-sample AUC, mean and deviation of the five held-out AUCs, and the enhanced - baseline delta row."""
    out = None
    for name, formula in (("baseline", BASELINE), ("enhanced", ENHANCED), ("combined", COMBINED)):
        d, fit = _fit(spark, sf_dir, formula)
        auc = ME.roc_auc(d.withColumn("p1", fit.predict()), "churn", "p1").first()["roc_auc"]
        folds = _fold_aucs(spark, sf_dir, formula)
        row = fit.summary(spark, name).select("model", "pseudo_r2", "aic", "bic", "llf", "num_params") \
            .withColumns({"roc_auc": F.lit(float(auc)), "cv_mean": F.lit(float(np.mean(folds))), "cv_std": F.lit(float(np.std(folds)))})
        out = row if out is None else out.unionByName(row)
    wide = out.agg(*[F.max(F.when(F.col("model") == "enhanced", F.col(c))).alias(f"e_{c}") for c in
                     ("pseudo_r2", "aic", "bic", "llf", "num_params", "roc_auc", "cv_mean", "cv_std")],
                   *[F.max(F.when(F.col("model") == "baseline", F.col(c))).alias(f"b_{c}") for c in
                     ("pseudo_r2", "aic", "bic", "llf", "num_params", "roc_auc", "cv_mean", "cv_std")])
    delta = wide.select(F.lit("delta").alias("model"),
                        *[(F.col(f"e_{c}") - F.col(f"b_{c}")).cast(t).alias(c) for c, t in
                          (("pseudo_r2", "double"), ("aic", "double"), ("bic", "double"), ("llf", "double"),
                           ("num_params", "int"), ("roc_auc", "double"), ("cv_mean", "double"), ("cv_std", "double"))])
    return out.unionByName(delta)


@register("likelihood_ratio_tests")
def likelihood_ratio_tests(spark, sf_dir):
    """Enhanced v baseline (non-nested: |df| and p = 1 when LR <= 0) and
    enhanced v the intercept-only model."""
    _, base = _fit(spark, sf_dir, BASELINE)
    _, enh = _fit(spark, sf_dir, ENHANCED)
    _, null = _fit(spark, sf_dir, NULL_MODEL)
    rows = []
    for name, r, f in (("enhanced_vs_baseline", base, enh), ("enhanced_vs_null", null, enh)):
        lr, dof, p = G.likelihood_ratio(r, f)
        rows.append((name, float(lr), float(dof), float(p)))
    return spark.createDataFrame(rows, "test string, lr_stat double, df double, p_value double")


@register("poisson_orders")
def poisson_orders(spark, sf_dir):
    """Poisson GLM (log link): orders per customer on account balance and segment."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    df = c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left") \
        .select((F.col("c_acctbal") / 1000).alias("acctbal_k"), "c_mktsegment",
                F.coalesce("n_orders", F.lit(0)).alias("n_orders"))
    d, names, resp, _ = DS.design_frame(df, "n_orders ~ acctbal_k + C(c_mktsegment)")
    fit = G.fit_glm(d, names, resp, family="poisson")
    return fit.table(spark)


_ONE_FACTOR = with_churn(f"""
g AS (SELECT segment, CAST(count(*) AS DOUBLE) AS n, avg(CAST(churn AS DOUBLE)) AS p FROM churn_t GROUP BY segment),
r AS (SELECT n AS n0, p AS p0 FROM g WHERE segment = (SELECT min(segment) FROM g)),
a AS (SELECT sum(n) AS n_all, sum(n * p) / sum(n) AS pm, sum(n * (p * ln(p) + (1 - p) * ln(1 - p))) AS llf,
             sum(n * p * (1 - p)) / sum(n) AS slope FROM g),
c AS (SELECT 'Intercept' AS term, ln(p0 / (1 - p0)) AS coef, sqrt(1 / (n0 * p0 * (1 - p0))) AS se FROM r
  UNION ALL SELECT 'C(segment)[T.' || segment || ']', ln(p / (1 - p)) - ln(p0 / (1 - p0)),
                   sqrt(1 / (n0 * p0 * (1 - p0)) + 1 / (n * p * (1 - p))) FROM g, r WHERE segment > (SELECT min(segment) FROM g))
SELECT term, round(coef, 5) AS coef, round(se, 5) AS std_err, round(coef / se, 4) AS z,
       round({chi2_tail("(coef / se) * (coef / se)", "1")}, 6) AS p_value, round(exp(coef), 5) AS odds_ratio,
       round(coef * slope, 6) AS marginal_effect, round(llf, 4) AS llf,
       round(2 * (llf - n_all * (pm * ln(pm) + (1 - pm) * ln(1 - pm))), 4) AS lr_stat FROM c, a""")


@register("logit_one_factor", _ONE_FACTOR)
def logit_one_factor(spark, sf_dir):
    """Logit of churn on the segment alone: saturated, so the iterative fit must give
    the log odds, their errors, the likelihood and the LR statistic in closed form."""
    d, fit = _fit(spark, sf_dir, "churn ~ C(segment)")
    lr, _, _ = G.likelihood_ratio(_fit(spark, sf_dir, NULL_MODEL)[1], fit)
    slope = d.select(fit.predict().alias("p")).agg(F.avg(F.col("p") * (1 - F.col("p")))).first()[0]
    t = fit.table(spark)
    return t.select("term", F.round("coef", 5).alias("coef"), F.round("std_err", 5).alias("std_err"), F.round("z", 4).alias("z"),
                    F.round("p_value", 6).alias("p_value"), F.round(F.exp("coef"), 5).alias("odds_ratio"),
                    F.round(F.col("coef") * F.lit(float(slope)), 6).alias("marginal_effect"),
                    F.round(F.lit(float(fit.llf)), 4).alias("llf"), F.round(F.lit(float(lr)), 4).alias("lr_stat"))


@register("poisson_one_factor", """
WITH o AS (SELECT o_custkey, count(*) AS k FROM orders GROUP BY o_custkey),
g AS (SELECT c_mktsegment AS s, CAST(count(*) AS DOUBLE) AS n, CAST(sum(coalesce(k, 0)) AS DOUBLE) AS y
      FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY c_mktsegment),
r AS (SELECT n AS n0, y AS y0 FROM g WHERE s = (SELECT min(s) FROM g)),
c AS (SELECT 'Intercept' AS term, ln(y0 / n0) AS coef, sqrt(1 / y0) AS se FROM r
  UNION ALL SELECT 'C(c_mktsegment)[T.' || s || ']', ln(y / n) - ln(y0 / n0), sqrt(1 / y0 + 1 / y) FROM g, r WHERE s > (SELECT min(s) FROM g))
SELECT term, round(coef, 5) AS coef, round(se, 5) AS std_err, round(coef / se, 4) AS z FROM c""")
def poisson_one_factor(spark, sf_dir):
    """Poisson regression of the number of orders on the segment alone (saturated)."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"))
    df = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left") \
        .select("c_mktsegment", F.coalesce("k", F.lit(0)).alias("n_orders"))
    d, names, resp, _ = DS.design_frame(df, "n_orders ~ C(c_mktsegment)")
    t = G.fit_glm(d, names, resp, family="poisson").table(spark)
    return t.select("term", F.round("coef", 5).alias("coef"), F.round("std_err", 5).alias("std_err"), F.round("z", 4).alias("z"))


@register("logit_fold_auc")
def logit_fold_auc(spark, sf_dir):
    """Refit the enhanced logit on each of 5 shuffled stratified folds (seed 99)
    and score the held-out fold: per-fold exact AUC, mean and population std."""
    per = spark.createDataFrame(list(enumerate(_fold_aucs(spark, sf_dir, ENHANCED))), "fold int, roc_auc double")
    return per.agg(F.avg("roc_auc").alias("cv_mean"), F.stddev_pop("roc_auc").alias("cv_std"),
                   F.count(F.lit(1)).alias("n_folds"))


# ---------------------------------------------------------------- feature-group search

# fixed values: the named feature groups of the search
SEARCH_GROUPS = {
    "segment": ["C(segment)"],
    "region": ["C(region)"],
    "security": ["C(security)"],
    "senior": ["senior"],
    "auto_pay": ["auto_pay"],
    "log_tenure": ["log_tenure"],
    "avg_charge_per_month": ["avg_charge_per_month"],
    "charge_per_service": ["charge_per_service"],
    "num_addons": ["num_addons"],
    "log_tenure_x_avg_charge_per_month": ["log_tenure:avg_charge_per_month"],
    "senior_x_region": ["senior:C(region)"],
}
ALWAYS_ON = ["segment", "region", "security"]
SEARCH_FORMULA = "churn ~ " + " + ".join(t for terms in SEARCH_GROUPS.values() for t in terms)
GROUP_TRIALS = 80  # as group_search itself


def _group_trials(spark, sf_dir):
    from tabula.models.groups import group_search, named_groups
    t = CH.churn_table(spark, sf_dir)
    d, names, resp, _ = DS.design_frame(t, SEARCH_FORMULA, keep=["id"])
    d = SP.kfold(d, "id", 5, label=resp, seed=42)
    groups = named_groups(SEARCH_FORMULA, names, SEARCH_GROUPS)
    return group_search(spark, d, resp, groups, ALWAYS_ON, n_trials=GROUP_TRIALS, seed=42)


@register("feature_group_search")
def feature_group_search(spark, sf_dir):
    """Trials of the group search ordered best first (the top-10 report is a
    limit on this table), with the best-so-far curve."""
    from pyspark.sql import Window
    trials = _group_trials(spark, sf_dir)
    w = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, 0)  # one row per trial: small
    return trials.withColumn("best_so_far", F.max("value").over(w)).orderBy(F.desc("value"), "trial")


@register("feature_group_importance")
def feature_group_importance(spark, sf_dir):
    """Mean CV-AUC with each optional group on minus off (both sides non-empty)."""
    from tabula.operators.profile import on_off_difference
    trials = _group_trials(spark, sf_dir)
    flags = [c for c in trials.columns if c.startswith("use_")]
    return on_off_difference(trials.withColumns({f: F.col(f).cast("int") for f in flags}), flags, "value")
