"""Model registry: name -> task, search space and a builder of a ``pyspark.ml``
estimator from one parameter draw (E5).  Spaces keep the reference's parameter
names and bounds; builders translate them to Spark knobs.  Knobs without a
Spark counterpart are listed in ``APPROXIMATIONS`` (and in the README).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Callable

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor

from tabula.models.estimators import GaussianNB, GramLinear, ScaledC


class RefusedKnob(ValueError):
    """A parameter value, or a metric, that a model cannot serve."""


@dataclass(frozen=True)
class P:
    """One search dimension: ``int`` (step), ``float`` (log) or ``cat`` (choices);
    ``when`` makes it conditional on earlier draws."""
    name: str
    kind: str
    lo: float = 0.0
    hi: float = 0.0
    step: int = 1
    log: bool = False
    choices: tuple = ()
    when: Callable[[dict], bool] | None = None


@dataclass
class ModelSpec:
    name: str
    task: str
    space: list[P]
    build: Callable[[dict, int], object]
    notes: list[str] = field(default_factory=list)


def sample(space: list[P], rng: np.random.Generator) -> dict:
    out: dict = {}
    for p in space:
        if p.when is not None and not p.when(out):
            continue
        if p.kind == "int":
            k = int((p.hi - p.lo) // p.step)
            out[p.name] = int(p.lo + p.step * rng.integers(0, k + 1))
        elif p.kind == "float":
            if p.log:
                out[p.name] = float(math.exp(rng.uniform(math.log(p.lo), math.log(p.hi))))
            else:
                out[p.name] = float(rng.uniform(p.lo, p.hi))
        else:
            out[p.name] = p.choices[int(rng.integers(0, len(p.choices)))]
    return out


# fixed values: search spaces (names and bounds as in the reference templates)
TREE = [P("max_depth", "int", 3, 30), P("min_samples_split", "int", 2, 20), P("min_samples_leaf", "int", 1, 10)]
FEATS = [P("max_features", "cat", choices=("sqrt", "log2", None))]
CLS_CRIT = [P("criterion", "cat", choices=("gini", "entropy", "log_loss"))]
REG_CRIT = [P("criterion", "cat", choices=("squared_error", "absolute_error", "friedman_mse"))]
N_EST = [P("n_estimators", "int", 50, 500, step=50)]
BOOST = [P("learning_rate", "float", 1e-3, 0.3, log=True), P("max_depth", "int", 3, 15),
         P("min_samples_split", "int", 2, 20), P("min_samples_leaf", "int", 1, 10),
         P("subsample", "float", 0.5, 1.0)]
XGB = [*N_EST, P("learning_rate", "float", 1e-3, 0.3, log=True), P("max_depth", "int", 3, 15),
       P("min_child_weight", "int", 1, 10), P("subsample", "float", 0.5, 1.0),
       P("colsample_bytree", "float", 0.5, 1.0), P("reg_alpha", "float", 1e-8, 10.0, log=True),
       P("reg_lambda", "float", 1e-8, 10.0, log=True), P("gamma", "float", 1e-8, 5.0, log=True)]
LGBM = [*N_EST, P("learning_rate", "float", 1e-3, 0.3, log=True), P("max_depth", "int", 3, 15),
        P("num_leaves", "int", 15, 127), P("min_child_samples", "int", 5, 100),
        P("subsample", "float", 0.5, 1.0), P("colsample_bytree", "float", 0.5, 1.0),
        P("reg_alpha", "float", 1e-8, 10.0, log=True), P("reg_lambda", "float", 1e-8, 10.0, log=True)]
CATB = [P("iterations", "int", 100, 1000, step=100), P("learning_rate", "float", 1e-3, 0.3, log=True),
        P("depth", "int", 3, 10), P("l2_leaf_reg", "float", 1e-2, 10.0, log=True),
        P("bagging_temperature", "float", 0.0, 10.0), P("random_strength", "float", 1e-2, 10.0, log=True),
        P("border_count", "int", 32, 255)]
KNN = [P("n_neighbors", "int", 3, 50), P("weights", "cat", choices=("uniform", "distance")),
       P("metric", "cat", choices=("euclidean", "manhattan", "minkowski")), P("p", "int", 1, 5)]
SVM = [P("kernel", "cat", choices=("linear", "rbf", "poly")), P("C", "float", 1e-3, 100.0, log=True),
       P("max_iter", "int", 1000, 10000), P("tol", "float", 1e-4, 1e-2, log=True),
       P("gamma", "cat", choices=("scale", "auto"), when=lambda d: d["kernel"] in ("rbf", "poly")),
       P("degree", "int", 2, 5, when=lambda d: d["kernel"] == "poly")]
LOGISTIC = [P("C", "float", 1e-4, 10.0, log=True), P("penalty", "cat", choices=("l1", "l2", "elasticnet")),
            P("l1_ratio", "float", 0.0, 1.0), P("max_iter", "int", 100, 1000, step=100)]
ADA_C = [*N_EST, P("learning_rate", "float", 1e-3, 2.0, log=True),
         P("algorithm", "cat", choices=("SAMME", "SAMME.R"))]
ADA_R = [*N_EST, P("learning_rate", "float", 1e-3, 2.0, log=True),
         P("loss", "cat", choices=("linear", "square", "exponential"))]
ENET = [P("alpha", "float", 1e-4, 100.0, log=True), P("l1_ratio", "float", 0.0, 1.0),
        P("fit_intercept", "cat", choices=(True, False)), P("max_iter", "int", 500, 5000, step=500),
        P("tol", "float", 1e-5, 1e-2, log=True)]
LASSO = [P("alpha", "float", 1e-4, 100.0, log=True), P("fit_intercept", "cat", choices=(True, False)),
         P("max_iter", "int", 500, 5000, step=500), P("tol", "float", 1e-5, 1e-2, log=True)]
RIDGE = [P("alpha", "float", 1e-4, 100.0, log=True), P("fit_intercept", "cat", choices=(True, False)),
         P("solver", "cat", choices=("auto", "svd", "cholesky", "lsqr", "sag", "saga"))]

APPROXIMATIONS = {
    "min_samples_split": "decision trees (best splitter): no Spark knob; minInstancesPerNode = "
                         "max(min_samples_leaf, ceil(min_samples_split / 2)); exact elsewhere",
    "criterion=absolute_error": "refused for trees and forests (no sums give it)",
    "bins": "own trees (models/treegrow.py) cut features into 64 quantile bins, border_count for the catboost preset",
    "SAMME.R": "refused (discrete boosting only)",
    "ridge solver": "every solver's aim, the exact minimiser, is taken from the Gram matrix",
    "svm kernels": "rbf by random Fourier features (parameter rff_components, 100 unless given), poly by explicit polynomial expansion, then a linear fit",
}


def _leaf(p: dict) -> int:
    return max(int(p.get("min_samples_leaf", 1)), math.ceil(int(p.get("min_samples_split", 2)) / 2))


def _subset(p: dict) -> str:
    v = p.get("max_features")
    return "all" if v is None else v


def _cls_impurity(p: dict) -> str:
    return "gini" if p.get("criterion", "gini") == "gini" else "entropy"


def _reg_impurity(p: dict) -> str:
    if p.get("criterion") == "absolute_error":
        raise RefusedKnob("criterion=absolute_error has no Spark impurity")
    return "variance"


def _ensemble(task, trees=None, random_cuts=True, bootstrap=False):
    """Extra trees or, with a bootstrap and best cuts, a random forest; one tree with random cuts is a decision
    tree with the random splitter."""
    def b(p, n):
        from tabula.models.ensembles import TreeEnsemble
        criterion = _cls_impurity(p) if task == "classification" else _reg_impurity(p)
        return TreeEnsemble(task=task, nEstimators=trees or int(p["n_estimators"]), maxDepth=int(p["max_depth"]), criterion=criterion,
                            maxFeatures=_subset(p), minSamplesSplit=int(p.get("min_samples_split", 2)),
                            minSamplesLeaf=int(p.get("min_samples_leaf", 1)), randomCuts=random_cuts, bootstrap=bootstrap)
    return b


def _dt_c(p, n):
    if p.get("splitter") == "random":
        return _ensemble("classification", 1)(p, n)
    return RandomForestClassifier(numTrees=1, bootstrap=False, maxDepth=min(int(p["max_depth"]), 30),
                                  minInstancesPerNode=_leaf(p), impurity=_cls_impurity(p),
                                  featureSubsetStrategy=_subset(p), seed=42) if p.get("max_features") else \
        DecisionTreeClassifier(maxDepth=min(int(p["max_depth"]), 30), minInstancesPerNode=_leaf(p),
                               impurity=_cls_impurity(p), seed=42)


def _dt_r(p, n):
    if p.get("splitter") == "random":
        return _ensemble("regression", 1)(p, n)
    return RandomForestRegressor(numTrees=1, bootstrap=False, maxDepth=min(int(p["max_depth"]), 30),
                                 minInstancesPerNode=_leaf(p), impurity=_reg_impurity(p),
                                 featureSubsetStrategy=_subset(p), seed=42) if p.get("max_features") else \
        DecisionTreeRegressor(maxDepth=min(int(p["max_depth"]), 30), minInstancesPerNode=_leaf(p),
                              impurity=_reg_impurity(p), seed=42)


def _gbt(regression=False):
    def b(p, n):
        from tabula.models.ensembles import GradientBoosting
        return GradientBoosting(loss=p.get("loss", "squared_error") if regression else "log_loss", nEstimators=int(p["n_estimators"]),
                                learningRate=float(p["learning_rate"]), maxDepth=int(p["max_depth"]), subsample=float(p.get("subsample", 1.0)),
                                minSamplesSplit=int(p.get("min_samples_split", 2)), minSamplesLeaf=int(p.get("min_samples_leaf", 1)))
    return b


def _logistic(p, n):
    en = {"l1": 1.0, "l2": 0.0}.get(p["penalty"], float(p.get("l1_ratio", 0.5)))
    return ScaledC(C=float(p["C"]), model="logistic", elasticNet=en, maxIter=int(p["max_iter"]))


def _svm_c(p, n):
    from tabula.models.kernels import RandomFourierFeatures
    svc = ScaledC(C=float(p["C"]), model="svm", maxIter=int(p["max_iter"]), tol=float(p["tol"]),
                  featuresCol="__kfeat")
    if p["kernel"] == "linear":
        svc = ScaledC(C=float(p["C"]), model="svm", maxIter=int(p["max_iter"]), tol=float(p["tol"]))
        return svc
    if p["kernel"] == "rbf":
        mapper = RandomFourierFeatures(inputCol="features", outputCol="__kfeat", gamma=str(p["gamma"]),
                                       components=int(p.get("rff_components", 100)))
    else:
        mapper = PolynomialExpansion(inputCol="features", outputCol="__kfeat", degree=int(p["degree"]))
    return Pipeline(stages=[mapper, svc])


def _ada_c(p, n):
    if p.get("algorithm") == "SAMME.R":
        raise RefusedKnob("algorithm=SAMME.R: boosting here is discrete (SAMME)")
    from tabula.models.boosting import AdaBoostClassifier
    return AdaBoostClassifier(nEstimators=int(p["n_estimators"]), learningRate=float(p["learning_rate"]))


def _hist(growth, regression=False):
    def b(p, n):
        from tabula.models.histboost import HistBoost
        return HistBoost(
            objective="squared" if regression else "binary",
            nEstimators=int(p.get("n_estimators", p.get("iterations", 100))),
            learningRate=float(p["learning_rate"]),
            maxDepth=int(p.get("max_depth", p.get("depth", 6))),
            minChildWeight=float(p.get("min_child_weight", 0.0 if "min_child_samples" in p else 1.0)),
            minChildSamples=int(p.get("min_child_samples", 1)),
            regLambda=float(p.get("reg_lambda", p.get("l2_leaf_reg", 1.0))),
            regAlpha=float(p.get("reg_alpha", 0.0)),
            gamma=float(p.get("gamma", 0.0)),
            subsample=float(p.get("subsample", 1.0)),
            colsample=float(p.get("colsample_bytree", 1.0)),
            maxBins=int(p["border_count"]) + 1 if "border_count" in p else 64,
            baggingTemperature=float(p.get("bagging_temperature", 0.0)), randomStrength=float(p.get("random_strength", 0.0)),
            growth=growth, numLeaves=int(p.get("num_leaves", 31)), seed=42)
    return b


def _ada_r(p, n):
    from tabula.models.boosting import AdaBoostRegressor
    return AdaBoostRegressor(nEstimators=int(p["n_estimators"]), learningRate=float(p["learning_rate"]),
                             loss=str(p["loss"]))


def _svr(p, n):
    from tabula.models.kernels import RandomFourierFeatures
    from tabula.models.svr import EpsilonSVR
    kw = dict(C=float(p["C"]), epsilon=float(p["epsilon"]), maxIter=int(p["max_iter"]), tol=float(p["tol"]))
    if p["kernel"] == "linear":
        return EpsilonSVR(**kw)
    if p["kernel"] == "rbf":
        mapper = RandomFourierFeatures(inputCol="features", outputCol="__kfeat", gamma=str(p["gamma"]),
                                       components=int(p.get("rff_components", 100)))
    else:
        mapper = PolynomialExpansion(inputCol="features", outputCol="__kfeat", degree=int(p["degree"]))
    return Pipeline(stages=[mapper, EpsilonSVR(featuresCol="__kfeat", **kw)])


def _knn(task):
    def b(p, n):
        from tabula.models.knn import KNNEstimator
        return KNNEstimator(k=int(p["n_neighbors"]), weights=p["weights"], metric=p["metric"],
                            p=int(p.get("p", 2)), task=task)
    return b


MODELS: dict[str, ModelSpec] = {}


def _add(name, task, space, build, notes=()):
    MODELS[name] = ModelSpec(name, task, list(space), build, list(notes))


# classification
_add("logistic_regression", "classification", LOGISTIC, _logistic)
_add("naive_bayes", "classification", [P("var_smoothing", "float", 1e-12, 1e-2, log=True)],
     lambda p, n: GaussianNB(varSmoothing=float(p["var_smoothing"])))
_add("decision_tree_classifier", "classification",
     TREE + CLS_CRIT + FEATS + [P("splitter", "cat", choices=("best", "random"))], _dt_c,
     ["min_samples_split"])
_add("random_forest_classifier", "classification", N_EST + TREE + FEATS + CLS_CRIT,
     _ensemble("classification", random_cuts=False, bootstrap=True), ["bins"])
_add("extra_trees_classifier", "classification", N_EST + TREE + FEATS + CLS_CRIT,
     _ensemble("classification"), ["bins"])
_add("adaboost_classifier", "classification", ADA_C, _ada_c, ["SAMME.R"])
_add("knn_classifier", "classification", KNN, _knn("classification"))
_add("svc", "classification", SVM, _svm_c)
_add("gradient_boosting_classifier", "classification", N_EST + BOOST, _gbt(), ["bins"])
_add("xgboost_classifier", "classification", XGB, _hist("depthwise"), ["bins"])
_add("lightgbm_classifier", "classification", LGBM, _hist("lossguide"), ["bins"])
_add("catboost_classifier", "classification", CATB, _hist("symmetric"), ["bins"])
# regression
_add("linear_regression", "regression", [P("fit_intercept", "cat", choices=(True, False))],
     lambda p, n: LinearRegression(fitIntercept=bool(p["fit_intercept"]), regParam=0.0, solver="normal"))
_add("ridge", "regression", RIDGE,
     lambda p, n: GramLinear(kind="ridge", alpha=float(p["alpha"]), fitIntercept=bool(p["fit_intercept"])),
     ["ridge solver"])
_add("lasso", "regression", LASSO,
     lambda p, n: GramLinear(kind="elasticnet", l1Ratio=1.0, alpha=float(p["alpha"]),
                             fitIntercept=bool(p["fit_intercept"]), maxIter=int(p["max_iter"]),
                             tol=float(p["tol"])))
_add("elastic_net", "regression", ENET,
     lambda p, n: GramLinear(kind="elasticnet", l1Ratio=float(p["l1_ratio"]), alpha=float(p["alpha"]),
                             fitIntercept=bool(p["fit_intercept"]), maxIter=int(p["max_iter"]),
                             tol=float(p["tol"])))
_add("decision_tree_regressor", "regression",
     TREE + REG_CRIT + FEATS + [P("splitter", "cat", choices=("best", "random"))], _dt_r,
     ["min_samples_split", "criterion=absolute_error"])
_add("random_forest_regressor", "regression", N_EST + TREE + FEATS + REG_CRIT,
     _ensemble("regression", random_cuts=False, bootstrap=True), ["bins", "criterion=absolute_error"])
_add("extra_trees_regressor", "regression", N_EST + TREE + FEATS + REG_CRIT,
     _ensemble("regression"), ["bins", "criterion=absolute_error"])
_add("knn_regressor", "regression", KNN, _knn("regression"))
_add("adaboost_regressor", "regression", ADA_R, _ada_r)
_add("svr", "regression", [*SVM[:2], P("epsilon", "float", 1e-3, 1.0, log=True), *SVM[2:]], _svr, ["svm kernels"])
_add("gradient_boosting_regressor", "regression",
     N_EST + BOOST + [P("loss", "cat", choices=("squared_error", "absolute_error", "huber"))],
     _gbt(regression=True), ["bins"])
_add("xgboost_regressor", "regression", XGB, _hist("depthwise", True), ["bins"])
_add("lightgbm_regressor", "regression", LGBM, _hist("lossguide", True), ["bins"])
_add("catboost_regressor", "regression", CATB, _hist("symmetric", True), ["bins"])

