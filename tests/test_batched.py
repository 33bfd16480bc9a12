"""Searches by batched fits: against single fits, optimality conditions and plain metrics."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabula.models import batched_logistic as BL
from tabula.models import groups as G
from tabula.models import search as SE
from tabula.models.estimators import PenalizedLogistic, ScaledC
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 6))
    x[:, 5] = 0.9 * x[:, 4] + 0.1 * x[:, 5]  # nearly collinear
    y = (rng.random(300) < 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1])))).astype(float)
    return x, y, np.arange(300) % 5


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y, fold = data
    made = [(BL.SHARED, int(f), float(v), r.tolist()) for r, v, f in zip(x, y, fold, strict=True)]
    return spark.createDataFrame(made, "view int, fold int, y double, x array<double>").repartition(6).cache()


GRID = [BL.Candidate(f, c, share, 200) for f in range(5) for c in (0.01, 1.0, 50.0) for share in (0.0, 0.4, 1.0)]


def test_every_candidate_is_optimal(rows, data, monkeypatch):
    monkeypatch.setattr(BL, "MERGE", 2)
    monkeypatch.setattr(BL, "STATE_BYTES", 20 * 8 * (1 + 7 + 28))  # 20 candidates at a time
    x, y, fold = data
    betas = BL.fit_candidates(rows, GRID, tol=1e-14)
    assert betas.shape == (45, 7)
    for c, beta in zip(GRID, betas, strict=True):
        train = fold != c.fold
        design = np.hstack([np.ones((train.sum(), 1)), x[train]])
        grad = design.T @ (1 / (1 + np.exp(-design @ beta)) - y[train])
        l1, l2 = c.l1_share / c.C, (1 - c.l1_share) / c.C
        assert abs(grad[0]) < 1e-6
        for b, g in zip(beta[1:], grad[1:], strict=True):
            g = g + l2 * b
            assert abs(g + l1 * np.sign(b)) < 1e-6 if b else abs(g) <= l1 + 1e-6


def test_batched_fits_equal_single_fits(rows, data):
    x, y, fold = data
    some = GRID[::11]
    for c, beta in zip(some, BL.fit_candidates(rows, some, tol=1e-14), strict=True):
        one = PenalizedLogistic(C=c.C, elasticNet=c.l1_share, maxIter=200, tol=1e-15).fit(
            rows.where(F.col("fold") != c.fold).select(array_to_vector("x").alias("features"), F.col("y").alias("label")))
        single = np.r_[one.getOrDefault("intercept"), one.getOrDefault("coefficients")]
        train = fold != c.fold
        eta = [np.hstack([np.ones((train.sum(), 1)), x[train]]) @ b for b in (beta, single)]
        cost = [np.sum(np.logaddexp(0, e) - y[train] * e) + (c.l1_share * np.abs(b[1:]).sum() + 0.5 * (1 - c.l1_share) * (b[1:] ** 2).sum()) / c.C
                for e, b in zip(eta, (beta, single), strict=True)]
        assert cost[0] == pytest.approx(cost[1], rel=1e-8) and np.abs(beta - single).max() < 1e-6


def test_metrics_of_all_candidates(rows, data):
    x, y, fold = data
    some = GRID[1::9]
    betas = BL.fit_candidates(rows, some)
    scored = BL.validation_scores(rows, some, betas).cache()
    got = {m: BL.candidate_metric(scored, m) for m in ("roc_auc", "log_loss", "accuracy", "f1", "precision", "recall")}
    for i, (c, beta) in enumerate(zip(some, betas, strict=True)):
        own = fold == c.fold
        p, t = 1 / (1 + np.exp(-(beta[0] + x[own] @ beta[1:]))), y[own]
        pairs = p[t == 1][:, None] - p[t == 0][None, :]
        assert got["roc_auc"][i] == pytest.approx(np.mean((pairs > 0) + 0.5 * (pairs == 0)))
        assert got["log_loss"][i] == pytest.approx(-np.mean(np.where(t == 1, np.log(p), np.log(1 - p))))
        assert got["accuracy"][i] == got["recall"][i] == pytest.approx(np.mean((p > 0.5) == t))
        f1 = precision = 0.0
        for k in (0, 1):
            hit, said, true = np.sum((p > 0.5) & (t == k)) if k else np.sum((p <= 0.5) & (t == 0)), np.sum((p > 0.5) == k), np.sum(t == k)
            f1 += true / len(t) * (2 * hit / (said + true) if said + true else 0.0)
            precision += true / len(t) * (hit / said if said else 0.0)
        assert got["f1"][i] == pytest.approx(f1) and got["precision"][i] == pytest.approx(precision)


def test_a_pass_takes_few_rows_at_a_time(rows, data, monkeypatch):
    monkeypatch.setattr(BL, "PAIR_BYTES", 1)  # 64 rows
    x, y, fold = data
    folds, betas = np.arange(5), np.random.default_rng(3).normal(size=(5, 7))
    betas[4] *= 300.0  # probabilities of 0 and 1
    with np.errstate(over="raise"):
        loss, score, hess = BL._pass(rows, folds, betas, None)
    for f in range(5):
        train = fold != f
        design = np.hstack([np.ones((train.sum(), 1)), x[train]])
        eta = design @ betas[f]
        p = np.exp(-np.logaddexp(0, -eta))
        assert loss[f] == pytest.approx(np.sum(np.logaddexp(0, eta) - y[train] * eta))
        assert np.allclose(score[f], design.T @ (y[train] - p)) and np.allclose(hess[f], (design * (p * (1 - p))[:, None]).T @ design)


def test_scores_are_counted_in_the_worker_that_makes_them(rows, data, monkeypatch):
    plans, real = [], BL.ME.auc_of_counts

    def seen(counts, *more):
        plans.append(counts._jdf.queryExecution().executedPlan().toString())
        return real(counts, *more)

    monkeypatch.setattr(BL.ME, "auc_of_counts", seen)
    some = GRID[::9]
    assert len(BL.validation_auc(rows, some, BL.fit_candidates(rows, some))) == len(some)
    assert plans[0].split("InMemoryTableScan")[0].count("MapInArrow") == 1


def test_tuned_refit_makes_its_table_once(spark, monkeypatch):
    from tabula.plans import q_models as Q
    trials = spark.createDataFrame([(0, 0.8, json.dumps({"C": 1.0, "penalty": "l2", "max_iter": 100}))], "trial int, value double, params string")
    monkeypatch.setattr(Q, "_logistic_trials", lambda *a: trials)
    held, real = [], SE.evaluate

    def seen(pred, metric, *more):
        held.append(pred.storageLevel.useMemory)
        return real(pred, metric, *more)

    monkeypatch.setattr(SE, "evaluate", seen)
    assert Q.tuned_refit_scores(spark, SF_SMALL).count() == 6 and held == [True] * 6


def test_scales_and_columns_of_a_group_search(spark, rows, data):
    x, y, fold = data
    scales = BL.fold_scales(rows, range(5))
    for f in range(5):
        assert np.allclose(scales[f][0], x[fold != f].mean(axis=0)) and np.allclose(scales[f][1], x[fold != f].std(axis=0))
    beta = BL.fit_candidates(rows, [BL.Candidate(2, 1.0, 0.0, 100, (0, 3))], scales)[0]
    assert set(np.flatnonzero(beta[1:])) == {0, 3}
    z = (x[fold != 2][:, [0, 3]] - scales[2][0][[0, 3]]) / scales[2][1][[0, 3]]
    p = 1 / (1 + np.exp(-(beta[0] + z @ beta[[1, 4]])))
    assert np.abs(z.T @ (p - y[fold != 2]) + beta[[1, 4]]).max() < 1e-5
    wide = rows.select("fold", F.col("y").alias("label"), *[F.col("x")[j].alias(f"v{j}") for j in range(6)], F.lit(3.0).alias("const"))
    groups = {"on": ["v0"], "p": ["v1", "v2"], "q": ["v3", "const"]}
    trials = G.group_search(spark, wide, "label", groups, ["on"], n_trials=12, seed=1).collect()
    assert len(trials) == 12 and all(0.4 < t["value"] < 1 for t in trials)
    few = [t for t in trials if t["n_features"] < G.MIN_FEATURES]
    assert few and all(t["value"] == 0.5 and t["cv_std"] == 0.0 for t in few)


def test_random_search_preprocesses_inside_the_folds(spark, rows):
    df = rows.select("fold", F.col("y").alias("label"), *[F.col("x")[j].alias(f"v{j}") for j in range(6)])
    va = VectorAssembler(inputCols=[f"v{j}" for j in range(6)], outputCol="features")
    with_views = SE.random_search(spark, df, "logistic_regression", "roc_auc", n_trials=3, preprocess=Pipeline(stages=[va])).orderBy("trial").collect()
    shared = SE.random_search(spark, va.transform(df), "logistic_regression", "roc_auc", n_trials=3).orderBy("trial").collect()
    for a, b in zip(with_views, shared, strict=True):
        assert a["params"] == b["params"] and a["value"] == pytest.approx(b["value"], abs=1e-9)
    draw = json.loads(shared[0]["params"])
    scores = SE.cross_validate(SE.fold_frames(va.transform(df)), "logistic_regression", draw, "roc_auc")
    assert np.mean(scores) == pytest.approx(shared[0]["value"], abs=1e-6)


def test_more_than_two_classes(spark):
    rng = np.random.default_rng(2)
    c = rng.integers(0, 3, 150)
    df = spark.createDataFrame([(float(k), float(k + e[0]), float(-k * k + e[1])) for k, e in zip(c, rng.normal(size=(150, 2)) * 0.3, strict=True)],
                               "label double, a double, b double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    for model in ("logistic", "svm"):
        got = ScaledC(C=10.0, model=model, maxIter=10).fit(df).transform(df)
        assert SE.evaluate(got, "accuracy") > 0.9
        if model == "logistic":
            assert all(abs(sum(r["probability"]) - 1) < 1e-9 and len(r["probability"]) == 3 for r in got.collect())


@pytest.mark.parametrize("name", ["random_search_trials", "tuned_refit_scores", "param_importance", "feature_group_search",
                                  "feature_group_importance", "boosted_presets", "model_leaderboard", "regression_leaderboard"])
def test_searches_and_leaderboards_run_whole(spark, name):
    from __spark_entry__ import queries
    rows = queries()[name](spark, SF_SMALL).collect()
    if name in ("random_search_trials", "feature_group_search"):
        trials = sorted(rows, key=lambda r: r["trial"])
        assert [t["trial"] for t in trials] == list(range({"random_search_trials": 50, "feature_group_search": 80}[name]))
        best = np.maximum.accumulate([t["value"] for t in trials])
        assert [t["best_so_far"] for t in trials] == best.tolist() and all(0 <= t["value"] <= 1 for t in trials)
    elif name.endswith("board") or name == "boosted_presets":
        kind = "regression" if name == "regression_leaderboard" else "classification"
        names = {n for n, m in SE.MODELS.items() if m.task == kind}
        three = {"xgboost_classifier", "lightgbm_classifier", "catboost_classifier"}
        assert {r["model"] for r in rows} == (three if name == "boosted_presets" else names - three)
        assert all(r["state"] == "ok" for r in rows)
    else:
        assert rows
