"""Feature-group search over a formula design (T9, M18, H-S2..S7).

Design columns are grouped by the formula terms they come from; some groups are always on, the
others are switched per trial.  Each trial scales the selected columns
(population std, fitted inside each training fold) and fits an L1 / L2 /
elastic-net logistic regression; the objective is the mean ROC-AUC over
stratified folds.  Fewer than three selected columns score 0.5 without a fit.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.models import batched_logistic as BL
from tabula.models.registry import P, sample
from tabula.models.search import logistic_candidate
from tabula.operators.design import parse

# fixed values: the tuned parameters of the group search
GROUP_SPACE = [P("penalty", "cat", choices=("l1", "l2", "elasticnet")), P("C", "float", 1e-3, 100.0, log=True),
               P("l1_ratio", "float", 0.1, 0.9, when=lambda d: d["penalty"] == "elasticnet")]
MIN_FEATURES = 3


def named_groups(formula: str, names: list[str], members: dict[str, list[str]]) -> dict[str, list[str]]:
    """Design columns of each named group of formula terms (``a``, ``C(a)``, ``a:C(b)``); a
    term that the formula lacks is an error."""
    _, terms, _ = parse(formula)
    labels = {":".join(f.label for f in term): tuple(f.label for f in term) for term in terms}
    bare = {c: tuple(re.sub(r"\[[^\]]*\]$", "", part) for part in c.split(":")) for c in names}
    out = {}
    for group, of_group in members.items():
        if lost := [t for t in of_group if t not in labels]:
            raise ValueError(f"{group}: no such term: {', '.join(lost)}")
        wanted = {labels[t] for t in of_group}
        out[group] = [c for c in names if bare[c] in wanted]
    return out


def group_search(spark: SparkSession, data: DataFrame, label: str, groups: dict[str, list[str]],
                 always_on: list[str], n_trials: int = 80, seed: int = 42, fold_col: str = "fold", k: int = 5,
                 max_iter: int = 500) -> DataFrame:
    """Trials ``(trial, value, cv_std, n_features, C, penalty, l1_ratio, groups, use_<group>...)``."""
    optional = [g for g in groups if g not in always_on]
    rng = np.random.default_rng(seed)
    draws = []
    for _ in range(n_trials):
        use = {g: bool(rng.integers(0, 2)) for g in optional}
        draws.append((use, sample(GROUP_SPACE, rng)))
    every = list(dict.fromkeys(c for g in groups for c in groups[g]))
    rows = data.select(F.lit(BL.SHARED).alias("view"), F.col(fold_col).cast("int").alias("fold"), F.col(label).cast("double").alias("y"),
                       F.array(*[F.col(f"`{c}`").cast("double") for c in every]).alias("x"))
    rows = BL.balanced(rows, data.count(), n_trials * k).persist(StorageLevel.MEMORY_AND_DISK)
    table, candidates, fitted = [], [], []
    for i, (use, p) in enumerate(draws):
        chosen = [g for g in always_on] + [g for g in optional if use[g]]
        cols = list(dict.fromkeys(c for g in chosen for c in groups[g]))
        table.append([i, 0.5, 0.0, len(cols) + 1, float(p["C"]), p["penalty"], p.get("l1_ratio"),
                      json.dumps(chosen), *[use[g] for g in optional]])
        if len(cols) + 1 >= MIN_FEATURES:  # the intercept counts as in the design
            at = tuple(every.index(c) for c in cols)
            candidates += [logistic_candidate({**p, "max_iter": max_iter}, f, at) for f in range(k)]
            fitted.append(i)
    try:
        scales = BL.fold_scales(rows, range(k))
        betas = BL.fit_candidates(rows, candidates, scales)
        auc = BL.validation_auc(rows, candidates, betas, scales)
    finally:
        rows.unpersist()
    for at, i in enumerate(fitted):
        scores = [auc[at * k + f] for f in range(k)]
        table[i][1:3] = float(np.mean(scores)), float(np.std(scores))
    schema = ("trial int, value double, cv_std double, n_features int, C double, penalty string, "
              "l1_ratio double, groups string, " + ", ".join(f"use_{g} boolean" for g in optional))
    return spark.createDataFrame([tuple(r) for r in table], schema)
