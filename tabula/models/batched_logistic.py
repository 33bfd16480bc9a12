"""Penalised logistic fits of many candidates at once (H-S2, H-S3, M1, M18).

A search needs trials x folds fits on the same rows.  Here all of them advance together:
one pass multiplies every Arrow block with the matrix of all live candidates' coefficients and
returns each candidate's log-loss, score and packed X'WX (of all candidates in one matrix product: their
weights with the products of columns, a few hundred rows at a time); the proximal Newton step of each
is then solved on its k x k matrix.  A candidate leaves when it has converged, so the data are
read as often as the slowest candidate needs, some 10 to 20 times, not once per trial, fold and step.

Rows are ``(view, fold, y, x)``.  ``view`` is the fold whose training rows fitted the
preprocessing of ``x``, or -1 where all folds share the same values; a candidate of fold f
trains on the rows of its view with another fold and is scored on those of fold f.  Validation scores
of all candidates become one keyed table: an exact AUC for each from one keyed prefix sum."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.operators import metrics as ME

STATE_BYTES = 64 << 20  # of all candidates' sums in one task; more are fitted in turns
MERGE = 64  # task states merged at once
SHARED = -1  # the view of rows that all folds share
TASK_WORK = 2_000_000  # rows times candidates that train on them, in one task
PAIR_BYTES = 1 << 20  # of a block's products of columns
TASK_SCORES = 500_000  # scored rows of all candidates in one range of the AUC's sort


class Candidate(NamedTuple):
    fold: int
    C: float
    l1_share: float
    max_iter: int = 100
    columns: tuple[int, ...] | None = None  # of x; all, if None


Scales = dict[int, tuple[np.ndarray, np.ndarray]]  # fold -> means and deviations of its training rows


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _design(x: np.ndarray, fold: int, scales: Scales | None) -> np.ndarray:
    if scales:
        x = (x - scales[fold][0]) / scales[fold][1]
    return np.hstack([np.ones((len(x), 1)), x])


def _pass(data: DataFrame, folds: np.ndarray, betas: np.ndarray, scales: Scales | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-loss, score X'(y - p) and X'WX of every candidate on its training rows; one scan."""
    m, k = betas.shape
    upper = np.triu_indices(k)
    width = 1 + k + len(upper[0])
    step = max(64, PAIR_BYTES // (8 * len(upper[0])))  # rows taken at once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = np.zeros((m, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            view, fold, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("view", "fold", "y"))
            for f in np.unique(folds):
                rows = (fold != f) & ((view == f) | (view == SHARED))
                if not rows.any():
                    continue
                of_fold, part_x, part_y = np.flatnonzero(folds == f), x[rows], y[rows]
                for lo in range(0, len(part_x), step):
                    design, label = _design(part_x[lo:lo + step], int(f), scales), part_y[lo:lo + step, None]
                    eta = design @ betas[of_fold].T
                    small = np.exp(-np.abs(eta))
                    p = np.where(eta >= 0, 1.0, small) / (1.0 + small)
                    state[of_fold, 0] += (np.maximum(eta, 0) + np.log1p(small) - label * eta).sum(axis=0)
                    state[of_fold, 1:1 + k] += (label - p).T @ design
                    # one product for all candidates: their weights with the products of columns
                    state[of_fold, 1 + k:] += (p * (1 - p)).T @ (design[:, upper[0]] * design[:, upper[1]])
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(m), pa.int32()), pa.array(np.full(m, part // MERGE), pa.int32()),
                                          pa.array(list(state), pa.list_(pa.float64()))], names=["c", "part", "state"])

    def added(rows: pa.Table) -> pa.Table:
        total = rows.column("state").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1).sum(axis=0)
        return pa.table({"c": rows.column("c").slice(0, 1), "part": pa.array([rows.column("part")[0].as_py() // MERGE], pa.int32()),
                         "state": pa.array([total], pa.list_(pa.float64()))})

    schema = "c int, part int, state array<double>"
    states, tasks = data.mapInArrow(run, schema), data.rdd.getNumPartitions()
    while tasks > 1:
        states, tasks = states.groupBy("c", "part").applyInArrow(added, schema), -(-tasks // MERGE)
    got = states.toArrow().sort_by("c")
    flat = got.column("state").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(m, width)
    hess = np.zeros((m, k, k))
    hess[:, upper[0], upper[1]] = flat[:, 1 + k:]
    hess[:, upper[1], upper[0]] = flat[:, 1 + k:]
    return flat[:, 0], flat[:, 1:1 + k], hess


def _exact_on_support(new: np.ndarray, hess: np.ndarray, lin: np.ndarray, l1: float, l2: float, allowed: np.ndarray) -> np.ndarray | None:
    """The minimiser with the signs of ``new``, if it keeps them and meets the optimality conditions."""
    k = len(new)
    on = np.flatnonzero((new != 0) & allowed | (np.arange(k) == 0))
    sign = np.sign(new[on])
    sign[0] = 0.0
    ridge = np.full(len(on), l2)
    ridge[0] = 0.0
    try:
        b = np.linalg.solve(hess[np.ix_(on, on)] + np.diag(ridge), lin[on] - l1 * sign)
    except np.linalg.LinAlgError:
        return None
    out = np.zeros(k)
    out[on] = b
    off = allowed & (out == 0)
    off[0] = False
    if not np.isfinite(b).all() or (np.sign(b[1:]) != sign[1:]).any():
        return None
    slack = lin[off] - hess[off] @ out
    return out if (np.abs(slack) <= l1 * (1 + 1e-9) + 1e-12).all() else None


def newton_targets(betas: np.ndarray, score: np.ndarray, hess: np.ndarray, l1: np.ndarray, l2: np.ndarray,
                   allowed: np.ndarray, sweeps: int = 3000) -> np.ndarray:
    """Minimisers of the penalised quadratic models, one a candidate; the intercept is free.

    Without an L1 part one solve.  With it, coordinate descent for all candidates at a time; every
    few sweeps a candidate is finished by a solve on its support, where that meets the optimality conditions."""
    m, k = betas.shape
    lin = score + np.einsum("mij,mj->mi", hess, betas)
    out = betas.copy()
    for c in np.flatnonzero(l1 == 0):
        on = np.flatnonzero(allowed[c])
        ridge = np.full(len(on), l2[c])
        ridge[0] = 0.0
        out[c] = 0.0
        out[c, on] = np.linalg.solve(hess[c][np.ix_(on, on)] + np.diag(ridge), lin[c, on])
    live = np.flatnonzero(l1 > 0)
    for sweep in range(sweeps):
        if not len(live):
            break
        h, new = hess[live], out[live]
        moved = np.zeros(len(live))
        fit = np.einsum("mij,mj->mi", h, new)
        for j in range(k):
            hjj, old = h[:, j, j], new[:, j].copy()
            z = hjj * old + lin[live, j] - fit[:, j]
            if j:
                z = np.sign(z) * np.maximum(np.abs(z) - l1[live], 0.0)
            to = np.where(allowed[live, j] & (hjj > 0), z / np.where(hjj > 0, hjj + (l2[live] if j else 0.0), 1.0), old)
            new[:, j] = to
            fit += h[:, :, j] * (to - old)[:, None]
            moved = np.maximum(moved, np.abs(to - old))
        out[live] = new
        done = moved <= 1e-10 * (1.0 + np.abs(new).max(axis=1))
        if sweep % 10 == 9:
            for i, c in enumerate(live):
                exact = None if done[i] else _exact_on_support(out[c], hess[c], lin[c], l1[c], l2[c], allowed[c])
                if exact is not None:
                    out[c], done[i] = exact, True
        live = live[~done]
    return out


def _penalty(betas: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    return l1 * np.abs(betas[:, 1:]).sum(axis=1) + 0.5 * l2 * (betas[:, 1:] ** 2).sum(axis=1)


def _fit_block(data: DataFrame, candidates: Sequence[Candidate], k: int, scales: Scales | None, tol: float) -> np.ndarray:
    m = len(candidates)
    folds = np.array([c.fold for c in candidates])
    l1 = np.array([c.l1_share / c.C for c in candidates])
    l2 = np.array([(1.0 - c.l1_share) / c.C for c in candidates])
    allowed = np.zeros((m, k), bool)
    for i, c in enumerate(candidates):
        allowed[i, 0] = True
        allowed[i, 1 + np.array(c.columns if c.columns is not None else range(k - 1), int)] = True
    betas, steps, size = np.zeros((m, k)), np.zeros((m, k)), np.ones(m)
    left = np.array([max(1, c.max_iter) for c in candidates])
    halvings = np.zeros(m, int)
    objective = np.full(m, np.inf)
    live = np.arange(m)
    while len(live):  # each round is one pass over the data
        trial = betas[live] + size[live, None] * steps[live]
        loss, score, hess = _pass(data, folds[live], trial, scales)
        value = loss + _penalty(trial, l1[live], l2[live])
        better = (value <= objective[live] + 1e-12 * np.abs(objective[live])) | (halvings[live] >= 30)
        worse = live[~better]
        size[worse] /= 2.0
        halvings[worse] += 1
        ahead, at = live[better], np.flatnonzero(better)
        gain = objective[ahead] - value[at]
        moved = np.abs(size[ahead, None] * steps[ahead]).max(axis=1)
        betas[ahead], objective[ahead] = trial[at], value[at]
        left[ahead] -= 1
        done = (left[ahead] < 0) | (np.isfinite(gain) & ((np.abs(gain) <= tol * np.maximum(1.0, np.abs(value[at]))) | (moved < 1e-9)))
        on, at = ahead[~done], at[~done]
        if len(on):
            steps[on] = newton_targets(betas[on], score[at], hess[at], l1[on], l2[on], allowed[on]) - betas[on]
            size[on], halvings[on] = 1.0, 0
        live = np.sort(np.concatenate([worse, on]))
    return betas


def fit_candidates(data: DataFrame, candidates: Sequence[Candidate], scales: Scales | None = None, tol: float = 1e-10) -> np.ndarray:
    """Coefficients, intercept first, of every candidate: a row each.  Columns that a
    candidate leaves out, and all after an L1 penalty shut them out, are 0.

    ``data`` is ``(view, fold, y, x)`` with y 0 or 1 and x array<double>, best persisted."""
    first = data.select(F.size("x")).first()
    if first is None or not candidates:
        return np.zeros((len(candidates), 1))
    k = int(first[0]) + 1
    block = max(1, STATE_BYTES // (8 * (1 + k + k * (k + 1) // 2)))
    return np.vstack([_fit_block(data, candidates[i:i + block], k, scales, tol) for i in range(0, len(candidates), block)])


Batches = Iterator[pa.RecordBatch]


def _scorer(candidates: Sequence[Candidate], betas: np.ndarray, scales: Scales | None) -> Callable[[Batches], Batches]:
    folds = np.array([c.fold for c in candidates])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            view, fold, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("view", "fold", "y"))
            for f in np.unique(folds):
                rows, of_fold = (fold == f) & ((view == f) | (view == SHARED)), np.flatnonzero(folds == f)
                if rows.any():
                    eta = _design(x[rows], int(f), scales) @ betas[of_fold].T
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(of_fold, len(eta)), pa.int32()),
                                                      pa.array(np.tile(y[rows], len(of_fold)), pa.float64()),
                                                      pa.array((1.0 / (1.0 + np.exp(-eta))).T.ravel())], names=["c", "y", "p"])

    return run


def validation_scores(data: DataFrame, candidates: Sequence[Candidate], betas: np.ndarray, scales: Scales | None = None) -> DataFrame:
    """``(c, y, p)``: the probability that candidate ``c`` gives each row of its own fold."""
    return data.mapInArrow(_scorer(candidates, betas, scales), "c int, y double, p double")


def balanced(rows: DataFrame, n: int, per_row: int) -> DataFrame:
    """``rows`` (``n`` of them, each of use to ``per_row`` candidates) in partitions whose number grows with the work."""
    return rows.repartition(max(1, -(-n * max(1, per_row) // TASK_WORK)))


def validation_auc(data: DataFrame, candidates: Sequence[Candidate], betas: np.ndarray, scales: Scales | None = None) -> dict[int, float]:
    """Exact ROC-AUC of each candidate on its own fold, from one sort of all distinct scores of a batch."""
    scored = _scorer(candidates, betas, scales)
    per_fold = np.bincount([c.fold for c in candidates])
    n = sum(r["n"] * int(per_fold[r["fold"]]) for r in data.where((F.col("view") == F.col("fold")) | (F.col("view") == SHARED))
            .groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect() if 0 <= (-1 if r["fold"] is None else r["fold"]) < len(per_fold))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scored(batches):  # counted where they are made: only counts leave the worker
            if batch.num_rows:
                c, y, p = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("c", "y", "p"))
                order = np.lexsort((p, c))
                c, y, p = c[order], y[order], p[order]
                first = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | ((p[1:] != p[:-1]) & ~(np.isnan(p[1:]) & np.isnan(p[:-1])))])
                pos, neg = (np.add.reduceat(v.astype(np.int64), first) for v in (y == 1, (y != 1) & ~np.isnan(y)))
                yield pa.RecordBatch.from_arrays([pa.array(c[first]), pa.array(p[first]), pa.array(pos), pa.array(neg)],
                                                 names=["c", "score", "pos", "neg"])

    counts = data.mapInArrow(counted, "c int, score double, pos long, neg long")
    table = ME.auc_of_counts(counts, "c", max(1, -(-n // TASK_SCORES)))
    return {r["c"]: r["roc_auc"] for r in table.collect()}


def candidate_metric(scored: DataFrame, metric: str) -> dict[int, float]:
    """One value of a classification metric for each candidate of ``(c, y, p)``."""
    pos, said = F.col("y") == 1, F.col("p") > 0.5
    if metric == "roc_auc":
        table = ME.roc_auc(scored, "y", "p", 1.0, keys=["c"]).withColumnRenamed("roc_auc", "v")
    elif metric == "log_loss":
        p = F.least(F.greatest("p", F.lit(ME.LOG_LOSS_EPS)), F.lit(1 - ME.LOG_LOSS_EPS))
        table = scored.groupBy("c").agg(F.avg(-F.when(pos, F.log(p)).otherwise(F.log(1 - p))).alias("v"))
    else:
        count = lambda cond: F.sum(cond.cast("long"))
        cells = scored.groupBy("c").agg(count(pos & said).alias("tp"), count(~pos & said).alias("fp"), count(pos & ~said).alias("fn"),
                                        count(~pos & ~said).alias("tn"))
        rows = {}
        for r in cells.collect():  # a row a candidate
            support = {1: r["tp"] + r["fn"], 0: r["tn"] + r["fp"]}
            per = []
            for cls, hit, wrong, missed in ((1, r["tp"], r["fp"], r["fn"]), (0, r["tn"], r["fn"], r["fp"])):
                precision = hit / (hit + wrong) if hit + wrong else 0.0
                recall = hit / (hit + missed) if hit + missed else 0.0
                per.append((support[cls], {"accuracy": recall, "precision": precision, "recall": recall,
                                           "f1": 2 * precision * recall / (precision + recall) if precision + recall else 0.0}))
            rows[r["c"]] = sum(n * v[metric] for n, v in per) / sum(support.values())
        return rows
    return {r["c"]: r["v"] for r in table.collect()}


def fold_scales(data: DataFrame, folds: Sequence[int]) -> Scales:
    """Means and population deviations (0 counts as 1) of x over the rows of all other folds, from one pass:
    moments by fold and column, merged exactly."""
    per = data.select("fold", F.posexplode("x").alias("j", "v")).groupBy("fold", "j") \
        .agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("var")).collect()
    k = 1 + max((r["j"] for r in per), default=-1)
    held = {f: np.zeros((3, k)) for f in {r["fold"] for r in per}}
    for r in per:
        held[r["fold"]][:, r["j"]] = r["n"], r["mean"] or 0.0, r["var"] or 0.0
    out = {}
    for f in folds:
        n, mean, m2 = np.zeros(k), np.zeros(k), np.zeros(k)
        for g, (gn, gm, gv) in sorted(held.items()):
            if g != f:
                total = np.maximum(n + gn, 1)
                delta = gm - mean
                m2 += gv * gn + delta ** 2 * n * gn / total
                mean += delta * gn / total
                n += gn
        sd = np.sqrt(m2 / np.maximum(n, 1))
        out[int(f)] = mean, np.where(sd > 0, sd, 1.0)
    return out
