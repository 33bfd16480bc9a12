"""Generalised linear models by iteratively reweighted least squares (G2-G7, H5).

Each Newton step is one pass over the persisted design: every task computes
the score X'(y - mu), the weighted Gram X'WX and the log-likelihood of its
Arrow batches with numpy, and Spark sums those k^2 + k partial slots.  The
k x k solve happens on the driver; steps are halved when the likelihood would
fall.
Families: binomial (logit link) and Poisson (log link).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.functions import distributions as D
from tabula.operators.linear import _rank_columns, qcol

ROWS_PER_TASK = 50_000  # a Newton step is a pass over all partitions: small ones are read together


def _eta(names: Sequence[str], coef: np.ndarray) -> Column:
    expr = F.lit(0.0)
    for n, b in zip(names, coef):
        x = F.lit(1.0) if n == "Intercept" else qcol(n).cast("double")
        expr = expr + F.lit(float(b)) * x
    return expr


def _softplus(eta: Column) -> Column:
    """log(1 + exp(eta)) without overflow."""
    return F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta)))


@dataclass
class GLMResult:
    family: str
    names: list[str]
    coef: np.ndarray
    cov: np.ndarray
    llf: float
    llnull: float
    n: float
    iterations: int
    converged: bool
    separated: bool
    aliased: list[str]

    @property
    def df_model(self) -> int:
        return len(self.names) - (1 if "Intercept" in self.names else 0)

    @property
    def pseudo_r2(self) -> float:
        return 1.0 - self.llf / self.llnull if self.llnull else float("nan")

    @property
    def aic(self) -> float:
        return -2 * self.llf + 2 * len(self.names)

    @property
    def bic(self) -> float:
        return -2 * self.llf + math.log(self.n) * len(self.names)

    def linear_predictor(self) -> Column:
        return _eta(self.names, self.coef)

    def predict(self) -> Column:
        eta = self.linear_predictor()
        return 1.0 / (1.0 + F.exp(-eta)) if self.family == "binomial" else F.exp(eta)

    def table(self, spark: SparkSession, alpha: float = 0.05) -> DataFrame:
        """``(term, coef, std_err, z, p_value, ci_lower, ci_upper)`` with normal tails."""
        se = np.sqrt(np.maximum(np.diag(self.cov), 0.0))
        q = D.norm_ppf(1 - alpha / 2)
        rows = []
        for n, b, s in zip(self.names, self.coef, se):
            z = b / s if s > 0 else float("nan")
            rows.append((n, float(b), float(s), float(z), float(2 * D.norm_sf(abs(z))),
                         float(b - q * s), float(b + q * s)))
        return spark.createDataFrame(rows, "term string, coef double, std_err double, z double, "
                                           "p_value double, ci_lower double, ci_upper double")

    def odds_ratios(self, spark: SparkSession, alpha: float = 0.05) -> DataFrame:
        """exp(coef) with exp of the interval, significance flag; intercept dropped."""
        t = self.table(spark, alpha).where(F.col("term") != "Intercept")
        return t.select("term", F.exp("coef").alias("odds_ratio"), F.exp("ci_lower").alias("ci_lower"),
                        F.exp("ci_upper").alias("ci_upper"), "p_value",
                        (F.col("p_value") < alpha).alias("significant"))

    def summary(self, spark: SparkSession, name: str = "model") -> DataFrame:
        row = (name, float(self.pseudo_r2), float(self.aic), float(self.bic), float(self.llf), float(self.llnull),
               int(len(self.names)), int(self.n), bool(self.converged), bool(self.separated), ",".join(self.aliased))
        return spark.createDataFrame(
            [row], "model string, pseudo_r2 double, aic double, bic double, llf double, llnull double, "
                   "num_params int, n_obs bigint, converged boolean, separated boolean, aliased string")


def fit_glm(df: DataFrame, xcols: Sequence[str], y: str, family: str = "binomial",
            intercept: bool = True, max_iter: int = 100, tol: float = 1e-10) -> GLMResult:
    """Maximum likelihood by Newton / IRLS; rows with a null are dropped.

    Aliased columns (exact linear dependence, found on the first weighted Gram
    matrix) are dropped and reported.  Perfect separation in a logit (every
    row fitted to its label, coefficients diverging) sets ``separated``."""
    yv = F.col(y).cast("double")
    complete = yv.isNotNull()
    for c in xcols:
        complete = complete & qcol(c).isNotNull()
    # the design is read once per Newton step: keep just its columns (under
    # positional names for the Python workers), persisted
    safe = [f"x{i}" for i in range(len(xcols))]
    data = df.where(complete).select(*[qcol(c).cast("double").alias(s) for c, s in zip(xcols, safe)],
                                     yv.alias("y")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tasks = max(1, -(-data.count() // ROWS_PER_TASK))
        fit = _fit_glm(data.coalesce(tasks), safe, "y", family, intercept, max_iter, tol)
    finally:
        data.unpersist()
    rename = dict(zip(safe, xcols))
    fit.names = [rename.get(n, n) for n in fit.names]
    fit.aliased = [rename.get(n, n) for n in fit.aliased]
    return fit


def _newton_pieces(data: DataFrame, xcols: list[str], y: str, coef: np.ndarray, intercept: bool,
                   family: str, final: bool = False) -> dict:
    """One pass: log-likelihood, score, weighted Gram, n, max |eta|.

    Each task turns its Arrow batches into numpy blocks and accumulates
    X'WX and X'(y - mu) locally; Spark then sums the k^2 + k + 4 partial
    slots with a grouped aggregate, so only one small row set per task moves."""
    k = len(coef)
    beta = np.asarray(coef, dtype=float)

    def part(batches):
        hess = np.zeros((k, k))
        grad = np.zeros(k)
        ll = 0.0
        n = 0.0
        emax = 0.0
        lg = 0.0
        miss = 0.0
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = pdf[xcols].to_numpy(dtype=float) if xcols else np.zeros((len(pdf), 0))
            if intercept:
                X = np.hstack([np.ones((len(pdf), 1)), X])
            yv = pdf[y].to_numpy(dtype=float)
            eta = X @ beta
            if family == "binomial":
                mu = 1.0 / (1.0 + np.exp(-eta))
                w = mu * (1.0 - mu)
                ll += float(np.sum(yv * eta - (np.maximum(eta, 0) + np.log1p(np.exp(-np.abs(eta))))))
            else:
                mu = np.exp(eta)
                w = mu
                ll += float(np.sum(yv * eta - mu))
                if final:
                    counts, times = np.unique(yv, return_counts=True)
                    lg += float(sum(math.lgamma(v + 1.0) * t for v, t in zip(counts, times)))
            miss += float(np.sum(np.abs(yv - mu) > 1e-6))
            hess += (X * w[:, None]).T @ X
            grad += X.T @ (yv - mu)
            n += len(pdf)
            emax = max(emax, float(np.max(np.abs(eta))))
        flat = np.concatenate([[ll, n, emax, lg, miss], grad, hess[np.triu_indices(k)]])
        yield pd.DataFrame({"i": np.arange(len(flat), dtype=np.int32), "v": flat,
                            "m": flat})

    out = (data.mapInPandas(part, "i int, v double, m double")
           .groupBy("i").agg(F.sum("v").alias("v"), F.max("m").alias("m")).collect())
    vals = dict((r["i"], (r["v"], r["m"])) for r in out)
    flat = [vals[i][0] for i in range(len(vals))]
    hess = np.zeros((k, k))
    hess[np.triu_indices(k)] = flat[5 + k:]
    hess = hess + np.triu(hess, 1).T
    return {"ll": flat[0], "n": flat[1], "emax": vals[2][1], "lg": flat[3], "miss": flat[4],
            "grad": np.array(flat[5:5 + k]), "hess": hess}


def _fit_glm(data: DataFrame, xcols: Sequence[str], y: str, family: str, intercept: bool,
             max_iter: int, tol: float) -> GLMResult:
    if family not in ("binomial", "poisson"):
        raise ValueError(f"unknown family {family}")
    xcols = list(xcols)
    names = (["Intercept"] if intercept else []) + xcols
    coef = np.zeros(len(names))
    ybar = data.agg(F.avg(qcol(y))).first()[0]
    if intercept and ybar:
        if family == "binomial" and 0 < ybar < 1:
            coef[0] = math.log(ybar / (1 - ybar))
        elif family == "poisson" and ybar > 0:
            coef[0] = math.log(ybar)
    # drop aliased columns (rank of the first weighted Gram matrix)
    pieces = _newton_pieces(data, xcols, y, coef, intercept, family)
    keep = _rank_columns(pieces["hess"], tol=1e-9)
    aliased = [names[j] for j in range(len(names)) if j not in keep]
    if aliased:
        names = [names[j] for j in keep]
        xcols = [n for n in names if n != "Intercept"]
        intercept = "Intercept" in names
        coef = coef[keep]
        pieces = _newton_pieces(data, xcols, y, coef, intercept, family)
    converged = False
    it = 0
    for it in range(1, max_iter + 1):
        try:
            step = np.linalg.solve(pieces["hess"], pieces["grad"])
        except np.linalg.LinAlgError:
            step = np.linalg.pinv(pieces["hess"]) @ pieces["grad"]
        # step halving keeps the log-likelihood non-decreasing
        scale = 1.0
        for _ in range(30):
            trial = _newton_pieces(data, xcols, y, coef + scale * step, intercept, family)
            if trial["ll"] >= pieces["ll"] - 1e-12 * abs(pieces["ll"]):
                break
            scale /= 2.0
        gain = trial["ll"] - pieces["ll"]
        coef = coef + scale * step
        pieces = trial
        if abs(gain) <= tol * (abs(pieces["ll"]) + tol) and np.max(np.abs(scale * step)) < 1e-6:
            converged = True
            break
    final = _newton_pieces(data, xcols, y, coef, intercept, family, final=True)
    cov = np.linalg.pinv(final["hess"])
    n, llf = final["n"], final["ll"]
    if family == "binomial":
        # complete separation: every row fitted to its own label
        separated = final["miss"] == 0 or ((not converged) and final["emax"] > 25)
        llnull = n * (ybar * math.log(ybar) + (1 - ybar) * math.log(1 - ybar)) if 0 < ybar < 1 else 0.0
    else:
        separated = False
        llf -= final["lg"]
        sy = ybar * n
        llnull = sy * math.log(ybar) - n * ybar - final["lg"] if ybar > 0 else float("nan")
    return GLMResult(family=family, names=names, coef=coef, cov=cov, llf=llf, llnull=llnull, n=n,
                     iterations=it, converged=converged, separated=separated, aliased=aliased)


def marginal_effects(df: DataFrame, fit: GLMResult, spark: SparkSession) -> DataFrame:
    """Average marginal effects of a logit (every column treated as continuous):
    AME_j = mean(p(1-p)) b_j, delta-method errors from one aggregate of
    mean(p(1-p)) and mean(p(1-p)(1-2p) x_l)."""
    eta = fit.linear_predictor()
    p = 1.0 / (1.0 + F.exp(-eta))
    d = p * (1.0 - p)
    names = fit.names
    xs = [F.lit(1.0) if n == "Intercept" else qcol(n).cast("double") for n in names]
    r = df.agg(F.avg(d).alias("d"), *[F.avg(d * (1.0 - 2.0 * p) * x).alias(f"c{i}") for i, x in enumerate(xs)]).first()
    dbar = r["d"]
    c = np.array([r[f"c{i}"] for i in range(len(names))])
    idx = [i for i, n in enumerate(names) if n != "Intercept"]
    ame = np.array([dbar * fit.coef[j] for j in idx])
    jac = np.zeros((len(idx), len(names)))
    for a, j in enumerate(idx):
        jac[a, :] = fit.coef[j] * c
        jac[a, j] += dbar
    cov = jac @ fit.cov @ jac.T
    se = np.sqrt(np.maximum(np.diag(cov), 0.0))
    q = D.norm_ppf(0.975)
    rows = []
    for a, j in enumerate(idx):
        z = ame[a] / se[a] if se[a] > 0 else float("nan")
        rows.append((names[j], float(ame[a]), float(se[a]), float(z), float(2 * D.norm_sf(abs(z))),
                     float(ame[a] - q * se[a]), float(ame[a] + q * se[a])))
    return spark.createDataFrame(rows, "term string, dy_dx double, std_err double, z double, p_value double, "
                                       "ci_lower double, ci_upper double")


def likelihood_ratio(restricted: GLMResult, full: GLMResult) -> tuple[float, float, float]:
    """LR = -2 (llf_r - llf_f); df = |df_f - df_r|; p = 1 when LR <= 0."""
    lr = -2.0 * (restricted.llf - full.llf)
    dof = float(abs(full.df_model - restricted.df_model))
    p = D.chi2_sf(lr, dof) if lr > 0 and dof > 0 else 1.0
    return lr, dof, p
