"""Linear models and regression inference from one Gram-matrix aggregate.

``gram`` scans the table once and returns n, means and the centred moment
matrices: numpy block sums per task, merged pairwise; only one row per task is
shuffled, and the plan does not grow with the number of columns.  Every
estimate below is then a k x k computation on the driver:

* OLS with standard errors, t, p, confidence intervals, R2, F, log-likelihood,
  AIC/BIC, rank-aware (aliased columns are reported and dropped)  (G1, M2)
* ridge with an unpenalised intercept (M3), elastic net / lasso by coordinate
  descent on the covariance matrix (M4, M5)
* VIF (H12), type-I ANOVA (H9)

Passes that need residuals (Breusch-Pagan H7, HC3 H8) are one more such pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.functions import distributions as D


@dataclass
class Gram:
    """Centred second moments: n, means, Cxx = sum (x-mx)(x-mx)', cxy, cyy."""
    names: list[str]
    n: float
    mx: np.ndarray
    my: float
    cxx: np.ndarray
    cxy: np.ndarray
    cyy: float

    def sub(self, idx: Sequence[int]) -> "Gram":
        idx = list(idx)
        return Gram([self.names[i] for i in idx], self.n, self.mx[idx], self.my,
                    self.cxx[np.ix_(idx, idx)], self.cxy[idx], self.cyy)

    def raw(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Uncentred X'X, X'y, y'y (for fits without an intercept)."""
        n = self.n
        return (self.cxx + n * np.outer(self.mx, self.mx), self.cxy + n * self.mx * self.my,
                self.cyy + n * self.my * self.my)


def qcol(name: str) -> Column:
    """Column by exact name (design names hold brackets, dots and colons)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _cols(df: DataFrame, cols: Sequence[str | Column]) -> list[Column]:
    return [qcol(c).cast("double") if isinstance(c, str) else c.cast("double") for c in cols]


def gram(df: DataFrame, xcols: Sequence[str | Column], y: str | Column,
         names: Sequence[str] | None = None) -> Gram:
    """All centred cross-products over complete rows, in one pass and one small shuffle.

    Every task reduces its rows to (n, means, centred moments), batch by batch, with
    the parallel update formula, which does not suffer the cancellation of raw sums
    of squares at large n.  Such states merge in two steps, about the root of the
    number of tasks at a time, so neither a task nor the driver meets more than that."""
    values = [*_cols(df, xcols), *_cols(df, [y])]
    k = len(values) - 1
    states = _task_states(df, values, lambda z: (float(len(z)), z.mean(axis=0), (z - z.mean(axis=0)).T @ (z - z.mean(axis=0))), _merge_moments)
    n, mean, c = states if states is not None else (0.0, np.zeros(k + 1), np.zeros((k + 1, k + 1)))
    return Gram(names=list(names or [c_ if isinstance(c_, str) else f"x{i}" for i, c_ in enumerate(xcols)]),
                n=n, mx=mean[:k], my=float(mean[k]), cxx=c[:k, :k], cxy=c[:k, k], cyy=float(c[k, k]))


State = tuple[float, np.ndarray, np.ndarray]


def _merge_moments(a: State, b: State) -> State:
    n = a[0] + b[0]
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


def _merge_sums(a: State, b: State) -> State:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def _task_states(df: DataFrame, values: Sequence[Column], state: Callable[[np.ndarray], State],
                 merge: Callable[[State, State], State]) -> State | None:
    """``state`` of every Arrow batch of complete rows, merged; None without rows."""
    names = [f"v{i}" for i in range(len(values))]
    schema = "part int, n double, v array<double>, m array<double>"

    def packed(part: int, s: State) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([s[0]], pa.float64()),
                                           pa.array([s[1].tolist()], pa.list_(pa.float64())),
                                           pa.array([s[2].ravel().tolist()], pa.list_(pa.float64()))], names=["part", "n", "v", "m"])

    def unpacked(rows: pa.Table | pa.RecordBatch) -> State | None:
        held = None
        for n, v, m in zip(*(rows.column(c).to_pylist() for c in ("n", "v", "m")), strict=True):
            one = (n, np.array(v), np.array(m).reshape(len(v), -1))
            held = one if held is None else merge(held, one)
        return held

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            full = np.ones(batch.num_rows, bool)
            for c in batch.columns:
                full &= c.is_valid().to_numpy(zero_copy_only=False).astype(bool)
            if full.any():
                z = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])[full]
                held = state(z) if held is None else merge(held, state(z))
        if held is not None:
            yield packed(TaskContext.get().partitionId(), held)

    def reduce_group(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([packed(0, unpacked(rows))])

    tasks = df.select(*[c.alias(n) for c, n in zip(values, names, strict=True)])
    rows = tasks.mapInArrow(reduce_task, schema)
    groups = max(1, math.isqrt(int(df.sparkSession.sparkContext.defaultParallelism)))
    merged = rows.withColumn("g", F.pmod("part", F.lit(groups))).groupBy("g").applyInArrow(
        lambda t: reduce_group(t.drop_columns(["g"])), schema)
    return unpacked(merged.toArrow())


def _rank_columns(xtx: np.ndarray, tol: float = 1e-10) -> list[int]:
    """Greedy pivoted selection of linearly independent columns (in order)."""
    keep: list[int] = []
    for j in range(xtx.shape[0]):
        if xtx[j, j] <= 0:
            continue
        cand = keep + [j]
        sub = xtx[np.ix_(cand, cand)]
        scale = np.sqrt(np.diag(sub))
        corr = sub / np.outer(scale, scale)
        if np.linalg.eigvalsh(corr).min() > tol:
            keep = cand
    return keep


@dataclass
class OLSResult:
    names: list[str]
    coef: np.ndarray
    cov: np.ndarray
    n: float
    df_model: float
    df_resid: float
    sse: float
    sst: float
    has_intercept: bool
    aliased: list[str] = field(default_factory=list)

    @property
    def sigma2(self) -> float:
        return self.sse / self.df_resid if self.df_resid > 0 else float("nan")

    @property
    def r2(self) -> float:
        return 1.0 - self.sse / self.sst if self.sst > 0 else float("nan")

    @property
    def adj_r2(self) -> float:
        d = self.n - 1 if self.has_intercept else self.n
        return 1.0 - (1.0 - self.r2) * d / self.df_resid if self.df_resid > 0 else float("nan")

    @property
    def f_stat(self) -> float:
        if self.df_model <= 0 or self.df_resid <= 0:
            return float("nan")
        return ((self.sst - self.sse) / self.df_model) / (self.sse / self.df_resid)

    @property
    def llf(self) -> float:
        n = self.n
        return -n / 2.0 * (math.log(2 * math.pi) + math.log(self.sse / n) + 1.0)

    @property
    def aic(self) -> float:
        return -2 * self.llf + 2 * (self.df_model + int(self.has_intercept))

    @property
    def bic(self) -> float:
        return -2 * self.llf + math.log(self.n) * (self.df_model + int(self.has_intercept))

    def table(self, spark: SparkSession, alpha: float = 0.05) -> DataFrame:
        """Coefficient table ``(term, coef, std_err, t_stat, p_value, ci_lower, ci_upper)``."""
        se = np.sqrt(np.maximum(np.diag(self.cov), 0.0))
        q = D.t_ppf(1 - alpha / 2, self.df_resid)
        rows = []
        for name, b, s in zip(self.names, self.coef, se):
            t = b / s if s > 0 else float("nan")
            p = D.t_sf_two_sided(t, self.df_resid) if s > 0 else float("nan")
            rows.append((name, float(b), float(s), float(t), float(p), float(b - q * s), float(b + q * s)))
        return spark.createDataFrame(
            rows, "term string, coef double, std_err double, t_stat double, p_value double, "
                  "ci_lower double, ci_upper double")

    def summary(self, spark: SparkSession) -> DataFrame:
        fp = D.f_sf(self.f_stat, self.df_model, self.df_resid) if self.df_model > 0 else float("nan")
        row = (int(self.n), *[float(v) for v in (self.df_model, self.df_resid, self.r2, self.adj_r2,
                                                  self.f_stat, fp, self.llf, self.aic, self.bic)],
               ",".join(self.aliased))
        return spark.createDataFrame(
            [row], "n_obs bigint, df_model double, df_resid double, r2 double, adj_r2 double, f_stat double, "
                   "f_pvalue double, llf double, aic double, bic double, aliased string")

    def predict(self, intercept_name: str = "Intercept", columns: dict[str, Column] | None = None) -> Column:
        """Fitted value as a column expression ``sum b_j x_j``."""
        expr = F.lit(0.0)
        for name, b in zip(self.names, self.coef):
            if name == intercept_name:
                expr = expr + F.lit(float(b))
            else:
                c = (columns or {}).get(name, qcol(name))
                expr = expr + F.lit(float(b)) * c.cast("double")
        return expr


def ols_from_gram(g: Gram, intercept: bool = True) -> OLSResult:
    """Least squares from centred moments (with intercept) or raw moments
    (without); aliased columns are dropped and reported."""
    if intercept:
        keep = _rank_columns(g.cxx)
        A = np.linalg.inv(g.cxx[np.ix_(keep, keep)]) if keep else np.zeros((0, 0))
        b = A @ g.cxy[keep]
        mx = g.mx[keep]
        b0 = g.my - mx @ b
        sse = max(g.cyy - b @ g.cxy[keep], 0.0)
        p = len(keep) + 1
        df_resid = g.n - p
        sigma2 = sse / df_resid if df_resid > 0 else float("nan")
        inv = np.zeros((p, p))
        inv[0, 0] = 1.0 / g.n + mx @ A @ mx
        inv[0, 1:] = inv[1:, 0] = -(A @ mx)
        inv[1:, 1:] = A
        names = ["Intercept"] + [g.names[j] for j in keep]
        return OLSResult(names=names, coef=np.concatenate([[b0], b]), cov=sigma2 * inv, n=g.n,
                         df_model=len(keep), df_resid=df_resid, sse=sse, sst=g.cyy, has_intercept=True,
                         aliased=[g.names[j] for j in range(len(g.names)) if j not in keep])
    xtx, xty, yty = g.raw()
    keep = _rank_columns(xtx)
    inv = np.linalg.inv(xtx[np.ix_(keep, keep)])
    b = inv @ xty[keep]
    sse = max(yty - b @ xty[keep], 0.0)
    df_resid = g.n - len(keep)
    sigma2 = sse / df_resid if df_resid > 0 else float("nan")
    return OLSResult(names=[g.names[j] for j in keep], coef=b, cov=sigma2 * inv, n=g.n,
                     df_model=len(keep), df_resid=df_resid, sse=sse, sst=yty, has_intercept=False,
                     aliased=[g.names[j] for j in range(len(g.names)) if j not in keep])


def ols(df: DataFrame, xcols: Sequence[str], y: str, intercept: bool = True) -> OLSResult:
    return ols_from_gram(gram(df, xcols, y), intercept)


def ridge(df: DataFrame, xcols: Sequence[str], y: str, alpha: float = 1.0,
          fit_intercept: bool = True) -> tuple[float, np.ndarray]:
    """argmin ||y - b0 - Xb||^2 + alpha ||b||^2 with the intercept unpenalised."""
    g = gram(df, xcols, y)
    if fit_intercept:
        b = np.linalg.solve(g.cxx + alpha * np.eye(len(g.names)), g.cxy)
        return float(g.my - g.mx @ b), b
    xtx, xty, _ = g.raw()
    return 0.0, np.linalg.solve(xtx + alpha * np.eye(len(g.names)), xty)


def elastic_net(df: DataFrame, xcols: Sequence[str], y: str, alpha: float = 1.0, l1_ratio: float = 0.5,
                fit_intercept: bool = True, max_iter: int = 1000, tol: float = 1e-4,
                g: Gram | None = None) -> tuple[float, np.ndarray, int]:
    """Minimise 1/(2n)||y - b0 - Xb||^2 + alpha*l1_ratio*|b|_1 + alpha*(1-l1_ratio)/2*||b||^2
    by cyclic coordinate descent on the (centred) Gram matrix — exact given the
    one aggregate, no further passes.  ``l1_ratio=1`` is the lasso."""
    g = g or gram(df, xcols, y)
    n = g.n
    if fit_intercept:
        mx, my, cxx, cxy = g.mx, g.my, g.cxx, g.cxy
    else:
        cxx, cxy, _ = g.raw()
        mx, my = np.zeros(len(g.names)), 0.0
    k = len(mx)
    b = np.zeros(k)
    l1 = alpha * l1_ratio * n
    l2 = alpha * (1 - l1_ratio) * n
    it = 0
    for it in range(1, max_iter + 1):
        max_step = 0.0
        for j in range(k):
            if cxx[j, j] <= 0:
                continue
            rho = cxy[j] - cxx[j] @ b + cxx[j, j] * b[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (cxx[j, j] + l2)
            max_step = max(max_step, abs(new - b[j]))
            b[j] = new
        if max_step <= tol * max(1e-12, np.max(np.abs(b)) if np.any(b) else 1.0):
            break
    return float(my - mx @ b), b, it


def vif(df: DataFrame, xcols: Sequence[str]) -> list[tuple[str, float]]:
    """Variance inflation factor of each column given the others and an intercept:
    the diagonal of the inverse correlation matrix (one aggregate)."""
    g = gram(df, xcols, F.lit(0.0))
    sd = np.sqrt(np.diag(g.cxx))
    corr = g.cxx / np.outer(sd, sd)
    inv = np.linalg.pinv(corr)
    return [(name, float(inv[i, i])) for i, name in enumerate(g.names)]


def anova_type1(df: DataFrame, terms: Sequence[Sequence[str]], term_names: Sequence[str], y: str
                ) -> list[tuple[str, float, float, float, float, float]]:
    """Sequential (type I) sums of squares: each term's reduction of the residual
    sum of squares after the terms before it.  Rows
    ``(term, df, sum_sq, mean_sq, F, p)`` plus ``Residual``; nested fits come from
    sub-blocks of the one Gram matrix."""
    cols = [c for t in terms for c in t]
    g = gram(df, cols, y)
    full = ols_from_gram(g)
    rows = []
    used: list[int] = []
    prev_sse = g.cyy
    prev_p = 0
    pos = 0
    for name, t in zip(term_names, terms):
        used = used + list(range(pos, pos + len(t)))
        pos += len(t)
        fit = ols_from_gram(g.sub(used))
        ss = prev_sse - fit.sse
        dfree = float(fit.df_model - prev_p)
        prev_sse, prev_p = fit.sse, fit.df_model
        ms = ss / dfree if dfree > 0 else float("nan")
        fstat = ms / full.sigma2
        rows.append((name, dfree, ss, ms, fstat, D.f_sf(fstat, dfree, full.df_resid)))
    rows.append(("Residual", full.df_resid, full.sse, full.sigma2, float("nan"), float("nan")))
    return rows


def breusch_pagan(df: DataFrame, fit: OLSResult, xcols: Sequence[str], y: str
                  ) -> tuple[float, float, float, float]:
    """Regress squared residuals on the design: LM = n R2, its chi-square p-value,
    the F statistic and its p-value.  One extra aggregate."""
    e2 = F.pow(qcol(y).cast("double") - fit.predict(), 2)
    aux = ols_from_gram(gram(df, xcols, e2))
    k = aux.df_model
    lm = aux.n * aux.r2
    fval = aux.f_stat
    return lm, D.chi2_sf(lm, k), fval, D.f_sf(fval, k, aux.df_resid)


def hc3_cov(df: DataFrame, fit: OLSResult, y: str) -> np.ndarray:
    """Heteroscedasticity-consistent (HC3) covariance:
    (X'X)^-1 [sum x x' e^2 / (1 - h)^2] (X'X)^-1 with leverage h = x'(X'X)^-1 x
    evaluated on numpy blocks; one pass whose k x k sums merge as in ``gram``."""
    values = [F.lit(1.0) if n == "Intercept" else qcol(n).cast("double") for n in fit.names] + [qcol(y).cast("double")]
    bread, coef = fit.cov / fit.sigma2, np.asarray(fit.coef, float)

    def state(z: np.ndarray) -> State:
        x = z[:, :-1]
        h = ((x @ bread) * x).sum(axis=1)
        w = (z[:, -1] - x @ coef) ** 2 / (1 - h) ** 2
        return float(len(z)), np.zeros(len(coef)), (x * w[:, None]).T @ x

    got = _task_states(df, values, state, _merge_sums)
    meat = got[2] if got is not None else np.zeros_like(bread)
    return bread @ meat @ bread


def coef_table_from_cov(spark: SparkSession, names, coef, cov, dof: float | None = None) -> DataFrame:
    """Coefficient table for an alternative covariance; normal tails when ``dof`` is None."""
    se = np.sqrt(np.maximum(np.diag(cov), 0.0))
    rows = []
    q = D.norm_ppf(0.975) if dof is None else D.t_ppf(0.975, dof)
    for name, b, s in zip(names, coef, se):
        z = b / s if s > 0 else float("nan")
        p = 2 * D.norm_sf(abs(z)) if dof is None else D.t_sf_two_sided(z, dof)
        rows.append((name, float(b), float(s), float(z), float(p), float(b - q * s), float(b + q * s)))
    return spark.createDataFrame(rows, "term string, coef double, std_err double, stat double, p_value double, "
                                       "ci_lower double, ci_upper double")
