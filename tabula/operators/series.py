"""Series statistics for many keyed series at once (W2, W3, H10, H11) and the
Shapiro-Wilk normality test (H6).

Positions come from ``row_index`` (range partitions with offsets), so a series
holding a third of all rows is still spread over many tasks; lags come from blocks of
positions with a halo (``ordering.lags``).

* ``acf``: r_k = sum_t z_t z_{t-k} / sum_t z_t^2 with z = x - mean (per key).
* ``pacf``: Durbin-Levinson on the ACF (the Yule-Walker / MLE form), run by
  ``applyInPandas`` on the small (key, lag) table.
* ``arima111``: ARIMA(1,1,1) without constant by the Hannan-Rissanen two-step
  method — a long autoregression of the differenced series (Yule-Walker from
  its ACF) gives innovation estimates; regressing d_t on d_{t-1} and e_{t-1}
  gives (phi, theta).  Every step is a join plus aggregate per key; forecasts
  are column expressions of the last state.  (Estimates are close to, not
  equal to, exact maximum likelihood.)
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.functions import distributions as D
from tabula.operators.ordering import lags, null_safe_join, row_index


def indexed(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """(keys, idx, value) with 0-based positions in ``order``."""
    return row_index(df.select(*keys, *order, F.col(value).cast("double").alias(value)), keys, order) \
        .select(*keys, "idx", value)


def acf(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, nlags: int = 10,
        is_indexed: bool = False) -> DataFrame:
    """``(keys, lag, acf)`` for lags 1..nlags."""
    keys = list(keys)
    s = df if is_indexed else indexed(df, keys, order, value)
    m = s.groupBy(*keys).agg(F.avg(value).alias("__m"), F.count(F.lit(1)).alias("__n"))
    z = null_safe_join(s, m, keys).select(*keys, "idx", (F.col(value) - F.col("__m")).alias("z"))
    return _autocorrelations(lags(z, keys, "idx", ["z"], range(1, nlags + 1)), keys, "z", nlags)


def _autocorrelations(wide: DataFrame, keys: list[str], value: str, nlags: int) -> DataFrame:
    """``(keys, lag, acf)`` from a table with the lags as columns: one aggregate of all products; a lag
    that no row of a key has gives no row."""
    v = F.col(value)
    sums = wide.groupBy(*keys).agg(F.sum(v * v).alias("__ss"), F.max("idx").alias("__last"), F.min("idx").alias("__first"),
                                   *[F.sum(v * F.col(f"{value}_lag{k}")).alias(f"__{k}") for k in range(1, nlags + 1)])
    long = sums.select(*keys, "__ss", "__last", "__first", F.explode(F.array(*[
        F.struct(F.lit(k).alias("lag"), F.col(f"__{k}").alias("num")) for k in range(1, nlags + 1)])).alias("__l"))
    return long.where(F.col("__l.lag") <= F.col("__last") - F.col("__first")) \
        .select(*keys, F.col("__l.lag").alias("lag"), F.try_divide("__l.num", "__ss").alias("acf"))


def durbin_levinson(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Partial autocorrelations and AR coefficients from autocorrelations r[1..p]."""
    p = len(r)
    phi = np.zeros((p + 1, p + 1))
    pac = np.zeros(p)
    v = 1.0
    for k in range(1, p + 1):
        num = r[k - 1] - sum(phi[k - 1, j] * r[k - 1 - j] for j in range(1, k))
        a = num / v if v > 0 else 0.0
        phi[k, k] = a
        for j in range(1, k):
            phi[k, j] = phi[k - 1, j] - a * phi[k - 1, k - j]
        v *= (1 - a * a)
        pac[k - 1] = a
    return pac, phi[p, 1:]


def pacf(acf_table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, lag, pacf)`` from an ACF table (one small group per series)."""
    keys = list(keys)
    schema = T.StructType([acf_table.schema[k] for k in keys] +
                          [T.StructField("lag", T.IntegerType()), T.StructField("pacf", T.DoubleType())])

    def per_key(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        pac, _ = durbin_levinson(pdf["acf"].to_numpy(dtype=float))
        out = pd.DataFrame({k: pdf[k].iloc[0] for k in keys}, index=range(len(pac)))
        out["lag"] = pdf["lag"].to_numpy(dtype=np.int32)
        out["pacf"] = pac
        return out

    return acf_table.groupBy(*keys).applyInPandas(per_key, schema)


def arima111(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, steps: int = 5,
             long_ar: int = 6) -> DataFrame:
    """Per key: ``phi, theta, sigma2, n`` and forecasts ``f1..f{steps}`` of the
    original series (ARIMA(1,1,1), no constant).  Every series gives a row: one too
    short or too flat to estimate has nulls and says so in ``reason``."""
    keys = list(keys)
    x = indexed(df, keys, order, value)
    d = lags(x, keys, "idx", [value], [1]).where("idx > 0").select(*keys, "idx", (F.col(value) - F.col(f"{value}_lag1")).alias("d"))
    # step 1: long AR(m) on the differences (Yule-Walker from the ACF about zero mean); positions of d begin at 1
    wide = lags(d.withColumn("idx", F.col("idx") - 1), keys, "idx", ["d"], range(1, long_ar + 1)).withColumn("idx", F.col("idx") + 1)
    r = _autocorrelations(wide, keys, "d", long_ar)
    coef_schema = T.StructType([r.schema[k] for k in keys] +
                               [T.StructField("a", T.ArrayType(T.DoubleType()))])

    def ar_coef(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        _, a = durbin_levinson(pdf["acf"].to_numpy(dtype=float))
        out = pd.DataFrame({k: pdf[k].iloc[0] for k in keys}, index=range(1))
        out["a"] = [a.tolist()]
        return out

    a = r.groupBy(*keys).applyInPandas(ar_coef, coef_schema)
    full = null_safe_join(wide.where(F.col("idx") > long_ar), a.where(F.size("a") == long_ar), keys)
    fit = sum((F.col("a")[k - 1] * F.col(f"d_lag{k}") for k in range(2, long_ar + 1)), F.col("a")[0] * F.col("d_lag1"))
    e = full.select(*keys, (F.col("idx") - long_ar - 1).alias("idx"), "d", (F.col("d") - fit).alias("e"))
    # step 2: d_t on d_{t-1} and e_{t-1}
    reg = lags(e, keys, "idx", ["d", "e"], [1]).where("idx > 0").withColumnsRenamed({"d_lag1": "d1", "e_lag1": "e1"})
    g = reg.groupBy(*keys).agg(
        F.sum(F.col("d1") * F.col("d1")).alias("s11"), F.sum(F.col("d1") * F.col("e1")).alias("s12"),
        F.sum(F.col("e1") * F.col("e1")).alias("s22"), F.sum(F.col("d1") * F.col("d")).alias("s1y"),
        F.sum(F.col("e1") * F.col("d")).alias("s2y"), F.count(F.lit(1)).alias("m"))
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    g = g.select(*keys, "m", F.try_divide(F.col("s22") * F.col("s1y") - F.col("s12") * F.col("s2y"), det).alias("phi"),
                 F.try_divide(F.col("s11") * F.col("s2y") - F.col("s12") * F.col("s1y"), det).alias("theta"))
    res = null_safe_join(reg, g, keys).select(
        *keys, "idx", (F.col("d") - F.col("phi") * F.col("d1") - F.col("theta") * F.col("e1")).alias("eps"))
    sig = res.groupBy(*keys).agg(F.avg(F.col("eps") * F.col("eps")).alias("sigma2"),
                                 F.max_by("eps", "idx").alias("eps_T"), F.max("idx").alias("__t"))
    last = x.groupBy(*keys).agg(F.max_by(value, "idx").alias("x_T"), F.count(F.lit(1)).alias("n"))
    last_d = d.groupBy(*keys).agg(F.max_by("d", "idx").alias("d_T"))
    out = last
    for part in (last_d, g, sig):
        out = null_safe_join(out, part, keys, "left")
    step = F.col("phi") * F.col("d_T") + F.col("theta") * F.col("eps_T")
    level = F.col("x_T") + step
    cols = [level.alias("f1")]
    for h in range(2, steps + 1):
        step = F.col("phi") * step
        level = level + step
        cols.append(level.alias(f"f{h}"))
    reason = F.when(F.col("phi").isNull() | F.isnan("phi"), F.lit("too short or too flat to estimate"))
    return out.select(*keys, "phi", "theta", "sigma2", "n", *cols, reason.alias("reason"))


# ---------------------------------------------------------------- Shapiro-Wilk

def shapiro_wilk(df: DataFrame, value: str) -> tuple[float, float, int]:
    """W statistic and p-value (Royston's approximation, 1995).

    Order statistics come from a range-partitioned index; the normal scores
    m_i are computed per row by an Arrow-batched UDF; W is a ratio of two
    aggregates.  The p-value approximation is meant for 4 <= n <= 5000; above
    that W is still exact but p is an extrapolation."""
    s = df.select(F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    s = row_index(s.withColumn("__u", F.monotonically_increasing_id()), [], ["x", "__u"], out="i")
    n = s.count()
    if n < 3:
        raise ValueError("Shapiro-Wilk needs at least 3 values")

    @F.pandas_udf(T.DoubleType())
    def mscore(i: pd.Series) -> pd.Series:
        return pd.Series(D.norm_ppf_array(((i.to_numpy(dtype=float) + 1) - 0.375) / (n + 0.25)))

    s = s.withColumn("m", mscore(F.col("i"))).persist()  # read by two aggregates
    agg = s.agg(F.sum(F.col("m") * F.col("m")).alias("mm"), F.avg("x").alias("mean")).first()
    mm, mean = agg["mm"], agg["mean"]
    # fixed values: polynomial coefficients of the published approximation
    c1 = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
    c2 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
    u = 1.0 / math.sqrt(n)
    m_n = D.norm_ppf((n - 0.375) / (n + 0.25))
    m_n1 = D.norm_ppf((n - 1 - 0.375) / (n + 0.25))
    poly = lambda c: sum(ci * u ** k for k, ci in enumerate(c))
    a_n = m_n / math.sqrt(mm) + poly(c1)
    if n > 5:
        a_n1 = m_n1 / math.sqrt(mm) + poly(c2)
        phi = (mm - 2 * m_n ** 2 - 2 * m_n1 ** 2) / (1 - 2 * a_n ** 2 - 2 * a_n1 ** 2)
        edge = {n - 1: a_n, 0: -a_n, n - 2: a_n1, 1: -a_n1}
    else:
        phi = (mm - 2 * m_n ** 2) / (1 - 2 * a_n ** 2)
        edge = {n - 1: a_n, 0: -a_n}
    coef = F.col("m") / math.sqrt(phi)
    for i, v in edge.items():
        coef = F.when(F.col("i") == i, F.lit(v)).otherwise(coef)
    r = s.agg(F.sum(coef * F.col("x")).alias("num"),
              F.sum(F.pow(F.col("x") - F.lit(mean), 2)).alias("den")).first()
    s.unpersist()
    w = min(r["num"] ** 2 / r["den"], 1.0) if r["den"] > 0 else 1.0
    if n == 3:
        p = max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    elif n <= 11:
        gamma = 0.459 * n - 2.273
        wt = -math.log(gamma - math.log1p(-w)) if w < 1 else float("inf")
        mu = 0.5440 - 0.39978 * n + 0.025054 * n ** 2 - 0.0006714 * n ** 3
        sd = math.exp(1.3822 - 0.77857 * n + 0.062767 * n ** 2 - 0.0020322 * n ** 3)
        p = D.norm_sf((wt - mu) / sd)
    else:
        ln = math.log(n)
        mu = 0.0038915 * ln ** 3 - 0.083751 * ln ** 2 - 0.31082 * ln - 1.5861
        sd = math.exp(0.0030302 * ln ** 2 - 0.082676 * ln - 0.4803)
        p = D.norm_sf((math.log1p(-w) - mu) / sd) if w < 1 else 1.0
    return w, p, n
