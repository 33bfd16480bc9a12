"""Queries: per-user event series — ACF, PACF, ARIMA(1,1,1) forecasts — and the
Shapiro-Wilk test on regression residuals (W2, W3, H6, H10, H11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions.expressions import round_doubles
from tabula.operators import linear as L
from tabula.operators import series as SR
from tabula.plans.registry import register
from tabula.sources.tables import table

NLAGS = 10


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")


_ACF_SQL = """
WITH s AS (SELECT user_id, ts, event_id, value - avg(value) OVER (PARTITION BY user_id) AS z FROM events),
l AS (SELECT user_id, z, """ + ", ".join(
    f"lag(z, {k}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS l{k}" for k in range(1, NLAGS + 1)) + """
      FROM s),
den AS (SELECT user_id, sum(z * z) AS ss FROM s GROUP BY user_id),
num AS (""" + "\nUNION ALL\n".join(
    f"SELECT user_id, {k} AS lag, sum(z * l{k}) AS nm, count(l{k}) AS c FROM l GROUP BY user_id"
    for k in range(1, NLAGS + 1)) + """)
SELECT num.user_id, CAST(lag AS INTEGER) AS lag, round(nm / ss, 6) AS acf FROM num JOIN den USING (user_id)
WHERE c > 0"""


@register("acf", _ACF_SQL)
def acf(spark, sf_dir):
    """Autocorrelation of each user's event values in time order, lags 1..10."""
    out = SR.acf(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", NLAGS)
    return round_doubles(out.withColumn("lag", F.col("lag").cast("int")), 6)


@register("pacf")
def pacf(spark, sf_dir):
    """Partial autocorrelations (Durbin-Levinson on each user's ACF)."""
    a = SR.acf(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", NLAGS)
    return SR.pacf(a.withColumn("lag", F.col("lag").cast("int")), ["user_id"])


@register("pacf_low_lags", f"""
WITH a AS ({_ACF_SQL.replace("round(nm / ss, 6)", "nm / ss")}),
r AS (SELECT user_id, max(CASE WHEN lag = 1 THEN acf END) AS r1, max(CASE WHEN lag = 2 THEN acf END) AS r2,
             max(CASE WHEN lag = 3 THEN acf END) AS r3 FROM a GROUP BY user_id),
p AS (SELECT user_id, 1 AS lag, r1 AS pacf FROM r
  UNION ALL SELECT user_id, 2, (r2 - r1 * r1) / (1 - r1 * r1) FROM r
  UNION ALL SELECT user_id, 3, (pow(r1, 3) - r1 * r2 * (2 - r2) + r3 * (1 - r1 * r1)) / (1 - r2 * r2 - 2 * r1 * r1 * (1 - r2)) FROM r)
SELECT user_id, CAST(lag AS INTEGER) AS lag, round(pacf, 5) AS pacf FROM p WHERE pacf IS NOT NULL""")
def pacf_low_lags(spark, sf_dir):
    """The first three partial autocorrelations, which have closed forms."""
    return round_doubles(pacf(spark, sf_dir).where("lag <= 3"), 5)


@register("arima_forecast")
def arima_forecast(spark, sf_dir):
    """ARIMA(1,1,1) per user (Hannan-Rissanen) and 5-step forecasts."""
    return SR.arima111(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", steps=5)


@register("shapiro_wilk_residuals")
def shapiro_wilk_residuals(spark, sf_dir):
    """Normality of the residuals of price ~ quantity + discount on all line items."""
    li = table(spark, sf_dir, "lineitem")
    fit = L.ols(li, ["l_quantity", "l_discount"], "l_extendedprice")
    res = li.select((F.col("l_extendedprice") - fit.predict()).alias("resid"))
    w, p, n = SR.shapiro_wilk(res, "resid")
    return spark.createDataFrame([(float(w), float(p), int(n))], "w double, p_value double, n bigint")
