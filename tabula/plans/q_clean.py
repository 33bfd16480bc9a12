"""Queries: ordering operators — position index, running max, lag difference,
top-k and arg-best (W1, W3, L1-L5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions.expressions import round_doubles
from tabula.operators import ordering as OR
from tabula.plans.registry import register
from tabula.sources.tables import table


@register("orders_running_max", """
SELECT o_orderkey, o_custkey,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS idx,
       round(max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS running_max
FROM orders""")
def orders_running_max(spark, sf_dir):
    """Best-so-far curve and position per customer over its orders in date order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    order = ["o_orderdate", "o_orderkey"]
    idx = OR.row_index(o, ["o_custkey"], order, out="idx")
    rm = OR.running_max(idx, ["o_custkey"], order, "o_totalprice", out="running_max")
    return round_doubles(rm.select("o_orderkey", "o_custkey", "idx", "running_max"), 6)


@register("events_first_difference", """
SELECT event_id, user_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS idx,
       round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS diff
FROM events""")
def events_first_difference(spark, sf_dir):
    """First difference of each user's event values in time order (ARIMA d=1)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    idx = OR.row_index(ev, ["user_id"], ["ts", "event_id"], out="idx")
    d = OR.first_difference(idx, ["user_id"], "idx", "value", out="diff")
    return round_doubles(d.select("event_id", "user_id", "idx", "diff"), 6)


@register("top_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return OR.top_k(o, 10, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@register("best_customer_per_segment", """
SELECT c_mktsegment, c_custkey, c_acctbal FROM (
  SELECT c_mktsegment, c_custkey, c_acctbal,
         row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn
  FROM customer) WHERE rn = 1""")
def best_customer_per_segment(spark, sf_dir):
    """Arg-max per group as a struct max aggregate (ties to the lowest key)."""
    c = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return OR.arg_best(c, "c_acctbal", "c_custkey", maximize=True, keys=["c_mktsegment"]) \
        .select("c_mktsegment", "c_custkey", "c_acctbal")
