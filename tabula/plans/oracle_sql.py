"""Reference SQL (DuckDB dialect) for the registered queries.

Every statement recomputes its result from the raw tables so the DuckDB run is
an independent check of the Spark plan.  Doubles are rounded to 6 decimals on
both sides before comparison; integer aggregates are cast to BIGINT.
"""

from __future__ import annotations

# Churn-style customer table: same definition as tabula.plans.churn.
CHURN_CTES = """
li AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_ret
  FROM lineitem GROUP BY l_orderkey),
pc AS (
  SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
         count(*) AS n_orders, avg(o_totalprice) AS avg_price, sum(o_totalprice) AS sum_price,
         sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS n_open,
         sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_urgent,
         sum(coalesce(n_ret, 0)) AS n_ret, sum(coalesce(n_lines, 0)) AS n_lines
  FROM orders LEFT JOIN li ON o_orderkey = l_orderkey GROUP BY o_custkey),
geo AS (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
raw AS (
  SELECT c_custkey AS id, c_mktsegment AS segment, r_name AS region,
         CAST(c_acctbal < 0 AS BIGINT) AS senior,
         CAST(floor(date_diff('day', CAST(first_order AS DATE), CAST(last_order AS DATE)) / 30) AS BIGINT) AS tenure,
         avg_price / 1000 AS monthly,
         CASE WHEN c_custkey % 17 = 0 THEN ' ' ELSE CAST(sum_price / 1000 AS VARCHAR) END AS total_charges,
         CASE WHEN n_open >= 3 THEN 'Yes' ELSE 'No' END AS phone,
         CASE WHEN n_open < 3 THEN 'No phone service' WHEN n_orders > 10 THEN 'Yes' ELSE 'No' END AS multi,
         CASE WHEN c_custkey % 11 = 0 THEN 'No internet service' WHEN n_urgent >= 2 THEN 'Yes' ELSE 'No' END AS security,
         CASE WHEN c_custkey % 11 = 0 THEN 'No internet service' WHEN n_ret * 3 > n_lines THEN 'Yes' ELSE 'No' END AS backup,
         CASE WHEN last_order < TIMESTAMP '2001-01-01' THEN 'Yes' ELSE 'No' END AS churned
  FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey LEFT JOIN pc ON c_custkey = o_custkey),
cleaned AS (
  SELECT * FROM (
    SELECT id, segment, region, senior, tenure, monthly,
           CASE WHEN trim(total_charges) = '' THEN NULL ELSE TRY_CAST(trim(total_charges) AS DOUBLE) END AS total_charges,
           phone,
           CASE WHEN multi IN ('No internet service', 'No phone service') THEN 'No' ELSE multi END AS multi,
           CASE WHEN security IN ('No internet service', 'No phone service') THEN 'No' ELSE security END AS security,
           CASE WHEN backup IN ('No internet service', 'No phone service') THEN 'No' ELSE backup END AS backup,
           churned, coalesce(CAST(churned = 'Yes' AS INTEGER), 0) AS churn
    FROM raw) WHERE total_charges IS NOT NULL),
churn_t AS (
  SELECT *,
    CAST((CASE WHEN phone = 'Yes' THEN 1 ELSE 0 END) + (CASE WHEN multi = 'Yes' THEN 1 ELSE 0 END)
       + (CASE WHEN security = 'Yes' THEN 1 ELSE 0 END) + (CASE WHEN backup = 'Yes' THEN 1 ELSE 0 END) AS INTEGER) AS num_services,
    CAST((CASE WHEN security = 'Yes' THEN 1 ELSE 0 END) + (CASE WHEN backup = 'Yes' THEN 1 ELSE 0 END) AS INTEGER) AS num_addons,
    total_charges / greatest(CAST(tenure AS DOUBLE), 1.0) AS avg_charge_per_month,
    monthly / greatest(CAST((CASE WHEN phone = 'Yes' THEN 1 ELSE 0 END) + (CASE WHEN multi = 'Yes' THEN 1 ELSE 0 END)
       + (CASE WHEN security = 'Yes' THEN 1 ELSE 0 END) + (CASE WHEN backup = 'Yes' THEN 1 ELSE 0 END) AS DOUBLE), 1.0) AS charge_per_service,
    CASE WHEN tenure > 0 AND tenure <= 6 THEN '0-6m' WHEN tenure > 6 AND tenure <= 12 THEN '7-12m'
         WHEN tenure > 12 AND tenure <= 24 THEN '13-24m' WHEN tenure > 24 AND tenure <= 48 THEN '25-48m'
         WHEN tenure > 48 AND tenure <= 72 THEN '49-72m' END AS tenure_bin,
    CAST(tenure <= 6 AS INTEGER) AS is_new_customer,
    coalesce(CAST(segment IN ('AUTOMOBILE', 'BUILDING') AS INTEGER), 0) AS auto_pay,
    ln(1 + CAST(tenure AS DOUBLE)) AS log_tenure,
    ln(1 + total_charges) AS log_total_charges
  FROM cleaned)
"""


def with_churn(body: str) -> str:
    body = body.strip()
    sep = "\n" if body[:6].upper() == "SELECT" else ",\n"
    return "WITH " + CHURN_CTES.strip() + sep + body


def union_long(features, value_expr="CAST({c} AS VARCHAR)", extra="churn", source="churn_t"):
    parts = [f"SELECT '{c}' AS feature, {value_expr.format(c=c)} AS value, {extra} FROM {source}"
             for c in features]
    return "\nUNION ALL\n".join(parts)


def chi2_tail(x: str, dof: str, terms: int = 3000) -> str:
    """Upper tail of chi-square: 1 minus the series of the lower incomplete gamma."""
    a, h = f"({dof} / 2.0)", f"(greatest({x}, 1e-300) / 2.0)"
    return (f"CASE WHEN {dof} = 0 THEN 1.0 ELSE greatest(0.0, 1.0 - list_sum(list_transform(range(0, {terms}), "
            f"lambda i: exp(({a} + i) * ln({h}) - {h} - lgamma({a} + i + 1))))) END")


def beta_upper(y: str, a: str, b: str, terms: int = 20000) -> str:
    """1 - I_y(a, b), I by its hypergeometric series in y."""
    front = f"({a} * ln({y}) + {b} * ln(1.0 - {y}) - ln({a}) - lgamma({a}) - lgamma({b}) + lgamma({a} + {b}))"
    term = f"lgamma({a} + {b} + i) - lgamma({a} + {b}) - lgamma({a} + 1 + i) + lgamma({a} + 1) + i * ln({y})"
    return f"greatest(0.0, 1.0 - list_sum(list_transform(range(0, {terms}), lambda i: exp({front} + {term}))))"


def t_tail(t: str, dof: str, terms: int = 20000) -> str:
    """Two-sided tail of Student's t."""
    return beta_upper(f"greatest({t} * {t} / ({dof} + {t} * {t}), 1e-300)", "0.5", f"({dof} / 2.0)", terms)


def f_tail(f: str, d1: str, d2: str, terms: int = 20000) -> str:
    """Upper tail of F."""
    return beta_upper(f"({d1} * {f} / ({d2} + {d1} * {f}))", f"({d1} / 2.0)", f"({d2} / 2.0)", terms)
