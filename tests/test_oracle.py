"""Registered queries against their DuckDB oracle (sf0.001 here; the driver and
tools/oracle_check.py run sf0.01)."""

import math

import pytest

from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 5)
        return 0.0 if r == 0 else r
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


FAST = ["chi_square", "welch_ttest", "churn_features", "null_counts", "describe_lineitem",
        "density_histogram", "stratified_folds", "orders_running_max", "roc_auc", "roc_curve",
        "classification_report", "design_matrix", "mode_imputed", "ols_coefficients", "anova_type1",
        "hc3_errors", "formula_design"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, drows)


def test_every_oracle_has_a_query():
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0 and "chi2" in df.columns
