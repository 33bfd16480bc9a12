"""Queries: feature transformers fitted on the training split and applied to
all rows (T2-T6, T8)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabula.functions.expressions import round_doubles
from tabula.operators import features as FE
from tabula.operators import split as SP
from tabula.plans import churn as CH
from tabula.plans.oracle_sql import with_churn
from tabula.plans.registry import register
from tabula.sources.tables import table

SCALE_COLS = ["tenure", "monthly", "total_charges"]
NOMINAL = ["segment", "region", "phone"]
_TRAIN = "CAST(('0x' || substr(md5(concat(CAST(id AS VARCHAR), ':42')), 1, 8)) AS BIGINT) % 100 >= 20"


def _with_split(spark, sf_dir):
    return SP.with_split_flag(CH.churn_table(spark, sf_dir), "id", 0.2, 42)


@register("scaled_numeric", with_churn(
    "st AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE_COLS) + f" FROM churn_t WHERE {_TRAIN})\n"
    "SELECT id, " + ", ".join(
        f"round((CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END, 6) AS {c}_z"
        for c in SCALE_COLS) + " FROM churn_t, st"))
def scaled_numeric(spark, sf_dir):
    """Population-std scaling fitted on the training rows, applied to every row."""
    df = _with_split(spark, sf_dir)
    model = FE.PopulationScaler(inputCols=SCALE_COLS, outputCols=[f"{c}_z" for c in SCALE_COLS]) \
        .fit(df.where("is_test = 0"))
    return round_doubles(model.transform(df).select("id", *[f"{c}_z" for c in SCALE_COLS]), 6)


_HOLES = {"segment": 7, "region": 5, "senior": 9}


def _holed(spark, sf_dir):
    df = _with_split(spark, sf_dir)
    return df.withColumns({c: F.when(F.col("id") % m == 0, F.lit(None).cast(df.schema[c].dataType))
                          .otherwise(F.col(c)) for c, m in _HOLES.items()})


_HOLED_SQL = ("holed AS (SELECT id, " + ", ".join(
    f"CASE WHEN id % {m} = 0 THEN NULL ELSE {c} END AS {c}" for c, m in _HOLES.items())
    + f", {_TRAIN} AS is_train FROM churn_t)")


@register("mode_imputed", with_churn(
    _HOLED_SQL + ",\n" + ",\n".join(
        f"mode_{c} AS (SELECT {c} AS v FROM holed WHERE is_train AND {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 1)" for c in _HOLES)
    + "\nSELECT id, " + ", ".join(f"coalesce({c}, (SELECT v FROM mode_{c})) AS {c}" for c in _HOLES)
    + " FROM holed"))
def mode_imputed(spark, sf_dir):
    """Most-frequent imputation (strings and integers) fitted on the training rows."""
    df = _holed(spark, sf_dir)
    model = FE.ModeImputer(inputCols=list(_HOLES)).fit(df.where("is_test = 0"))
    return model.transform(df).select("id", *_HOLES)


_SEG_LEVELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]


@register("one_hot_unknown", with_churn(
    "SELECT id, " + ", ".join(
        f"CASE WHEN segment = '{lv}' THEN 1.0 ELSE 0.0 END AS segment_{lv}" for lv in _SEG_LEVELS)
    + " FROM churn_t"))
def one_hot_unknown(spark, sf_dir):
    """One-hot fitted without the HOUSEHOLD segment: that level is unknown at
    transform time and encodes as all zeros."""
    df = CH.churn_table(spark, sf_dir)
    model = FE.Pipeline(stages=FE.one_hot_stages(["segment"])).fit(df.where("segment <> 'HOUSEHOLD'"))
    labels = model.stages[0].labelsArray[0]
    out = model.transform(df).withColumn("__a", vector_to_array("segment_oh"))
    return out.select("id", *[F.col("__a")[i].alias(f"segment_{lv}") for i, lv in enumerate(labels)])


@register("ordinal_codes", """
WITH lv AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code
            FROM (SELECT DISTINCT o_orderpriority AS v FROM orders WHERE o_orderpriority <> '5-LOW'))
SELECT o_orderkey, coalesce(code, -1.0) AS priority_code
FROM orders LEFT JOIN lv ON o_orderpriority = v""")
def ordinal_codes(spark, sf_dir):
    """Alphabetical ordinal codes fitted without '5-LOW'; that level maps to -1."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    model = FE.OrdinalEncoder(inputCols=["o_orderpriority"], outputCols=["priority_code"]) \
        .fit(o.where("o_orderpriority <> '5-LOW'"))
    return model.transform(o).select("o_orderkey", "priority_code")


def _design_sql():
    nums = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE_COLS)
    parts = []
    for i, c in enumerate(SCALE_COLS):
        parts.append(f"SELECT id, {i} AS slot, (CAST({c} AS DOUBLE) - m_{c}) / "
                     f"CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END AS value FROM te, st")
    offset_terms = []
    for c in NOMINAL:
        off = f"{len(SCALE_COLS)}" + "".join(f" + (SELECT count(*) FROM lv_{p})" for p in offset_terms)
        parts.append(f"SELECT id, {off} + code AS slot, 1.0 AS value FROM te JOIN lv_{c} ON {c} = v")
        offset_terms.append(c)
    levels = ",\n".join(
        f"lv_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM "
        f"(SELECT DISTINCT {c} AS v FROM churn_t WHERE {_TRAIN} AND {c} IS NOT NULL))" for c in NOMINAL)
    return with_churn(
        f"st AS (SELECT {nums} FROM churn_t WHERE {_TRAIN}),\n{levels},\n"
        f"te AS (SELECT * FROM churn_t WHERE NOT ({_TRAIN})),\n"
        f"d AS ({' UNION ALL '.join(parts)})\n"
        "SELECT id, CAST(slot AS INTEGER) AS slot, round(value, 6) AS value FROM d WHERE value <> 0")


@register("design_matrix", _design_sql())
def design_matrix(spark, sf_dir):
    """Column transformer (scaled numerics + one-hot nominals, assembled in that
    order) fitted on training rows; the test rows' vectors as (id, slot, value)
    non-zero entries."""
    df = _with_split(spark, sf_dir)
    pipe = FE.preprocessing_pipeline(SCALE_COLS, NOMINAL)
    model = pipe.fit(df.where("is_test = 0"))
    out = model.transform(df.where("is_test = 1"))
    long = out.select("id", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return round_doubles(long.where(F.col("value") != 0).select("id", F.col("slot").cast("int"), "value"), 6)
