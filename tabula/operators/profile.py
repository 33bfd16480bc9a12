"""Profiling aggregates (A1-A10): shape, null counts, column info, describe,
value counts, distinct values, crosstab, group means, density histograms and
on/off mean differences.

Every operator is one scan with map-side partial aggregation: many columns are
summarised by a single ``agg`` whose one-row result is stacked into a long table,
never by one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.session import cut_lineage
from tabula.operators.quantiles import exact_quantiles


def _stack(wide: DataFrame, names: Sequence[str], fields: Sequence[str], key: str = "column") -> DataFrame:
    """Turn a one-row frame with ``<name>__<field>`` columns into one row per name."""
    parts = ", ".join(
        "'" + n.replace("'", "''") + "', " + ", ".join(f"`{n}__{f}`" for f in fields) for n in names)
    return wide.select(F.expr(f"stack({len(names)}, {parts}) as ({key}, {', '.join(fields)})"))


def shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_cols)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("bigint"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count per column: one aggregate, stacked to ``(column, null_count)``."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(f"{c}__nulls") for c in cols])
    out = _stack(wide, cols, ["nulls"])
    return out.select("column", F.coalesce("nulls", F.lit(0)).cast("bigint").alias("null_count"))


def column_info(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, position, dtype, non_null)`` — the data behind ``info()``."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wide = df.agg(*[F.count(F.col(c)).alias(f"{c}__nn") for c in cols])
    out = _stack(wide, cols, ["nn"])
    meta = df.sparkSession.createDataFrame(
        [(c, i, types[c]) for i, c in enumerate(cols)], "column string, position int, dtype string")
    return out.join(meta, "column").select(
        "column", "position", "dtype", F.col("nn").cast("bigint").alias("non_null"))


def describe(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, sample std, min, exact quartiles (linear interpolation), max;
    one row per column (the transposed ``describe()``)."""
    cols = list(cols)
    wide = df.agg(*[
        agg for c in cols for agg in (
            F.count(F.col(c)).alias(f"{c}__count"),
            F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
            F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__std"),
            F.min(F.col(c).cast("double")).alias(f"{c}__min"),
            F.max(F.col(c).cast("double")).alias(f"{c}__max"))])
    moments = _stack(wide, cols, ["count", "mean", "std", "min", "max"])
    q = exact_quantiles(df, cols, probs)
    qnames = [f"q{int(round(p * 100)):02d}" for p in probs]
    qwide = q.groupBy("column").pivot("prob", list(probs)).agg(F.first("value"))
    for p, name in zip(probs, qnames):
        qwide = qwide.withColumnRenamed(str(p), name)
    return moments.join(qwide, "column", "left").select(
        "column", F.col("count").cast("bigint").alias("count"), "mean", "std", "min", *qnames, "max")


def value_counts(df: DataFrame, col: str, normalize: bool = True) -> DataFrame:
    """Counts per value (nulls dropped) and their share of non-null rows."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return counts
    total = df.agg(F.count(F.col(col))).first()[0]  # one scalar, computed by Spark
    return counts.select(col, "count", (F.col("count") / F.lit(float(total or 1))).alias("share"))


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def crosstab(df: DataFrame, row: str, column: str, levels: Sequence | None = None) -> DataFrame:
    """Contingency counts, wide; pass ``levels`` to skip the extra distinct pass."""
    g = df.where(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(row)
    pivoted = g.pivot(column, list(levels) if levels is not None else None).count()
    return pivoted.na.fill(0)


def group_means(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Mean of each feature per label value, long: ``(feature, <label>, mean)``."""
    from tabula.operators.stattests import long_form
    return (long_form(df, features, [label], value_type="double")
            .groupBy("feature", label).agg(F.avg("value").alias("mean")))


def density_histogram(df: DataFrame, features: Sequence[str], group: str | None = None,
                      bins: int = 50, density: bool = True) -> DataFrame:
    """Equal-width histogram over each (feature, group)'s own min..max, last edge
    closed; empty bins are omitted.  ``density`` divides by ``n * width``."""
    from tabula.operators.stattests import long_form
    gcols = [group] if group else []
    long = long_form(df, features, gcols, value_type="double").where(F.col("value").isNotNull())
    keys = ["feature", *gcols]
    rng = long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                  F.count(F.lit(1)).alias("n"))
    lo = F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5)
    hi = F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("hi") + 0.5)
    # one row per feature and group value; Spark's own size check decides on a broadcast,
    # and with more groups the join splits a hot one, both sides being stored
    rng = cut_lineage(rng.select(*keys, lo.alias("lo"), hi.alias("hi"), "n"))
    idx = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
                  F.lit(bins - 1)).cast("int")
    counted = (long.join(rng, keys).select(*keys, idx.alias("bin"), "lo", "hi", "n")
               .groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"),
                                          F.first("lo").alias("lo"), F.first("hi").alias("hi"),
                                          F.first("n").alias("n")))
    width = (F.col("hi") - F.col("lo")) / bins
    out = counted.select(
        *keys, "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        "count",
        (F.col("count") / (F.col("n") * width)).alias("density") if density
        else F.lit(None).cast(T.DoubleType()).alias("density"))
    return out


def on_off_difference(df: DataFrame, flags: Sequence[str], value: str) -> DataFrame:
    """For each 0/1 flag: mean(value | on) - mean(value | off), only when both
    sides are non-empty.  ``(flag, mean_on, mean_off, delta)``."""
    aggs = []
    for f in flags:
        on = F.col(f).cast("boolean")
        v = F.col(value).cast("double")
        aggs += [F.avg(F.when(on, v)).alias(f"{f}__on"), F.avg(F.when(~on, v)).alias(f"{f}__off")]
    out = _stack(df.agg(*aggs), flags, ["on", "off"], key="flag")
    return (out.where(F.col("on").isNotNull() & F.col("off").isNotNull())
            .select("flag", F.col("on").alias("mean_on"), F.col("off").alias("mean_off"),
                    (F.col("on") - F.col("off")).alias("delta")))
