"""Scalar column expressions used by cleaning and feature engineering.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none of them needs a Python worker.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def equals_flag(c: str | Column, value) -> Column:
    """``(c == value)`` as 0/1 where a missing value counts as 0."""
    return F.coalesce((col_(c) == F.lit(value)).cast("int"), F.lit(0))


def map_values(c: str | Column, mapping: Mapping, strict: bool = True) -> Column:
    """Map values to codes.  Unmapped values give null, or raise when strict."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(col_(c) == F.lit(k), F.lit(v)) if expr is None else expr.when(col_(c) == F.lit(k), F.lit(v))
    if strict:
        return expr.otherwise(F.raise_error(F.concat(F.lit("unmapped value: "), col_(c).cast("string"))))
    return expr


def coerce_double(c: str | Column) -> Column:
    """Coercing numeric parse: blank or non-numeric text becomes null."""
    text = F.trim(col_(c).cast("string"))
    return F.when(text == "", F.lit(None).cast("double")).otherwise(text.try_cast("double"))


def replace_values(df: DataFrame, mapping: Mapping[str, str], subset: Sequence[str]) -> DataFrame:
    """Replace listed values in ``subset`` columns and keep all others."""
    return df.replace(dict(mapping), subset=list(subset))


def count_matches(cols: Iterable[str | Column], value) -> Column:
    """Row-wise count of columns equal to ``value``."""
    terms = [equals_flag(c, value) for c in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def floor_ratio(num: str | Column, den: str | Column, floor: float = 1) -> Column:
    """``num / max(den, floor)``."""
    return col_(num) / F.greatest(col_(den).cast("double"), F.lit(float(floor)))


def right_closed_bins(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label ``(e_i, e_{i+1}]`` intervals; values outside all bins give null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    x = col_(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def threshold_flag(c: str | Column, cut: float, op: str = "<=") -> Column:
    x = col_(c)
    cond = {"<=": x <= cut, "<": x < cut, ">=": x >= cut, ">": x > cut}[op]
    return cond.cast("int")


def membership_flag(c: str | Column, values: Sequence) -> Column:
    return F.coalesce(col_(c).isin(list(values)).cast("int"), F.lit(0))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (result tables compared across engines)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
