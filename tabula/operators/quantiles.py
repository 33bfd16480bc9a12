"""Exact quantiles without gathering a column in one task.

Spark's exact ``percentile`` aggregate keeps every distinct value of a group in
one map, so a global quantile over a large table ends in one task holding the
whole column.  Here each order statistic is found by narrowing a value interval:
every pass is one scan that counts values per (target, bucket) over ``buckets``
equal-width buckets of the target's current interval (map-side partial
aggregation, at most targets x buckets rows leave the executors).  The bucket
that holds the wanted rank becomes the next interval.  A target is resolved when
its bucket holds a single distinct value, or few enough values
(``gather_limit``) to be fetched and ranked directly.

Quantiles use linear interpolation between order statistics floor((n-1)p) and
ceil((n-1)p), the rule used by pandas and numpy.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    buckets: int = 1024, gather_limit: int = 4096,
                    max_passes: int = 64) -> DataFrame:
    """Return ``(column, prob, value)`` with exact interpolated quantiles."""
    spark = df.sparkSession
    cols = list(cols)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = data.agg(*[x for c in cols for x in (
            F.count(F.col(c)).alias(f"{c}__n"), F.min(c).alias(f"{c}__lo"),
            F.max(c).alias(f"{c}__hi"))]).first()
        # target = (column, rank); state = [lo, hi, below]
        pending: dict[tuple[str, int], list] = {}
        resolved: dict[tuple[str, int], float] = {}
        for c in cols:
            n = first[f"{c}__n"]
            if not n:
                continue
            for p in probs:
                pos = (n - 1) * p
                for k in {math.floor(pos), math.ceil(pos)}:
                    key = (c, int(k))
                    if first[f"{c}__lo"] == first[f"{c}__hi"]:
                        resolved[key] = first[f"{c}__lo"]
                    else:
                        pending[key] = [first[f"{c}__lo"], first[f"{c}__hi"], 0]
        passes = 0
        while pending and passes < max_passes:
            passes += 1
            # targets on the same column and interval share one histogram
            groups: dict[tuple, list] = {}
            for key, (lo, hi, below) in pending.items():
                groups.setdefault((key[0], lo, hi, below), []).append(key)
            ivals = list(groups)
            entries = []
            for gid, (c, lo, hi, _b) in enumerate(ivals):
                x = F.col(c)
                inside = (x >= F.lit(lo)) & (x <= F.lit(hi))
                b = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * buckets), F.lit(buckets - 1))
                entries.append(F.when(inside, F.struct(F.lit(gid).alias("t"), b.cast("int").alias("b"),
                                                       x.alias("x"))))
            hist = (data.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
                    .groupBy(F.col("e.t").alias("t"), F.col("e.b").alias("b"))
                    .agg(F.count(F.lit(1)).alias("n"), F.min("e.x").alias("mn"), F.max("e.x").alias("mx"))
                    .collect())  # at most intervals x buckets rows
            by_t: dict[int, list] = {}
            for r in hist:
                by_t.setdefault(r["t"], []).append(r)
            gathers = []
            for gid, (c, lo, hi, below) in enumerate(ivals):
                rows = sorted(by_t.get(gid, []), key=lambda r: r["b"])
                for key in groups[(c, lo, hi, below)]:
                    cum = below
                    for r in rows:
                        if cum + r["n"] > key[1]:
                            if r["mn"] == r["mx"]:
                                resolved[key] = r["mn"]
                                del pending[key]
                            elif r["n"] <= gather_limit:
                                gathers.append((key, r["mn"], r["mx"], cum))
                            else:
                                pending[key] = [r["mn"], r["mx"], cum]
                            break
                        cum += r["n"]
            if gathers:
                # one job fetches every small final set (each at most gather_limit values)
                spans = sorted({(key[0], lo, hi) for key, lo, hi, _ in gathers})
                parts = [F.when((F.col(c) >= lo) & (F.col(c) <= hi),
                                F.struct(F.lit(i).alias("s"), F.col(c).alias("x"))) for i, (c, lo, hi) in enumerate(spans)]
                got = data.select(F.explode(F.filter(F.array(*parts), lambda e: e.isNotNull())).alias("e")) \
                    .select("e.s", "e.x").collect()
                vals: dict[int, list] = {}
                for r in got:
                    vals.setdefault(r["s"], []).append(r["x"])
                index = {sp: i for i, sp in enumerate(spans)}
                for key, lo, hi, below in gathers:
                    v = sorted(vals[index[(key[0], lo, hi)]])
                    resolved[key] = v[key[1] - below]
                    del pending[key]
        if pending:
            raise RuntimeError(f"quantile search did not converge for {sorted(pending)}")
        out = []
        for c in cols:
            n = first[f"{c}__n"]
            for p in probs:
                if not n:
                    out.append((c, float(p), None))
                    continue
                pos = (n - 1) * p
                lo_k, hi_k = math.floor(pos), math.ceil(pos)
                a, b = resolved[(c, lo_k)], resolved[(c, hi_k)]
                out.append((c, float(p), a + (pos - lo_k) * (b - a)))
    finally:
        data.unpersist()
    return spark.createDataFrame(out, "column string, prob double, value double")
