"""Order-dependent operators that stay balanced when one key holds a large share
of the rows.

A window partitioned by a key puts each key in one task; a hot key then sorts
and scans in a single task.  Here rows are first range-partitioned on
(keys, order) — a hot key is split across consecutive range partitions — and
each partition is processed locally.  What crosses partition boundaries is a
small per-(partition, key) summary (a count or a maximum), combined with a
window over that summary table, whose size is about partitions + keys.

``row_index``   0-based position of each row inside its key group
``running_max`` maximum of a value over all earlier rows of the key group
``lags``        values k positions earlier, from blocks that bring the last rows of the block before
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.session import cut_lineage

_PID = "__pid"
_MID = "__mid"


def _ordered(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which a null key equals a null key; the keys of
    ``left`` stay."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def _ranged(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
            num_partitions: int | None = None) -> DataFrame:
    """Range-partition, sort within partitions and tag rows with (partition, id).

    The tags depend on the sampled range bounds, so the tagged rows are written
    once to the shared checkpoint folder; both the per-segment summary and the
    rows read that single copy (also what a retried task reads after an
    executor is lost)."""
    cols = [*_ordered(keys), *_ordered(order_by)]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *cols)
              .sortWithinPartitions(*cols)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id()))
    return cut_lineage(tagged)


def row_index(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
              out: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row within its ``keys`` group.

    ``keys + order_by`` must be a total order (end it with a unique column)
    for the result to be deterministic.  Equivalent to
    ``row_number() over (partition by keys order by order_by) - 1``.
    """
    keys = list(keys)
    ranged = _ranged(df, keys, order_by, num_partitions)
    seg = ranged.groupBy(_PID, *keys).agg(F.count(F.lit(1)).alias("__n"), F.min(_MID).alias("__first"))
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    joined = null_safe_join(ranged, seg.select(_PID, *keys, "__first", "__off"), [_PID, *keys])
    return joined.withColumn(out, (F.col(_MID) - F.col("__first") + F.col("__off")).cast("bigint")) \
        .drop(_PID, _MID, "__first", "__off")


def running_max(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                value: str, out: str = "running_max", num_partitions: int | None = None) -> DataFrame:
    """Maximum of ``value`` over rows up to and including the current one,
    within each key group, in ``order_by`` order (best-so-far curve)."""
    keys = list(keys)
    ranged = _ranged(df, keys, order_by, num_partitions)
    seg = ranged.groupBy(_PID, *keys).agg(F.max(value).alias("__pmax"))
    w_prev = (Window.partitionBy(*keys) if keys else Window).orderBy(_PID) \
        .rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("__carry", F.max("__pmax").over(w_prev)).drop("__pmax")
    joined = null_safe_join(ranged, seg, [_PID, *keys])
    w_local = (Window.partitionBy(_PID, *keys).orderBy(_MID)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = F.max(value).over(w_local)
    return joined.withColumn(out, F.greatest(local, F.col("__carry"))).drop(_PID, _MID, "__carry")


def prefix_sum(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
               values: Sequence[str], suffix: str = "_cum", inclusive: bool = True,
               num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``values`` within each key group in ``order_by`` order
    (with ``inclusive=False`` the current row is excluded)."""
    keys = list(keys)
    ranged = _ranged(df, keys, order_by, num_partitions)
    seg = ranged.groupBy(_PID, *keys).agg(*[F.sum(v).alias(f"__s_{v}") for v in values])
    w_prev = (Window.partitionBy(*keys) if keys else Window).orderBy(_PID) \
        .rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select(_PID, *keys, *[F.coalesce(F.sum(f"__s_{v}").over(w_prev), F.lit(0)).alias(f"__c_{v}")
                                    for v in values])
    joined = null_safe_join(ranged, seg, [_PID, *keys])
    end = Window.currentRow if inclusive else -1
    w_local = Window.partitionBy(_PID, *keys).orderBy(_MID).rowsBetween(Window.unboundedPreceding, end)
    for v in values:
        joined = joined.withColumn(f"{v}{suffix}", F.coalesce(F.sum(v).over(w_local), F.lit(0)) + F.col(f"__c_{v}"))
    return joined.drop(_PID, _MID, *[f"__c_{v}" for v in values])


LAG_BLOCK = 65_536  # rows of a key that one window partition holds


def lags(df: DataFrame, keys: Sequence[str], idx: str, values: Sequence[str], ks: Sequence[int], block: int | None = None) -> DataFrame:
    """``df`` with ``<value>_lag<k>``: the value ``k`` positions earlier in the key group, null where
    there is none.

    A key's rows are cut into blocks of consecutive positions, and the last rows of each block go to the next
    one as well, so a window over (key, block) sees all it needs: one shuffle of little more than one copy of the rows,
    no join, and a hot key is as many partitions as it has blocks.  ``idx`` is the 0-based position in the
    group, without gaps (``row_index``)."""
    keys, most = list(keys), max(ks)
    size = max(block or LAG_BLOCK, most + 1)
    own = F.floor(F.col(idx) / size).cast("bigint")
    goes_on = F.col(idx) % size >= size - most
    spread = df.withColumn("__block", F.explode(F.when(goes_on, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy(*keys, "__block").orderBy(idx)
    back = spread.withColumns({f"{v}_lag{k}": F.lag(v, k).over(w) for v in values for k in ks})
    return back.where(F.col("__block") == own).drop("__block")


def first_difference(df: DataFrame, keys: Sequence[str], idx: str, value: str,
                     out: str = "diff") -> DataFrame:
    """``value - previous value`` within each key group (null for the first row)."""
    return lags(df, keys, idx, [value], [1]).withColumn(out, F.col(value) - F.col(f"{value}_lag1")).drop(f"{value}_lag1")


def top_k(df: DataFrame, k: int, order_by: Sequence[Column]) -> DataFrame:
    """Global top-k (``TakeOrderedAndProject``: per-partition top-k, then merge)."""
    return df.orderBy(*order_by).limit(k)


def arg_best(df: DataFrame, value: str, tie: str, maximize: bool = True,
             keys: Sequence[str] = ()) -> DataFrame:
    """Row with the best ``value`` (ties to the lowest ``tie``) per key group,
    as a struct max/min aggregate (partial aggregation, no sort)."""
    others = [c for c in df.columns if c not in keys]
    v = F.col(value) if maximize else -F.col(value)
    packed = F.struct(v.alias("__v"), (-F.col(tie)).alias("__t"),
                      *[F.col(c) for c in others]).alias("__best")
    g = df.groupBy(*keys) if keys else df.groupBy()
    res = g.agg(F.max(packed).alias("__best"))
    return res.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in others])
