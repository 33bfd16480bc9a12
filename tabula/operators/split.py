"""Reproducible splits and folds (D1-D4).

Membership is a function of the row key, never of partition layout or a random
stream, so re-planning, retries and lost executors give the same split, and
the same rule can be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.operators.ordering import null_safe_join, row_index


def hash_bucket(key: str | Column, seed: int | str = 42, buckets: int = 100) -> Column:
    """``conv(first 8 hex digits of md5(key || ':' || seed)) % buckets``."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def train_test_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42
                     ) -> tuple[DataFrame, DataFrame]:
    """Hash split on ``key``: a row is in the test part when its bucket (0..99)
    is below ``test_share * 100``.  Sizes are approximate, membership exact."""
    b = hash_bucket(key, seed)
    cut = int(round(test_share * 100))
    return df.where(b >= cut), df.where(b < cut)


def with_split_flag(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42,
                    out: str = "is_test") -> DataFrame:
    return df.withColumn(out, (hash_bucket(key, seed) < int(round(test_share * 100))).cast("int"))


def _ntile(idx: Column, n: Column, k: int) -> Column:
    """0-based ``ntile(k)`` of a 0-based position ``idx`` in a group of ``n``:
    the first ``n % k`` tiles hold one extra row."""
    q = F.floor(n / k)
    r = n % k
    big = r * (q + 1)
    return F.when(idx < big, F.floor(idx / (q + 1))).otherwise(r + F.floor((idx - big) / q)).cast("int")


def kfold(df: DataFrame, key: str, k: int = 5, label: str | None = None,
          seed: int | None = None, out: str = "fold") -> DataFrame:
    """Contiguous k folds.

    With ``label`` the folds are stratified (each class is cut into k contiguous
    blocks).  With ``seed`` rows are ordered by ``md5(key || ':' || seed)``
    (shuffled folds), else by ``key``.  Equivalent to
    ``ntile(k) over (partition by label order by ...) - 1``, computed with range
    partitions and offsets so a large class is not one task.
    """
    order = [F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), F.col(key)] \
        if seed is not None else [F.col(key)]
    groups = [label] if label else []
    indexed = row_index(df, groups, order, out="__idx")
    if groups:
        sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
        joined = null_safe_join(indexed, sizes, groups)  # one row per class, a null label being one
    else:
        joined = indexed.withColumn("__n", F.lit(df.count()))
    return joined.withColumn(out, _ntile(F.col("__idx"), F.col("__n"), k)).drop("__idx", "__n")


def fold_slices(df: DataFrame, fold_col: str, k: int) -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) pair per fold."""
    return [(df.where(F.col(fold_col) != i), df.where(F.col(fold_col) == i)) for i in range(k)]


def fold_summary(df: DataFrame, fold_col: str, label: str) -> DataFrame:
    """Rows and positives per fold: validation side and the complementary train side."""
    per = df.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n_valid"),
                                   F.sum(F.col(label).cast("bigint")).alias("pos_valid"))
    tot = df.agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col(label).cast("bigint")).alias("__p")).first()
    return per.select(fold_col, "n_valid", "pos_valid",
                      (F.lit(tot["__n"]) - F.col("n_valid")).alias("n_train"),
                      (F.lit(tot["__p"]) - F.col("pos_valid")).alias("pos_train"))

