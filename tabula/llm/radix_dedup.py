"""Exact deduplication by distributed most-significant-digit radix partitioning.

The byte string of a document is its normalised text (every ``[\\x20\\x09-\\x0D]``
removed) in UTF-8, led by its length as the most significant digit.  Each level
splits the groups left by the level before on their next run of bytes; runs grow
16-fold, so a text of any length is consumed in a few levels.  A group of one
document, or one whose bytes have ended, is finished; only the others go on.
Texts are compared byte by byte, no digest takes part.

Per level there is one aggregation (partial sums before the shuffle, so a group
of copies costs one row per map task) and one equi-join of the rows with the
groups of two or more, which adaptive execution splits where a group is hot.
Each level is a written table in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import stored, text_or_empty

FIRST_WIDTH = 64
GROWTH = 16


def normalised(col: str | Column) -> Column:
    return F.regexp_replace(text_or_empty(col), r"[\x20\x09-\x0D]+", "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the most code points in the original text, then
    the smallest id (null ids last) stays.  Null text counts as empty.  Of rows
    repeated with the same id and text exactly one is ``kept``.  An empty table
    gives an empty result; other columns are ignored."""
    return _grouped(docs, id_col, text_col).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``exact_groups`` with the digest of the whole original text, ``original``.  Of rows with the
    longest text and the smallest id the one with the smallest digest stays."""
    body = normalised(text_col).cast("binary")
    whole = F.unhex(F.sha2(text_or_empty(text_col).cast("binary"), 256)).alias("original")
    state = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.length(text_or_empty(text_col)).alias("chars"), body.alias("body"), whole) \
        .select("*", F.lit(0).cast("long").alias("grp"), F.length("body").alias("n_bytes"),
                F.sha2("body", 256).alias("sha"))
    key = ["grp", "n_bytes", "head"]
    closed: list[DataFrame] = []
    offset, width, level = 0, FIRST_WIDTH, 0
    while True:
        headed = state.withColumn("head", F.substring("body", offset + 1, width))
        groups = headed.groupBy(*key).agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("z"),
                           F.col("doc_id").alias("d"), F.col("original").alias("o"))).alias("best")) \
            .filter("n > 1") \
            .select(*key, "n", F.col("best.d").alias("keep_id"), (-F.col("best.c")).alias("keep_chars"), F.col("best.o").alias("keep_original"),
                    F.monotonically_increasing_id().alias("sub"))
        groups = stored(groups, f"radix-groups{level}")
        is_open = F.col("n").isNotNull() & (F.col("n_bytes") > offset + width)
        # always a sort-merge join: the number of groups follows the data, and a hot
        # group can then be split
        rows = headed.join(groups.hint("merge"), key, "left").select(
            "doc_id", "chars", "n_bytes", "sha", "original", "n", "keep_id", "keep_chars", "keep_original", "sub", is_open.alias("open"),
            F.when(is_open, F.col("body")).alias("body"), F.monotonically_increasing_id().alias("rid"))
        rows = stored(rows, f"radix-rows{level}")
        closed.append(rows.filter("not open").drop("body", "open").withColumn("level", F.lit(level)))
        state = rows.filter("open").select("doc_id", "chars", "n_bytes", "sha", "original", F.col("sub").alias("grp"), "body")
        if state.isEmpty():
            break
        offset, width, level = offset + width, width * GROWTH, level + 1
    done = reduce(DataFrame.unionByName, closed)
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars")) & (F.col("original") == F.col("keep_original"))
    first = done.filter(F.col("n").isNotNull() & best).groupBy("level", "sub") \
        .agg(F.min("rid").alias("rid")).withColumn("first", F.lit(True))
    return done.join(first, ["level", "sub", "rid"], "left").select(
        "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | F.coalesce("first", F.lit(False))).alias("kept"),
        F.col("sha").alias("text_sha256"), "original")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, which may have any names.

    The row that stays is known by its id and the digest of its original text; of rows repeated with both, one
    stays.  The join and the choice among repeated rows use one shuffle of the rows."""
    def key(row_id: Column, original: Column) -> Column:
        told = F.coalesce(F.concat(F.lit("="), row_id.cast("string")), F.lit("null"))
        return F.sha2(F.concat(told.cast("binary"), F.lit("|").cast("binary"), original), 256)

    slot = "kept_row"
    while slot in docs.columns:
        slot += "_"
    keep = _grouped(docs, id_col, text_col).filter("kept").select(key(F.col("doc_id"), F.col("original")).alias(slot))
    original = F.unhex(F.sha2(text_or_empty(F.col(f"`{text_col}`")).cast("binary"), 256))
    keyed = docs.withColumn(slot, key(F.col(f"`{id_col}`"), original))
    return keyed.join(keep.hint("merge"), slot, "left_semi").dropDuplicates([slot]).drop(slot)
