"""A Bloom filter of fixed size that spares a shuffle.

It says which rows cannot find a partner in a later exact join, so that they are
dropped before the shuffle.  Its size does not follow the data (it is small
enough to broadcast always); a filter too full for its data lets more rows pass and
changes no result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.words import mix64

BITS = 26    # 2^26 bits, 8 MB
PROBES = 2


def _positions(values: np.ndarray) -> list[np.ndarray]:
    h = mix64(values.view(np.uint64))
    return [(h >> np.uint64(i * BITS)) & np.uint64((1 << BITS) - 1) for i in range(PROBES)]


def fixed_filter(df: DataFrame, column: str) -> Broadcast:
    """Filter of the values of a long column; its words (at most 2^20) are merged by
    a partial bit-wise or."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_positions(batch.column(0).drop_null().to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)),
                                              pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["word", "bits"])

    rows = df.select(column).mapInArrow(mark, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (BITS - 6), np.int64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return df.sparkSession.sparkContext.broadcast(words.view(np.uint64))


def probably_in(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For every long value, whether the filter may hold it."""
    good = np.ones(len(values), bool)
    for at in _positions(values):
        good &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return good


def maybe_in(df: DataFrame, held: Broadcast, column: str) -> DataFrame:
    """The rows whose value may be in the filter; null is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held.value
        for batch in batches:
            value = batch.column(column)
            good = value.is_valid().to_numpy(zero_copy_only=False).astype(bool)
            yield batch.filter(pa.array(good & probably_in(words, value.fill_null(0).to_numpy())))

    return df.mapInArrow(run, df.schema)
