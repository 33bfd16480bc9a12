"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark) or spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


BATCH_BYTES = 8 << 20  # of the Arrow batches between the JVM and a Python worker


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, since texts differ in length a thousandfold."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    This cuts lineage: a lost executor costs the running stage, never the
    steps before it, and every reader sees the same rows."""
    spark = df.sparkSession
    small_batches(spark)
    path = path or scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


CHUNK_BYTES = 8 << 20  # text handled at once inside a task
SMALL_CHUNK = 2 << 20  # the same where a byte of text takes many bytes of arrays

_HELD: dict = {}


def held_by_worker(key: object, make: Callable[[], object]):
    """An object that this worker process keeps from task to task of one operator; it keeps
    one at a time, and ``give_back`` drops it when the next operator begins."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def give_back(forget: bool = True) -> None:
    """Return freed memory to the system: worker processes live on between tasks and stages."""
    if forget:
        _HELD.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def text_chunks(text: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of about ``limit`` bytes; at least one, if empty."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while True:
        base = int(ends[row - 1]) if row else 0
        end = max(row + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield text.slice(row, end - row)
        row = end
        if row >= len(text):
            return


def numbered_chunks(text: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.Array, int]]:
    """Slices of bounded size with the row at which each begins."""
    done = 0
    for part in text_chunks(text, limit):
        yield part, done
        done += len(part)


def map_text(df: DataFrame, text_col: str, fields: Sequence[T.StructField],
             make: Callable[[], Callable[[pa.Array], dict]], keep: Sequence[str] | None = None,
             only: str | None = None, bare: bool = False, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Append columns computed from the text, about ``chunk`` bytes of it at a time
    (a longer text goes alone).

    ``make()`` runs once per task and returns ``fn(text) -> {field: array}``.
    ``keep`` names the input columns of the result (default: all of them).
    With ``only`` (a boolean field of the result) rows where it is false are
    dropped before they leave the task; with ``bare`` the fields themselves are left
    out of the result.  Rows are never joined back, so null
    or repeated ids and clashing extra columns pass through unchanged."""
    small_batches(df.sparkSession)
    kept = list(df.columns if keep is None else keep)
    fields = list(fields)
    slots = [f"c{i}" for i in range(len(kept))]
    source = df.select(*[F.col(f"`{c}`").alias(s) for c, s in zip(kept, slots, strict=True)],
                       *([] if text_col in kept else [F.col(f"`{text_col}`").cast("string").alias("t")]))
    text_slot = slots[kept.index(text_col)] if text_col in kept else "t"
    outs = [f"n{i}" for i in range(len(fields))]
    schema = T.StructType([T.StructField(s, df.schema[c].dataType) for c, s in zip(kept, slots, strict=True)]
                          + [T.StructField(o, f.dataType) for o, f in zip(outs, fields, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        fn = make()
        for batch in batches:
            done = 0
            for text in text_chunks(batch.column(text_slot).cast(pa.string()), chunk):
                got = fn(text)
                new = [a if isinstance(a, pa.Array) else pa.array(a) for a in (got[f.name] for f in fields)]
                old = [batch.column(s).slice(done, len(text)) for s in slots]
                out = pa.RecordBatch.from_arrays(old + new, names=slots + outs)
                done += len(text)
                yield out if only is None else out.filter(pa.array(got[only]))
        del fn
        give_back()

    mapped = source.mapInArrow(run, schema)
    return mapped.select(*[F.col(s).alias(c) for c, s in zip(kept, slots, strict=True)],
                         *[F.col(o).alias(f.name) for o, f in zip(outs, fields, strict=True) if not bare])


def crc32_of(col: str) -> Column:
    """CRC-32 of the id written as text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def bounded_sample(df: DataFrame, key: str, text_col: str, rows: int, max_bytes: int) -> DataFrame:
    """The first rows in the order of a hash of key and text, as many as are ``rows`` rows and
    ``max_bytes`` bytes of text at most: the bounded sample on which a classifier is fitted, the
    same for every partitioning.  Only hashes and lengths of ``rows`` rows come to the driver."""
    order = [F.xxhash64(F.col(key), F.lit("sample")), F.xxhash64(F.col(text_col), F.lit("sample"))]
    sized = df.select(order[0].alias("a"), order[1].alias("b"), F.octet_length(text_col).alias("n"))
    total, last = 0, None
    for r in sized.orderBy("a", "b").limit(rows).collect():
        if total + r["n"] > max_bytes:
            break
        total, last = total + r["n"], r
    if last is None:
        return df.limit(0)
    within = (order[0] < last["a"]) | ((order[0] == last["a"]) & (order[1] <= last["b"]))
    return df.filter(within).limit(rows)  # the limit only meets rows repeated with key and text
