"""Embedding whitening by blockwise QR and a bidiagonal qd solver.

Entries become whole numbers, so sums and deviations are exact.  Every task reduces
its centred rows to one triangular R by QR of row blocks; the R of the tasks are
merged 16 at a time in written levels, never all in one place.  The last R, of the size of
one embedding squared, is bidiagonalised on the driver (``bidiagonal``): dqds gives the
singular values, twisted factorisations the directions.  The product X'X is never formed,
so the directions are as exact as the rows allow."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.bidiagonal import right_singular
from tabula.llm.common import small_batches, stored

SCALE, SHIFT = 1024, 100_000  # x = floor(SCALE * c) + SHIFT
LARGEST = 2.0 ** 53 / SCALE  # entries from here on have no exact x
FAN = 16  # states merged by one task
BLOCK = 1 << 20  # numbers of a row block
RANK = 1e-11  # singular values below this share of the largest are zero


class Whitening(NamedTuple):
    n: int
    sums: list[int]  # of x, by dimension
    largest: int  # |x|
    eigenvalues: np.ndarray  # of the covariance of x, the kept ones
    directions: np.ndarray  # a column each
    trace: float


def usable(vector: str | Column) -> Column:
    """Neither null nor with null, non-finite or inexactly scaled entries, and not empty."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return F.coalesce(v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(LARGEST))), F.lit(False))


def _blocks(vectors: pa.Array) -> Iterator[np.ndarray]:
    """Row blocks of x."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    step = max(1, BLOCK // rows.shape[1])
    for at in range(0, len(rows), step):
        yield np.floor(rows[at:at + step] * SCALE).astype(np.int64) + SHIFT


def _centred(x: np.ndarray, n: int, sums: list[int], largest: int) -> np.ndarray:
    """n * x - sums, exactly: 64-bit integers where they hold it, else Python's."""
    if 2 * n * largest < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _merged(states: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray], label: str) -> np.ndarray | None:
    """The arrays in ``states(part, state)`` merged into one, ``FAN`` to a task and level."""
    def group(rows: pa.Table) -> pa.Table:
        ordered = rows.sort_by("part")
        out = merge([np.array(s.as_py()) for s in ordered.column("state")])
        return pa.table({"part": pa.array([ordered.column("part")[0].as_py() // FAN], pa.int64()),
                         "state": pa.array([out.tolist()], pa.list_(pa.float64()))})

    level = stored(states, label)
    while level.count() > FAN:
        level = level.withColumn("g", (F.col("part") / FAN).cast("long"))
        level = stored(level.groupBy("g").applyInArrow(lambda t: group(t.drop_columns(["g"])), "part long, state array<double>"), label)
    rows = [np.array(r["state"]) for r in level.orderBy("part").collect()]  # FAN at most
    return merge(rows) if rows else None


def _merge_r(d: int) -> Callable[[list[np.ndarray]], np.ndarray]:
    def merge(states: list[np.ndarray]) -> np.ndarray:
        held = np.zeros((0, d))
        for s in states:  # one after the other: two triangles in memory
            held = np.linalg.qr(np.vstack([held, s.reshape(-1, d)]), mode="r")
        return held.ravel()
    return merge


def _merge_moments(k: int) -> Callable[[list[np.ndarray]], np.ndarray]:
    """States are (count, means, centred products)."""
    def merge(states: list[np.ndarray]) -> np.ndarray:
        held = states[0]
        for s in states[1:]:
            n, m = held[0] + s[0], s[1:1 + k] - held[1:1 + k]
            held = np.concatenate([[n], held[1:1 + k] + m * (s[0] / n),
                                   held[1 + k:] + s[1 + k:] + np.outer(m, m).ravel() * (held[0] * s[0] / n)])
        return held
    return merge


def _one_state(df: DataFrame, col: str, start: Callable[[], Callable[[np.ndarray | None, pa.Array], np.ndarray]]) -> DataFrame:
    """(part, state) of every task that has rows; ``start()(state, vectors)`` adds a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, add = None, start()
        for batch in batches:
            if batch.num_rows:
                held = add(held, batch.column("v"))
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([held.tolist()], pa.list_(pa.float64()))], names=["part", "state"])

    return df.select(F.col(col).alias("v")).mapInArrow(run, "part long, state array<double>")


def _sums(rows: DataFrame) -> tuple[int, list[int], int]:
    """Rows, exact sums of x by dimension and the largest |x|.  Halves of 26 bits are summed,
    so that 64 bits hold the sum of 10^11 rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low, largest = 0, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for x in _blocks(batch.column("v")):
                n += len(x)
                high = high + (x >> 26).sum(axis=0)
                low = low + (x & ((1 << 26) - 1)).sum(axis=0)
                largest = max(largest, int(np.abs(x).max()))
        if n:
            d = len(high)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(high), pa.array(low),
                                              pa.array([n] * d, pa.int64()), pa.array([largest] * d, pa.int64())],
                                             names=["dim", "high", "low", "n", "largest"])

    found = rows.mapInArrow(run, "dim int, high long, low long, n long, largest long").groupBy("dim").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n"), F.max("largest").alias("largest"))
    got = sorted(found.collect())  # a row a dimension
    return got[0]["n"] if got else 0, [(r["high"] << 26) + r["low"] for r in got], max((r["largest"] for r in got), default=0)


def fit_whitening(rows: DataFrame, components: int = 8) -> Whitening | None:
    """The whitening of the usable vectors in column ``v``, all of one length; None without rows."""
    n, sums, largest = _sums(rows)
    if not n:
        return None
    d = len(sums)

    def start():
        def add(held: np.ndarray | None, vectors: pa.Array) -> np.ndarray:
            r = np.zeros((0, d)) if held is None else held.reshape(-1, d)
            for x in _blocks(vectors):
                r = np.linalg.qr(np.vstack([r, _centred(x, n, sums, largest).astype(float) / n]), mode="r")
            return r.ravel()
        return add

    r = _merged(_one_state(rows, "v", start), _merge_r(d), "whitening-r").reshape(-1, d)
    squares, directions = right_singular(np.vstack([r, np.zeros((d - len(r), d))]), components)
    kept = int(np.sum(squares[:components] > squares[0] * RANK ** 2)) if squares[0] > 0 else 0
    directions = directions[:, :kept]
    if kept:  # the largest entry of a direction is positive
        directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(kept)])
    return Whitening(n, sums, largest, squares[:kept] / n, directions, float(squares.sum() / n))


def _deviation(centred: np.ndarray) -> pa.Array:
    """Sums of squares by row, exact, as decimal(38, 0); null beyond 38 digits."""
    kind = pa.decimal128(38, 0)
    most = int(np.abs(centred).max()) if centred.size else 0
    if most * most * centred.shape[1] < 1 << 62:
        return pa.array((centred.astype(np.int64) ** 2).sum(axis=1), pa.int64()).cast(kind)
    total = [sum(v * v for v in map(int, row)) for row in centred]
    return pa.array([Decimal(t) if t < 10 ** 38 else None for t in total], kind)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """One row per usable vector and component: the id under its name, ``component`` (from 1, by falling
    eigenvalue), ``n``, ``deviation`` decimal(38, 0), ``whitened``, ``explained`` and ``identity_error``.

    Null vectors and those with null or non-finite entries (or entries of 2^43 and more, whose x is not exact)
    are left out, and so are empty vectors.  Where vectors differ in length, the most frequent
    length counts (ties: the longer) and the others are left out.  Components without variance are not
    returned, so constant vectors, a single row or an empty table give an empty result.  Null or
    repeated ids keep their rows; other columns are ignored.  Whitened rows are written once; the identity
    error is measured on them, all of them."""
    spark = df.sparkSession
    small_batches(spark)
    v = F.col(f"`{vector_col}`")
    good = df.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).filter(usable("v"))
    length = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    fitted = fit_whitening(good.filter(F.size("v") == length["d"]).select("v"), components) if length else None
    schema = f"id {df.schema[id_col].dataType.simpleString()}, deviation decimal(38,0), w array<double>"
    if fitted is None or not len(fitted.eigenvalues):
        empty = spark.createDataFrame([], schema)
        return _long(empty, id_col, fitted, 0.0)
    n, sums, largest = fitted.n, fitted.sums, fitted.largest
    project = fitted.directions / np.sqrt(fitted.eigenvalues)
    k = project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            if not batch.num_rows:
                continue
            for x in _blocks(batch.column("v")):
                c = _centred(x, n, sums, largest)
                w = (c.astype(float) / n) @ project
                out = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, k), pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(done, len(x)), _deviation(c), out],
                                                 names=["id", "deviation", "w"])
                done += len(x)

    whitened = stored(good.filter(F.size("v") == length["d"]).mapInArrow(run, schema), "whitened")

    def start():
        merge = _merge_moments(k)

        def add(held: np.ndarray | None, vectors: pa.Array) -> np.ndarray:
            w = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).reshape(-1, k)
            m = w.mean(axis=0)
            one = np.concatenate([[len(w)], m, ((w - m).T @ (w - m)).ravel()])
            return one if held is None else merge([held, one])
        return add

    moments = _merged(_one_state(whitened, "w", start), _merge_moments(k), "whitening-check")
    error = float(np.abs(moments[1 + k:].reshape(k, k) / moments[0] - np.eye(k)).max())
    return _long(whitened, id_col, fitted, error)


def _long(whitened: DataFrame, id_col: str, fitted: Whitening | None, error: float) -> DataFrame:
    n = fitted.n if fitted else 0
    shares = [float(e / fitted.trace) for e in fitted.eigenvalues] if fitted else []
    by_component = F.array(*map(F.lit, shares)) if shares else F.lit(None).cast("array<double>")
    return whitened.select("id", "deviation", F.posexplode("w").alias("c", "whitened")).select(
        F.col("id").alias(id_col), (F.col("c") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(by_component, F.col("c") + 1).alias("explained"), F.lit(error).alias("identity_error"))
