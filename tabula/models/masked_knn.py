"""Exact k-nearest neighbours between rows with nulls (T1).

The distance of two rows is Euclidean over the columns both hold, times
sqrt(columns / columns shared).  Donors with the same null pattern lie together: a cell holds donors of one of the
``MAX_MASKS`` most frequent patterns, near one pivot, or donors of the rarer patterns together.  Of a cell the
driver knows the range of each column and how many donors hold it, which bounds the distance of a query to any
of its donors from below:

    one pattern:     columns / shared * sum over shared columns of the gap to the range, squared
    mixed patterns:  columns * least squared gap of a column that both sides hold

A query has one row, whatever it misses: it visits the nearest cells until they hold k donors for each
missing column, then all cells whose bound does not exceed the k-th distance of some missing column.  Patterns
are bit masks inside the blocks; their number enters neither the plan nor the number of rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.models.knn import DONOR_BLOCK, MAX_PIVOTS, QUERY_BLOCK
from tabula.session import cut_lineage

MAX_MASKS = 512
CELLS_AT_ONCE = 1 << 19  # numbers of a (queries x cells) matrix, of which a worker holds some ten


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column; nulls become NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def shared_distances(x: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Distances of rows with NaN; infinite where no column is shared."""
    total, shared = np.zeros((len(x), len(d))), np.zeros((len(x), len(d)))
    for j in range(x.shape[1]):
        gap = x[:, j, None] - d[None, :, j]
        both = ~np.isnan(gap)
        total += np.where(both, gap * gap, 0.0)
        shared += both
    return np.sqrt(np.where(shared > 0, x.shape[1] / np.maximum(shared, 1) * total, np.inf))


class _Cells:
    def __init__(self, pivots: np.ndarray, group: np.ndarray, pure: np.ndarray):
        """``pivots`` (NaN outside their pattern) with the pattern's number, -1 for rare ones."""
        self.pivots, self.group, self.pure = pivots, group, pure
        c, n = pivots.shape
        self.count, self.low, self.high = np.zeros((c, n)), np.full((c, n), np.nan), np.full((c, n), np.nan)

    def first_visits(self, x: np.ndarray, k: int) -> np.ndarray:
        """Which cells each row visits first: for every missing column, the nearest that together hold k donors."""
        near = shared_distances(x, self.pivots)
        out = np.zeros(near.shape, bool)
        for t in range(x.shape[1]):
            rows = np.flatnonzero(np.isnan(x[:, t]))
            if not len(rows):
                continue
            far = np.where(self.count[None, :, t] > 0, near[rows], np.inf)
            order = np.argsort(far, axis=1, kind="stable")
            held = np.where(np.isfinite(np.take_along_axis(far, order, 1)), self.count[order, t], 0)
            before = np.cumsum(held, axis=1) - held
            r, at = np.nonzero((before < k) & (held > 0))
            out[rows[r], order[r, at]] = True
        return out

    def bounds(self, x: np.ndarray) -> np.ndarray:
        total, shared = np.zeros((len(x), len(self.pivots))), np.zeros((len(x), len(self.pivots)))
        least = np.full(total.shape, np.inf)
        for j in range(x.shape[1]):
            gap = np.maximum(np.maximum(self.low[None, :, j] - x[:, j, None], x[:, j, None] - self.high[None, :, j]), 0.0)
            both = ~np.isnan(gap)
            square = np.where(both, gap * gap, 0.0)
            total += square
            shared += both
            least = np.where(both, np.minimum(least, square), least)
        n = x.shape[1]
        return np.sqrt(np.where(shared == 0, np.inf, np.where(self.pure[None, :], n / np.maximum(shared, 1) * total, n * least)))

    def other_visits(self, x: np.ndarray, k: int, kth: np.ndarray) -> np.ndarray:
        """The cells left that may hold a donor within the k-th distance of a missing column."""
        bound = self.bounds(x) * (1 - 1e-9) - 1e-12
        may = np.zeros(bound.shape, bool)
        for t in range(x.shape[1]):
            rows = np.flatnonzero(np.isnan(x[:, t]))
            may[rows] |= (bound[rows] <= kth[rows, t, None]) & np.isfinite(bound[rows]) & (self.count[None, :, t] > 0)
        return may & ~self.first_visits(x, k)


def _mask(vec: str) -> Column:
    return F.array_join(F.transform(vec, lambda v: F.when(v.isNull(), F.lit("0")).otherwise(F.lit("1"))), "")


def _find_cells(donors: DataFrame, n_cols: int) -> tuple[_Cells, list[str]]:
    """Pivots, about the root of the donors' number, and the frequent patterns.  A pattern's mean is a
    pivot too, so each has one."""
    counted = donors.groupBy("mask").agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("vec")[j]).alias(f"m{j}") for j in range(n_cols)])
    rows = counted.orderBy(F.desc("n"), "mask").limit(MAX_MASKS).collect()
    total = donors.count()
    masks = [r["mask"] for r in rows]
    number = {m: i for i, m in enumerate(masks)}
    pivots = [[np.nan if r[f"m{j}"] is None else r[f"m{j}"] for j in range(n_cols)] for r in rows]
    group = list(range(len(rows)))
    want = min(MAX_PIVOTS, max(1, round(total ** 0.5)))
    hashed = F.xxhash64("did").bitwiseAND((1 << 30) - 1)
    share = int(min(1.0, 2.0 * want / max(total, 1) + 16 / max(total, 1)) * (1 << 30))
    for r in donors.where(hashed <= share).select("vec", "mask", hashed.alias("h"), "did").orderBy("h", "did").limit(want).collect():
        pivots.append([np.nan if v is None else v for v in r["vec"]])
        group.append(number.get(r["mask"], -1))
    if -1 not in group:  # of rare patterns, if there are any
        pivots.append([0.0] * n_cols)
        group.append(-1)
    group = np.array(group)
    return _Cells(np.array(pivots, float).reshape(len(group), n_cols), group, group >= 0), masks


def _deal(donors: DataFrame, cells: _Cells, masks: list[str]) -> DataFrame:
    number = {m: i for i, m in enumerate(masks)}
    names = [f.name for f in donors.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(names.index("vec")))
            group = np.array([number.get(m, -1) for m in batch.column(names.index("mask")).to_pylist()])
            cell = np.zeros(len(x), np.int32)
            for g in np.unique(group):
                own, rows = np.flatnonzero(cells.group == g), np.flatnonzero(group == g)
                step = max(1, CELLS_AT_ONCE // len(own))
                for lo in range(0, len(rows), step):
                    at = rows[lo:lo + step]
                    cell[at] = own[shared_distances(x[at], cells.pivots[own]).argmin(axis=1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*names, "cell"])

    return donors.mapInArrow(run, T.StructType([*donors.schema.fields, T.StructField("cell", T.IntegerType())]))


def _visits(queries: DataFrame, cells: _Cells, k: int, bounded: bool) -> DataFrame:
    """A row per query and cell to visit."""
    names = [f.name for f in queries.schema.fields]
    kept = [f for f in queries.schema.fields if f.name != "kth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, CELLS_AT_ONCE // len(cells.pivots))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                x = _matrix(part.column(names.index("vec")))
                at = cells.other_visits(x, k, _matrix(part.column(names.index("kth")))) if bounded else cells.first_visits(x, k)
                row, cell = np.nonzero(at)
                if len(row):
                    yield pa.RecordBatch.from_arrays([part.column(names.index(f.name)).take(pa.array(row)) for f in kept]
                                                     + [pa.array(cell.astype(np.int32))], names=[*[f.name for f in kept], "cell"])

    return queries.mapInArrow(run, T.StructType([*kept, T.StructField("cell", T.IntegerType())]))


def _meet(visits: DataFrame, dealt: DataFrame, k: int) -> DataFrame:
    """For each missing column of a query the k nearest donors that hold it, of every block it visits;
    ``visits`` are written already."""
    loads = cut_lineage(visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("batches"))) \
        .join(cut_lineage(dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / DONOR_BLOCK).cast("int").alias("chunks"))), "cell")
    q = visits.join(loads, "cell").withColumns({
        "chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)),
        "batch": F.pmod(F.xxhash64("qid"), F.col("batches")).cast("int")}).drop("batches", "chunks")
    d = dealt.drop("mask").join(loads, "cell").withColumns({
        "batch": F.explode(F.sequence(F.lit(0), F.col("batches") - 1)),
        "chunk": F.pmod(F.xxhash64("did"), F.col("chunks")).cast("int")}).drop("batches", "chunks")
    schema = T.StructType([visits.schema["qid"], T.StructField("target", T.IntegerType()), dealt.schema["did"],
                           T.StructField("dist", T.DoubleType()), T.StructField("value", T.DoubleType())])

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = schema_arrow.empty_table()
        if not left.num_rows or not right.num_rows:
            return empty
        right = right.sort_by("did")
        every, y = (_matrix(t.column("vec").combine_chunks()) for t in (left, right))
        out, step = [], max(1, CELLS_AT_ONCE // len(y))
        for lo in range(0, len(every), step):
            x = every[lo:lo + step]
            dist = shared_distances(x, y)
            for t in range(x.shape[1]):
                rows, cols = np.flatnonzero(np.isnan(x[:, t])), np.flatnonzero(~np.isnan(y[:, t]))
                if not len(rows) or not len(cols):
                    continue
                near = dist[np.ix_(rows, cols)]
                best = np.argsort(near, axis=1, kind="stable")[:, :k]
                row, col = np.repeat(np.arange(len(rows)), best.shape[1]), best.ravel()
                found = np.isfinite(near[row, col])
                row, col = row[found], col[found]
                out.append(pa.table([left.column("qid").take(pa.array(lo + rows[row])), pa.array(np.full(len(row), t, np.int32)),
                                     right.column("did").take(pa.array(cols[col])), pa.array(near[row, col]), pa.array(y[cols[col], t])],
                                    schema=schema_arrow))
        return pa.concat_tables(out) if out else empty

    from pyspark.sql.pandas.types import to_arrow_schema
    schema_arrow = to_arrow_schema(schema)
    by = ["cell", "chunk", "batch"]
    return q.groupBy(*by).cogroup(d.groupBy(*by)).applyInArrow(block, schema)


def _top(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid", "target").orderBy("dist", "did")  # at most k rows a block
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank")


def masked_neighbours(queries: DataFrame, donors: DataFrame, k: int, stats: dict | None = None) -> DataFrame:
    """``(qid, target, did, dist, value)``: for each null of a query's vector, by position ``target``, the k
    nearest donors that hold it and share a column, and what they hold.  ``queries`` is ``(qid, vec)``, ``donors``
    ``(did, vec)`` with arrays of one length; nulls are allowed on both sides, donors without any value take no part.
    Ties rank by donor id.  ``stats`` receives the number of pairs compared."""
    q = cut_lineage(queries.where(F.exists("vec", lambda v: v.isNull()) & F.exists("vec", lambda v: v.isNotNull())).select("qid", "vec"))
    d = cut_lineage(donors.where(F.exists("vec", lambda v: v.isNotNull())).select("did", "vec", _mask("vec").alias("mask")))
    first = d.select(F.size("vec")).first()
    if first is None:  # nobody to learn from
        schema = T.StructType([q.schema["qid"], T.StructField("target", T.IntegerType()), d.schema["did"],
                               T.StructField("dist", T.DoubleType()), T.StructField("value", T.DoubleType())])
        return queries.sparkSession.createDataFrame([], schema)
    n_cols = int(first[0])
    cells, masks = _find_cells(d, n_cols)
    dealt = cut_lineage(_deal(d, cells, masks))
    per = dealt.groupBy("cell").agg(*[f(F.col("vec")[j]).alias(f"{n}{j}") for j in range(n_cols)
                                      for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))])
    for r in per.collect():  # a row a pivot
        for j in range(n_cols):
            cells.count[r["cell"], j] = r[f"n{j}"]
            if r[f"n{j}"]:
                cells.low[r["cell"], j], cells.high[r["cell"], j] = r[f"lo{j}"], r[f"hi{j}"]

    def visit(rows: DataFrame, bounded: bool) -> DataFrame:
        v = cut_lineage(_visits(rows, cells, k, bounded))
        if stats is not None:
            sizes = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
            stats["pairs"] = stats.get("pairs", 0) + (v.join(sizes, "cell").agg(F.sum("n")).first()[0] or 0)
        return _meet(v, dealt, k)

    found = cut_lineage(_top(visit(q, False), k))
    kth = found.groupBy("qid", "target").agg(F.max("dist").alias("d"), F.count(F.lit(1)).alias("got")).where(F.col("got") >= k) \
        .groupBy("qid").agg(F.map_from_entries(F.collect_list(F.struct("target", "d"))).alias("by"))  # a column an entry
    far = F.lit(float("inf"))
    limits = F.array(*[F.coalesce(F.try_element_at("by", F.lit(j)), far) for j in range(n_cols)])
    again = q.join(kth, "qid", "left").select("qid", "vec", limits.alias("kth"))
    return _top(found.unionByName(visit(again, True)), k)
