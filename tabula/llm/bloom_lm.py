"""Language-model scores from a log-frequency Bloom filter of bigram counts.

Training counts words and bigrams with numpy per Arrow batch; what crosses the
shuffle is one binary row per batch and cell (sorted keys and their counts), so a
frequent word or pair costs one entry per batch.  A cell task adds up its keys and,
for bigrams, builds its own Bloom filter: a key whose count has level q (base
sqrt 2) is inserted as (key, 1) .. (key, q).  Workers get the cells by broadcast
and recover a count by probing levels until one is absent; a pair is probed only
if both words are known, and never beyond the level of the rarer word.  The level
is read as its smallest count, so seen mass is never overstated by rounding.

    P(w | v) = (c(v, w) + MU * P0(w)) / (c(v) + MU),   P0 the add-0.1 unigram

Cells are grouped by the hash of the word (for bigrams, of the first word).  When
all cells exceed ``max_broadcast`` bytes, they stay where they are: the texts are cut
into written batches, a batch sends every cell its distinct keys with their training
counts, the cell task builds its filter from these, probes it for the same keys and
answers with one level a key (words: with the count), and the batch is scored where
its answers meet it.  Text and keys cross the shuffle once, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm.common import SMALL_CHUNK, crc32_of, give_back, map_text, stored, text_chunks
from tabula.llm.words import hash_words, mix64, pack48, split_words, unpack48

GROUP_BITS = 5                   # 32 groups of words
LEAST_SUB_BITS, MOST_SUB_BITS = 3, 11  # 8 cells or more a group, as the text asks
CELL_TEXT = 4 << 20              # bytes of training text a cell stands for
KEY_BITS = 48                    # of a bigram inside its cell
BITS_PER_ENTRY, PROBES = 10, 4   # about 1.2 % false positives a level
MU = 1000.0  # weight of the unigram; 300 to 3000 differ by 2 % on held-out text
ADD = 0.1
END = np.uint64(0xE3D0000000000001)  # the end token, also the history of a first word
MULT = np.uint64(0x9E3779B97F4A7C15)
MASK = np.uint64((1 << KEY_BITS) - 1)
TEXT_OF_CELLS = 4  # more training text than so many times what is broadcast: its cells are not tried
MOST_LEVEL = 64    # of a count of 32 bits


def level_of(count: np.ndarray) -> np.ndarray:
    """1 + floor(2 log2 count); 0 for a count of 0."""
    c = np.maximum(count, 1).astype(np.float64)
    return np.where(count > 0, 1 + np.floor(2 * np.log2(c) + 1e-9), 0).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """The smallest count of a level."""
    return np.where(level > 0, np.ceil(2.0 ** ((level - 1) / 2) - 1e-9), 0)


def token_stream(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens (an end token after every text), of the tokens before
    them, and the first position of every text."""
    words = split_words(text, lower=True)
    n = len(words.starts) - 1
    cur = np.full(len(words.codes) + n, END, np.uint64)
    starts = words.starts + np.arange(n + 1)
    body = np.ones(len(cur), bool)
    body[starts[1:] - 1] = False
    cur[body] = hash_words(words.vocab)[words.codes]
    prev = np.concatenate([np.full(1, END, np.uint64), cur[:-1]])[:len(cur)]
    return cur, prev, starts


def group_of(word: np.ndarray) -> np.ndarray:
    return (word >> np.uint64(64 - GROUP_BITS)).astype(np.int64)


def bigram_key(prev: np.ndarray, cur: np.ndarray, sub_bits: int) -> np.ndarray:
    """Cell in the high bits, hash of the pair in the low ``KEY_BITS``."""
    pair = mix64(prev * MULT + cur)
    cell = (prev >> np.uint64(64 - GROUP_BITS)) << np.uint64(sub_bits) | pair >> np.uint64(64 - sub_bits)
    return cell << np.uint64(KEY_BITS) | pair & MASK


HALF = np.uint64(32)
LOW = np.uint64(0xFFFFFFFF)
MOST_BITS = 1 << 32  # of a cell: places are drawn with 32 bits


def _steps(key: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and stride, in 32 bits, of the probes of (key, level)."""
    h = mix64(key * MULT + np.uint64(level))
    return h & LOW, h >> HALF | np.uint64(1)


def _place(first: np.ndarray, stride: np.ndarray, i: int, size: np.ndarray | np.uint64) -> np.ndarray:
    """Place of the i-th probe among ``size`` bits: scaled, not divided."""
    return (((first + np.uint64(i) * stride) & LOW) * size) >> HALF


def _count_rows(texts: DataFrame, sub_bits: int) -> DataFrame:
    """``kind, cell, keys, counts`` per batch; kind 0 words, kind 1 bigrams."""
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("cell", T.IntegerType()),
                           T.StructField("keys", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for text in text_chunks(batch.column(0)):
                cur, prev, _ = token_stream(text)
                rows: list[tuple] = []
                word, n = np.unique(cur, return_counts=True)
                cell = (word >> np.uint64(64 - GROUP_BITS - sub_bits)).astype(np.int64)
                for c, lo, hi in _runs(cell):
                    rows.append((0, c, word[lo:hi].tobytes(), n[lo:hi].astype(np.uint32).tobytes()))
                pair, n = np.unique(bigram_key(prev, cur, sub_bits), return_counts=True)
                cell = (pair >> np.uint64(KEY_BITS)).astype(np.int64)
                for c, lo, hi in _runs(cell):
                    rows.append((1, c, pack48(pair[lo:hi] & MASK), n[lo:hi].astype(np.uint32).tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(col), t) for col, t in zip(
                        zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=schema.names)
                del cur, prev, word, pair, n, cell, rows
        give_back()

    return texts.mapInArrow(run, schema)


def _runs(cell: np.ndarray) -> Iterator[tuple[int, int, int]]:
    at = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]])
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        if hi > lo:
            yield int(cell[lo]), int(lo), int(hi)


def _filter_of(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, int]:
    """The Bloom filter of a cell, a byte a bit and full to the next eight, and its bits."""
    level = level_of(n)
    bits = min(MOST_BITS, max(64, BITS_PER_ENTRY * int(level.sum())))
    on = np.zeros(-(-bits // 8) * 8, bool)
    for q in range(1, int(level.max()) + 1):
        first, stride = _steps(keys[level >= q], q)
        for i in range(PROBES):
            on[_place(first, stride, i, np.uint64(bits))] = True
    return on, bits


def _cells(counted: DataFrame) -> DataFrame:
    """Per cell: distinct keys, their total, and either the sorted keys with counts
    (words) or the Bloom filter (bigrams)."""
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("cell", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("distinct", "total", "bits")],
                           T.StructField("blob", T.BinaryType())])

    def build(table: pa.Table) -> pa.Table:
        kind, cell = table["kind"][0].as_py(), table["cell"][0].as_py()
        blobs = table["keys"].to_pylist()
        keys = np.concatenate([np.frombuffer(b, np.uint64) if kind == 0 else unpack48(b) for b in blobs])
        n = np.concatenate([np.frombuffer(b, np.uint32) for b in table["counts"].to_pylist()]).astype(np.int64)
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        keys, n = keys[first], np.add.reduceat(n, np.flatnonzero(first))
        bits = 0
        if kind == 0:
            blob = keys.tobytes() + np.minimum(n, 0xFFFFFFFF).astype(np.uint32).tobytes()
        else:
            on, bits = _filter_of(keys, n)
            blob = np.packbits(on, bitorder="little").tobytes()
        return pa.Table.from_arrays([pa.array([x], t) for x, t in (
            (kind, pa.int32()), (cell, pa.int32()), (len(keys), pa.int64()), (int(n.sum()), pa.int64()),
            (bits, pa.int64()), (blob, pa.binary()))], names=schema.names)

    return counted.groupBy("kind", "cell").applyInArrow(build, schema)


class CountFilter:
    """The broadcast cells: exact word counts, and bigram counts by probing."""

    def __init__(self, cells: Iterable, sizes: list, total: int, distinct: int, sub_bits: int):
        """``sizes`` lists the cells that ``cells`` yields (in any order), without blobs:
        every array is allocated once and filled cell by cell."""
        self.total, self.distinct = total, distinct
        self.sub_bits, n_cells = sub_bits, 1 << (GROUP_BITS + sub_bits)
        self.bits, self.base = np.zeros(n_cells, np.uint64), np.zeros(n_cells, np.uint64)
        place, at = {}, [0, 0]
        for r in sorted(sizes, key=lambda r: (r["kind"], r["cell"])):
            place[r["kind"], r["cell"]] = at[r["kind"]]
            if r["kind"]:
                self.bits[r["cell"]], self.base[r["cell"]] = r["bits"], 8 * at[1]
            at[r["kind"]] += r["bytes"] if r["kind"] else r["distinct"]
        self.keys, self.counts, self.filter = np.zeros(at[0], np.uint64), np.zeros(at[0], np.uint32), np.zeros(max(8, at[1]), np.uint8)
        for r in cells:
            raw, lo = np.frombuffer(r["blob"], np.uint8), place[r["kind"], r["cell"]]
            if r["kind"]:
                self.filter[lo:lo + len(raw)] = raw
            else:
                n = r["distinct"]
                self.keys[lo:lo + n], self.counts[lo:lo + n] = raw[:8 * n].view(np.uint64), raw[8 * n:].view(np.uint32)

    def words(self, word: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(word), np.int64)
        at = np.minimum(np.searchsorted(self.keys, word), len(self.keys) - 1)
        return np.where(self.keys[at] == word, self.counts[at], 0).astype(np.int64)

    def bigrams(self, prev: np.ndarray, cur: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Smallest counts of the levels found; ``most`` bounds each from above."""
        key = bigram_key(prev, cur, self.sub_bits)
        cell = (key >> np.uint64(KEY_BITS)).astype(np.int64)
        key &= MASK
        limit, out = level_of(most), np.zeros(len(key), np.int64)
        alive = np.flatnonzero((limit > 0) & (self.bits[cell] > 0))
        q = 1
        while len(alive):
            first, stride = _steps(key[alive], q)
            size, base = self.bits[cell[alive]], self.base[cell[alive]]
            for i in range(PROBES):
                at = base + _place(first, stride, i, size)
                on = (self.filter[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                alive, first, stride, size, base = (x[on] for x in (alive, first, stride, size, base))
            out[alive] = q
            q += 1
            alive = alive[limit[alive] >= q]
        return count_of(out)


def _sums(starts: np.ndarray, count: np.ndarray, before: np.ndarray, seen: np.ndarray, total: int, distinct: int) -> dict:
    """Of every text: tokens, known ones, and its logarithms from the counts of tokens, of those before them and of pairs."""
    p0 = (count + ADD) / (total + ADD * (distinct + 1))
    score = np.log10(np.where(before > 0, (seen + MU * p0) / (before + MU), p0))
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (np.log10(p0), score, count > 0)]
    base_sum, score_sum, known = (s[starts[1:]] - s[starts[:-1]] for s in sums)
    return {"n_tokens": np.diff(starts), "n_known": known.astype(np.int64), "base_score": base_sum, "score": score_sum}


def _before(count: np.ndarray, starts: np.ndarray, of_end: int) -> np.ndarray:
    """Counts of the tokens before; before the first token of a text that is the end token."""
    out = np.concatenate([[of_end], count[:-1]])[:len(count)]
    out[starts[:-1]] = of_end
    return out


def _scorer(cells: CountFilter):
    def fn(text: pa.Array) -> dict:
        cur, prev, starts = token_stream(text)
        distinct, code = np.unique(cur, return_inverse=True)
        count = cells.words(distinct)[code]
        before = _before(count, starts, cells.words(np.array([END]))[0])
        seen = np.zeros(len(cur))
        for lo in range(0, len(cur), 1 << 20):
            i = slice(lo, lo + (1 << 20))
            seen[i] = cells.bigrams(prev[i], cur[i], np.minimum(before[i], count[i]))
        return _sums(starts, count, before, seen, cells.total, cells.distinct)

    return fn


# ---------------------------------------------------------------- cells that are not broadcast

def _batches(rows: DataFrame) -> DataFrame:
    """``batch, rows``: the rows in numbered Arrow streams of about ``SMALL_CHUNK`` bytes of text, compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            done = 0
            for text in text_chunks(batch.column("text"), SMALL_CHUNK):
                if len(text):
                    held = pa.BufferOutputStream()
                    with pa.ipc.new_stream(held, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                        out.write_batch(batch.slice(done, len(text)))
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([held.getvalue().to_pybytes()], pa.binary())],
                                                     names=["batch", "rows"])
                    number, done = number + 1, done + len(text)
        give_back()

    return rows.mapInArrow(run, "batch long, rows binary")


def _unpacked(held: bytes) -> pa.Table:
    return pa.ipc.open_stream(held).read_all().combine_chunks()


def _text(table: pa.Table) -> pa.Array:
    return table["text"].combine_chunks()


def _with_counts(keys: np.ndarray, trains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in rising order and how often each occurs in training text."""
    distinct = np.unique(keys)
    held, n = np.unique(keys[trains], return_counts=True)
    out = np.zeros(len(distinct), np.uint32)
    out[np.searchsorted(distinct, held)] = n
    return distinct, out


def _narrow(n: np.ndarray) -> bytes:
    """Whole numbers in one byte each or, where one does not fit, in four."""
    return n.astype(np.uint8 if n.max(initial=0) < 256 else np.uint32).tobytes()


def _wide(blob: bytes, many: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint8 if len(blob) == many else np.uint32).astype(np.int64)


def _questions(batches: DataFrame, sub_bits: int) -> DataFrame:
    """``kind, cell, batch, keys, counts``: as ``_count_rows``, of all texts, counted in training ones."""
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("cell", T.IntegerType()), T.StructField("batch", T.LongType()),
                           T.StructField("keys", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for frame in frames:
            for number, held in zip(frame.column("batch").to_pylist(), frame.column("rows"), strict=True):
                table = _unpacked(held.as_py())
                cur, prev, starts = token_stream(_text(table))
                trains = np.repeat(~table["held_out"].to_numpy().astype(bool), np.diff(starts))
                rows: list[tuple] = []
                word, n = _with_counts(cur, trains)
                for c, lo, hi in _runs((word >> np.uint64(64 - GROUP_BITS - sub_bits)).astype(np.int64)):
                    rows.append((0, c, number, word[lo:hi].tobytes(), _narrow(n[lo:hi])))
                pair, n = _with_counts(bigram_key(prev, cur, sub_bits), trains)
                for c, lo, hi in _runs((pair >> np.uint64(KEY_BITS)).astype(np.int64)):
                    rows.append((1, c, number, pack48(pair[lo:hi] & MASK), _narrow(n[lo:hi])))
                yield pa.RecordBatch.from_arrays([pa.array(list(col), t) for col, t in zip(
                    zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=schema.names)
                del table, cur, prev, trains, word, pair, n, rows
        give_back()

    return batches.mapInArrow(run, schema)


def _levels(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the cell's filter says of each key, those that were never counted too."""
    out = np.zeros(len(keys), np.uint8)
    if not n.any():
        return out
    on, bits = _filter_of(keys[n > 0], n[n > 0])
    alive = np.arange(len(keys))
    for q in range(1, MOST_LEVEL + 1):
        first, stride = _steps(keys[alive], q)
        for i in range(PROBES):
            hit = on[_place(first, stride, i, np.uint64(bits))]
            alive, first, stride = alive[hit], first[hit], stride[hit]
        out[alive] = q
        if not len(alive):
            break
    return out


def _answers(asked: DataFrame) -> DataFrame:
    """``batch, kind, cell, many, answer``: for each of the keys asked its count (words) or level (bigrams);
    ``distinct, total`` of a cell of words stand in one of its rows."""
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("cell", T.IntegerType()),
                           T.StructField("many", T.IntegerType()), T.StructField("answer", T.BinaryType()),
                           T.StructField("distinct", T.LongType()), T.StructField("total", T.LongType())])

    def build(table: pa.Table) -> pa.Table:
        kind, rows = table["kind"][0].as_py(), len(table)
        held = [np.frombuffer(b, np.uint64) if kind == 0 else unpack48(b) for b in table["keys"].to_pylist()]
        many = np.array([len(h) for h in held])
        keys = np.concatenate(held)
        del held
        n = np.concatenate([_wide(b, m) for b, m in zip(table["counts"].to_pylist(), many, strict=True)])
        order = np.argsort(keys)
        new = np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])
        keys, n = keys[order[new]], np.add.reduceat(n[order], np.flatnonzero(new))
        said = np.minimum(n, 0xFFFFFFFF).astype(np.uint32) if kind == 0 else _levels(keys, n)
        out = np.empty(len(order), said.dtype)
        out[order] = said[np.cumsum(new) - 1]
        ends = np.cumsum(many)
        answers = [_narrow(out[hi - m:hi]) for m, hi in zip(many, ends, strict=True)]
        sums = [[int(v)] + [0] * (rows - 1) for v in (((n > 0).sum(), n.sum()) if kind == 0 else (0, 0))]
        return pa.Table.from_arrays([table["batch"].combine_chunks(), table["kind"].combine_chunks(), table["cell"].combine_chunks(),
                                     pa.array(many, pa.int32()), pa.array(answers, pa.binary()),
                                     *[pa.array(v, pa.int64()) for v in sums]], names=schema.names)

    return asked.groupBy("kind", "cell").applyInArrow(build, schema)


def _score_by_exchange(rows: DataFrame, sub_bits: int) -> tuple[DataFrame, int]:
    """The scored rows and the training tokens."""
    batches = stored(_batches(rows), "lm-batches")
    answers = stored(_answers(_questions(batches, sub_bits)), "lm-answers")
    sums = answers.agg(F.sum("distinct"), F.sum("total")).first()
    distinct, total = int(sums[0] or 0), int(sums[1] or 0)
    schema = T.StructType([rows.schema["doc_id"], rows.schema["held_out"], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        table = _unpacked(left["rows"][0].as_py())
        cur, prev, starts = token_stream(_text(table))
        order = np.lexsort((right["cell"].to_numpy(), right["kind"].to_numpy()))
        right = right.take(pa.array(order))
        said = [_wide(b, m) for b, m in zip(right["answer"].to_pylist(), right["many"].to_pylist(), strict=True)]
        words = int((right["kind"].to_numpy() == 0).sum())
        distinct_words, code = np.unique(cur, return_inverse=True)
        of_word = np.concatenate(said[:words])
        count = of_word[code]
        before = _before(count, starts, int(of_word[np.searchsorted(distinct_words, END)]))
        level = np.concatenate(said[words:])[np.unique(bigram_key(prev, cur, sub_bits), return_inverse=True)[1]]
        seen = count_of(np.minimum(level, level_of(np.minimum(before, count))))
        got = _sums(starts, count, before, seen, total, distinct)
        return pa.table({"doc_id": table["doc_id"], "held_out": table["held_out"], **got}).cast(left_schema(table))

    def left_schema(table: pa.Table) -> pa.Schema:
        kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
        return pa.schema([table.schema.field("doc_id"), table.schema.field("held_out"), *[pa.field(c, t) for c, t in kinds.items()]])

    done = batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, schema)
    return done, total


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_mod: int = 10,
                max_broadcast: int = 256 << 20) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Rows whose CRC-32 of the id (as text) is not 0 modulo ``held_out_mod`` train;
    rows with a null id are held out.  A null or empty text is one end token.
    Texts of any length are read whole.  Repeated rows each count and each give a row.  With no training rows N and V
    are 0 and every token has the add-0.1 probability 1.  Other columns are
    ignored.  Bigram counts come from the filter and may be overstated by false
    positives; word counts, and with them the base score, are exact."""
    crc = crc32_of(f"`{id_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.coalesce(crc % held_out_mod == 0, F.lit(True)).alias("held_out"))
    train = rows.filter("not held_out").select("text")
    size = train.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    sub_bits = min(MOST_SUB_BITS, max(LEAST_SUB_BITS, (size // CELL_TEXT).bit_length() - GROUP_BITS))
    done = None
    if size <= TEXT_OF_CELLS * max_broadcast:
        done, total = _score_by_broadcast(rows, train, sub_bits, max_broadcast)
    if done is None:
        done, total = _score_by_exchange(rows, sub_bits)
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _score_by_broadcast(rows: DataFrame, train: DataFrame, sub_bits: int, max_broadcast: int) -> tuple[DataFrame | None, int]:
    """The scored rows, None if the cells exceed ``max_broadcast`` bytes, and the training tokens."""
    cells = stored(_cells(_count_rows(train, sub_bits)), "lm-cells")
    sizes = cells.select("kind", "cell", "distinct", "total", "bits", F.length("blob").alias("bytes")).collect()
    total = sum(r["total"] for r in sizes if r["kind"] == 0)
    distinct = sum(r["distinct"] for r in sizes if r["kind"] == 0)
    if sum(r["bytes"] for r in sizes) > max_broadcast:
        return None, total
    # fetched a partition at a time
    shared = rows.sparkSession.sparkContext.broadcast(CountFilter(cells.toLocalIterator(), sizes, total, distinct, sub_bits))
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
              T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    done = stored(map_text(rows, "text", fields, lambda: _scorer(shared.value), keep=["doc_id", "held_out"], chunk=SMALL_CHUNK), "lm-scores")
    shared.destroy()  # executors and their workers drop the cells
    return done, total
