"""Best-fit packing of tokenised documents by minimum bin slack.

Only lengths matter to packing, so the documents are reduced to a histogram of
piece lengths (at most ``capacity`` rows whatever the number of documents).  For
each bin the longest length left is placed first, then a bitset subset-sum
dynamic programme over the lengths still available finds the combination that
fills the bin fullest; that combination is removed as many times at once as the
histogram allows.  The resulting patterns say, for the k-th piece of a length,
its bin and place.  The k is a running number inside each task plus the count
of earlier tasks, so no length gathers its pieces in one task.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm.bpe_count import byte_letters
from tabula.llm.common import SMALL_CHUNK, give_back, held_by_worker, numbered_chunks, stored
from tabula.llm.words import split_words

MEMO_PARTS = 200_000
ENCODE_WORDS = 10_000  # handed to the tokenizer at once, whose results are large objects
TEXT_WORDS = 500  # of these, in one text
MARK = "\x01"  # stands alone between two words of such a text
CHUNK_WORDS = 200_000


@dataclass
class Run:
    """Of one length: pieces ``first .. first + each * bins - 1`` (in rank order)
    go ``each`` to a bin, into bins ``bin0 .. bin0 + bins - 1`` from ``offset``."""

    length: int
    first: int
    each: int
    bins: int
    bin0: int
    offset: int


def fullest(lengths: Sequence[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """Multiset of available lengths with the largest sum up to ``room``.

    ``reach`` is a bitset of the sums that can be made; a length with c pieces
    is added by doubling shifts.  The sums before each length are kept to read
    the combination back."""
    mask, reach = (1 << (room + 1)) - 1, 1
    trail: list[tuple[int, int]] = []
    for length in lengths:
        left = min(counts.get(length, 0), room // length)
        if not left:
            continue
        trail.append((length, reach))
        step = 1
        while left:
            take = min(step, left)
            reach |= reach << (take * length)
            left, step = left - take, step * 2
        reach &= mask
        if reach >> room & 1:
            break
    target, used = reach.bit_length() - 1, {}
    for length, before in reversed(trail):
        n = 0
        while not before >> target & 1:
            target, n = target - length, n + 1
        if n:
            used[length] = n
    return used


def plan_bins(histogram: dict[int, int], capacity: int) -> list[Run]:
    counts = {k: v for k, v in histogram.items() if v > 0}
    order = sorted(counts, reverse=True)
    placed = dict.fromkeys(order, 0)
    runs: list[Run] = []
    bins = 0
    while order:
        longest = order[0]
        counts[longest] -= 1
        used = fullest([k for k in order if k <= capacity - longest], counts, capacity - longest) if longest < capacity else {}
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in used.items())
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            runs.append(Run(length, placed[length], n, times, bins, offset))
            placed[length] += n * times
            counts[length] -= n * times
            offset += n * length
        bins += times
        order = [k for k in order if counts[k]]
    return runs


SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # of the tokenizer files whose plain words are cut here
ODD, LETTER, DIGIT, SIGN = range(4)


def byte_kinds() -> np.ndarray:
    """Kind of each byte of a word.  A word without an odd byte is plain: ASCII signs, digits
    and letters and, behind byte C3, the letters U+00C0 to U+00FF."""
    kind = np.full(256, ODD, np.uint8)
    kind[0x21:0x7F] = SIGN
    kind[ord("'")] = ODD  # may begin a contraction
    kind[ord("0"):ord("9") + 1] = DIGIT
    kind[ord("A"):ord("Z") + 1] = kind[ord("a"):ord("z") + 1] = kind[0xC3] = LETTER
    return kind


KINDS = byte_kinds()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
LETTERS = np.array([ord(c) for c in byte_letters()], "<u4")  # code point of each byte in the vocabulary
LETTERS[ord(" ")] = ord(" ")


def cuts_plain_words(spec: dict) -> bool:
    """Whether the file lower-cases and splits as ``Encoder.parts`` does."""
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    model = spec["model"]
    return ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"}
            and [s["type"] for s in split] == ["Split", "ByteLevel"] and split[0]["pattern"] == {"Regex": SPLIT}
            and split[0]["behavior"] == "Removed" and split[0]["invert"]
            and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
            and model.get("type") == "BPE" and bool(model.get("end_of_word_suffix"))
            and not spec.get("truncation") and not spec.get("padding"))


def raw_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a large binary array."""
    _, ends, data = values.buffers()
    at = np.frombuffer(ends, np.int64)[values.offset:values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    return at - at[0], np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]


def large_array(kind: pa.DataType, at: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(data)])


class Encoder:
    """Token ids of a text through ids remembered per distinct part of a word.

    White space is dropped by the tokenizer and never joins two words, so the
    ids of a text are those of its words in turn.  A plain word is lower-cased and cut into the
    tokenizer's runs of letters, digits and runs of signs here, many words at once, and its parts
    go to the tokenizer's model; any other word is one part and passes through the whole tokenizer."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        alone, other = (self.tokenizer.encode(c, add_special_tokens=False).ids for c in (MARK, "\x02"))
        self.mark = alone[0] if len(alone) == 1 and alone != other else None  # its own id, not that of unknown words
        parsed = json.loads(spec)
        self.kinds = KINDS.copy()
        if cuts_plain_words(parsed):
            suffix, vocab = parsed["model"]["end_of_word_suffix"], parsed["model"]["vocab"]
            # the first byte of a special string or of the suffix makes a word odd
            self.kinds[[t.encode()[0] for t in [suffix, *(a["content"] for a in parsed["added_tokens"])]]] = ODD
            self.final = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a part
            self.final[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            bare = {**parsed, "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None}
            self.model = Tokenizer.from_str(json.dumps(bare))
        else:
            self.kinds[:] = ODD
        self.memo: dict[str, int] = {}  # part -> slot s, with ids[starts[s]:starts[s + 1]]
        self.size = 0
        self.starts = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)

    @staticmethod
    def of(spec: str) -> Encoder:
        """The encoder of this worker process; the next packing task finds its parts there."""
        return held_by_worker(("encoder", hash(spec)), lambda: Encoder(spec))

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has.  They go many to a text,
        with ``MARK`` after each, since a result a word costs more than its tokens; alone where a word holds ``MARK``."""
        if self.mark is not None and not any(MARK in w for w in words):
            texts = [f" {MARK} ".join(words[i:i + TEXT_WORDS]) + f" {MARK}" for i in range(0, len(words), TEXT_WORDS)]
            flat = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            ends = np.flatnonzero(flat == self.mark)
            if len(ends) == len(words):
                return np.delete(flat, ends), np.diff(ends, prepend=-1) - 1
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for g in got for i in g), np.uint32, int(size.sum())), size

    def plain_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of parts of plain words, whose bytes are spelled in the letters of the
        vocabulary here, so that only the model is left to the library."""
        texts = [LETTERS[np.frombuffer(" ".join(parts[i:i + TEXT_WORDS]).encode(), np.uint8)].tobytes().decode("utf-32-le")
                 for i in range(0, len(parts), TEXT_WORDS)]
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(self.final[flat])
        return (flat, np.diff(ends, prepend=-1)) if len(ends) == len(parts) else self.word_ids(parts)

    def parts(self, vocab: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Parts of non-empty words end to end, the place of every word's first (and their number),
        and whether the word is odd."""
        at, data = raw_bytes(vocab.cast(pa.large_binary()))
        kind, low = self.kinds[data], LOWER[data]
        second = np.zeros(len(data), bool)
        second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (kind[:-1] == LETTER)
        second &= (data != 0x97) & (data != 0xB7)  # U+00D7 and U+00F7 are signs
        kind[second] = LETTER
        low[second & (data < 0x9F)] += 32
        odd = np.logical_or.reduceat(kind == ODD, at[:-1]) if len(at) > 1 else np.zeros(0, bool)
        whole = np.repeat(odd, np.diff(at))
        first = np.ones(len(data), bool)
        first[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) & ~whole[1:]
        first[at[:-1]] = True
        begin = np.append(np.flatnonzero(first), len(data))
        return large_array(pa.large_string(), begin, np.where(whole, data, low)), np.searchsorted(begin, at), odd

    def part_slots(self, parts: list[str], odd: np.ndarray) -> np.ndarray:
        """Slots of distinct parts.  The first ``MEMO_PARTS`` parts are remembered,
        the slots of others hold until the next call."""
        known = self.size = len(self.memo)
        slots = np.fromiter((self.memo.get(p, -1) for p in parts), np.int64, len(parts))
        added: list[str] = []
        for which, ids_of in ((~odd, self.plain_ids), (odd, self.word_ids)):
            new = np.flatnonzero(which & (slots < 0))
            for lo in range(0, len(new), ENCODE_WORDS):
                at = new[lo:lo + ENCODE_WORDS]
                part = [parts[i] for i in at]
                flat, size = ids_of(part)
                while self.size + len(part) + 1 >= len(self.starts):
                    self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
                end = self.starts[self.size]
                while end + len(flat) > len(self.ids):
                    self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
                self.ids[end:end + len(flat)] = flat
                self.starts[self.size + 1:self.size + len(part) + 1] = end + np.cumsum(size)
                slots[at] = np.arange(self.size, self.size + len(part))
                self.size += len(part)
                added += part[:max(0, MEMO_PARTS - known - len(added))]
        self.memo.update(zip(added, range(known, known + len(added)), strict=True))
        return slots

    def spelled(self, vocab: pa.Array) -> pa.Array:
        """Every word's ids, as the bytes of a binary array, which Arrow gathers by copying."""
        parts, first, odd = self.parts(vocab)
        coded = parts.dictionary_encode()
        codes = coded.indices.to_numpy()
        whole = np.zeros(len(coded.dictionary), bool)
        whole[codes] = np.repeat(odd, np.diff(first))
        slots = self.part_slots(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), whole)  # quicker than to_pylist
        held = large_array(pa.large_binary(), self.starts[:self.size + 1] * 4, self.ids)
        at, data = raw_bytes(held.take(pa.array(slots[codes])))
        return large_array(pa.large_binary(), at[first], data)

    def encode(self, text: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of every text, in blocks of bounded size."""
        words = split_words(text)
        spelled = self.spelled(words.vocab)
        row, n = 0, len(text)
        while row < n:
            end = max(row + 1, int(np.searchsorted(words.starts, words.starts[row] + CHUNK_WORDS, "right")) - 1)
            at, data = raw_bytes(spelled.take(pa.array(words.codes[words.starts[row]:words.starts[end]])))
            flat, bounds = data.view(np.uint32), at[words.starts[row:end + 1] - words.starts[row]] // 4
            for i in range(row, end):
                yield i, flat[bounds[i - row]:bounds[i - row + 1]]
            row = end


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int,
               id_col: str, text_col: str) -> DataFrame:
    """Pieces of every document with, for each, its task and its running number
    among the task's pieces of that length."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "task", "nth")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = Encoder.of(spec.value), np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch, text, done in ((b, t, d) for b in batches for t, d in numbered_chunks(b.column(1), 2 * SMALL_CHUNK)):
            rows: list[tuple[int, int, int, int, int, int]] = []
            for i, ids in encoder.encode(text):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append((done + i, k, start, len(part), zlib.crc32(part.tobytes()), seen[len(part)]))
                    seen[len(part)] += 1
            cols = np.array(rows, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[:, 0])), pa.array(cols[:, 1].astype(np.int32)),
                 *[pa.array(cols[:, j]) for j in (2, 3, 4)], pa.array(np.full(len(cols), task)), pa.array(cols[:, 5])],
                names=schema.names)
        give_back(forget=False)

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece.

    Every document is its ids and then ``end_id``; null and empty texts are that
    one id.  Only documents longer than ``capacity`` are cut.  Repeated rows and
    null ids are packed like any other row; an empty table packs to nothing."""
    pieces = stored(cut_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = stored(per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    histogram = {r[0]: r[1] for r in per_task.groupBy("length").agg(F.sum("n")).collect()}  # at most capacity rows
    runs = plan_bins(histogram, capacity)
    # sorted by (length, first), a piece finds its run by one binary search
    table = np.array(sorted((r.length, r.first, r.each, r.bin0, r.offset) for r in runs), np.int64).reshape(-1, 5)
    span = np.int64(1) << 44
    shared = docs.sparkSession.sparkContext.broadcast((table, table[:, 0] * span + table[:, 1]))
    numbered = pieces.join(per_task.drop("n").hint("merge"), ["length", "task"]) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"))
    schema = T.StructType([*numbered.schema.fields[:5], T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in (3, 5))
            run = table[np.searchsorted(keys, length * span + rank, "right") - 1]
            k = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(run[:, 3] + k // run[:, 2]), pa.array(run[:, 4] + k % run[:, 2] * length)],
                names=schema.names)

    return numbered.mapInArrow(place, schema)
