"""Benchmark decontamination by spaced-seed hashing.

Texts and test items become lower-cased words without punctuation.  Fixed masks
hash six of about ten consecutive words and ignore the others, so a hit survives
substitutions at the ignored places.  Test items are hashed on the driver in blocks
of bounded size and broadcast; documents are hashed in Arrow batches and looked up
first in a bit table, then in the sorted hashes.  Around every hit the document and
the item are compared word by word along their common diagonal, and the longest run
with at least the wanted share of equal words decides.  Items shorter than the shortest mask are hashed
whole, one mask without ignored places for each such length.  Letters of scripts that put no blanks
between words are words of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm.common import SMALL_CHUNK, map_text
from tabula.llm.words import hash_words, mix64, ragged_range, split_words

# fixed values: the spaced seeds; 1 is a word that must be equal, 0 one that is ignored
MASKS = ("110110011", "1011000111", "1010011011", "11100101001")
SHORTEST = min(map(len, MASKS))
# scripts written without blanks between words
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
TABLE_BITS = 22
BLOCK_BYTES = 16 << 20
MULT = np.uint64(0x9E3779B97F4A7C15)
SPAN = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()),
                     T.StructField("words", T.LongType()), T.StructField("equal", T.LongType())])


def plain_words(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words without case and punctuation, and where texts start.
    Words without a letter or digit are left out; each letter of an unspaced script is a word."""
    if pc.any(pc.match_substring_regex(text, UNSPACED)).as_py():
        text = pc.replace_substring_regex(text, f"({UNSPACED})", r" \1 ")
    words = split_words(text)
    plain = pc.replace_substring_regex(pc.utf8_lower(words.vocab), r"[^\p{L}\p{N}]+", "")
    filled = pc.greater(pc.binary_length(plain), 0).to_numpy(zero_copy_only=False)
    keep = filled[words.codes] if len(words.codes) else np.zeros(0, bool)
    at = np.concatenate([[0], np.cumsum(keep)])
    return hash_words(plain)[words.codes][keep], at[words.starts]


def seed_hashes(word: np.ndarray, starts: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which the mask fits inside its text, and the hashes there."""
    at = ragged_range(starts[:-1], np.maximum(np.diff(starts) - len(mask) + 1, 0))
    h = np.full(len(at), np.uint64(len(mask)), np.uint64)
    for j, c in enumerate(mask):
        if c == "1":
            h = h * MULT + word[at + j]
    return at, mix64(h + np.uint64(int(mask, 2)))


@dataclass
class SeedTable:
    """Hashed seeds of a block of items: sorted hashes with item number and place."""

    ids: np.ndarray
    word: np.ndarray
    starts: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray
    masks: tuple[str, ...]


def seed_table(ids: list[int], texts: list[str]) -> SeedTable:
    word, starts = plain_words(pa.array(texts, pa.string()))
    found = [seed_hashes(word, starts, m) for m in MASKS]
    size = np.diff(starts)
    short = [n for n in range(1, SHORTEST) if (size == n).any()]
    for n in short:  # the only place of such an item
        at, h = seed_hashes(word, starts, "1" * n)
        whole = size[np.searchsorted(starts, at, "right") - 1] == n
        found.append((at[whole], h[whole]))
    at, h = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(h, kind="stable")
    at, h = at[order], h[order]
    item = np.searchsorted(starts, at, "right") - 1
    table = np.zeros(1 << TABLE_BITS, bool)
    table[h >> np.uint64(64 - TABLE_BITS)] = True
    return SeedTable(np.array(ids, np.int64), word, starts, h, item, at - starts[item], table,
                     (*MASKS, *("1" * n for n in short)))


def best_run(equal: np.ndarray, share: float) -> tuple[int, int]:
    """The longest run with at least the share of equal words, the first of equally
    long ones.  In whole numbers an equal word earns den - num and another costs num,
    so that a run has the share exactly when its score is 0 or more."""
    num, den = Fraction(share).limit_denominator(1_000_000).as_integer_ratio()
    total = np.concatenate([[0], np.cumsum(np.where(equal, den - num, -num))])
    # per end, the first start that is not higher
    start = np.searchsorted(-np.minimum.accumulate(total), -total, "left")
    end = int(np.argmax(np.arange(len(total)) - start))
    return int(start[end]), end


def find_overlaps(seeds: SeedTable, word: np.ndarray, starts: np.ndarray, min_words: int,
                  share: float) -> list[list[tuple[int, int, int, int]]]:
    """Per text, the verified (item id, start, words, equal words), one per item."""
    out: list[dict[int, tuple]] = [{} for _ in range(len(starts) - 1)]
    hits = []
    for m in seeds.masks:
        at, h = seed_hashes(word, starts, m)
        may = seeds.table[h >> np.uint64(64 - TABLE_BITS)]
        at, h = at[may], h[may]
        lo, hi = np.searchsorted(seeds.hashes, h, "left"), np.searchsorted(seeds.hashes, h, "right")
        which = ragged_range(lo, hi - lo)
        at = np.repeat(at, hi - lo)
        text = np.searchsorted(starts, at, "right") - 1
        hits.append(np.stack([text, seeds.item[which], at - starts[text] - seeds.place[which]], axis=1))
    for text, item, shift in np.unique(np.concatenate(hits), axis=0).tolist():
        a, b = word[starts[text]:starts[text + 1]], seeds.word[seeds.starts[item]:seeds.starts[item + 1]]
        lo, hi = max(0, shift), min(len(a), shift + len(b))
        equal = a[lo:hi] == b[lo - shift:hi - shift]
        start, end = best_run(equal, share)
        if end - start >= min(min_words, len(b)):
            got = (int(seeds.ids[item]), lo + start, end - start, int(equal[start:end].sum()))
            if item not in out[text] or out[text][item][3] < got[3]:
                out[text][item] = got
    return [sorted(x.values()) for x in out]


def mark_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", min_words: int = 12, share: float = 0.75, spans_col: str = "spans",
                  keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``spans_col``: for every test item found, its id, the first word
    and number of words of the overlap (in words that have a letter or digit), and how many are equal.

    An overlap needs ``min_words`` words (or the whole item, if shorter), of which
    ``share`` are equal, and the longest such run of a diagonal is given (of several diagonals, the one with most
    equal words).  It is looked for where a seed hits: six equal words at the places of a mask.  Items of fewer words than the shortest mask (9) are
    found where all their words occur in a row.  Words of scripts without blanks are their letters.  Null and
    empty items match nothing, nor do items without an id; null and empty documents get an empty list.  Texts of any length are read whole.  Rows, ids
    and other columns pass through unchanged."""
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("id"), F.col(f"`{item_text_col}`").cast("string").alias("t")) \
        .filter("id is not null and t is not null").distinct()
    size = items.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    kept = list(docs.columns if keep is None else keep)
    out, parts = docs, []
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b).orderBy("id", "t").collect()
        shared = docs.sparkSession.sparkContext.broadcast(seed_table([r[0] for r in rows], [r[1] for r in rows]))
        part = f"__spans{b}"

        def make(shared=shared, part=part):
            def fn(text: pa.Array) -> dict:
                found = find_overlaps(shared.value, *plain_words(text), min_words, share)
                names = SPAN.names
                return {part: pa.array([[dict(zip(names, s, strict=True)) for s in f] for f in found],
                                       pa.list_(pa.struct([(n, pa.int64()) for n in names])))}

            return fn

        out = map_text(out, text_col, [T.StructField(part, T.ArrayType(SPAN))], make,
                       keep=[*(dict.fromkeys([*kept, text_col]) if b + 1 < blocks else kept), *parts], chunk=SMALL_CHUNK)
        parts.append(part)
    return out.withColumn(spans_col, F.concat(*parts)).drop(*parts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any overlap, with their columns."""
    marked = mark_overlaps(docs, benchmark, text_col, spans_col="__found", **options)
    return marked.filter(F.size("__found") == 0).drop("__found")
