"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch lie end to end in one integer array.  Each round looks up
the rank of every adjacent pair, takes the lowest rank of every pre-token with
one segmented minimum, merges all its occurrences in all pre-tokens at once and
compacts the array; a pre-token without a mergeable pair leaves with its number
of surviving symbols.  Counts are held per distinct word, so a text costs one
look-up per word.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabula.llm.common import map_text
from tabula.llm.words import split_words

NO_RANK = np.iinfo(np.int64).max
MEMO_WORDS = 300_000  # words remembered in a task; the memo starts anew beyond it


@dataclass
class MergeTable:
    """What counting needs of a tokenizer file with word-end BPE."""

    pattern: str
    special: tuple[str, ...]
    normalizer: str       # JSON, as in the file
    inner: np.ndarray     # symbol of each byte inside a pre-token
    final: np.ndarray     # symbol of each byte that ends a pre-token
    pairs: np.ndarray     # sorted (left << 32 | right)
    ranks: np.ndarray
    merged: np.ndarray


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = [chr(b) for b in range(256)]
    for i, b in enumerate(sorted(set(range(256)) - set(own))):
        out[b] = chr(256 + i)
    return out


def load_merge_table(path: str) -> MergeTable:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, steps = spec["model"], spec["normalizer"]["normalizers"]
    split, level = spec["pre_tokenizer"]["pretokenizers"]
    known = ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and split["type"] == "Split"
             and level["type"] == "ByteLevel" and model["end_of_word_suffix"] and not model["ignore_merges"])
    if not known:
        raise ValueError(f"{path}: not a lower-casing word-end BPE tokenizer")
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    letters = byte_letters()
    triples = [(vocab[a] << 32 | vocab[b], i, vocab[a + b]) for i, (a, b) in enumerate(model["merges"])]
    triples.sort()
    pairs, ranks, merged = (np.array(x, np.int64) for x in zip(*triples, strict=True))
    return MergeTable(
        pattern=split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"),
        special=tuple(t["content"] for t in spec["added_tokens"]),
        normalizer=json.dumps(spec["normalizer"]),
        inner=np.array([vocab[c] for c in letters], np.int64),
        final=np.array([vocab[c + end] for c in letters], np.int64),
        pairs=pairs, ranks=ranks, merged=merged)


def surviving_symbols(table: MergeTable, tokens: Sequence[bytes]) -> np.ndarray:
    """Symbols left of each pre-token (non-empty UTF-8 bytes) after all merges."""
    n = len(tokens)
    counts = np.zeros(n, np.int64)
    if n == 0:
        return counts
    size = np.fromiter((len(t) for t in tokens), np.int64, n)
    raw = np.frombuffer(b"".join(tokens), np.uint8)
    last = np.cumsum(size) - 1
    sym = table.inner[raw]
    sym[last] = table.final[raw[last]]
    who = np.arange(n)
    while len(who):
        first = np.cumsum(size) - size
        key = np.full(len(sym), -1, np.int64)
        key[:-1] = sym[:-1] << 32 | sym[1:]
        key[first + size - 1] = -1
        at = np.minimum(np.searchsorted(table.pairs, key), len(table.pairs) - 1)
        rank = np.where(table.pairs[at] == key, table.ranks[at], NO_RANK)
        lowest = np.minimum.reduceat(rank, first)
        done = lowest == NO_RANK
        counts[who[done]] = size[done]
        hit = (rank != NO_RANK) & (rank == np.repeat(lowest, size))
        # a run of hits such as "aaa" merges from its left, every second one
        idx = np.arange(len(sym))
        prev = np.concatenate([[False], hit[:-1]])
        run = np.maximum.accumulate(np.where(hit & ~prev, idx, 0))
        hit &= (idx - run) % 2 == 0
        sym[hit] = table.merged[at[hit]]
        stay = np.repeat(~done, size)
        gone = np.concatenate([[False], hit[:-1]])
        left = np.add.reduceat((~gone).astype(np.int64), first)
        sym = sym[stay & ~gone]
        size, who = left[~done], who[~done]
    return counts


class WordCounter:
    """Tokens of a word, remembered per distinct word."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.split = regex.compile(table.pattern)
        self.special = regex.compile("(" + "|".join(map(regex.escape, table.special)) + ")") if table.special else None
        self.memo: dict[str, int] = {}
        # the file's own normalizer: Unicode tables differ between libraries
        from tokenizers import Tokenizer
        bare = {"version": "1.0", "added_tokens": [], "normalizer": json.loads(table.normalizer),
                "model": {"type": "BPE", "vocab": {}, "merges": []}}
        self.normal = Tokenizer.from_str(json.dumps(bare)).normalizer

    def pre_tokens(self, word: str) -> tuple[int, list[bytes]]:
        """Special strings in the word, and the pre-tokens of the rest."""
        parts, found = [word], 0
        if self.special and self.special.search(word):
            parts = self.special.split(word)
            found = len(parts) // 2
            parts = parts[::2]
        out: list[bytes] = []
        for p in parts:
            p = p.lower() if p.isascii() else self.normal.normalize_str(p)
            out += [t.encode() for t in self.split.findall(p)]
        return found, out

    def counts(self, words: Sequence[str]) -> np.ndarray:
        new = [w for w in words if w not in self.memo]
        if new:
            if len(self.memo) + len(new) > MEMO_WORDS:
                self.memo = {}
                new = list(words)
            fixed = np.zeros(len(new), np.int64)
            owner: list[int] = []
            tokens: list[bytes] = []
            for i, w in enumerate(new):
                fixed[i], got = self.pre_tokens(w)
                tokens += got
                owner += [i] * len(got)
            distinct: dict[bytes, int] = {}
            which = np.fromiter((distinct.setdefault(t, len(distinct)) for t in tokens), np.int64, len(tokens))
            each = surviving_symbols(self.table, list(distinct))
            fixed += np.bincount(np.array(owner, np.int64), each[which], len(new)).astype(np.int64) if tokens else 0
            self.memo.update(zip(new, fixed.tolist(), strict=True))
        return np.fromiter((self.memo[w] for w in words), np.int64, len(words))


def batch_counter(table: MergeTable) -> Callable[[pa.Array], np.ndarray]:
    counter = WordCounter(table)

    def count(text: pa.Array) -> np.ndarray:
        words = split_words(text)
        per_word = counter.counts(words.vocab.to_pylist())
        total = np.concatenate([[0], np.cumsum(per_word[words.codes])])
        return total[words.starts[1:]] - total[words.starts[:-1]]

    return count


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    Null and empty texts have no bytes and no tokens.  Each input row gives one
    row, repeated rows and null ids too; other columns are ignored.  The merge
    table (about 2 MB, fixed by the tokenizer file) is read on the driver and
    broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(load_merge_table(tokenizer_path))
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
              T.StructField("over_limit", T.BooleanType())]

    def make():
        count = batch_counter(shared.value)

        def fn(text: pa.Array) -> dict:
            n = count(text)
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            return {"n_bytes": size, "n_tokens": n, "over_limit": n > limit}

        return fn

    return map_text(docs, text_col, fields, make, keep=[id_col]).withColumnRenamed(id_col, "doc_id")
