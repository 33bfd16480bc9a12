"""Words of an Arrow batch of texts as numpy arrays.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``.  A batch becomes one integer
code per word, the start of every text in that code array, and the distinct
words, so that work on words is done once per distinct word of the batch."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc


@dataclass
class Words:
    codes: np.ndarray    # one per word, an index into vocab
    starts: np.ndarray   # texts + 1 positions in codes
    vocab: pa.Array      # distinct words

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)


def split_words(text: pa.Array, lower: bool = False) -> Words:
    """Null counts as empty.  ``lower`` folds A-Z only."""
    text = pc.fill_null(text, "")
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(text)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    values = lists.flatten()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    filled = pc.greater(pc.binary_length(values), 0)
    at = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))]).astype(np.int64)
    coded = values.filter(filled).dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), at[ends], coded.dictionary)


def hash_words(vocab: pa.Array) -> np.ndarray:
    """64-bit keyed hash of each distinct word (the same in every process)."""
    if len(vocab) == 0:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(vocab.to_numpy(zero_copy_only=False), categorize=False).astype(np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged_range(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i] .. starts[i] + lengths[i] - 1`` for every i, end to end."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)


def pack48(keys: np.ndarray) -> bytes:
    """The low six bytes of every key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()
