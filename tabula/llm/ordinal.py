"""Quality classifier: cumulative-link (ordinal logistic) regression.

Ratings are ordered grades 0 .. K-1.  One weight vector over hashed text features
is shared by all grades; ordered thresholds cut its score:

    P(grade >= k) = sigmoid(score - threshold_k),  threshold_1 < ... < threshold_{K-1}

The expected grade is the sum of these tail probabilities, and one of them selects.
Features of a text: each plain word it holds (case and punctuation removed), each
beginning of such a word, the share of words with each kind of punctuation, the share of words equal to the word
before, and how many distinct words there are for its length.  Fitted with Adam in
numpy on the driver, from a bounded sample of rated rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm.common import SMALL_CHUNK, bounded_sample, give_back, map_text, numbered_chunks
from tabula.llm.words import hash_words, mix64, split_words

BITS = 20
MIN_TEXTS = 5       # a bucket can be a feature from so many texts of the sample
MIN_Z = 4.0         # and when its texts lie below or above a grade so much oftener than chance
BEGIN = 4           # letters of a word's beginning
STEPS = 300
RATE = 0.1
DECAY = 2e-4
DENSE = 2
FIT_BYTES = 2 << 20  # text turned into features at once in fitting


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def features(text: pa.Array, useful: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features (text, bucket, value) and the dense ones.

    With ``useful`` (a bit per bucket) other buckets are left out early."""
    words = split_words(text)
    n, lengths = len(text), words.lengths
    owner = np.repeat(np.arange(n), lengths)
    lower = pc.utf8_lower(words.vocab)
    plain = pc.replace_substring_regex(lower, r"[^\p{L}\p{N}]+", "")
    begins = pc.utf8_slice_codeunits(plain, 0, BEGIN)
    marks = pc.replace_substring_regex(words.vocab, r"[\p{L}\p{N}]+", "")
    share = 1 / np.maximum(lengths, 1)
    cols: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for salt, strings in enumerate((plain, begins, marks)):
        filled = pc.greater(pc.binary_length(strings), 0).to_numpy(zero_copy_only=False).astype(bool)
        bucket = (mix64(hash_words(strings) + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.int64)
        if useful is not None:
            filled = filled & useful[bucket] if len(filled) else filled
        used = filled[words.codes] if len(filled) else np.zeros(0, bool)
        pair, times = np.unique(owner[used] << BITS | bucket[words.codes[used]], return_counts=True)
        who = pair >> BITS
        value = np.sqrt(times * share[who]) if strings is marks else np.ones(len(pair))
        cols.append((who, pair & ((1 << BITS) - 1), value))
    who, bucket, value = (np.concatenate(c) for c in zip(*cols, strict=True))
    same = np.zeros(len(words.codes))
    same[1:] = (words.codes[1:] == words.codes[:-1]) & (owner[1:] == owner[:-1])
    distinct = np.bincount(np.unique(owner * (len(words.vocab) + 1) + words.codes) // (len(words.vocab) + 1), minlength=n) \
        if len(owner) else np.zeros(n)
    dense = np.stack([3 * np.bincount(owner, same, n) * share,
                      (np.log1p(distinct) - 0.85 * np.log1p(lengths))], axis=1)
    return who, bucket, value, dense


@dataclass
class OrdinalModel:
    grades: int
    useful: np.ndarray       # bit per bucket
    weight: np.ndarray       # per bucket
    dense: np.ndarray
    centre: np.ndarray
    thresholds: np.ndarray

    def tails(self, text: pa.Array) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K-1, a row a text."""
        who, bucket, value, dense = features(text, self.useful)
        score = np.bincount(who, value * self.weight[bucket], len(text)) + (dense - self.centre) @ self.dense
        return sigmoid(score[:, None] - self.thresholds[None, :])


def fit(texts: list[str | None], grades: list[int], n_grades: int) -> OrdinalModel:
    y, array = np.array(grades, np.int64), pa.array(texts, pa.string())
    # first pass, a slice at a time: in how many texts, and in how many below each grade, a bucket occurs
    held, below = np.zeros(1 << BITS), np.zeros((n_grades, 1 << BITS))
    for part, done in numbered_chunks(array, FIT_BYTES):
        who, bucket, _, _ = features(part)
        held += np.bincount(bucket, minlength=1 << BITS)
        for k in range(1, n_grades):
            below[k] += np.bincount(bucket, y[done + who] < k, 1 << BITS)
    useful = np.zeros(1 << BITS, bool)
    for k in range(1, n_grades):
        low = (y < k).mean()
        chance = np.sqrt(np.maximum(held * low * (1 - low), 1e-9))
        useful |= np.abs(below[k] - held * low) >= MIN_Z * chance
    useful &= held >= MIN_TEXTS
    got = [(done + who, bucket, value, dense) for part, done in numbered_chunks(array, FIT_BYTES)
           for who, bucket, value, dense in [features(part, useful)]]
    who, bucket, value, dense = (np.concatenate(x) for x in zip(*got, strict=True))
    kept, col = np.unique(bucket, return_inverse=True)
    centre = dense.mean(axis=0)
    dense = dense - centre
    tail = np.array([np.clip((y >= k).mean(), 1e-3, 1 - 1e-3) for k in range(1, n_grades)])
    base = -np.log(tail / (1 - tail))
    gaps = np.maximum(np.diff(base), 0.05)
    # parameters: sparse weights, dense weights, first threshold, logarithms of the gaps
    theta = np.concatenate([np.zeros(len(kept) + DENSE), base[:1], np.log(gaps)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    k, rows = len(kept), np.arange(len(y))
    for step in range(1, STEPS + 1):
        cuts = theta[k + DENSE] + np.concatenate([[0.0], np.cumsum(np.exp(theta[k + DENSE + 1:]))])
        score = np.bincount(who, value * theta[col], len(y)) + dense @ theta[k:k + DENSE]
        above = np.concatenate([np.ones((len(y), 1)), sigmoid(score[:, None] - cuts), np.zeros((len(y), 1))], axis=1)
        p = np.maximum(above[rows, y] - above[rows, y + 1], 1e-12)
        slope = above * (1 - above)
        d_score = -(slope[rows, y] - slope[rows, y + 1]) / p / len(y)
        d_cut = np.zeros(n_grades + 1)
        np.add.at(d_cut, y, slope[rows, y] / p / len(y))
        np.add.at(d_cut, y + 1, -slope[rows, y + 1] / p / len(y))
        d_cut = d_cut[1:n_grades]
        later = np.cumsum(d_cut[::-1])[::-1]
        grad = np.concatenate([np.bincount(col, value * d_score[who], k) + DECAY * theta[:k], dense.T @ d_score,
                               later[:1], later[1:] * np.exp(theta[k + DENSE + 1:])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weight, bits = np.zeros(1 << BITS), np.zeros(1 << BITS, bool)
    weight[kept], bits[kept] = theta[:k], True
    cuts = theta[k + DENSE] + np.concatenate([[0.0], np.cumsum(np.exp(theta[k + DENSE + 1:]))])
    return OrdinalModel(n_grades, bits, weight, theta[k:k + DENSE], centre, cuts)


def document_grade() -> Column:
    """Grade of a label row: 0 toxic, 1 of low quality, 2 good; null if unrated."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


def fit_on_labels(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, id_col: str = "doc_id", text_col: str = "text",
                  grade_col: str = "grade", max_train: int = 6000, max_bytes: int = 64 << 20) -> OrdinalModel | None:
    """Fit on at most ``max_train`` rated rows and ``max_bytes`` bytes of text, chosen by a hash of id and text.  Rows with
    a null id, grade or text, and grades out of range, are not learned from; None without any."""
    rated = ratings.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{grade_col}`").cast("int").alias("grade")) \
        .filter((F.col("grade") >= 0) & (F.col("grade") < n_grades) & F.col("id").isNotNull())
    # at most max_train pairs of numbers, chosen by hash: safe to broadcast
    chosen = rated.orderBy(F.xxhash64("id", F.lit("rated")), "id", "grade").limit(max_train)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).filter("text is not null")
    joined = texts.join(F.broadcast(chosen), "id")
    rows = sorted((r["text"], r["grade"]) for r in bounded_sample(joined, "id", "text", max_train, max_bytes).collect())
    model = fit([t for t, _ in rows], [g for _, g in rows], n_grades) if rows else None
    del rows
    give_back(forget=False)  # the driver lives on through the stages that follow
    return model


def grade_texts(docs: DataFrame, model: OrdinalModel | None, n_grades: int = 3, text_col: str = "text",
                select_from: int | None = None, at_least: float = 0.5, keep: list[str] | None = None,
                only_kept: bool = False) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_at_least_1`` .. and ``keep``.

    ``keep`` is true where P(grade >= ``select_from``) (default: the top grade) is
    ``at_least`` or more; ``only_kept`` returns only those rows, with their own
    columns alone (which may have any names).  Null and empty
    texts are graded as texts without words, very long ones whole.  Without a model every text has the top grade.
    Rows, ids and other columns pass through."""
    top = n_grades - 1 if select_from is None else select_from
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tails = [f"p_at_least_{k}" for k in range(1, n_grades)]
    fields = [T.StructField(c, T.DoubleType()) for c in ("expected_grade", *tails)] + [T.StructField("keep", T.BooleanType())]

    def make():
        model = shared.value

        def fn(text: pa.Array) -> dict:
            p = model.tails(text) if model else np.ones((len(text), n_grades - 1))
            return {"expected_grade": p.sum(axis=1), "keep": p[:, top - 1] >= at_least} | {c: p[:, j] for j, c in enumerate(tails)}

        return fn

    return map_text(docs, text_col, fields, make, keep=keep, only="keep" if only_kept else None, bare=only_kept, chunk=SMALL_CHUNK)
