"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its subwords (the 2- to 4-byte grams of
each lower-cased word with its boundaries), hashed into a table; a linear softmax
on the average gives the languages.  Table and softmax are trained together by
stochastic gradient descent in numpy on the driver, from a bounded sample.  As both
layers are linear, prediction needs one row of logits per bucket, and a word costs
one look-up in its batch however often it occurs.  A temperature fitted on the part
of the sample that was left out of training calibrates the score; below the
threshold that keeps the wanted precision there, a prediction is not ``accepted``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm.common import bounded_sample, crc32_of, map_text, text_chunks
from tabula.llm.words import mix64, ragged_range, split_words

BUCKET_BITS = 16
WIDTH = 16
GRAMS = (2, 3, 4)
EPOCHS = 3
RATE = 0.5
PRECISION = 0.99
FIT_BYTES = 2 << 20  # text turned into subwords at once in fitting
NONE = "und"


def word_grams(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of each distinct word, end to end, and their starts."""
    if len(vocab) == 0:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    marked = pc.binary_join_element_wise(pa.scalar("<"), pc.utf8_lower(vocab), pa.scalar(">"), "")
    size = pc.binary_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = _bytes_of(marked).astype(np.uint64)
    first = np.cumsum(size) - size
    per = np.stack([np.maximum(size - n + 1, 0) for n in GRAMS])
    starts = np.concatenate([[0], np.cumsum(per.sum(axis=0))])
    out = np.zeros(int(starts[-1]), np.int64)
    to = starts[:-1].copy()
    for n, count in zip(GRAMS, per, strict=True):
        at = ragged_range(first, count)
        h = np.full(len(at), np.uint64(n), np.uint64)
        for j in range(n):
            h = h * np.uint64(257) + raw[at + j]
        out[ragged_range(to, count)] = (mix64(h) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        to += count
    return out, starts


def _bytes_of(strings: pa.Array) -> np.ndarray:
    """The characters of a string array, end to end."""
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32)[strings.offset:strings.offset + len(strings) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]


def has_letter(vocab: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(vocab, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray      # bucket -> logit of every language
    bias: np.ndarray
    temperature: float
    accept_from: float

    def text_logits(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Logits of each text and whether it has a letter."""
        words = split_words(text)
        grams, starts = word_grams(words.vocab)
        count = np.diff(starts)
        rows = np.zeros((len(words.vocab), len(self.languages)))
        if len(grams):
            total = np.add.reduceat(self.logits[grams], np.minimum(starts[:-1], len(grams) - 1), axis=0)
            rows = np.where(count[:, None] > 0, total, 0)
        owner = np.repeat(np.arange(len(text)), words.lengths)
        columns = [*rows.T, count.astype(float), has_letter(words.vocab).astype(float)]
        sums = np.stack([np.bincount(owner, c[words.codes], len(text)) for c in columns], axis=1)
        return sums[:, :-2] / np.maximum(sums[:, -2:-1], 1) + self.bias, sums[:, -1] > 0.5

    def predict(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language number (-1: no letter) and calibrated probability."""
        z, lettered = self.text_logits(text)
        p = softmax(z * self.temperature)
        best = p.argmax(axis=1) if len(p) else np.zeros(0, np.int64)
        return np.where(lettered, best, -1), np.where(lettered, p.max(axis=1) if len(p) else 0.0, 0.0)


def train(texts: list[str], labels: list[str], seed: int = 7) -> LanguageModel:
    """Embeddings and softmax by stochastic gradient descent, a text a step."""
    names = sorted(set(labels))
    y = np.array([names.index(x) for x in labels], np.int64)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / WIDTH, (1 << BUCKET_BITS, WIDTH))
    out, bias = np.zeros((WIDTH, len(names))), np.zeros(len(names))
    held = rng.permutation(len(texts))
    n_left = len(texts) // 5
    left, used = held[:n_left], held[n_left:]
    bags = []
    for part in text_chunks(pa.array(texts, pa.string()), FIT_BYTES):
        words = split_words(part)
        grams, starts = word_grams(words.vocab)
        for i in range(len(part)):
            code, n = np.unique(words.codes[words.starts[i]:words.starts[i + 1]], return_counts=True)
            size = starts[code + 1] - starts[code]
            share = np.bincount(grams[ragged_range(starts[code], size)], np.repeat(n, size).astype(float), 1 << BUCKET_BITS)
            bucket = np.flatnonzero(share)
            bags.append((bucket.astype(np.uint16), (share[bucket] / max(1.0, share.sum())).astype(np.float32)))
    step, steps = 0, max(1, EPOCHS * len(used))
    for _ in range(EPOCHS):
        for i in rng.permutation(used):
            bucket, share = bags[i]
            if not len(bucket):
                continue
            rate = RATE * (1 - step / steps)
            step += 1
            mean = share @ table[bucket]
            g = softmax(mean @ out + bias)
            g[y[i]] -= 1
            back = out @ g
            out -= rate * np.outer(mean, g)
            bias -= rate * 0.1 * g
            table[bucket] -= rate * len(names) * share[:, None] * back
    model = LanguageModel(names, (table @ out).astype(np.float32), bias, 1.0, 0.0)
    if n_left and len(names) > 1:
        parts = [model.text_logits(p) for p in text_chunks(pa.array([texts[i] for i in left], pa.string()), FIT_BYTES)]
        z, lettered = (np.concatenate(x) for x in zip(*parts, strict=True))
        z, truth = z[lettered], y[left][lettered]
        if len(truth):
            loss = {t: -np.log(softmax(z * t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.1, 20, 60)}
            model.temperature = float(min(loss, key=loss.get))
            p = softmax(z * model.temperature)
            order = np.argsort(-p.max(axis=1))
            right = np.cumsum((p.argmax(axis=1) == truth)[order]) / np.arange(1, len(truth) + 1)
            good = np.flatnonzero(right >= PRECISION)
            model.accept_from = float(p.max(axis=1)[order][good[-1]]) if len(good) else 1.0
    return model


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       mod: int = 4, held_out: int = 2, max_train: int = 5000, max_bytes: int = 64 << 20) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` for every row.

    Rows whose CRC-32 of the id (as text) is ``held_out`` modulo ``mod``, and rows
    with a null id, text or language, are not learned from; of the others at most
    ``max_train`` with ``max_bytes`` bytes of text (chosen by a hash of id and text) are.  ``lang_pred`` is ``und`` with
    score 0 if the text is null or has no letter, or if there was nothing to learn
    from.  Repeated rows each give a row; other columns are ignored."""
    keep_out = F.coalesce(crc32_of(f"`{id_col}`") % mod == held_out, F.lit(True))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"), keep_out.alias("held_out"))
    known = rows.filter("not held_out and lang is not null and text is not null")
    sample = sorted((r["lang"], r["text"]) for r in bounded_sample(known, "doc_id", "text", max_train, max_bytes).collect())
    model = train([t for _, t in sample], [x for x, _ in sample]) if sample else None
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("accepted", T.BooleanType())]

    def make():
        model = shared.value

        def fn(text: pa.Array) -> dict:
            if model is None:
                n = len(text)
                return {"lang_pred": [NONE] * n, "score": np.zeros(n), "accepted": np.zeros(n, bool)}
            best, score = model.predict(text)
            names = np.array([*model.languages, NONE], object)
            return {"lang_pred": pa.array(names[best], pa.string()), "score": score,
                    "accepted": (best >= 0) & (score >= model.accept_from)}

        return fn

    return map_text(rows, "text", fields, make, keep=["doc_id", "held_out"])
