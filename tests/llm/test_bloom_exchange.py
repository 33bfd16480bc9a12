"""op2 on more cells than may be broadcast (F2): no pass over the texts for each pair of blocks."""

import random

from tabula.llm import bloom_lm


def _docs(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(400)] + [(7, None), (None, "w1 w2"), (8, ""), (7, "w1 w2")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def _results(docs, **kw):
    key = lambda r: [str(round(v, 6) if isinstance(v, float) else v) for v in r]
    return sorted(map(key, bloom_lm.score_texts(docs, held_out_mod=3, **kw).collect()))


def test_answers_of_cells_score_as_broadcast_cells(spark, monkeypatch):
    written, plain = [], bloom_lm.stored
    monkeypatch.setattr(bloom_lm, "stored", lambda df, label, path=None: written.append(label) or plain(df, label, path))
    docs = _docs(spark)
    whole = _results(docs)
    assert len(whole) == 404 and written == ["lm-cells", "lm-scores"]
    for most in (1, 5_000):
        written.clear()
        assert _results(docs, max_broadcast=most) == whole
        assert written[-2:] == ["lm-batches", "lm-answers"] and len(written) <= 3  # texts once, whatever the cells
    monkeypatch.setattr(bloom_lm, "SMALL_CHUNK", 500)
    assert _results(docs, max_broadcast=1) == whole


def test_other_ids_and_no_training_text(spark):
    docs = spark.createDataFrame([("a", "x y"), ("b", "x")], "doc_id string, text string")
    assert _results(docs, max_broadcast=0) == _results(docs)
    none = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert _results(none, max_broadcast=0) == _results(none)
    assert bloom_lm.score_texts(docs.limit(0), max_broadcast=0).count() == 0
