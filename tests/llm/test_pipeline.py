"""The pipeline against a plain version of its stages on the smallest tables."""

from __future__ import annotations

import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabula.llm import packing, queries
from tabula.llm.common import stored
from tests.conftest import SF_SMALL
from tests.llm.test_ops import BLANK, brute_components, check_packing


def plain(text):
    return [w for w in (re.sub(r"[\W_]+", "", x.lower()) for x in (text or "").split()) if w]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("keep", F.lit("an extra column")), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), "test-" + name.replace(" ", "-"))
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_keep_the_columns_of_documents(spark, stages):
    want = [*spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns, "keep"]
    assert all(s.columns == want for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join",
                                                      "benchmark decontamination", "best-fit packing"]


def test_every_stage_equals_its_plain_version(spark, stages):
    graded = {r["doc_id"]: r["keep"] for r in queries.op10_quality(spark, SF_SMALL).collect()}
    kept = texts(stages[0])
    assert set(kept) == {i for i, k in graded.items() if k} and len(kept) > 100

    best = {}
    for i, t in kept.items():
        key = BLANK.sub("", t or "")
        best[key] = min(best.get(key, (1, 0)), (-len(t or ""), i))
    unique = texts(stages[1])
    assert set(unique) == {i for _, i in best.values()}

    comp = brute_components(list(unique.items()), 5, 80)
    apart = texts(stages[2])
    assert set(apart) == {i for i, (_, c) in comp.items() if i == c}

    items = [plain(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    whole = lambda t: any(" " + " ".join(x) + " " in f" {' '.join(plain(t))} " for x in items)
    clean = texts(stages[3])
    assert set(apart) - set(clean) == {i for i, t in apart.items() if whole(t)}

    used, bound = check_packing(list(clean.items()), stages[4].collect(), 4096)
    assert used <= bound + 1


def test_stages_bear_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_run_returns_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == packing.pack(stages[3], public_tokenizers.path("word_bpe_49k.json")).columns
    assert got.count() == stages[4].count()
