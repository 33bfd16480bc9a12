"""Steps whose tasks must not grow with the input: partitions follow the work, workers hold bounded blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.models import batched_logistic as BL
from tabula.models import knn as KN
from tabula.models import masked_knn as MK
from tabula.operators import glm as G
from tabula.operators import metrics as ME


def test_newton_passes_read_small_partitions_together(spark, monkeypatch):
    """model_comparison: a pass had a task for each of the many small partitions of its design."""
    seen, plain = [], G._newton_pieces
    monkeypatch.setattr(G, "_newton_pieces", lambda data, *a, **k: seen.append(data.rdd.getNumPartitions()) or plain(data, *a, **k))
    df = spark.range(200).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3 == 0).cast("int").alias("y")).repartition(40)
    monkeypatch.setattr(G, "ROWS_PER_TASK", 50)
    fit = G.fit_glm(df, ["a"], "y")
    assert fit.n == 200 and set(seen) == {4}


def test_auc_of_many_candidates_in_bounded_ranges(spark, monkeypatch):
    """feature_group_search: ties, a constant score and one class of rows apart, equal to the AUC by key."""
    rng = np.random.default_rng(3)
    rows = [(-1, int(i % 3), float(rng.integers(0, 2)), [float(v) for v in rng.integers(0, 3, 2)]) for i in range(300)]
    data = spark.createDataFrame(rows, "view int, fold int, y double, x array<double>").repartition(5)
    candidates = [BL.Candidate(f, 1.0, 0.0) for f in (0, 1, 2, 0)]
    betas = np.array([[0.1, 1.0, -0.5], [0.0, 0.2, 0.2], [0.3, 0.0, 0.0], [0.0, -1.0, 0.0]])
    want = BL.candidate_metric(BL.validation_scores(data, candidates, betas), "roc_auc")
    ranges, plain = [], ME.auc_of_counts
    monkeypatch.setattr(ME, "auc_of_counts", lambda counts, key, n: ranges.append(n) or plain(counts, key, n))
    monkeypatch.setattr(BL, "TASK_SCORES", 60)
    got = BL.validation_auc(data, candidates, betas)
    assert ranges == [7] and got.keys() == want.keys()  # 400 scores
    assert got == pytest.approx(want, abs=1e-12)


def test_rows_of_a_search_are_dealt_by_work(spark, monkeypatch):
    monkeypatch.setattr(BL, "TASK_WORK", 1000)
    rows = spark.range(100).coalesce(1)
    assert BL.balanced(rows, 100, 50).rdd.getNumPartitions() == 5


def test_visits_come_in_bounded_blocks(spark, monkeypatch):
    """knn_scores: a worker held the visits of a whole Arrow batch, 10,000 queries times all cells."""
    monkeypatch.setattr(KN, "VISITS_AT_ONCE", 64)
    cells = KN._Cells(np.arange(16.0)[:, None], "euclidean", 2)
    cells.count[:], cells.high[:] = 5, 0.5
    sizes = []

    class Rows:
        schema = spark.createDataFrame([], "space int, qid long, vec array<double>, kth double").schema

        def mapInPandas(self, run, schema):
            pdf = pd.DataFrame({"space": 0, "qid": range(40), "vec": [[7.0]] * 40, "kth": 99.0})
            out = list(run(iter([pdf])))
            sizes.extend(len(o) for o in out)
            return pd.concat(out)

    seen = KN._visits(Rows(), {0: cells}, 5, True)
    assert len(seen) == 40 * 15 and max(sizes) <= 64


def test_blocks_of_a_masked_search_are_cut(spark, monkeypatch):
    """knn_imputed: the distances of a block are held a slice at a time, with the same neighbours."""
    rng = np.random.default_rng(5)
    cell = lambda v, j: None if rng.random() < 0.3 else float(v[j])
    rows = [(i, [cell(v, j) for j in range(3)]) for i, v in enumerate(rng.integers(0, 5, (120, 3)))]
    q, d = spark.createDataFrame(rows[:60], "qid long, vec array<double>"), spark.createDataFrame(rows[60:], "did long, vec array<double>")
    want = sorted(map(tuple, MK.masked_neighbours(q, d, 3).collect()))
    monkeypatch.setattr(MK, "CELLS_AT_ONCE", 16)
    assert sorted(map(tuple, MK.masked_neighbours(q, d, 3).collect())) == want
