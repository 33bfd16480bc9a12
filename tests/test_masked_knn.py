"""Imputation by masked neighbour search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.models import knn as KN
from tabula.models import masked_knn as MK


def plain(x: np.ndarray, donors: np.ndarray, k: int) -> np.ndarray:
    out = x.copy()
    means = np.array([np.nanmean(c) if (~np.isnan(c)).any() else np.nan for c in donors.T])
    for i, r in enumerate(x):
        for t in np.flatnonzero(np.isnan(r)):
            found = []
            for j, d in enumerate(donors):
                both = ~np.isnan(r) & ~np.isnan(d)
                if both.any() and not np.isnan(d[t]):
                    found.append((np.sqrt(len(r) / both.sum() * ((r[both] - d[both]) ** 2).sum()), j))
            best = [donors[j, t] for _, j in sorted(found)[:k]]
            out[i, t] = np.mean(best) if best else means[t]
    return out


def holes(seed: int, n: int, cols: int, share: float) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, cols)) + 3 * rng.integers(0, 4, size=(n, 1))
    x[: n // 3] = x[0]  # a third of the rows are copies
    x[rng.random(x.shape) < share] = np.nan
    return x


def frame(spark, x: np.ndarray, first: int = 0):
    names = [f"c{j}" for j in range(x.shape[1])]
    rows = [(first + i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in names)), names


@pytest.mark.parametrize("masks", [512, 5])
def test_many_columns_with_independent_nulls(spark, monkeypatch, masks):
    monkeypatch.setattr(MK, "MAX_MASKS", masks)
    monkeypatch.setattr(MK, "DONOR_BLOCK", 40)
    monkeypatch.setattr(MK, "QUERY_BLOCK", 60)
    x = holes(1, 300, 10, 0.15)
    df, names = frame(spark, x)
    got = KN.knn_impute(df.repartition(3), "id", names, 4).orderBy("id").select(*names).collect()
    assert np.allclose(np.array([list(r) for r in got], float), plain(x, x, 4), atol=1e-9)


def test_other_training_rows_empty_rows_and_columns(spark):
    x, d = holes(2, 60, 3, 0.3), holes(3, 80, 3, 0.2)
    x[0] = np.nan  # shares nothing with anybody
    d[:, 2] = np.nan  # nobody holds the last column
    d[5] = np.nan
    q, names = frame(spark, x)
    t, _ = frame(spark, d, 1000)
    got = KN.knn_impute(q, "id", names, 5, train=t).orderBy("id").select(*names).collect()
    want = plain(x, d, 5)
    assert np.allclose(np.array([[np.nan if v is None else v for v in r] for r in got], float), want, atol=1e-9, equal_nan=True)
    assert KN.knn_impute(q.limit(0), "id", names, 5, train=t).count() == 0
    nobody = KN.knn_impute(q, "id", names, 5, train=t.limit(0)).where("id = 0").first()
    assert [nobody[c] for c in names] == [None] * 3


def test_bounds_spare_most_pairs_of_clustered_rows(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 6)) * 20
    x = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 6)) * 0.3
    x[rng.random(x.shape) < 0.02] = np.nan
    df, names = frame(spark, x)
    vec = F.array(*names)
    stats = {}
    near = MK.masked_neighbours(df.select(F.col("id").alias("qid"), vec.alias("vec")), df.select(F.col("id").alias("did"), vec.alias("vec")), 5, stats)
    queries = np.isnan(x).any(axis=1).sum()
    assert near.count() == 5 * np.isnan(x).sum() and stats["pairs"] < 0.5 * queries * len(x)
