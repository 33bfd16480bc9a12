"""Plain support vector regression, lags by blocks, scored epochs, named groups."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabula.models import treegrow as TG
from tabula.models.groups import named_groups
from tabula.models.svr import EpsilonSVR, proximal
from tabula.operators.ordering import first_difference, lags
from tabula.operators.series import acf


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = x @ [1.0, -2.0, 0.5] + 3.0 + rng.standard_t(2, size=400) * 0.5  # heavy tails
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache(), x, y


def test_svr_is_optimal_on_one_task_and_on_many(points, monkeypatch):
    df, x, y = points
    one = EpsilonSVR(C=0.5, epsilon=0.2, tol=1e-4, maxIter=3000)._fit(df.coalesce(1))
    beta = np.r_[one.getOrDefault("intercept"), one.getOrDefault("coefficients")]
    cost = lambda b: 0.5 * b[1:] @ b[1:] + 0.5 * np.maximum(np.abs(y - b[0] - x @ b[1:]) - 0.2, 0).sum()
    assert one.gap <= 1e-4 * cost(beta) and one.rounds < 3000
    rng = np.random.default_rng(1)
    near = [beta + d for d in rng.normal(size=(2000, 4)) * 10.0 ** rng.uniform(-4, 0, size=(2000, 1))]
    assert min(map(cost, near)) >= cost(beta) * (1 - 2e-4)
    # stationarity: w is a sum of rows, weighted at most C, outside the tube with the sign of the residual
    r = y - beta[0] - x @ beta[1:]
    sure = np.abs(np.abs(r) - 0.2) > 0.02
    weight = np.where(np.abs(r) > 0.2, 0.5 * np.sign(r), 0.0)
    rest = beta[1:] - x[sure].T @ weight[sure]
    assert np.abs(rest).max() <= 0.5 * np.abs(x[~sure]).sum(axis=0).max() + 0.05
    monkeypatch.setattr(TG, "ROWS_PER_TASK", 100)
    many = EpsilonSVR(C=0.5, epsilon=0.2, tol=1e-4, maxIter=30)._fit(df.repartition(4))
    few = EpsilonSVR(C=0.5, epsilon=0.2, tol=1e-4, maxIter=30)._fit(df.coalesce(1))
    assert many.getOrDefault("coefficients") == pytest.approx(few.getOrDefault("coefficients"), abs=1e-9)


def test_proximal_step():
    for a in np.linspace(-3, 3, 41):
        grid = np.linspace(-4, 4, 80_001)
        want = grid[np.argmin(0.7 * np.maximum(np.abs(grid) - 0.3, 0) + (grid - a) ** 2 / 2)]
        assert proximal(np.array([a]), 0.3, 0.7)[0] == pytest.approx(want, abs=2e-4)


@pytest.mark.parametrize("block", [4, 7, 1000])
def test_lags_cross_blocks(spark, block):
    rng = np.random.default_rng(2)
    series = {"hot": 60, "b": 9, None: 12, "one": 1}
    rows = [(k, i, None if rng.random() < 0.1 else float(rng.normal())) for k, n in series.items() for i in range(n)]
    df = spark.createDataFrame(rows, "k string, idx long, v double").repartition(3)
    got = {(r["k"], r["idx"]): r for r in lags(df, ["k"], "idx", ["v"], [1, 3], block).collect()}
    held = {(k, i): v for k, i, v in rows}
    assert len(got) == len(rows)
    for (k, i), r in got.items():
        assert r["v"] == held[k, i] and r["v_lag1"] == held.get((k, i - 1)) and r["v_lag3"] == held.get((k, i - 3))
    diff = {(r["k"], r["idx"]): r["diff"] for r in first_difference(df, ["k"], "idx", "v").collect()}
    for (k, i), v in held.items():
        back = held.get((k, i - 1))
        assert diff[k, i] == (None if v is None or back is None else v - back)


def test_acf_equals_plain_version(spark):
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.normal(size=50))
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)] + [("b", i, float(i)) for i in range(3)], "k string, t long, v double")
    got = {(r["k"], r["lag"]): r["acf"] for r in acf(df, ["k"], ["t"], "v", 5).collect()}
    z = x - x.mean()
    for k in range(1, 6):
        assert got["a", k] == pytest.approx(z[k:] @ z[:-k] / (z @ z))
    assert sorted(lag for key, lag in got if key == "b") == [1, 2]


def test_an_epoch_that_runs_again_replaces_its_rows(spark, tmp_path):
    from tabula.streaming.scoring import score_stream

    class Model:
        def transform(self, df):
            return df.withColumn("prediction", F.col("x") * 2)

    class Stream:
        """Stands in for a stream that hands the same epoch over twice, as after a crash."""

        def __getattr__(self, name):
            return lambda *a, **k: self

        @property
        def writeStream(self):  # noqa: N802
            return self

        def foreachBatch(self, fn):  # noqa: N802
            for epoch in (0, 1, 1):
                fn(spark.createDataFrame([(epoch * 10 + i, float(i)) for i in range(5)], "id long, x double"), epoch)
            return self

    path = str(tmp_path / "scored")
    score_stream(Model(), Stream(), ["id"], path, str(tmp_path / "ckpt"))
    got = spark.read.parquet(path)
    assert sorted(r["id"] for r in got.collect()) == [*range(5), *range(10, 15)]


def test_named_groups_take_the_columns_of_their_terms():
    formula = "y ~ C(a) + b + c + b:c + b:C(a)"
    names = ["Intercept", "C(a)[T.x]", "C(a)[T.y]", "b", "c", "b:c", "b:C(a)[T.x]", "b:C(a)[T.y]"]
    got = named_groups(formula, names, {"cat": ["C(a)"], "num": ["b", "c"], "inter": ["b:C(a)"]})
    assert got == {"cat": names[1:3], "num": ["b", "c"], "inter": names[6:]}
    with pytest.raises(ValueError):
        named_groups(formula, names, {"cat": ["C(z)"]})
