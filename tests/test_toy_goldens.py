"""Small frames with known answers (the reference notebooks' toy examples)."""

import numpy as np

from tabula.operators import design as DS
from tabula.operators import glm as G
from tabula.operators import linear as L


def _hours_score(spark):
    return spark.createDataFrame([(1, 50), (2, 55), (3, 65), (4, 70), (5, 75), (6, 85)],
                                 "hours bigint, score bigint")


def test_ols_golden(spark):
    fit = L.ols(_hours_score(spark), ["hours"], "score")
    assert np.allclose(fit.coef, [42.666666667, 6.857142857])
    assert abs(fit.r2 - 0.987428571) < 1e-8
    t = {r["term"]: r for r in fit.table(spark).collect()}
    assert abs(t["Intercept"]["p_value"] - 9.2509e-06) < 1e-9
    assert abs(t["hours"]["t_stat"] - 17.7251747) < 1e-6


def test_prediction_on_new_rows(spark):
    fit = L.ols(_hours_score(spark), ["hours"], "score")
    new = spark.createDataFrame([(7,), (8,), (9,)], "hours bigint")
    got = [r[0] for r in new.select(fit.predict().alias("p")).collect()]
    assert np.allclose(got, [90.666666667, 97.523809524, 104.380952381])


def test_categorical_treatment_coding(spark):
    df = spark.createDataFrame([("A", 60), ("A", 62), ("B", 70), ("B", 72), ("C", 68)],
                               "method string, score bigint")
    d, names, y, _ = DS.design_frame(df, "score ~ C(method)")
    assert names == ["C(method)[T.B]", "C(method)[T.C]"]
    assert np.allclose(L.ols(d, names, y).coef, [61.0, 10.0, 7.0])


def test_interaction_and_transform(spark):
    df = spark.createDataFrame([(1, 7, 50), (2, 6, 55), (3, 6, 63), (4, 5, 70), (5, 5, 72)],
                               "hours bigint, sleep bigint, score bigint")
    _, names, _, _ = DS.design_frame(df, "score ~ hours * sleep + I(hours ** 2)")
    assert names == ["hours", "sleep", "hours:sleep", "I(hours ** 2)"]
    full = L.ols(df, ["hours", "sleep"], "score")
    assert full.df_resid == 2


def test_anova_and_vif(spark):
    df = spark.createDataFrame([(1, 7, 50), (2, 6, 55), (3, 6, 63), (4, 5, 70), (5, 5, 72)],
                               "hours bigint, sleep bigint, score bigint")
    rows = L.anova_type1(df, [["hours"], ["sleep"]], ["hours", "sleep"], "score")
    assert abs(rows[0][2] - 348.1) < 1e-6 and abs(rows[2][2] - 9.0666667) < 1e-6
    v = dict(L.vif(df, ["hours", "sleep"]))
    assert abs(v["hours"] - 9.3333333) < 1e-6


def test_poisson_matches_known_fit(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 1)], "hours bigint, passed bigint")
    fit = G.fit_glm(df, ["hours"], "passed", family="poisson")
    assert np.allclose(fit.coef, [-3.4167, 0.6296], atol=1e-4)


def test_separation_is_flagged(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 1)], "hours bigint, passed bigint")
    assert G.fit_glm(df, ["hours"], "passed").separated


def test_logit_score_equation(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1), (5, 1), (6, 1)], "hours bigint, passed bigint")
    fit = G.fit_glm(df, ["hours"], "passed")
    rows = df.select("hours", "passed", fit.predict().alias("p")).collect()
    score = [sum((r["passed"] - r["p"]) * x for r, x in zip(rows, xs))
             for xs in ([1.0] * len(rows), [r["hours"] for r in rows])]
    assert np.allclose(score, 0, atol=1e-6)
    assert not fit.separated and fit.converged


def test_lasso_kkt(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), 2.0 * i + (i % 5)) for i in range(40)],
                               "a double, b double, y double")
    b0, b, _ = L.elastic_net(df, ["a", "b"], "y", alpha=0.5, l1_ratio=1.0, tol=1e-12, max_iter=10000)
    rows = df.collect()
    n = len(rows)
    for j, c in enumerate(["a", "b"]):
        g = sum((r["y"] - b0 - b[0] * r["a"] - b[1] * r["b"]) * r[c] for r in rows) / n
        if b[j] != 0:
            assert abs(g - 0.5 * np.sign(b[j])) < 1e-6
        else:
            assert abs(g) <= 0.5 + 1e-9


def test_gram_of_200_columns_in_one_pass(spark):
    import time

    import numpy as np

    from tabula.operators import linear as L
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 200)) + 1e6
    y = x[:, :3] @ [1.0, -2.0, 3.0] + rng.normal(size=400)
    cols = [f"c{i}" for i in range(200)]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)] + [(None, *[1.0] * 199, 0.0)],
                               ", ".join(f"{c} double" for c in [*cols, "y"])).repartition(5)
    t0 = time.time()
    g = L.gram(df, cols, "y")
    assert time.time() - t0 < 60 and g.n == 400
    z = x - x.mean(axis=0)
    assert np.allclose(g.cxx, z.T @ z, rtol=1e-8, atol=1e-6) and np.allclose(g.cxy, z.T @ (y - y.mean()), rtol=1e-6, atol=1e-4)
    assert L.gram(df.where("y is null"), cols, "y").n == 0
