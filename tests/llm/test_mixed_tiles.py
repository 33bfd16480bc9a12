"""pipeline, n-gram Jaccard join (F1): pairs of mixed tiles are compared in numpy, in blocks of bounded size."""

import numpy as np
from pyspark.sql import functions as F

from tabula.llm import jaccard_join as J


def _open_rows(spark):
    rng = np.random.default_rng(5)
    rows = []
    base = np.arange(900, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for tile in range(6):
        for i in range(int(rng.integers(2, 30))):
            size = int(rng.choice([5, 400, 440, 900])) if tile % 2 else int(rng.integers(1, 40))
            one = base[:size].copy()
            one[rng.integers(0, size, int(rng.integers(0, size // 4 + 2)))] += np.uint64(rng.integers(1, 1 << 40))
            bits = J.parity_bitmap(one) if size < 900 else np.concatenate([J.parity_bitmap(one), np.zeros(16, np.int64)])
            rows.append((tile, 100 * tile + i, int(100 * tile + rng.choice([0, 0, 1, 2, 3])), 100 * tile, size, bits.tolist()))
    df = spark.createDataFrame(rows, "tile long, node long, comp long, main long, size long, bits array<long>")
    of = df.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("comp") != F.col("main")).cast("long")).alias("outer"))
    return df.join(of, "tile").filter("outer > 0")


def test_pairs_are_those_of_the_column_rule(spark, monkeypatch):
    rows = _open_rows(spark).cache()
    a, b = (rows.select("tile", F.col("node").alias(x), F.col("comp").alias(f"{x}comp"), F.col("size").alias(f"{x}size"), F.col("bits").alias(f"{x}bits"),
                        (F.col("comp") == F.col("main")).alias(f"{x}main")) for x in ("a", "b"))
    met = a.join(b, "tile").filter("acomp <> bcomp and a < b").filter(J._may_link(80))
    want = {tuple(r) for r in met.select("a", "b").collect()}
    assert len(want) > 5
    assert {tuple(r) for r in J._across(rows, 80).collect()} == want
    monkeypatch.setattr(J, "FEW_PAIRS", 0)
    for side, words in ((3, 40), (2, 1)):
        monkeypatch.setattr(J, "SIDE", side)
        monkeypatch.setattr(J, "PAIRS_AT_ONCE", words)
        assert {tuple(r) for r in J._across(rows, 80).collect()} == want
    assert J._across(rows.limit(0), 80).count() == 0
