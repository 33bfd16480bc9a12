"""Range-partitioned ordering operators equal window results, whatever the
partition count."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabula.operators import ordering as OR
from tabula.operators import split as SP


def _skewed(spark):
    # one hot key holding a third of the rows
    rows = [(0 if i % 3 == 0 else i % 17, i, float((i * 37) % 101)) for i in range(3000)]
    return spark.createDataFrame(rows, "k long, t long, v double")


def test_row_index_matches_window(spark):
    df = _skewed(spark)
    ref = df.withColumn("idx", F.row_number().over(Window.partitionBy("k").orderBy("t")) - 1)
    for parts in (1, 8):
        got = OR.row_index(df, ["k"], ["t"], out="idx", num_partitions=parts)
        assert sorted(got.select("k", "t", "idx").collect()) == sorted(ref.select("k", "t", "idx").collect())


def test_running_max_and_prefix_sum(spark):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("k", "t", F.max("v").over(w).alias("m"), F.sum("v").over(w).alias("s"))
    got_m = OR.running_max(df, ["k"], ["t"], "v", out="m", num_partitions=6).select("k", "t", "m")
    got_s = OR.prefix_sum(df, ["k"], ["t"], ["v"], num_partitions=6).select("k", "t", F.col("v_cum").alias("s"))
    assert sorted(got_m.collect()) == sorted(ref.select("k", "t", "m").collect())
    a = {(r["k"], r["t"]): r["s"] for r in got_s.collect()}
    b = {(r["k"], r["t"]): r["s"] for r in ref.collect()}
    assert a.keys() == b.keys() and all(abs(a[x] - b[x]) < 1e-6 for x in a)


def test_folds_balanced_and_stable(spark):
    df = spark.createDataFrame([(i, i % 4 == 0) for i in range(1000)], "id long, y boolean") \
        .withColumn("y", F.col("y").cast("int"))
    f1 = SP.kfold(df, "id", 5, label="y", seed=42)
    sizes = {r["fold"]: r["count"] for r in f1.groupBy("fold").count().collect()}
    assert sorted(sizes.values()) == [200] * 5
    f2 = SP.kfold(df.repartition(7), "id", 5, label="y", seed=42)
    assert sorted(f1.collect()) == sorted(f2.collect())


def test_hash_split_bucket_of_key_7(spark):
    df = spark.createDataFrame([(7,)], "id long")
    assert df.select(SP.hash_bucket("id", 42)).first()[0] == 43


def test_rows_with_null_keys_and_labels_stay(spark):
    from tabula.operators import ordering as O
    from tabula.operators import series as S
    from tabula.operators import split as SP
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "a", float(i)) for i in range(40)], "id long, g string, v double")
    idx = O.row_index(df, ["g"], ["id"])
    got = {}
    for r in idx.collect():
        got.setdefault(r["g"], []).append(r["idx"])
    assert sorted(got[None]) == list(range(10)) and sorted(got["a"]) == list(range(30))
    assert O.running_max(df, ["g"], ["id"], "v").count() == 40
    diff = {r["id"]: r["diff"] for r in O.first_difference(idx, ["g"], "idx", "v").collect()}
    assert len(diff) == 40 and diff[4] == 4.0 and diff[0] is None
    assert SP.kfold(df, "id", 5, label="g").count() == 40
    long = [("x", i, float((i * 7919) % 13) + i) for i in range(200)] + [(None, i, float(i % 5)) for i in range(60)] + [("s", i, 1.0) for i in range(5)]
    rows = {r["k"]: r for r in S.arima111(spark.createDataFrame(long, "k string, i long, v double"), ["k"], ["i"], "v").collect()}
    assert set(rows) == {"x", None, "s"} and rows["s"]["reason"] and rows["s"]["f1"] is None and rows["x"]["reason"] is None
