"""Sinks: fitted pipelines round-trip through save/load; the run log appends rows."""

import os
import tempfile

from pyspark.ml import PipelineModel

from tabula.operators import features as FE
from tabula.sources import sinks as SK


def test_pipeline_save_load_roundtrip(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, None), (4.0, "b")], "x double, c string")
    model = FE.preprocessing_pipeline(["x"], ["c"]).fit(df)
    path = os.path.join(tempfile.mkdtemp(prefix="tabula-model-"), "m")
    SK.save_model(model, path)
    again = PipelineModel.load(path)
    a = [r["features"].toArray().tolist() for r in model.transform(df).collect()]
    b = [r["features"].toArray().tolist() for r in again.transform(df).collect()]
    assert a == b


def test_run_log_appends(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tabula-runs-"), "runs")
    SK.log_run(spark, path, "naive_bayes", "classification", "roc_auc", 5, {"var_smoothing": 1e-9},
               {"roc_auc": 0.8, "accuracy": 0.7})
    SK.log_run(spark, path, "ridge", "regression", "r2", 5, {"alpha": 1.0}, {"r2": 0.5})
    runs = spark.read.parquet(path)
    assert runs.count() == 2
    assert sorted(r["model_type"] for r in runs.collect()) == ["naive_bayes", "ridge"]
