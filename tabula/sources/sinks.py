"""Sinks (S4-S8): CSV tables, feature frames, prediction files, fitted models
and a run log.  Everything is written by executors in parallel to the given
(shared) location; nothing is collected on the driver.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header line, one file per partition, no index column."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_features(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Feature frame (id, vector features, label) as Parquet; vectors stay sparse."""
    df.write.mode(mode).parquet(path)
    return path


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def prediction_file(scored: DataFrame, id_col: str, prediction_col: str, target: str, base_dir: str,
                    model_name: str, when: datetime | None = None) -> str:
    """``submission_<model>_<UTC stamp>`` CSV with ``id_col`` and the prediction
    renamed to ``target``; rows keep their key (no positional alignment)."""
    stamp = (when or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    path = f"{base_dir.rstrip('/')}/submission_{model_name}_{stamp}"
    write_csv(scored.select(id_col, F.col(prediction_col).alias(target)), path)
    return path


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


RUN_SCHEMA = T.StructType([
    T.StructField("run_time", T.TimestampType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("task_type", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("n_trials", T.IntegerType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])


def log_run(spark: SparkSession, path: str, model_type: str, task_type: str, metric: str, n_trials: int,
            params: dict, metrics: dict) -> DataFrame:
    """Append one row to the Parquet run log and return it."""
    row = (datetime.now(timezone.utc).replace(tzinfo=None), model_type, task_type, metric, int(n_trials),
           {str(k): json.dumps(v) if not isinstance(v, str) else v for k, v in params.items()},
           {str(k): float(v) for k, v in metrics.items() if v is not None})
    df = spark.createDataFrame([row], RUN_SCHEMA)
    df.write.mode("append").parquet(path)
    return df


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint location; its last part is
    unique, so runs of the same second do not meet."""
    from tabula.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabula-out/{name}/{uuid.uuid4().hex}"
