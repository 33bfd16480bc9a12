"""Table sources: Parquet test tables, CSV with a declared schema, inline rows."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table; Catalyst prunes columns and pushes filters."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan.  A declared schema is required for production use; inference is
    only allowed for exploration (it costs a full extra pass)."""
    reader = spark.read.option("header", header).option("nullValue", "").option("mode", "PERMISSIVE")
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def inline_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """Small literal table (``VALUES``) for fixtures and toy examples."""
    return spark.createDataFrame(list(rows), schema)


def optional_source(spark: SparkSession, path: str | None, loader=None) -> DataFrame | None:
    """Return the table at ``path`` if present, else None (score file is optional)."""
    if not path:
        return None
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return None
    return (loader or (lambda p: spark.read.parquet(p)))(path)
