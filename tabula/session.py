"""Session helpers.

The library never creates a session behind the caller's back except through
``get_spark`` (tests, bench, command-line use).  Cluster settings such as
``spark.checkpoint.dir`` are read from the running session; a local default is
only filled in when the session has none.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tabula") -> SparkSession:
    master = master or os.environ.get("TABULA_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("TABULA_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TABULA_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` points at shared storage and is used as is.  A
    session in one process (master ``local``) without the setting gets a
    temporary folder, removed at exit; any other session must name one.
    """
    return checkpoint_dir_of(spark.sparkContext)


def checkpoint_dir_of(sc: SparkContext) -> str:
    """``ensure_checkpoint_dir`` for callers that hold no session: threads of a pool have no active one."""
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tabula-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context, so that their
    Python workers can import it from any working folder."""
    sc = spark.sparkContext
    if getattr(sc, "_tabula_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(sc._temp_dir, "tabula_package.zip")  # the driver serves it from here until Spark stops
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._tabula_shipped = True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
