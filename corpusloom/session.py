"""Session set-up and the shared folder used to cut lineage.

Iterative operators cut lineage by writing a table to the folder the cluster names in
``spark.checkpoint.dir``. A table is computed once, survives the loss of any executor, and is
read back with column pruning. The tables are left for the folder's own retention.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; extra settings override."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, which the driver and every executor can reach."""
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not configured:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    return configured


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back."""
    path = os.path.join(shared_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """A written table marked for broadcast if it has at most ``rows`` rows; else Spark joins it by shuffling."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few splits as many partitions as there are cores, for costly work per row.

    A table of many files has enough splits already and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, for the Python functions that run in tasks. Once per application."""
    context = spark.sparkContext
    if getattr(context, "_corpusloom_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, files in os.walk(here):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)
    context._corpusloom_shipped = True
