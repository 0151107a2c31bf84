"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans in this package rely on. Sizes (executors, memory, shuffle
# partitions) belong to the cluster and are left alone.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages can be megabytes each; keep a Python batch small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def get_session(app: str = "pricegrid", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_MADE: list[str] = []


def scratch_dir(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``.

    A machine-local folder is only used when Spark itself runs on one machine.
    ``delete_scratch`` removes what was made, unless it is to be kept.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "pricegrid")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not keep:
        _MADE.append(path)
    return path


def delete_scratch(spark: SparkSession) -> None:
    """Delete all folders of ``scratch_dir``.

    Results read from them lazily, so this is for when they have been used.
    """
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several later steps read the same derived table: they then scan
    Parquet, with its own pruning, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
