"""Intermediate tables in the folder every executor can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir where set; a temp folder only for an unconfigured local run."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    chosen = context.getCheckpointDir()
    if chosen is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sojourn-"))
        chosen = context.getCheckpointDir()
    return chosen.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage, survives lost executors, prunes columns later.

    The files go when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    written.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(written)
    return spark.read.schema(df.schema).parquet(path)
