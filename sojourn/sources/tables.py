"""Table scans and full-replace sinks."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections import Counter
from collections.abc import Callable, Mapping
from typing import TypeVar

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")


def scan(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{table}.parquet")


_MANIFEST = "publish_id string, sequence long, table string, path string, parts long"


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_published")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{root}/_published")


def _published(spark: SparkSession, root: str) -> dict[str, Row]:
    """The newest whole publication of every table. `parts` says how many rows make one whole."""
    rows = _manifest(spark, root).collect()
    sizes = Counter(r["publish_id"] for r in rows)
    whole = sorted((r for r in rows if sizes[r["publish_id"]] == r["parts"]), key=lambda r: (r["sequence"], r["publish_id"]))
    return {r["table"]: r for r in whole}


def publish(
    frames: Mapping[str, DataFrame], root: str, check: Callable[[dict[str, DataFrame]], T]
) -> tuple[dict[str, DataFrame], T]:
    """Store tables aside, check what was stored, then make all of them current at once.

    Readers find tables through a small manifest, and one append to it switches them all. If
    storing or the check fails, nothing is appended and the tables published before stay as they are.
    """
    root, publish_id = root.rstrip("/"), uuid.uuid4().hex
    spark = next(iter(frames.values())).sparkSession
    paths = {name: f"{root}/versions/{publish_id}/{name}.parquet" for name in frames}
    stored = {}
    for name, df in frames.items():
        df.write.parquet(paths[name])
        stored[name] = spark.read.schema(df.schema).parquet(paths[name])
    found = check(stored)
    newest = max((r["sequence"] for r in _published(spark, root).values()), default=0)
    rows = [(publish_id, newest + 1, name, path, len(paths)) for name, path in paths.items()]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/_published")
    return stored, found


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The current version of a published table."""
    return spark.read.parquet(_published(spark, root.rstrip("/"))[table]["path"])


def replace_table(df: DataFrame, root: str, table: str, order_by: list[str] | None = None) -> DataFrame:
    """Publish one table without a check and return the stored version."""
    out = df if order_by is None else df.sortWithinPartitions(*order_by)
    return publish({table: out}, root, lambda _: None)[0][table]


def model_version(config: Mapping[str, object], revision: str | None = None) -> str:
    """Seven characters of the code revision and a digest of the settings."""
    revision = (revision or os.environ.get("SOJOURN_REVISION") or "local")[:7]
    canonical = json.dumps(config, sort_keys=True, default=str)
    return f"{revision}-{hashlib.sha1(canonical.encode()).hexdigest()[:8]}"


def stamp(df: DataFrame, version: str) -> DataFrame:
    return df.withColumn("model_version", F.lit(version))
