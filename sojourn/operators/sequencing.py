"""Heavy keys and per-entity event numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one entity a single task may sort. Beyond it the entity takes the spread path.
MAX_ROWS_PER_KEY = 5_000_000
_BUCKETS = 1 << 20


def heavy_keys(keys: DataFrame, key: str, max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame | None:
    """Keys with more than max_rows rows, or None where there are none (the usual case).

    First a count per hash bucket, whose size is fixed whatever the data holds; the exact
    count per key runs only for buckets that could hide a heavy key. The result has at most
    rows / max_rows rows, which is what makes it safe to broadcast.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(_BUCKETS)).cast("int")
    full = (
        keys.groupBy(bucket.alias("bucket")).count().where(F.col("count") > max_rows).select("bucket")
    )
    suspects = full.collect()
    if not suspects:
        return None
    flagged = keys.sparkSession.createDataFrame(suspects, full.schema)
    heavy = (
        keys.withColumn("bucket", bucket)
        .join(F.broadcast(flagged), "bucket", "left_semi")
        .groupBy(key)
        .count()
        .where(F.col("count") > max_rows)
        .select(key)
    )
    found = [row[key] for row in heavy.collect()]
    if not found:
        return None
    return keys.sparkSession.createDataFrame([(k,) for k in found], heavy.schema)


def split_heavy(df: DataFrame, key: str, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ordinary rows, rows of heavy keys). Null keys count as ordinary."""
    return (
        df.join(F.broadcast(heavy), key, "left_anti"),
        df.join(F.broadcast(heavy), key, "left_semi"),
    )


def event_number(key: str, order: Sequence[Column | str]) -> Column:
    """1-based position of an event in its entity's history."""
    return F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long")
