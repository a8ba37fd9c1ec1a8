"""Positions and running totals within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sojourn.sources.scratch import materialize

CHUNK = "_chunk"


def positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    position: str = "position",
    running: dict[str, str] | None = None,
    totals: dict[str, str] | None = None,
    label: str = "positions",
) -> DataFrame:
    """1-based position of each row within its group, exact and without a per-group task.

    A plain row_number() sends a whole group to one task. Here the rows are range
    partitioned on (group, order), so a big group spreads over many chunks, and each chunk
    counts on from the rows of its group in the chunks before it. `order` must make rows of
    one group comparable without ties; ascending, nulls first. `running` maps a new column
    to the column whose running sum it holds (current row included); `totals` likewise for
    sums over the group, with "*" for its row count.

    Chunk numbers come from spark_partition_id(), so the chunked rows are written out once:
    the counts and the numbering must read the same chunks even if a task is run again.
    """
    running, totals = running or {}, totals or {}
    chunked = materialize(
        df.repartitionByRange(*group, *order).withColumn(CHUNK, F.spark_partition_id()), label
    )
    sums = sorted({c for c in [*running.values(), *totals.values()] if c != "*"})
    # One row per (group, chunk) pair: at most groups + chunks of them.
    per_chunk = chunked.groupBy(*group, CHUNK).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]
    )
    before = Window.partitionBy(*group).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    zero = F.lit(0).cast("long")
    offsets = per_chunk.select(
        *group,
        CHUNK,
        F.coalesce(F.sum("_n").over(before), zero).alias("_rows_before"),
        *[
            F.coalesce(F.sum(f"_sum_{c}").over(before), zero).alias(f"_before_{c}")
            for c in sorted(set(running.values()))
        ],
        *[
            F.sum("_n" if c == "*" else f"_sum_{c}").over(whole).alias(name)
            for name, c in totals.items()
        ],
    )
    # Group and chunk together bound the window; neither a hot group nor a chunk that holds
    # many small groups ends up in one task.
    inside = Window.partitionBy(*group, CHUNK).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = chunked.withColumns(
        {
            "_local": F.row_number().over(inside),
            **{f"_local_{name}": F.sum(c).over(so_far) for name, c in running.items()},
        }
    )
    # Null-safe, so that rows whose group is null keep their offsets.
    known = offsets.withColumnsRenamed({c: f"_of_{c}" for c in [*group, CHUNK]})
    same = reduce(Column.__and__, [numbered[c].eqNullSafe(known[f"_of_{c}"]) for c in [*group, CHUNK]])
    numbered = numbered.join(known, same)
    return numbered.select(
        *df.columns,
        (F.col("_local") + F.col("_rows_before")).cast("long").alias(position),
        *[
            (F.col(f"_local_{name}") + F.col(f"_before_{c}")).alias(name)
            for name, c in running.items()
        ],
        *list(totals),
    )
