"""Occupancy by event sweep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_census(
    episodes: DataFrame, group: str, start: str, end: str, as_name: str = "census_morning"
) -> DataFrame:
    """Episodes open on the morning of each day with any movement, per group.

    +1 on the start day and -1 on the end day from a single scan, netted per day before the
    running total, so the window only ever sees days x groups rows.
    """
    moves = F.array(
        F.struct(F.to_date(start).alias("event_date"), F.lit(1).alias("delta")),
        F.struct(F.to_date(end).alias("event_date"), F.lit(-1).alias("delta")),
    )
    daily = (
        episodes.select(group, F.explode(moves).alias("move"))
        .where(F.col("move.event_date").isNotNull())
        .groupBy(group, F.col("move.event_date").alias("event_date"))
        .agg(F.sum("move.delta").alias("net_change"))
    )
    earlier = (
        Window.partitionBy(group)
        .orderBy("event_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return daily.select(
        group,
        "event_date",
        "net_change",
        F.coalesce(F.sum("net_change").over(earlier), F.lit(0)).cast("long").alias(as_name),
    )
