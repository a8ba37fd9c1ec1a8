"""Exact interpolated percentiles over weighted distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_ranks(weighted: DataFrame, group: Sequence[str], value: str, weight: str = "n") -> DataFrame:
    """Adds how many observations lie at or below each value, and the group's total.

    `weighted` has one row per group and distinct value, so the window sees distinct values
    only, however many observations a group has.
    """
    members = Window.partitionBy(*group)
    upto = members.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return weighted.withColumns(
        {"_upto": F.sum(weight).over(upto), "_total": F.sum(weight).over(members)}
    )


def percentile_of(value: str, share: float) -> Column:
    """Aggregate over ranked rows: low * (1 - fraction) + high * fraction, of the two neighbours.

    The fraction is taken off the position first, as column stores do; percentile() measures
    both distances separately and can differ in the last digit.
    """
    at = (F.col("_total") - 1).cast("double") * F.lit(share)
    low = F.min(F.when(F.col("_upto") > F.floor(at), F.col(value))).cast("double")
    high = F.min(F.when(F.col("_upto") > F.ceil(at), F.col(value))).cast("double")
    fraction = F.max(at - F.floor(at))
    return low * (F.lit(1.0) - fraction) + high * fraction
