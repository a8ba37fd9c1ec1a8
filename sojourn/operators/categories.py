"""Frequent-category selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INFREQUENT = "infrequent"


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One (feature, category) row per listed column."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns]
    return df.select(*keep, F.inline(F.array(*pairs)))


def category_counts(df: DataFrame, columns: Sequence[str], group: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """Rows by category; `n` names the column that says how many rows each is."""
    number = F.count(F.lit(1)) if n is None else F.sum(n)
    rows = long_form(df, columns, [*group, *([n] if n else [])])
    return rows.groupBy(*group, "feature", "category").agg(number.alias("n"))


def frequent_categories(counts: DataFrame, max_categories: int, group: Sequence[str] = ()) -> DataFrame:
    """(feature, category, has_infrequent) kept as they are, at most max_categories per group and feature.

    A feature with more categories keeps the commonest max_categories - 1 and gives its last
    place to the infrequent bucket. The rank filter lets Spark cut each partition to its best
    few before the shuffle, so a column with millions of values stays cheap.
    """
    commonest = Window.partitionBy(*group, "feature").orderBy(F.desc("n"), "category")
    top = counts.withColumn("place", F.row_number().over(commonest)).where(
        F.col("place") <= max_categories + 1
    )
    distinct = F.count(F.lit(1)).over(Window.partitionBy(*group, "feature"))
    keep = F.when(F.col("has_infrequent"), max_categories - 1).otherwise(max_categories)
    return (
        top.withColumn("has_infrequent", distinct > max_categories)
        .where(F.col("place") <= keep)
        .select(*group, "feature", "category", "has_infrequent")
    )


def category_map(counts: DataFrame, max_categories: int) -> DataFrame:
    """Every category seen, with the name it is grouped under."""
    kept = frequent_categories(counts, max_categories).withColumn("kept", F.lit(True))
    return counts.join(kept, ["feature", "category"], "left").select(
        "feature",
        "category",
        "n",
        F.when(F.col("kept"), F.col("category")).otherwise(INFREQUENT).alias("grouped"),
    )
