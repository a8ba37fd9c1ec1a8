"""Nth start with nth end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_nth(
    starts: DataFrame,
    ends: DataFrame,
    key: str,
    sequence: str,
    shared: Sequence[str] = (),
    keep_orphans: bool = False,
) -> DataFrame:
    """Join the nth start of an entity with its nth end.

    Starts without an end stay (open episodes). Ends without a start are dropped, or kept
    with `keep_orphans`, where `has_start` is false for them. Columns in `shared` exist in
    both feeds: the start's value wins, the end's fills its gaps. Both inputs arrive
    clustered by `key`, so the join adds no exchange of its own.
    """
    renamed = ends.withColumnsRenamed({c: f"_end_{c}" for c in shared})
    tagged = starts.withColumn("has_start", F.lit(True))
    joined = tagged.join(renamed, [key, sequence], "full_outer" if keep_orphans else "left_outer")
    filled = {c: F.coalesce(F.col(c), F.col(f"_end_{c}")) for c in shared}
    if keep_orphans:
        filled["has_start"] = F.coalesce(F.col("has_start"), F.lit(False))
    return joined.withColumns(filled).drop(*[f"_end_{c}" for c in shared]) if filled else joined


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` whose keys have no partner."""
    return left.join(right.select(*keys), list(keys), "left_anti")
