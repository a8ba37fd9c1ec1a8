"""Broadcast only what was counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(stored: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when a stored table is small enough; else leave the join to AQE.

    Counting a stored table reads its footers only, so pass a written table here, not a plan.
    """
    return F.broadcast(stored) if stored.count() <= max_rows else stored
