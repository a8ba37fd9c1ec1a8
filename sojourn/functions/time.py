"""Zone-free timestamp helpers. Everything stays timestamp_ntz or date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: datetime | None) -> Column:
    """A driver-side moment as a literal, without passing through the session zone."""
    text = None if moment is None else moment.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def month_start(c: Column) -> Column:
    """First instant of the month; built on dates because date_trunc would add a zone."""
    return F.trunc(F.to_date(c), "month").cast("timestamp_ntz")


def whole_days_between(start: Column, end: Column) -> Column:
    """Completed 24-hour periods, unlike datediff which counts midnights."""
    return F.timestamp_diff("DAY", start, end).cast("long")
