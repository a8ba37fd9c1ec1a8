"""Training, holdout and backtest windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.time import ntz
from sojourn.plans.features import LONG_STAY_DAYS

# Window lengths.
HOLDOUT_DAYS = 365
TRAIN_YEARS = 4
CALIBRATION_MONTHS = 6
BACKTEST_MONTHS = 12


@dataclass(frozen=True)
class Window:
    """Train on [train_start, train_end), of which the last part recalibrates; score
    [score_start, score_end)."""

    train_start: datetime
    calibration_start: datetime
    train_end: datetime
    score_start: datetime
    score_end: datetime


def within(start: datetime | None, end: datetime, column: str = "intake_at") -> Column:
    """Half-open; no start means everything before the end."""
    inside = F.col(column) < ntz(end)
    return inside if start is None else inside & (F.col(column) >= ntz(start))


def _with_training(df: DataFrame, train_end: Column) -> DataFrame:
    return (
        df.withColumn("train_end", train_end)
        .withColumn("train_start", F.col("train_end") - F.expr(f"interval {TRAIN_YEARS} years"))
        .withColumn("calibration_start", F.col("train_end") - F.expr(f"interval {CALIBRATION_MONTHS} months"))
    )


def holdout_calendar(horizon: DataFrame) -> DataFrame:
    """The last year of settled labels, trained on what was settled when it began."""
    df = horizon.select(
        (F.col("label_cutoff") - F.expr(f"interval {HOLDOUT_DAYS} days")).alias("score_start"),
        F.col("label_cutoff").alias("score_end"),
    )
    return _with_training(df, F.col("score_start") - F.expr(f"interval {LONG_STAY_DAYS} days"))


def backtest_calendar(horizon: DataFrame) -> DataFrame:
    """The last twelve whole months whose every label is settled, one row each."""
    this_month = F.trunc(F.to_date("label_cutoff"), "month")
    first = F.add_months(this_month, -BACKTEST_MONTHS)
    last = F.add_months(this_month, -1)
    months = horizon.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month")
    ).select(
        F.col("month").cast("timestamp_ntz").alias("score_start"),
        F.add_months("month", 1).cast("timestamp_ntz").alias("score_end"),
    )
    return _with_training(months, F.col("score_start") - F.expr(f"interval {LONG_STAY_DAYS} days"))


def final_calendar(horizon: DataFrame) -> DataFrame:
    """Every settled label of the last years; what it scores is still open."""
    df = horizon.select(F.col("label_cutoff").alias("score_start"), F.col("as_of").alias("score_end"))
    return _with_training(df, F.col("score_start"))


def collect_windows(calendar: DataFrame) -> list[Window]:
    """Calendars have at most BACKTEST_MONTHS rows."""
    rows = calendar.orderBy("score_start").collect()
    return [
        Window(r["train_start"], r["calibration_start"], r["train_end"], r["score_start"], r["score_end"])
        for r in rows
    ]
