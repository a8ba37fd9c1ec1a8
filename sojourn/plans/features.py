"""Start-time features, mature labels and the populations they apply to."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions import bands
from sojourn.functions.time import ntz, whole_days_between
from sojourn.operators.census import daily_census
from sojourn.operators.joins import broadcast_if_small
from sojourn.plans.staging import ENTITY, KEY, SEQUENCE
from sojourn.sources.scratch import materialize

# Population, horizon and feature lists.
LONG_STAY_DAYS = 30
POPULATION_TYPES = ["Dog", "Cat"]
EXCLUDED_START_TYPES = ["Euthanasia Request", "Wildlife"]
CENSUS_WARMUP_DAYS = 180
MAX_PLAUSIBLE_OPEN_DAYS = 365
SEQUENCE_CAP = 3
CATEGORICAL = [
    "animal_type", "intake_type", "intake_condition", "reproductive_status", "is_mix",
    "primary_breed", "primary_color", "jurisdiction", "intake_month", "intake_weekday",
]
NUMERIC = ["age_at_intake_days", "stay_sequence", "census_same_type"]
FEATURES = CATEGORICAL + NUMERIC

FRAME_COLUMNS = [
    KEY, ENTITY, SEQUENCE, "intake_at", "outcome_at", "is_open_stay", "length_of_stay_days",
    "animal_type", "intake_type", "intake_condition", "sex_upon_intake", "outcome_subtype",
    "breed", "color", "found_location", "age_at_intake_days",
]


@dataclass(frozen=True)
class Horizon:
    """Where the data ends and which labels are settled. Taken from the data, not the clock."""

    as_of: datetime
    label_cutoff: datetime
    feed_start: datetime

    @property
    def warmed_up(self) -> datetime:
        return self.feed_start + timedelta(days=CENSUS_WARMUP_DAYS)

    @property
    def implausible_before(self) -> datetime:
        return self.as_of - timedelta(days=MAX_PLAUSIBLE_OPEN_DAYS)


def horizon_frame(fact: DataFrame) -> DataFrame:
    """One row: as_of, label_cutoff, feed_start."""
    ends = fact.agg(
        F.greatest(F.max("intake_at"), F.max("outcome_at")).alias("as_of"),
        F.min("intake_at").alias("feed_start"),
    )
    cutoff = F.to_date(F.col("as_of") - F.expr(f"interval {LONG_STAY_DAYS} days")).cast("timestamp_ntz")
    return ends.select("as_of", cutoff.alias("label_cutoff"), "feed_start")


def horizon_of(fact: DataFrame) -> Horizon:
    row = horizon_frame(fact).first()
    return Horizon(row["as_of"], row["label_cutoff"], row["feed_start"])


def census(fact: DataFrame) -> DataFrame:
    return daily_census(fact, "animal_type", "intake_at", "outcome_at")


def training_frame(fact: DataFrame) -> DataFrame:
    """Each episode with the number of its type in care on the morning it began."""
    mornings = materialize(census(fact).select("animal_type", "event_date", "census_morning"), "census")
    lookup = broadcast_if_small(mornings).select(
        F.col("animal_type"),
        F.col("event_date"),
        F.col("census_morning").alias("census_same_type"),
    )
    return (
        fact.select(*FRAME_COLUMNS)
        .withColumn("event_date", F.to_date("intake_at"))
        .join(lookup, ["animal_type", "event_date"], "left")
        .select(*FRAME_COLUMNS, "census_same_type")
    )


def eligible(frame: DataFrame) -> DataFrame:
    """Dogs and cats; an episode whose start type is missing stays in."""
    excluded = F.coalesce(F.col("intake_type").isin(EXCLUDED_START_TYPES), F.lit(False))
    return frame.where(F.col("animal_type").isin(POPULATION_TYPES) & ~excluded)


def implausible_open(horizon: Horizon) -> Column:
    """Open episodes that began more than MAX_PLAUSIBLE_OPEN_DAYS before the data ends."""
    return F.col("is_open_stay") & (F.col("intake_at") < ntz(horizon.implausible_before))


def excluded_implausible_open(frame: DataFrame, horizon: Horizon) -> int:
    return eligible(frame).where(implausible_open(horizon)).count()


def labelled(frame: DataFrame, horizon: Horizon) -> DataFrame:
    """Episodes old enough to judge, by start time alone, with is_long_stay as 0 or 1."""
    started = F.col("intake_at")
    settled = (started < ntz(horizon.label_cutoff)) & (started >= ntz(horizon.warmed_up))
    long_stay = F.col("is_open_stay") | (F.col("length_of_stay_days") >= LONG_STAY_DAYS)
    return (
        eligible(frame)
        .where(settled & ~implausible_open(horizon))
        .withColumn("is_long_stay", long_stay.cast("int"))
    )


def scoring_population(frame: DataFrame, horizon: Horizon) -> DataFrame:
    """Open episodes not yet past the horizon.

    The cutoff is a midnight, so an episode begun on the cutoff day can already be exactly
    thirty days old; the age limit keeps those out, as the checks on the scores demand.
    """
    days = whole_days_between(F.col("intake_at"), ntz(horizon.as_of))
    return (
        eligible(frame)
        .where(F.col("is_open_stay") & (F.col("intake_at") >= ntz(horizon.label_cutoff)))
        .withColumn("days_in_care", days)
        .where(F.col("days_in_care") < LONG_STAY_DAYS)
    )


def feature_columns() -> dict[str, Column]:
    """Stateless: nothing here is fitted."""
    return {
        "animal_type": bands.or_unknown(F.col("animal_type")),
        "intake_type": bands.or_unknown(F.col("intake_type")),
        "intake_condition": bands.or_unknown(F.col("intake_condition")),
        "reproductive_status": bands.reproductive_status(F.col("sex_upon_intake")),
        "is_mix": bands.is_mix(F.col("breed")),
        "primary_breed": bands.primary_component(F.col("breed")),
        "primary_color": bands.primary_component(F.col("color")),
        "jurisdiction": bands.jurisdiction(F.col("found_location")),
        "intake_month": F.month("intake_at").cast("string"),
        "intake_weekday": F.date_format("intake_at", "EEEE"),
        "age_at_intake_days": F.col("age_at_intake_days").try_cast("double"),
        "stay_sequence": F.least(F.col(SEQUENCE), F.lit(SEQUENCE_CAP)).cast("double"),
        "census_same_type": F.col("census_same_type").try_cast("double"),
    }


def derive(frame: DataFrame, *keep: str) -> DataFrame:
    """Model inputs next to the columns named in `keep` (none of them a feature's name)."""
    return frame.select(*keep, *[c.alias(name) for name, c in feature_columns().items()])
