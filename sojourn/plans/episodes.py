"""Typed events -> episodes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.rates import classify_outcome
from sojourn.operators.pairing import pair_nth
from sojourn.operators.sequencing import MAX_ROWS_PER_KEY, heavy_keys, split_heavy
from sojourn.plans.staging import ENTITY, KEY, SEQUENCE, stage_ends, stage_starts

# Attributes both feeds carry; the start's value describes the entity as it arrived.
SHARED = ["animal_type", "animal_name", "breed", "color", KEY]
# Events of both feeds that one task sorts and pairs; they take about 1.6 kB each there.
ROWS_IN_TASK = 200_000
# Fixed value: the start type that marks an owner's request.
OWNER_REQUEST = "Euthanasia Request"

EPISODE_COLUMNS = [
    KEY, ENTITY, SEQUENCE, "intake_at", "outcome_at", "intake_type", "intake_condition",
    "outcome_type", "outcome_subtype", "animal_type", "animal_name", "breed", "color",
    "sex_upon_intake", "sex_upon_outcome", "found_location", "date_of_birth",
    "age_at_intake_days", "age_at_outcome_days", "is_open_stay", "has_invalid_duration",
    "length_of_stay_days", "outcome_class", "is_owner_requested_euthanasia",
]


def is_invalid(start: Column, end: Column) -> Column:
    """The end comes strictly first. Compares times: the same day can be invalid too."""
    return F.coalesce(end < start, F.lit(False))


def duration_days(start: Column, end: Column) -> Column:
    """Midnights crossed; null while open or when the end comes first."""
    return F.when(end >= start, F.datediff(end, start)).cast("long")


def describe(paired: DataFrame) -> DataFrame:
    start, end = F.col("intake_at"), F.col("outcome_at")
    return paired.withColumns(
        {
            "is_open_stay": end.isNull(),
            "has_invalid_duration": is_invalid(start, end),
            "length_of_stay_days": duration_days(start, end),
            "outcome_class": classify_outcome(F.col("outcome_type")),
            "is_owner_requested_euthanasia": F.col("intake_type") == OWNER_REQUEST,
        }
    )


def pair_events(starts: DataFrame, ends: DataFrame, keep_orphans: bool = False) -> DataFrame:
    paired = describe(pair_nth(starts, ends, ENTITY, SEQUENCE, SHARED, keep_orphans))
    return paired.select(*EPISODE_COLUMNS, *(["has_start"] if keep_orphans else []))


def heavy_entities(
    starts: DataFrame, ends: DataFrame, max_rows: int = MAX_ROWS_PER_KEY
) -> DataFrame | None:
    """Entities with too many raw events, repeats included, for one task."""
    return heavy_keys(starts.select(ENTITY).unionAll(ends.select(ENTITY)).dropna(), ENTITY, max_rows)


def partitions_for(starts: DataFrame, ends: DataFrame) -> int | None:
    """Partitions such that a task gets ROWS_IN_TASK events; None where one per core is enough, as Spark then
    makes them. Packed by their compressed bytes alone, five times as many events came together in a task."""
    needed = -(-(starts.count() + ends.count()) // ROWS_IN_TASK)
    return needed if needed > starts.sparkSession.sparkContext.defaultParallelism else None


@dataclass(frozen=True)
class RawFeeds:
    """Both raw feeds, split once into ordinary entities and those too big for one task."""

    starts: DataFrame
    ends: DataFrame
    heavy_starts: DataFrame | None = None
    heavy_ends: DataFrame | None = None
    parts: int | None = None

    @classmethod
    def of(cls, starts: DataFrame, ends: DataFrame, max_rows: int = MAX_ROWS_PER_KEY) -> RawFeeds:
        return cls.split(starts, ends, heavy_entities(starts, ends, max_rows))

    @classmethod
    def split(cls, starts: DataFrame, ends: DataFrame, heavy: DataFrame | None) -> RawFeeds:
        parts = partitions_for(starts, ends)
        if heavy is None:
            return cls(starts, ends, parts=parts)
        (cold_starts, hot_starts) = split_heavy(starts, ENTITY, heavy)
        (cold_ends, hot_ends) = split_heavy(ends, ENTITY, heavy)
        return cls(cold_starts, cold_ends, hot_starts, hot_ends, parts)

    def staged_starts(self) -> DataFrame:
        ordinary = stage_starts(self.starts, parts=self.parts)
        if self.heavy_starts is None:
            return ordinary
        return ordinary.unionByName(stage_starts(self.heavy_starts, spread=True))

    def staged_ends(self) -> DataFrame:
        ordinary = stage_ends(self.ends, parts=self.parts)
        if self.heavy_ends is None:
            return ordinary
        return ordinary.unionByName(stage_ends(self.heavy_ends, spread=True))

    def episodes(self, keep_orphans: bool = False) -> DataFrame:
        """Ordinary entities join where they already lie; the heavy ones join spread over
        (entity, number)."""
        ordinary = pair_events(
            stage_starts(self.starts, parts=self.parts), stage_ends(self.ends, parts=self.parts), keep_orphans
        )
        if self.heavy_starts is None:
            return ordinary
        spread = [ENTITY, SEQUENCE]
        heavy = pair_events(
            stage_starts(self.heavy_starts, spread=True).repartition(*spread),
            stage_ends(self.heavy_ends, spread=True).repartition(*spread),
            keep_orphans,
        )
        return ordinary.unionByName(heavy)
