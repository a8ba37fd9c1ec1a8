"""Raw text events -> typed, deduplicated, numbered events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.keys import surrogate_key
from sojourn.functions.text import age_text_to_days, blank_to_null, clean_label, safe_timestamp, strict_timestamp
from sojourn.operators.ranking import positions
from sojourn.operators.sequencing import event_number

ENTITY, SEQUENCE, KEY = "animal_id", "stay_sequence", "stay_key"


@dataclass(frozen=True)
class Feed:
    """How one raw feed becomes typed events. `time` names the typed event time."""

    time: str
    columns: dict[str, Column]

    @property
    def order(self) -> list[str]:
        """Event time, then every other column, so equal times still order one way only."""
        return [self.time, *[c for c in self.columns if c not in (ENTITY, self.time)]]


def start_columns() -> Feed:
    return Feed(
        "intake_at",
        {
            ENTITY: F.col(ENTITY),
            "intake_at": strict_timestamp(F.col("datetime")),
            "animal_name": blank_to_null(F.col("name")),
            "found_location": blank_to_null(F.col("found_location")),
            "intake_type": clean_label(F.col("intake_type")),
            "intake_condition": clean_label(F.col("intake_condition")),
            "animal_type": clean_label(F.col("animal_type")),
            "sex_upon_intake": clean_label(F.col("sex_upon_intake")),
            "age_at_intake_days": age_text_to_days(F.col("age_upon_intake")),
            "breed": blank_to_null(F.col("breed")),
            "color": blank_to_null(F.col("color")),
        },
    )


def end_columns() -> Feed:
    return Feed(
        "outcome_at",
        {
            ENTITY: F.col(ENTITY),
            "outcome_at": strict_timestamp(F.col("datetime")),
            "date_of_birth": safe_timestamp(F.col("date_of_birth")),
            "animal_name": blank_to_null(F.col("name")),
            "outcome_type": clean_label(F.col("outcome_type")),
            "outcome_subtype": clean_label(F.col("outcome_subtype")),
            "animal_type": clean_label(F.col("animal_type")),
            "sex_upon_outcome": clean_label(F.col("sex_upon_outcome")),
            "age_at_outcome_days": age_text_to_days(F.col("age_upon_outcome")),
            "breed": blank_to_null(F.col("breed")),
            "color": blank_to_null(F.col("color")),
        },
    )


def with_required_keys(raw: DataFrame, required: Sequence[str] = (ENTITY, "datetime")) -> DataFrame:
    return raw.dropna(subset=list(required))


def collapse_repeats(raw: DataFrame, identity: Sequence[str] | None = None) -> DataFrame:
    """Exact repeats over all raw text columns.

    Rows that differ only in case or padding are kept, as two events. `identity` collapses
    on those columns instead (and then keeps the row whose text sorts first).
    """
    if identity is None:
        return raw.distinct()
    rest = [c for c in raw.columns if c not in identity]
    kept = raw.groupBy(*identity).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*[F.col(c) if c in identity else F.col(f"kept.{c}") for c in raw.columns])


def stage(
    raw: DataFrame, feed: Feed, spread: bool = False, identity: Sequence[str] | None = None, parts: int | None = None
) -> DataFrame:
    """Typed events with their number within the entity and a key over both.

    By default one exchange on the entity serves the de-duplication, the numbering and the
    later pairing join. With `spread` (entities too big for one task) repeats are collapsed
    map-side first and the events are numbered chunk by chunk. `parts` sets the partitions of the exchange.
    """
    keyed = with_required_keys(raw)
    clustered = keyed if spread else keyed.repartition(*[parts] * (parts is not None), ENTITY)
    unique = collapse_repeats(clustered, identity)
    typed = unique.select(*[c.alias(name) for name, c in feed.columns.items()])
    if spread:
        numbered = positions(typed, [ENTITY], feed.order, position=SEQUENCE, label="staged")
    else:
        numbered = typed.withColumn(SEQUENCE, event_number(ENTITY, feed.order))
    rest = [c for c in feed.columns if c != ENTITY]
    key = surrogate_key(F.col(ENTITY), F.col(SEQUENCE)).alias(KEY)
    return numbered.select(key, ENTITY, SEQUENCE, *rest)


def stage_starts(
    raw: DataFrame, spread: bool = False, identity: Sequence[str] | None = None, parts: int | None = None
) -> DataFrame:
    return stage(raw, start_columns(), spread, identity, parts)


def stage_ends(
    raw: DataFrame, spread: bool = False, identity: Sequence[str] | None = None, parts: int | None = None
) -> DataFrame:
    return stage(raw, end_columns(), spread, identity, parts)
