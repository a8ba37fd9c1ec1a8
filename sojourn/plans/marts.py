"""Episode fact, entity dimension, monthly mart, quality issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sojourn.functions.bands import age_band
from sojourn.functions.numbers import round_half_away
from sojourn.functions.rates import rate_pct
from sojourn.functions.time import month_start
from sojourn.operators.quantiles import percentile_of, with_ranks
from sojourn.plans.staging import ENTITY, KEY, SEQUENCE

FACT_COLUMNS = [
    KEY, ENTITY, SEQUENCE, "is_return_stay", "intake_at", "intake_date", "intake_month",
    "outcome_at", "outcome_date", "outcome_month", "is_open_stay", "length_of_stay_days",
    "intake_type", "intake_condition", "outcome_type", "outcome_subtype", "outcome_class",
    "is_owner_requested_euthanasia", "animal_type", "animal_name", "was_named", "breed", "color",
    "sex_upon_intake", "sex_upon_outcome", "found_location", "age_at_intake_days",
    "age_band_at_intake",
]

# Issue types and their texts.
OUTCOME_BEFORE_INTAKE = "outcome_before_intake"
UNRECOGNISED_OUTCOME = "unrecognised_outcome_type"
UNUSABLE_AGE = "unusable_age_at_intake"
OUTCOME_WITHOUT_INTAKE = "outcome_without_intake"
ISSUE_TEXTS = {
    OUTCOME_BEFORE_INTAKE: (
        "Outcome timestamp precedes intake timestamp. Indicates a missing record in the "
        "animal's history shifting the intake-to-outcome pairing, or a source data entry error."
    ),
    UNRECOGNISED_OUTCOME: (
        "Outcome type is not in the known live or non-live sets, so the stay is absent from "
        "live release rate calculations."
    ),
    UNUSABLE_AGE: (
        "Age on intake was absent, non-numeric, or negative, so no age band could be assigned."
    ),
    OUTCOME_WITHOUT_INTAKE: (
        "Outcome has no matching intake at the same stay sequence, so the stay is absent from "
        "fct_shelter_stays entirely. Usually an animal whose intake predates the published data "
        "range."
    ),
}


def episode_fact(episodes: DataFrame) -> DataFrame:
    """Valid episodes, one row each."""
    return (
        episodes.where(~F.col("has_invalid_duration"))
        .withColumns(
            {
                "is_return_stay": F.col(SEQUENCE) > 1,
                "intake_date": F.to_date("intake_at"),
                "intake_month": month_start(F.col("intake_at")),
                "outcome_date": F.to_date("outcome_at"),
                "outcome_month": month_start(F.col("outcome_at")),
                "was_named": F.col("animal_name").isNotNull(),
                "age_band_at_intake": age_band(F.col("age_at_intake_days")),
            }
        )
        .select(*FACT_COLUMNS)
    )


def closed(fact: DataFrame) -> DataFrame:
    return fact.where(~F.col("is_open_stay"))


def entity_dimension(fact: DataFrame) -> DataFrame:
    """Latest attributes and history totals in one grouping, so one shuffle at most."""
    latest = F.max_by(
        F.struct("animal_name", "animal_type", "breed", "color", "sex_upon_outcome"),
        F.struct("intake_at", SEQUENCE),
    )
    summary = fact.groupBy(ENTITY).agg(
        latest.alias("latest"),
        F.count(F.lit(1)).alias("stay_count"),
        F.min("intake_at").alias("first_intake_at"),
        F.max("intake_at").alias("last_intake_at"),
        F.max("outcome_at").alias("last_outcome_at"),
        F.bool_or("is_open_stay").alias("is_currently_in_care"),
        F.sum("length_of_stay_days").alias("total_days_in_care"),
    )
    return summary.select(
        ENTITY,
        "latest.animal_name",
        "latest.animal_type",
        "latest.breed",
        "latest.color",
        F.col("latest.sex_upon_outcome").alias("sex_latest"),
        "stay_count",
        (F.col("stay_count") > 1).alias("has_returned"),
        "first_intake_at",
        "last_intake_at",
        "last_outcome_at",
        "is_currently_in_care",
        "total_days_in_care",
    )


def monthly_outcomes(fact: DataFrame) -> DataFrame:
    """Counts, rates and durations per end month and type.

    Grouped by duration first: that aggregate is plain codegen with map-side combine, and all
    that follows sees one weighted row per distinct duration, not every episode.
    """
    kind, cls = F.col("outcome_type"), F.col("outcome_class")
    not_requested = ~F.col("is_owner_requested_euthanasia")
    classified = cls.isin("Live", "Non-Live")
    counts = {
        "outcomes_live": cls == "Live",
        "outcomes_non_live": cls == "Non-Live",
        "outcomes_unclassified": cls == "Unknown",
        "outcomes_adoption": kind == "Adoption",
        "outcomes_transfer": kind == "Transfer",
        "outcomes_return_to_owner": kind == "Return To Owner",
        "outcomes_euthanasia": kind == "Euthanasia",
        "outcomes_return_stays": F.col("is_return_stay"),
        "adjusted_live": (cls == "Live") & not_requested,
        "adjusted_classified": classified & not_requested,
    }
    by_duration = (
        closed(fact)
        .groupBy("outcome_month", "animal_type", "length_of_stay_days")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(condition).alias(name) for name, condition in counts.items()],
        )
    )
    days = F.sum(F.col("length_of_stay_days") * F.col("n")).cast("double")
    group = ["outcome_month", "animal_type"]
    monthly = with_ranks(by_duration, group, "length_of_stay_days").groupBy(*group).agg(
        F.sum("n").alias("outcomes_total"),
        *[F.sum(name).alias(name) for name in counts],
        round_half_away(days / F.sum("n"), 1).alias("avg_length_of_stay_days"),
        percentile_of("length_of_stay_days", 0.5).alias("median_length_of_stay_days"),
        percentile_of("length_of_stay_days", 0.9).alias("p90_length_of_stay_days"),
    )
    live, non_live = F.col("outcomes_live"), F.col("outcomes_non_live")
    return monthly.select(
        "outcome_month",
        "animal_type",
        "outcomes_total",
        *[name for name in counts if name.startswith("outcomes_")],
        rate_pct(live, live + non_live).alias("live_release_rate_pct"),
        rate_pct(F.col("adjusted_live"), F.col("adjusted_classified")).alias(
            "live_release_rate_adjusted_pct"
        ),
        "avg_length_of_stay_days",
        "median_length_of_stay_days",
        "p90_length_of_stay_days",
    )


def in_reading_order(mart: DataFrame) -> DataFrame:
    """Global sort for presentation; months x types rows."""
    return mart.orderBy("outcome_month", "animal_type")


def quality_issues(episodes_and_orphans: DataFrame) -> DataFrame:
    """One row per problem; an episode with several problems appears several times.

    All four branches come from one pass over the full pairing (has_start tells orphans).
    """
    paired = F.col("has_start")
    found = {
        OUTCOME_BEFORE_INTAKE: paired & F.col("has_invalid_duration"),
        UNRECOGNISED_OUTCOME: paired & (F.col("outcome_class") == "Unknown"),
        UNUSABLE_AGE: paired & F.col("age_at_intake_days").isNull(),
        OUTCOME_WITHOUT_INTAKE: ~paired,
    }
    candidates = F.array(
        *[
            F.struct(
                condition.alias("found"),
                F.lit(name).alias("issue_type"),
                F.lit(ISSUE_TEXTS[name]).alias("issue_description"),
            )
            for name, condition in found.items()
        ]
    )
    return (
        episodes_and_orphans.select(
            KEY, ENTITY, F.explode(candidates).alias("issue"), "intake_at", "outcome_at"
        )
        .where(F.col("issue.found"))
        .select(
            KEY, ENTITY, "issue.issue_type", "issue.issue_description", "intake_at", "outcome_at"
        )
    )


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("issue_type").agg(F.count(F.lit(1)).alias("issues"))
