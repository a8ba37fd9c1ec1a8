"""What every table promises, in two groups: the warehouse and the model's outputs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from sojourn.functions.bands import FACT_AGE_BANDS, FACT_AGE_OLDEST
from sojourn.functions.rates import LIVE_OUTCOMES, NON_LIVE_OUTCOMES
from sojourn.operators.checks import (
    WARN,
    RowRule,
    accepted_range,
    accepted_values,
    count_failures,
    count_row_rules,
    duplicate_values,
    missing_parents,
    not_null,
    union_results,
)
from sojourn.plans.marts import ISSUE_TEXTS

# Start types, model names, bands and states the checks accept.
INTAKE_TYPES = [
    "Stray", "Owner Surrender", "Public Assist", "Wildlife", "Abandoned", "Euthanasia Request",
]
MODELS = ["logistic_baseline", "gradient_boosting", "gradient_boosting_recalibrated"]
RISK_BANDS = ["High", "Elevated", "Typical"]
MONTH_STATES = ["ok", "review", "insufficient_data"]
MAX_AGE_DAYS = 10950
MODEL_TABLES = [
    "stay_scores", "model_evaluation", "calibration", "feature_importance", "monthly_performance",
    "feature_drift",
]
KINDS = ["not_null", "unique", "accepted_values", "accepted_range", "relationships"]


@dataclass(frozen=True)
class Contract:
    rules: list[RowRule] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    # column -> (parent table, parent column)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)


def warehouse_contracts() -> dict[str, Contract]:
    raw = Contract([not_null("animal_id"), not_null("datetime")])
    return {
        "raw_intakes": raw,
        "raw_outcomes": raw,
        "staged_intakes": Contract(
            [
                *map(not_null, ["stay_key", "animal_id", "stay_sequence", "intake_at"]),
                accepted_range("stay_sequence", 1),
                accepted_values("intake_type", INTAKE_TYPES, WARN),
                accepted_range("age_at_intake_days", 0, MAX_AGE_DAYS, severity=WARN),
            ],
            unique=["stay_key"],
        ),
        "staged_outcomes": Contract(
            [
                *map(not_null, ["stay_key", "animal_id", "stay_sequence", "outcome_at"]),
                accepted_values("outcome_type", LIVE_OUTCOMES + NON_LIVE_OUTCOMES, WARN),
            ],
            unique=["stay_key"],
        ),
        "episode_fact": Contract(
            [
                *map(
                    not_null,
                    ["stay_key", "animal_id", "is_return_stay", "is_open_stay", "is_owner_requested_euthanasia"],
                ),
                accepted_range("length_of_stay_days", 0),
                accepted_values("outcome_class", ["Live", "Non-Live", "Unknown"]),
                accepted_values(
                    "age_band_at_intake", [label for _, label in FACT_AGE_BANDS] + [FACT_AGE_OLDEST], WARN
                ),
            ],
            unique=["stay_key"],
            parents={"animal_id": ("entity_dimension", "animal_id")},
        ),
        "entity_dimension": Contract(
            [
                *map(not_null, ["animal_id", "stay_count", "has_returned", "is_currently_in_care"]),
                accepted_range("stay_count", 1),
            ],
            unique=["animal_id"],
        ),
        "monthly_outcomes": Contract(
            [
                *map(not_null, ["outcome_month", "outcomes_total"]),
                accepted_range("outcomes_total", 1),
                accepted_range("live_release_rate_pct", 0, 100),
                accepted_range("live_release_rate_adjusted_pct", 0, 100),
                accepted_range("median_length_of_stay_days", 0),
            ]
        ),
        "quality_issues": Contract(
            [
                *map(not_null, ["stay_key", "issue_type"]),
                accepted_values("issue_type", list(ISSUE_TEXTS)),
            ]
        ),
    }


def model_contracts() -> dict[str, Contract]:
    return {
        "stay_scores": Contract(
            [
                *map(not_null, ["stay_key", "long_stay_probability", "risk_band", "days_in_care"]),
                accepted_range("long_stay_probability", 0, 1),
                accepted_values("risk_band", RISK_BANDS),
                accepted_range("days_in_care", 0, 29),
            ],
            unique=["stay_key"],
            parents={"stay_key": ("episode_fact", "stay_key")},
        ),
        "model_evaluation": Contract(
            [not_null("model"), accepted_values("model", MODELS), accepted_range("roc_auc", 0, 1)],
            unique=["model"],
        ),
        "calibration": Contract([not_null("decile"), accepted_range("decile", 1, 10)], unique=["decile"]),
        "feature_importance": Contract([not_null("feature")], unique=["feature"]),
        "monthly_performance": Contract(
            [
                *map(not_null, ["intake_month", "status"]),
                accepted_values("status", MONTH_STATES),
                accepted_range("roc_auc", 0, 1),
            ],
            unique=["intake_month"],
        ),
        "feature_drift": Contract([not_null("psi"), accepted_range("psi", 0)]),
    }


def check_results(
    tables: Mapping[str, DataFrame],
    contracts: Mapping[str, Contract],
    kinds: list[str] = KINDS,
) -> DataFrame:
    """One row per declared check: how many rows (or values) fail it."""
    parts = []
    for table, contract in contracts.items():
        rules = [rule for rule in contract.rules if rule.name in kinds]
        if rules:
            parts.append(count_row_rules(tables[table], table, rules))
        if "unique" in kinds:
            parts += [
                count_failures(duplicate_values(tables[table], column), "unique", table, column)
                for column in contract.unique
            ]
        if "relationships" in kinds:
            parts += [
                count_failures(
                    missing_parents(tables[table], column, tables[parent], parent_column),
                    "relationships",
                    table,
                    column,
                    weight="failing_rows",
                )
                for column, (parent, parent_column) in contract.parents.items()
            ]
    return union_results(parts)
