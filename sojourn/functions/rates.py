"""Outcome classes and the live-release rate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sojourn.functions.numbers import round_half_away

# The outcome class lists.
LIVE_OUTCOMES = ["Adoption", "Return To Owner", "Rto-Adopt", "Transfer"]
NON_LIVE_OUTCOMES = ["Euthanasia", "Died", "Disposal", "Missing"]


def classify_outcome(c: Column) -> Column:
    """Null stays null: a closed episode without an end type has no class."""
    return (
        F.when(c.isin(LIVE_OUTCOMES), "Live")
        .when(c.isin(NON_LIVE_OUTCOMES), "Non-Live")
        .when(c.isNotNull(), "Unknown")
    )


def rate_pct(numerator: Column, denominator: Column) -> Column:
    """Two-decimal percentage, null when the denominator is zero."""
    return round_half_away(F.lit(100.0) * numerator / F.nullif(denominator, F.lit(0)), 2)


def live_release_rate(outcome_class: Column, exclude: Column | None = None) -> Column:
    """Aggregate. A null exclusion flag keeps its row out of both sides."""
    keep = F.lit(True) if exclude is None else ~exclude
    live = F.count_if((outcome_class == "Live") & keep)
    classified = F.count_if(outcome_class.isin("Live", "Non-Live") & keep)
    return rate_pct(live, classified)
