"""Categories derived from raw attribute text and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band edges (days) and labels. The fact's bands are closed on the left,
# the drift bands on the right; they are different features and stay apart.
FACT_AGE_BANDS = [
    (180, "Under 6 months"),
    (365, "6 to 12 months"),
    (1095, "1 to 3 years"),
    (2555, "3 to 7 years"),
]
FACT_AGE_OLDEST = "7 years and over"
DRIFT_AGE_BANDS = [(180, "<6m"), (365, "6-12m"), (1095, "1-3y"), (2555, "3-7y")]
DRIFT_AGE_OLDEST = "7y+"
UNKNOWN = "Unknown"
ANY_SPACE = " \t\n\r\x0b\x0c"
OUTSIDE = "Outside Jurisdiction"


def or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN))


def age_band(days: Column) -> Column:
    band = F.when(days.isNull(), F.lit(None).cast("string"))
    for upper, label in FACT_AGE_BANDS:
        band = band.when(days < upper, label)
    return band.otherwise(FACT_AGE_OLDEST)


def drift_age_band(days: Column) -> Column:
    """A missing or impossible age is the text 'nan', a category of its own."""
    band = F.when(days.isNull() | F.isnan(days.cast("double")) | (days <= -1), "nan")
    for upper, label in DRIFT_AGE_BANDS:
        band = band.when(days <= upper, label)
    return band.otherwise(DRIFT_AGE_OLDEST)


def reproductive_status(sex: Column) -> Column:
    return (
        F.when(sex.contains("Intact"), "Intact")
        .when(sex.contains("Neutered") | sex.contains("Spayed"), "Altered")
        .otherwise(UNKNOWN)
    )


def primary_component(c: Column) -> Column:
    """'Pit Bull Mix/Boxer' -> 'Pit Bull'."""
    head = F.trim(F.replace(F.substring_index(c, "/", 1), F.lit(" Mix"), F.lit("")), F.lit(ANY_SPACE))
    return or_unknown(F.nullif(head, F.lit("")))


def is_mix(breed: Column) -> Column:
    return F.when(breed.contains("Mix") | breed.contains("/"), "Mix").otherwise("Single")


def jurisdiction(location: Column) -> Column:
    """'12 A St in Millbrook (TX)' -> 'Millbrook'."""
    place = F.trim(F.substring_index(F.substring_index(location, " in ", -1), "(", 1), F.lit(ANY_SPACE))
    return F.when(location.contains(OUTSIDE), OUTSIDE).otherwise(
        or_unknown(F.nullif(place, F.lit("")))
    )


def band_index(value: Column, edges: Column) -> Column:
    """How many edges lie at or below the value, as text; null values sit below all.

    No edges at all (the group had no reference values) gives 'unknown'.
    """
    filled = F.coalesce(value.cast("double"), F.lit(-1.0))
    below = F.size(F.filter(edges, lambda edge: edge <= filled))
    return F.when(edges.isNull() | (F.size(edges) == 0), "unknown").otherwise(below.cast("string"))
