"""Cleaning of all-text event columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and unit lengths that results depend on.
WHITESPACE_RUN = "[ \\t\\n\\f\\r]+"
# Year, month and day, and a time only with its minutes: a cast alone would fill in the rest.
FULL_DATE = "^\\d{4}-\\d{1,2}-\\d{1,2}([ T]\\d{1,2}:\\d{1,2}(:\\d{1,2}([.]\\d+)?)?Z?)?$"
LEADING_INTEGER = "^(-?\\d+)"
DAYS_PER_UNIT = {"year": 365, "month": 30, "week": 7, "day": 1}

# initcap only starts a new word after a space, so each hyphen gets a marked space
# while the words are capitalised. U+0001 keeps the mark apart from real spaces.
_HYPHEN_BREAK = "-\u0001 "


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def clean_label(c: Column) -> Column:
    """Title-case per space word and per hyphen part; blank text becomes null."""
    squeezed = F.regexp_replace(F.lower(F.trim(c)), WHITESPACE_RUN, " ")
    opened = F.replace(squeezed, F.lit("-"), F.lit(_HYPHEN_BREAK))
    return F.nullif(F.replace(F.initcap(opened), F.lit(_HYPHEN_BREAK), F.lit("-")), F.lit(""))


def age_text_to_days(c: Column) -> Column:
    """'3 months' -> 90. Anything without a leading count >= 0 and a known unit is null.

    Placeholder words such as 'NULL' and 'unknown' have no leading count, so they need
    no branch of their own. The first unit named in DAYS_PER_UNIT wins.
    """
    count = F.regexp_extract(F.trim(c), LEADING_INTEGER, 1).try_cast("int")
    lowered = F.lower(c)
    unit = F.lit(None).cast("int")
    for name, days in reversed(DAYS_PER_UNIT.items()):
        unit = F.when(lowered.contains(name), F.lit(days)).otherwise(unit)
    return F.when(count >= 0, count * unit)


def safe_timestamp(c: Column) -> Column:
    """Text that is no full date, or is padded, becomes null."""
    return F.when(c.rlike(FULL_DATE), c.try_cast("timestamp_ntz"))


def strict_timestamp(c: Column) -> Column:
    """Text that is no full date stops the job; null stays null."""
    broken = F.raise_error(F.concat(F.lit("not a full date: "), c)).cast("timestamp_ntz")
    return F.when(c.isNull() | c.rlike(FULL_DATE), c.cast("timestamp_ntz")).otherwise(broken)
