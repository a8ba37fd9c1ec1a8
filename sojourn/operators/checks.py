"""Declarative data-quality checks. A check passes when nothing fails it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"
RESULT_COLUMNS = ["check_name", "table_name", "column_name", "severity", "failing_rows"]


class CheckFailure(RuntimeError):
    """At least one error-level check found failing rows."""


@dataclass(frozen=True)
class RowRule:
    """A check decided row by row; `violates` is true for failing rows."""

    name: str
    column: str
    violates: Column
    severity: str = ERROR


def not_null(column: str, severity: str = ERROR) -> RowRule:
    return RowRule("not_null", column, F.col(column).isNull(), severity)


def accepted_values(column: str, values: Sequence[str], severity: str = ERROR) -> RowRule:
    """Nulls pass."""
    return RowRule("accepted_values", column, ~F.col(column).isin(list(values)), severity)


def accepted_range(
    column: str,
    min_value: float | None = None,
    max_value: float | None = None,
    inclusive: bool = True,
    severity: str = ERROR,
) -> RowRule:
    """Nulls pass. At least one bound is needed."""
    if min_value is None and max_value is None:
        raise ValueError(f"accepted_range on {column} needs min_value, max_value or both")
    value = F.col(column)
    inside = []
    if min_value is not None:
        inside.append(value >= min_value if inclusive else value > min_value)
    if max_value is not None:
        inside.append(value <= max_value if inclusive else value < max_value)
    return RowRule("accepted_range", column, ~reduce(Column.__and__, inside), severity)


def failing_values(df: DataFrame, rule: RowRule) -> DataFrame:
    """The offending values and how often each occurs."""
    return (
        df.where(rule.violates)
        .groupBy(F.col(rule.column).alias("failing_value"))
        .agg(F.count(F.lit(1)).alias("failing_rows"))
    )


def count_row_rules(df: DataFrame, table: str, rules: Sequence[RowRule]) -> DataFrame:
    """All row rules of a table in one aggregate over one scan; one result row per rule."""
    counts = df.agg(*[F.count_if(r.violates).alias(f"r{i}") for i, r in enumerate(rules)])
    results = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("check_name"),
                F.lit(table).alias("table_name"),
                F.lit(r.column).alias("column_name"),
                F.lit(r.severity).alias("severity"),
                F.col(f"r{i}").alias("failing_rows"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(results))


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once; nulls are no values."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("failing_value"))
        .agg(F.count(F.lit(1)).alias("failing_rows"))
        .where(F.col("failing_rows") > 1)
    )


def missing_parents(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign keys without a parent row.

    Counted per key before the join: a key that fills a third of the child is one row by
    the time it is shuffled to the parent.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("failing_value"))
        .agg(F.count(F.lit(1)).alias("failing_rows"))
    )
    return keys.join(
        parent.select(F.col(parent_column).alias("failing_value")), "failing_value", "left_anti"
    )


def count_failures(
    failing: DataFrame, name: str, table: str, column: str, severity: str = ERROR, weight: str | None = None
) -> DataFrame:
    """One result row from a DataFrame whose rows are failures, or hold `weight` failures each."""
    failures = F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    return failing.agg(failures.alias("failing_rows")).select(
        F.lit(name).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"),
        "failing_rows",
    )


def union_results(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def enforce(results: DataFrame) -> list[str]:
    """Raise on error-level failures; return the warnings as text."""
    failed = results.where(F.col("failing_rows") > 0).collect()
    lines = {ERROR: [], WARN: []}
    for row in failed:
        lines[row["severity"]].append(
            f"{row['check_name']} {row['table_name']}.{row['column_name']}: {row['failing_rows']} rows"
        )
    if lines[ERROR]:
        raise CheckFailure("; ".join(sorted(lines[ERROR])))
    return sorted(lines[WARN])
