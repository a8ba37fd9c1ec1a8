"""Exact ranking, calibration and drift metrics over scored rows of any number."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sojourn.operators.ranking import positions
from sojourn.sources.scratch import materialize

LABEL, SCORE = "y", "p"
METRICS = [
    "n", "base_rate", "mean_predicted", "roc_auc", "average_precision", "brier",
    "top_decile_precision", "top_decile_lift",
]
# Fixed value: the smallest share a category counts with in the stability index.
SHARE_FLOOR = 0.005


def rank_scores(scored: DataFrame, group: Sequence[str], key: str, extra: Sequence[str] = ()) -> DataFrame:
    """Rows with their position by (score, key) within the group.

    Every metric below reads off these positions: `position` and `positives_so_far` count up
    from the lowest score, `n` and `positives` are the group's totals.
    """
    rows = scored.select(*group, key, F.col(LABEL).cast("long").alias(LABEL), SCORE, *extra)
    return positions(
        rows,
        group,
        [SCORE, key],
        running={"positives_so_far": LABEL},
        totals={"n": "*", "positives": LABEL},
        label="ranked-scores",
    )


def top_count(n: Column, share: float = 0.10) -> Column:
    """At least one row; halves round to even."""
    return F.greatest(F.lit(1), F.bround(n.cast("double") * F.lit(share), 0).cast("long"))


def in_top(share: float = 0.10) -> Column:
    """Among the highest scores; equal scores are taken by key, highest first."""
    return F.col("position") > F.col("n") - top_count(F.col("n"), share)


def evaluate(ranked: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row of metrics per group, from one pass per distinct score and one per group.

    Ties share their mean rank (AUC) and one threshold (average precision).
    """
    per_score = ranked.groupBy(*group, SCORE).agg(
        F.count(F.lit(1)).alias("rows_at"),
        F.sum(LABEL).alias("positives_at"),
        F.max("position").alias("last_position"),
        F.max("positives_so_far").alias("positives_upto"),
        F.max("n").alias("n"),
        F.max("positives").alias("positives"),
        F.count_if(in_top()).alias("top_rows"),
        F.sum(F.when(in_top(), F.col(LABEL)).otherwise(0)).alias("top_positives"),
    )
    return _totals(per_score, group)


def measure(scored: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """What evaluate gives, without an order of the rows: they are counted by distinct score map-side, and running
    sums go over the distinct scores. Only rows that tie at the edge of the top share, and there only where
    labels differ, are put in order of their key.
    """
    rows = scored.select(*group, key, F.col(LABEL).cast("long").alias(LABEL), SCORE)
    counts = rows.groupBy(*group, SCORE).agg(F.count(F.lit(1)).alias("rows_at"), F.sum(LABEL).alias("positives_at"))
    placed = positions(
        counts,
        group,
        [SCORE],
        running={"last_position": "rows_at", "positives_upto": "positives_at"},
        totals={"n": "rows_at", "positives": "positives_at"},
        label="score-counts",
    )
    below = F.col("n") - top_count(F.col("n"))
    top_rows = F.least("rows_at", F.greatest(F.lit(0), F.col("last_position") - below))
    per_score = materialize(placed.drop("position").withColumn("top_rows", top_rows), "scores")
    mixed = (F.col("positives_at") > 0) & (F.col("positives_at") < F.col("rows_at"))
    cut = per_score.where((F.col("top_rows") > 0) & (F.col("top_rows") < F.col("rows_at")) & mixed)
    whole = F.when(F.col("positives_at") == 0, F.lit(0)).otherwise(F.least("top_rows", "positives_at"))
    if cut.isEmpty():
        return _totals(per_score.withColumn("top_positives", whole.cast("long")), group)
    # One score per group at most. Null-safe, so that rows whose group is null find theirs.
    edges = cut.select(*[F.col(c).alias(f"_{c}") for c in [*group, SCORE]], F.col("rows_at").alias("_rows"), F.col("top_rows").alias("_top"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*group, SCORE]]
    tied = rows.join(edges, reduce(Column.__and__, same)).select(*rows.columns, "_rows", "_top")
    ordered = positions(tied, group, [key], label="tied-scores").where(F.col("position") > F.col("_rows") - F.col("_top"))
    found = ordered.groupBy(*[F.col(c).alias(f"_{c}") for c in [*group, SCORE]]).agg(F.sum(LABEL).alias("_positives"))
    known = per_score.join(found, reduce(Column.__and__, same), "left").drop(*[f"_{c}" for c in [*group, SCORE]])
    return _totals(known.withColumn("top_positives", F.coalesce("_positives", whole).cast("long")).drop("_positives"), group)


def _totals(per_score: DataFrame, group: Sequence[str]) -> DataFrame:
    """Metrics from one row per distinct score: rows_at, positives_at, last_position, positives_upto, n, positives,
    top_rows and top_positives."""
    rows_at, positives_at = F.col("rows_at").cast("double"), F.col("positives_at").cast("double")
    mean_rank = F.col("last_position") - (rows_at - 1.0) / 2.0
    rows_from = F.col("n") - F.col("last_position") + rows_at
    positives_from = F.col("positives") - F.col("positives_upto") + positives_at
    error = positives_at * F.pow(F.lit(1.0) - F.col(SCORE), F.lit(2.0)) + (
        rows_at - positives_at
    ) * F.pow(F.col(SCORE), F.lit(2.0))
    totals = per_score.groupBy(*group).agg(
        F.max("n").alias("n"),
        F.max("positives").cast("double").alias("positives"),
        F.sum(F.col(SCORE) * rows_at).alias("score_sum"),
        F.sum(error).alias("error_sum"),
        F.sum(positives_at * mean_rank).alias("rank_sum"),
        F.sum(positives_at * positives_from / rows_from).alias("precision_sum"),
        F.sum("top_positives").cast("double").alias("top_positives"),
        F.sum("top_rows").alias("top_rows"),
    )
    n, positives = F.col("n"), F.col("positives")
    negatives = n - positives
    base_rate = positives / n
    precision = F.col("top_positives") / F.col("top_rows")
    return totals.select(
        *group,
        "n",
        base_rate.alias("base_rate"),
        (F.col("score_sum") / n).alias("mean_predicted"),
        F.when(
            (positives > 0) & (negatives > 0),
            (F.col("rank_sum") - positives * (positives + 1.0) / 2.0) / (positives * negatives),
        ).alias("roc_auc"),
        F.when(positives > 0, F.col("precision_sum") / positives).alias("average_precision"),
        (F.col("error_sum") / n).alias("brier"),
        precision.alias("top_decile_precision"),
        F.when(positives > 0, precision / base_rate).alias("top_decile_lift"),
    )


def decile(position: Column, n: Column) -> Column:
    """Equal-width cuts of the ranks 1..n, closed on the right. Not the same as ntile(10)."""
    numerator = F.lit(10) * (position - 1) + n - 2
    steps = F.when(n > 1, (numerator - F.pmod(numerator, n - 1)) / (n - 1))
    return F.greatest(F.lit(1).cast("long"), steps.cast("long"))


def calibration_table(ranked: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    return (
        ranked.withColumn("decile", decile(F.col("position"), F.col("n")))
        .groupBy(*group, "decile")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(SCORE).alias("mean_predicted"),
            F.avg(LABEL).alias("observed_rate"),
        )
    )


def stability_index(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Population stability per group from (group, category, expected, actual) counts.

    Every category seen on either side counts; shares are floored but not rescaled.
    """
    # One row per category is little; a window keeps groups that are null.
    whole = Window.partitionBy(*group)
    shared = counts.withColumns(
        {"expected_total": F.sum("expected").over(whole), "actual_total": F.sum("actual").over(whole)}
    )
    floor = F.lit(SHARE_FLOOR)
    e = F.greatest(floor, F.coalesce(F.try_divide("expected", "expected_total"), F.lit(0.0)))
    a = F.greatest(floor, F.coalesce(F.try_divide("actual", "actual_total"), F.lit(0.0)))
    return shared.groupBy(*group).agg(F.sum((a - e) * F.log(a / e)).alias("psi"))


def score_quantiles(ranked: DataFrame, shares: Sequence[float]) -> list[float | None]:
    """Interpolated quantiles of the scores of a single-group ranking.

    Read off the positions (two rows per share reach the driver), because an exact
    percentile aggregate would hold every distinct score in one task.
    """
    last = (F.col("n") - 1).cast("double")
    wanted = F.lit(False)
    for share in shares:
        floor = F.floor(last * F.lit(share)) + 1
        wanted = wanted | F.col("position").between(floor, floor + 1)
    rows = {r["position"]: r for r in ranked.where(wanted).select("position", "n", SCORE).collect()}
    if not rows:
        return [None for _ in shares]
    n = next(iter(rows.values()))["n"]
    found = []
    for share in shares:
        at = (n - 1) * share
        low = rows[int(at) + 1][SCORE]
        high = rows[min(int(at) + 2, n)][SCORE]
        found.append(low + (high - low) * (at - int(at)))
    return found
