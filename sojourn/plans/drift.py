"""Input drift of every backtest month against the same calendar month in its training window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sojourn.functions.bands import band_index, drift_age_band
from sojourn.operators.categories import long_form
from sojourn.operators.metrics import stability_index
from sojourn.operators.quantiles import percentile_of, with_ranks

# Monitored features in reporting order, quantiles, alert levels.
DRIFT_FEATURES = ["intake_type", "intake_condition", "animal_type", "age_band", "census_band"]
CENSUS_QUANTILES = [0.2, 0.4, 0.6, 0.8]
PSI_ALERT = 0.25
AUC_FLOOR = 0.65
CALIBRATION_TOLERANCE = 0.05
MIN_MONTH_ROWS = 200


def month_members(features: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows a backtest month compares: its own (actual) and its reference rows (expected).

    A row can only matter to months with its own calendar month, so this is an equi-join on
    the month of the year with the calendar's twelve rows, not a range join.
    """
    months = calendar.select(
        F.col("score_start").alias("backtest_month"),
        "score_end",
        "train_start",
        "train_end",
        F.month("score_start").alias("month_of_year"),
    )
    started = F.col("intake_at")
    return (
        features.withColumn("month_of_year", F.month("intake_at"))
        .join(F.broadcast(months), "month_of_year")
        .withColumn("actual", (started >= F.col("backtest_month")) & (started < F.col("score_end")))
        .withColumn("expected", (started >= F.col("train_start")) & (started < F.col("train_end")))
        .where(F.col("actual") | F.col("expected"))
        .drop("month_of_year", "score_end", "train_start", "train_end")
    )


def census_edges(members: DataFrame) -> DataFrame:
    """Quintile edges of the census per month and type, from the reference rows only.

    Months times the population's types, so a few dozen rows.
    """
    weighted = (
        members.where(F.col("expected") & F.col("census_same_type").isNotNull())
        .groupBy("backtest_month", "animal_type", "census_same_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    group = ["backtest_month", "animal_type"]
    quantiles = [percentile_of("census_same_type", q) for q in CENSUS_QUANTILES]
    return (
        with_ranks(weighted, group, "census_same_type")
        .groupBy(*group)
        .agg(F.array_distinct(F.array(*quantiles)).alias("edges"))
    )


def drift_view(members: DataFrame, edges: DataFrame) -> DataFrame:
    """The monitored features as categories."""
    return (
        members.join(F.broadcast(edges), ["backtest_month", "animal_type"], "left")
        .withColumn("age_band", drift_age_band(F.col("age_at_intake_days")))
        .withColumn("census_band", band_index(F.col("census_same_type"), F.col("edges")))
        .select("backtest_month", "expected", "actual", *DRIFT_FEATURES)
    )


def category_shifts(view: DataFrame) -> DataFrame:
    """(month, feature, category) with its reference and current row counts, in one pass."""
    return (
        long_form(view, DRIFT_FEATURES, keep=["backtest_month", "expected", "actual"])
        .groupBy(F.col("backtest_month").alias("intake_month"), "feature", "category")
        .agg(F.count_if("expected").alias("expected"), F.count_if("actual").alias("actual"))
    )


def feature_drift(features: DataFrame, calendar: DataFrame) -> DataFrame:
    """(intake_month, feature, psi) for all months in one job."""
    members = month_members(features, calendar)
    view = drift_view(members, census_edges(members))
    return stability_index(category_shifts(view), ["intake_month", "feature"])


def drift_summary(drift: DataFrame) -> DataFrame:
    """Per month: the largest index and the features above the alert level, in fixed order."""
    place = F.array_position(F.array(*[F.lit(f) for f in DRIFT_FEATURES]), F.col("feature"))
    alerts = F.filter(
        F.array_sort(F.collect_list(F.struct(place.alias("place"), "feature", "psi"))),
        lambda item: item["psi"] > PSI_ALERT,
    )
    names = F.array_join(F.transform(alerts, lambda item: item["feature"]), ", ")
    return drift.groupBy("intake_month").agg(
        F.max("psi").alias("max_feature_psi"), F.nullif(names, F.lit("")).alias("drifted_features")
    )


def month_status(metrics: DataFrame) -> DataFrame:
    """Adds calibration_gap, status and review_reasons to one row of metrics per month.

    Too few rows outranks a review, but the reasons are given either way.
    """
    gap = F.col("mean_predicted") - F.col("base_rate")
    reasons = F.concat_ws(
        ", ",
        F.when(F.col("roc_auc") < AUC_FLOOR, F.lit("auc_below_floor")),
        F.when(F.abs(gap) > CALIBRATION_TOLERANCE, F.lit("calibration_gap")),
    )
    status = (
        F.when(F.col("n") < MIN_MONTH_ROWS, "insufficient_data")
        .when(reasons != "", "review")
        .otherwise("ok")
    )
    return metrics.withColumns(
        {"calibration_gap": gap, "status": status, "review_reasons": F.nullif(reasons, F.lit(""))}
    )
