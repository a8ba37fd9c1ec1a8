"""Yearly findings over the episode fact and the monthly mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sojourn.functions.numbers import round_half_away
from sojourn.functions.rates import live_release_rate, rate_pct
from sojourn.operators.quantiles import percentile_of, with_ranks
from sojourn.plans.features import Horizon
from sojourn.plans.marts import closed
from sojourn.plans.staging import ENTITY

SPECIES = ["Dog", "Cat"]
Years = tuple[int, int]


def whole_years(horizon: Horizon) -> Years:
    """First and last calendar year that lie wholly between the feed's first event and its last."""
    start, end = horizon.feed_start, horizon.as_of
    first = start.year if (start.month, start.day) == (1, 1) else start.year + 1
    return first, end.year if (end.month, end.day) == (12, 31) else end.year - 1


def closed_in(fact: DataFrame, years: Years) -> DataFrame:
    """Closed episodes that ended in whole years; the feed's partial edge years are left out."""
    year = F.year("outcome_date")
    return closed(fact).withColumn("outcome_year", year).where(F.col("outcome_year").between(*years))


def _duration_by(df: DataFrame, group: list[str], share: float, name: str) -> DataFrame:
    """Exact percentile per group, from one weighted row per distinct duration."""
    weighted = df.groupBy(*group, "length_of_stay_days").agg(F.count(F.lit(1)).alias("n"))
    return with_ranks(weighted, group, "length_of_stay_days").groupBy(*group).agg(
        F.sum("n").alias("stays"), percentile_of("length_of_stay_days", share).alias(name)
    )


def adoption_median(fact: DataFrame, years: Years) -> DataFrame:
    adopted = closed_in(fact, years).where(
        (F.col("outcome_type") == "Adoption") & F.col("animal_type").isin(SPECIES)
    )
    return _duration_by(adopted, ["outcome_year", "animal_type"], 0.5, "median_days")


def median_by_exit(fact: DataFrame, years: Years, species: str = "Dog") -> DataFrame:
    """The mix of exits held fixed: one species, split by how it left."""
    left = closed_in(fact, years).where(F.col("animal_type") == species)
    return _duration_by(left, ["outcome_year", "outcome_type"], 0.5, "median_days")


def live_rate(fact: DataFrame, years: Years) -> DataFrame:
    both = closed_in(fact, years).where(F.col("animal_type").isin(SPECIES))
    return both.groupBy("outcome_year").agg(
        F.count(F.lit(1)).alias("stays"), live_release_rate(F.col("outcome_class")).alias("live_release_rate_pct")
    )


def exit_mix(fact: DataFrame, years: Years) -> DataFrame:
    counts = (
        closed_in(fact, years)
        .where(F.col("animal_type").isin(SPECIES))
        .groupBy("outcome_year", "outcome_type")
        .agg(F.count(F.lit(1)).alias("stays"))
    )
    total = F.sum("stays").over(Window.partitionBy("outcome_year"))
    return counts.withColumn("share_pct", rate_pct(F.col("stays"), total))


def adoption_p90(fact: DataFrame, years: Years) -> DataFrame:
    adopted = closed_in(fact, years).where(
        (F.col("outcome_type") == "Adoption") & F.col("animal_type").isin(SPECIES)
    )
    return _duration_by(adopted, ["outcome_year", "animal_type"], 0.9, "p90_days")


def adjusted_gap(mart: DataFrame) -> DataFrame:
    gap: Column = F.col("live_release_rate_adjusted_pct") - F.col("live_release_rate_pct")
    return mart.agg(F.count(gap).alias("groups"), round_half_away(F.avg(gap), 6).alias("mean_gap_points"))


def longest_history(fact: DataFrame) -> DataFrame:
    """Most episodes of any one entity."""
    per_entity = fact.groupBy(ENTITY).agg(F.count(F.lit(1)).alias("stays"))
    return per_entity.agg(F.max("stays").alias("most_stays"), F.count(F.lit(1)).alias("animals"))


def start_volume(fact: DataFrame) -> DataFrame:
    return fact.groupBy("intake_month", "animal_type").agg(F.count(F.lit(1)).alias("intakes"))
