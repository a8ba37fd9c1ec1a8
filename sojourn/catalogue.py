"""Every query by name: (spark, table directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.functions.keys import surrogate_key
from sojourn.functions.numbers import logit, recalibrated, round_half_away, sigmoid
from sojourn.functions.rates import LIVE_OUTCOMES, NON_LIVE_OUTCOMES
from sojourn.functions.text import age_text_to_days, clean_label
from sojourn.functions.time import month_start, ntz, whole_days_between
from sojourn.operators import metrics
from sojourn.operators.categories import category_counts, category_map
from sojourn.operators.checks import accepted_range, accepted_values, failing_values
from sojourn.operators.pairing import unmatched
from sojourn.plans import drift, features, marts, model, training, trends, windows
from sojourn.plans.assertions import (
    check_window_results,
    model_assertions,
    scores_only_for_young_open_stays,
    warehouse_assertions,
)
from sojourn.plans.contracts import KINDS, MODEL_TABLES, MODELS, check_results, model_contracts, warehouse_contracts
from sojourn.plans.encoding import MAX_CATEGORIES, LinearEncoder, TreeEncoder, tree_long
from sojourn.plans.episodes import RawFeeds, heavy_entities
from sojourn.plans.pipeline import build_warehouse, publish_warehouse
from sojourn.plans.staging import with_required_keys
from sojourn.plans.training import ModelRun, prepare
from sojourn.sources import landing
from sojourn.sources.feeds import end_feed, start_feed
from sojourn.sources.scratch import materialize, scratch_path
from sojourn.sources.tables import read_published, scan

CATALOGUE: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    CATALOGUE[build.__name__] = build
    return build


# Stored once per application and table directory, as a warehouse stores them: the raw
# snapshots, the episode fact and the model tables. The given tables are snapshots too, so
# nothing kept here goes stale while an application runs.
_KEPT: dict[tuple, object] = {}


def kept(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def raw_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir, "starts", lambda: materialize(start_feed(spark, sf_dir), "raw-starts"))


def raw_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir, "ends", lambda: materialize(end_feed(spark, sf_dir), "raw-ends"))


def feeds(spark: SparkSession, sf_dir: str) -> RawFeeds:
    """Both raw snapshots. Which entities are heavy decides how rows are spread, never what
    comes out."""
    starts, ends = raw_starts(spark, sf_dir), raw_ends(spark, sf_dir)
    heavy = kept(spark, sf_dir, "heavy", lambda: heavy_entities(starts, ends))
    return RawFeeds.split(starts, ends, heavy)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.episode_fact(feeds(spark, sf_dir).episodes())


def stored_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir, "fact", lambda: materialize(fact(spark, sf_dir), "episode-fact"))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits: summation order and fused multiply-adds cannot show."""
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: round_half_away(F.col(c), digits) for c in doubles})


# --- landing ---------------------------------------------------------------------------


def _landed(spark: SparkSession, feed: DataFrame, label: str) -> str:
    """The feed as NDJSON files; keys without a value are left out of the objects."""
    path = scratch_path(spark, label)
    feed.write.json(path)
    return path


@query
def landed_starts(spark, sf_dir):
    path = _landed(spark, raw_starts(spark, sf_dir), "landed-starts")
    return landing.read_landed(spark, path, landing.START_COLUMNS)


@query
def landed_ends(spark, sf_dir):
    path = _landed(spark, raw_ends(spark, sf_dir), "landed-ends")
    return landing.read_landed(spark, path, landing.END_COLUMNS)


@query
def load_reconciliation(spark, sf_dir):
    rows = []
    for name, feed, columns in (
        ("intakes", raw_starts(spark, sf_dir), landing.START_COLUMNS),
        ("outcomes", raw_ends(spark, sf_dir), landing.END_COLUMNS),
    ):
        report = landing.replace_snapshot(
            spark, _landed(spark, feed, name), scratch_path(spark, f"raw-{name}"), columns
        )
        rows.append((name, report.expected_rows, report.loaded_rows))
    return spark.createDataFrame(rows, "feed string, landed_rows long, loaded_rows long")


@query
def absent_columns(spark, sf_dir):
    """A column no landed object carries is loaded as null and reported."""
    feed = raw_starts(spark, sf_dir).drop("found_location")
    report = landing.replace_snapshot(
        spark, _landed(spark, feed, "partial"), scratch_path(spark, "raw-partial"), landing.START_COLUMNS
    )
    rows = [("intakes", name, 0, report.loaded_rows) for name in report.absent_columns]
    return spark.createDataFrame(rows, "feed string, column_name string, filled_rows long, loaded_rows long")


@query
def landed_keys(spark, sf_dir):
    """A feed with a key too many, one left out and one without values, against the columns it should have."""
    feed = raw_starts(spark, sf_dir).withColumn("color", F.lit(None).cast("string")).withColumn("note", F.col("name"))
    path = scratch_path(spark, "keyed-starts")
    feed.drop("found_location").write.option("ignoreNullFields", "false").json(path)
    return landing.landed_keys(spark, path, landing.START_COLUMNS)


# --- cleaning --------------------------------------------------------------------------


@query
def required_keys(spark, sf_dir):
    both = (("intakes", raw_starts(spark, sf_dir)), ("outcomes", raw_ends(spark, sf_dir)))
    keyed = F.col("animal_id").isNotNull() & F.col("datetime").isNotNull()
    parts = [
        feed.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(keyed).alias("kept_rows")).select(
            F.lit(name).alias("feed"), "raw_rows", "kept_rows"
        )
        for name, feed in both
    ]
    return parts[0].unionByName(parts[1])


@query
def dedupe_exact(spark, sf_dir):
    parts = []
    for name, feed in (("intakes", raw_starts(spark, sf_dir)), ("outcomes", raw_ends(spark, sf_dir))):
        keyed = with_required_keys(feed)
        copies = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("copies"))
        parts.append(
            copies.agg(
                F.sum("copies").alias("keyed_rows"), F.count(F.lit(1)).alias("distinct_rows")
            ).select(F.lit(name).alias("feed"), "keyed_rows", "distinct_rows")
        )
    return parts[0].unionByName(parts[1])


@query
def clean_label_values(spark, sf_dir):
    starts = raw_starts(spark, sf_dir).select(F.explode(F.array("intake_type", "intake_condition")).alias("raw_value"))
    ends = raw_ends(spark, sf_dir).select(F.explode(F.array("outcome_type", "outcome_subtype")).alias("raw_value"))
    return starts.unionAll(ends).distinct().withColumn("label", clean_label(F.col("raw_value")))


@query
def age_text_days(spark, sf_dir):
    ages = raw_starts(spark, sf_dir).select(F.col("age_upon_intake").alias("age_text")).unionAll(
        raw_ends(spark, sf_dir).select("age_upon_outcome")
    )
    return ages.distinct().withColumn("age_days", age_text_to_days(F.col("age_text")))


@query
def surrogate_keys(spark, sf_dir):
    pairs = raw_starts(spark, sf_dir).select("animal_id", "name").distinct()
    return pairs.withColumn("digest", surrogate_key(F.col("animal_id"), F.col("name")))


# --- staging, episodes, marts ----------------------------------------------------------


@query
def stage_starts(spark, sf_dir):
    return feeds(spark, sf_dir).staged_starts()


@query
def stage_ends(spark, sf_dir):
    return feeds(spark, sf_dir).staged_ends()


@query
def paired_episodes(spark, sf_dir):
    return feeds(spark, sf_dir).episodes()


@query
def orphan_ends(spark, sf_dir):
    raw = feeds(spark, sf_dir)
    orphans = unmatched(raw.staged_ends(), raw.staged_starts(), ["animal_id", "stay_sequence"])
    return orphans.select("stay_key", "animal_id", "stay_sequence", "outcome_at", "outcome_type")


@query
def episode_fact(spark, sf_dir):
    return fact(spark, sf_dir)


@query
def entity_dimension(spark, sf_dir):
    return marts.entity_dimension(stored_fact(spark, sf_dir))


@query
def monthly_outcomes(spark, sf_dir):
    return marts.in_reading_order(rounded(marts.monthly_outcomes(stored_fact(spark, sf_dir))))


@query
def published_monthly_outcomes(spark, sf_dir):
    """The monthly mart as a reader finds it after a checked publication of all four."""
    starts = raw_starts(spark, sf_dir).dropna(subset=["datetime"])
    root = scratch_path(spark, "published")
    publish_warehouse(starts, raw_ends(spark, sf_dir), root)
    return rounded(read_published(spark, root, "monthly_outcomes"))


@query
def quality_issues(spark, sf_dir):
    return marts.quality_issues(feeds(spark, sf_dir).episodes(keep_orphans=True))


@query
def quality_issue_counts(spark, sf_dir):
    return marts.issue_counts(marts.quality_issues(feeds(spark, sf_dir).episodes(keep_orphans=True)))


# --- checks ----------------------------------------------------------------------------


def warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All warehouse tables; the pairing is stored because most of them read it."""
    return kept(
        spark,
        sf_dir,
        "warehouse",
        lambda: build_warehouse(feeds(spark, sf_dir), raw_starts(spark, sf_dir), raw_ends(spark, sf_dir)),
    )


def _checks(kind: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return check_results(warehouse(spark, sf_dir), warehouse_contracts(), [kind])

    build.__name__ = f"check_{kind}"
    return query(build)


for _kind in KINDS:
    _checks(_kind)


@query
def failing_outcome_types(spark, sf_dir):
    """The offending values behind one accepted-values check."""
    staged = feeds(spark, sf_dir).staged_ends()
    return failing_values(staged, accepted_values("outcome_type", LIVE_OUTCOMES + NON_LIVE_OUTCOMES))


@query
def failing_ages(spark, sf_dir):
    """The offending values behind a range check without its bounds: 30 < age < 730."""
    staged = feeds(spark, sf_dir).staged_starts()
    return failing_values(staged, accepted_range("age_at_intake_days", 30, 730, inclusive=False))


@query
def assert_warehouse(spark, sf_dir):
    tables = warehouse(spark, sf_dir)
    return warehouse_assertions(
        tables["staged_outcomes"],
        tables["episode_fact"],
        tables["monthly_outcomes"],
        tables["quality_issues"],
    )


# --- trends ----------------------------------------------------------------------------



def whole_years(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, trends.Years]:
    """The stored fact and the years it covers in full."""
    fact_table = stored_fact(spark, sf_dir)
    return fact_table, trends.whole_years(features.horizon_of(fact_table))


@query
def trend_adoption_median(spark, sf_dir):
    return trends.adoption_median(*whole_years(spark, sf_dir))


@query
def trend_median_by_exit(spark, sf_dir):
    return trends.median_by_exit(*whole_years(spark, sf_dir))


@query
def trend_live_rate(spark, sf_dir):
    return trends.live_rate(*whole_years(spark, sf_dir))


@query
def trend_exit_mix(spark, sf_dir):
    return trends.exit_mix(*whole_years(spark, sf_dir))


@query
def trend_adoption_p90(spark, sf_dir):
    return rounded(trends.adoption_p90(*whole_years(spark, sf_dir)))


@query
def trend_adjusted_gap(spark, sf_dir):
    return trends.adjusted_gap(marts.monthly_outcomes(stored_fact(spark, sf_dir)))


@query
def trend_longest_history(spark, sf_dir):
    return trends.longest_history(stored_fact(spark, sf_dir))


@query
def trend_start_volume(spark, sf_dir):
    return trends.start_volume(stored_fact(spark, sf_dir))


# --- features, labels, populations ------------------------------------------------------


@query
def daily_census(spark, sf_dir):
    return features.census(stored_fact(spark, sf_dir))


@query
def training_frame(spark, sf_dir):
    return features.training_frame(stored_fact(spark, sf_dir))


@query
def population_horizon(spark, sf_dir):
    stored = stored_fact(spark, sf_dir)
    horizon = features.horizon_of(stored)
    excluded = features.excluded_implausible_open(stored, horizon)
    return features.horizon_frame(stored).withColumn(
        "excluded_implausible_open", F.lit(excluded).cast("long")
    )


@query
def labels(spark, sf_dir):
    stored = stored_fact(spark, sf_dir)
    return features.labelled(stored, features.horizon_of(stored)).select("stay_key", "intake_at", "is_long_stay")


@query
def feature_frame(spark, sf_dir):
    stored = stored_fact(spark, sf_dir)
    frame = features.labelled(features.training_frame(stored), features.horizon_of(stored))
    return features.derive(frame, "stay_key", "intake_at", "is_long_stay")


@query
def scoring_population(spark, sf_dir):
    stored = stored_fact(spark, sf_dir)
    return features.scoring_population(stored, features.horizon_of(stored)).select(
        "stay_key", "animal_id", "animal_type", "intake_at", "days_in_care"
    )


def labelled_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stored features with label, one-row horizon)."""
    inputs = kept(spark, sf_dir, "inputs", lambda: prepare(stored_fact(spark, sf_dir)))
    return inputs.labelled, inputs.horizon_row


@query
def rare_category_map(spark, sf_dir):
    rows, horizon = labelled_features(spark, sf_dir)
    window = windows.collect_windows(windows.holdout_calendar(horizon))[0]
    train = rows.where(windows.within(window.train_start, window.train_end))
    return category_map(category_counts(train, features.CATEGORICAL), MAX_CATEGORIES)


def holdout_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(training rows, rows to score) of the holdout window."""
    rows, horizon = labelled_features(spark, sf_dir)
    window = windows.collect_windows(windows.holdout_calendar(horizon))[0]
    return (
        rows.where(windows.within(window.train_start, window.train_end)),
        rows.where(windows.within(window.score_start, window.score_end)),
    )


@query
def encoded_tree(spark, sf_dir):
    """Holdout rows as the tree learner sees them, encoded by what training had."""
    train, test = holdout_rows(spark, sf_dir)
    return rounded(tree_long(TreeEncoder.fit(train), test, "stay_key"))


@query
def encoded_linear(spark, sf_dir):
    """Holdout rows as the baseline sees them; zeros are left out."""
    train, test = holdout_rows(spark, sf_dir)
    return rounded(LinearEncoder.fit(train).long(test, "stay_key")).where("value <> 0")


@query
def baseline_optimality(spark, sf_dir):
    """Where the baseline's loss is least, fitted probabilities add up to what the labels add up to, input by input."""
    train, _ = holdout_rows(spark, sf_dir)
    config = model.ModelConfig()
    return rounded(model.baseline_optimality(model.fit_baseline(train, config), train, config), 2)


@query
def backtest_rows(spark, sf_dir):
    rows, horizon = labelled_features(spark, sf_dir)
    return training.backtest_rows(rows, windows.collect_windows(windows.backtest_calendar(horizon)))


@query
def check_windows(spark, sf_dir):
    """The checks on windows, which need no learner: training ends long enough before what is scored begins."""
    rows, horizon = labelled_features(spark, sf_dir)
    calendar = windows.backtest_calendar(horizon)
    months = training.backtest_rows(rows, windows.collect_windows(calendar)).where("usable")
    ends = calendar.select(F.col("score_start").alias("intake_month"), "train_end")
    performance = months.join(F.broadcast(ends), "intake_month")
    holdout = windows.holdout_calendar(horizon).select("train_end", F.col("score_start").alias("holdout_start"))
    evaluation = holdout.withColumn("model", F.explode(F.array(*[F.lit(m) for m in MODELS])))
    return check_window_results(performance, evaluation)


@query
def importance_donors(spark, sf_dir):
    """Which row's value each sampled row gets in every repeat."""
    _, test = holdout_rows(spark, sf_dir)
    config = model.ModelConfig()
    sample = materialize(training.importance_sample(test, config), "importance-rows")
    return training.importance_donors(sample, config).join(sample.select("place", "stay_key"), "place").select("repeat", "stay_key", "donor")


@query
def no_signal(spark, sf_dir):
    """The whole fit and its gate on labels that were dealt anew."""
    inputs = kept(spark, sf_dir, "inputs", lambda: prepare(stored_fact(spark, sf_dir)))
    auc = training.no_signal_run(inputs)
    return spark.createDataFrame([(training.NO_SIGNAL_MAX_AUC, auc <= training.NO_SIGNAL_MAX_AUC)], "auc_limit double, passed boolean")


@query
def holdout_calendar(spark, sf_dir):
    return windows.holdout_calendar(features.horizon_frame(stored_fact(spark, sf_dir)))


@query
def backtest_calendar(spark, sf_dir):
    return windows.backtest_calendar(features.horizon_frame(stored_fact(spark, sf_dir)))


# --- metrics, on a score that is a fixed function of the key ------------------------------


def pseudo_score(key: str = "stay_key"):
    """Unrelated to the label and coarse enough to hold many ties."""
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("double") / F.lit(4096.0)


def scored_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_fact(spark, sf_dir)
    horizon = features.horizon_of(stored)
    window = windows.collect_windows(windows.holdout_calendar(features.horizon_frame(stored)))[0]
    held_out = features.labelled(stored, horizon).where(windows.within(window.score_start, window.score_end))
    return held_out.select(
        "stay_key",
        F.col("is_long_stay").alias("y"),
        pseudo_score().alias("p"),
        F.lit("holdout").alias("slice"),
        "outcome_subtype",
    )


@query
def model_metrics(spark, sf_dir):
    return rounded(metrics.measure(scored_holdout(spark, sf_dir), ["slice"], "stay_key"))


@query
def calibration_deciles(spark, sf_dir):
    ranked = metrics.rank_scores(scored_holdout(spark, sf_dir), ["slice"], "stay_key")
    return rounded(metrics.calibration_table(ranked, ["slice"]))


@query
def top_decile(spark, sf_dir):
    ranked = metrics.rank_scores(scored_holdout(spark, sf_dir), ["slice"], "stay_key")
    return ranked.where(metrics.in_top()).select("stay_key", "p", "y", "position")


@query
def sensitivity_slice(spark, sf_dir):
    sliced = model.with_sensitivity_slice(scored_holdout(spark, sf_dir))
    return rounded(metrics.measure(sliced, ["slice"], "stay_key"))


@query
def risk_bands(spark, sf_dir):
    """Bands of those waiting, cut at quantiles of the holdout's scores."""
    ranked = metrics.rank_scores(scored_holdout(spark, sf_dir), ["slice"], "stay_key")
    high, elevated = metrics.score_quantiles(ranked, [0.9, 0.7])
    stored = stored_fact(spark, sf_dir)
    waiting = features.scoring_population(stored, features.horizon_of(stored))
    return waiting.select("stay_key", model.risk_band(pseudo_score(), high, elevated).alias("risk_band"))


@query
def misplaced_scores(spark, sf_dir):
    """The score-to-fact check over every stay: those closed, or open for thirty days or more, fail it."""
    stored = stored_fact(spark, sf_dir)
    as_of = ntz(features.horizon_of(stored).as_of)
    every = stored.select("stay_key", whole_days_between(F.col("intake_at"), as_of).alias("days_in_care"))
    return scores_only_for_young_open_stays(every, stored).select("stay_key")


@query
def recalibrated_scores(spark, sf_dir):
    scored = scored_holdout(spark, sf_dir)
    return rounded(scored.select("stay_key", recalibrated(F.col("p"), 0.8, -0.25).alias("probability")))


@query
def recalibration_fit(spark, sf_dir):
    """Slope and intercept for a score that knows the label a little, and for one that does not."""
    scored = scored_holdout(spark, sf_dir)
    knowing = F.col("p") * 0.5 + F.col("y") * 0.25 + 0.125
    both = scored.select(F.lit("related").alias("fit"), knowing.alias("p"), "y").unionAll(scored.select(F.lit("unrelated"), "p", "y"))
    log_odds = materialize(both.select("fit", logit(F.col("p")).alias("z"), "y"), "log-odds")
    found = model.platt(log_odds, model.ModelConfig().calibration_c)
    rows = spark.createDataFrame([(f, *x) for f, x in found.items()], "fit string, slope double, intercept double")
    return rounded(rows, 5)


@query
def level_shift(spark, sf_dir):
    """The shift in log-odds that brings the mean score to the observed rate."""
    stored = materialize(
        scored_holdout(spark, sf_dir).select(logit(F.col("p")).alias("z"), "y"), "level-shift"
    )
    shift = model.level_shift(stored)
    return stored.agg(
        F.count(F.lit(1)).alias("n"),
        round_half_away(F.avg("y"), 6).alias("target_rate"),
        round_half_away(F.avg(sigmoid(F.col("z") + F.lit(shift))), 6).alias("shifted_mean"),
        round_half_away(F.lit(shift), 4).alias("shift"),
    )


@query
def drift_bands(spark, sf_dir):
    rows, horizon = labelled_features(spark, sf_dir)
    members = drift.month_members(rows, windows.backtest_calendar(horizon))
    return drift.category_shifts(drift.drift_view(members, drift.census_edges(members)))


@query
def psi_by_month(spark, sf_dir):
    rows, horizon = labelled_features(spark, sf_dir)
    return rounded(drift.feature_drift(rows, windows.backtest_calendar(horizon)))


@query
def month_status(spark, sf_dir):
    rows, horizon = labelled_features(spark, sf_dir)
    calendar = windows.backtest_calendar(horizon)
    months = calendar.select("score_start", "score_end")
    scored = (
        rows.withColumn("score_start", month_start(F.col("intake_at")))
        .join(F.broadcast(months), "score_start")
        .select(
            F.col("score_start").alias("backtest_month"),
            "stay_key",
            F.col("is_long_stay").alias("y"),
            pseudo_score().alias("p"),
        )
    )
    per_month = metrics.measure(scored, ["backtest_month"], "stay_key").withColumnRenamed("backtest_month", "intake_month")
    summary = drift.drift_summary(drift.feature_drift(rows, calendar))
    return rounded(drift.month_status(per_month.join(summary, "intake_month")))


# --- the model run -----------------------------------------------------------------------


def model_run(spark: SparkSession, sf_dir: str) -> ModelRun:
    """One run per table directory; each of its tables makes the fits it needs, once."""
    return kept(spark, sf_dir, "model", lambda: ModelRun(stored_fact(spark, sf_dir)))


def _model_table(name: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return model_run(spark, sf_dir).table(name)

    build.__name__ = name
    return query(build)


for _name in MODEL_TABLES:
    _model_table(_name)


@query
def check_model_outputs(spark, sf_dir):
    tables = model_run(spark, sf_dir).tables() | {"episode_fact": stored_fact(spark, sf_dir)}
    declared = check_results(tables, model_contracts())
    return declared.unionByName(
        model_assertions(
            tables["model_evaluation"],
            tables["monthly_performance"],
            tables["stay_scores"],
            tables["episode_fact"],
        )
    )
