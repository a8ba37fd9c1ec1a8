"""Encoders, learners and the monitored run."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sojourn.catalogue import stored_fact
from sojourn.operators import metrics
from sojourn.plans import features, training, windows
from sojourn.plans.assertions import model_assertions
from sojourn.plans.contracts import MODEL_TABLES
from sojourn.plans.encoding import Categories, LinearEncoder, TreeEncoder
from sojourn.plans.episodes import RawFeeds
from sojourn.plans.marts import episode_fact
from sojourn.plans import pipeline
from sojourn.plans.model import ModelConfig, fit_baseline, fit_boosted, fit_recalibrated, stopping_round
from sojourn.plans.pipeline import publish_model
from sojourn.sources.scratch import materialize
from sojourn.sources.tables import read_published

QUICK = ModelConfig(max_iter=4, max_depth=3, logistic_iter=50, importance_repeats=2)


@pytest.fixture(scope="module")
def fact(feeds):
    return materialize(episode_fact(RawFeeds.of(*feeds).episodes()), "test-fact")


@pytest.fixture(scope="module")
def rows_with_signal(spark):
    """Labels that depend on age and start type, and became commoner in the last half year."""
    base = spark.range(6000).select(
        F.md5(F.col("id").cast("string")).alias("stay_key"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 1400 as int))").alias("intake_at"),
        F.lit(None).cast("string").alias("outcome_subtype"),
        F.element_at(F.array(F.lit("Dog"), F.lit("Cat")), (F.col("id") % 2 + 1).cast("int")).alias("animal_type"),
        F.element_at(F.array(F.lit("Stray"), F.lit("Abandoned")), (F.col("id") % 3 % 2 + 1).cast("int")).alias("intake_type"),
        *[F.lit("x").alias(c) for c in features.CATEGORICAL[2:5]],
        F.concat(F.lit("Breed"), F.pmod(F.xxhash64("id"), F.lit(60))).alias("primary_breed"),
        *[F.lit("x").alias(c) for c in features.CATEGORICAL[6:]],
        F.when(F.col("id") % 10 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("double")).alias("age_at_intake_days"),
        F.lit(1.0).alias("stay_sequence"),
        (F.col("id") % 90).cast("double").alias("census_same_type"),
    )
    draw = F.pmod(F.xxhash64("stay_key", F.lit(2)), F.lit(1000)) / 1000.0
    chance = F.when(F.coalesce("age_at_intake_days", F.lit(0)) > 500, 0.5).otherwise(0.1) + F.when(
        F.col("intake_type") == "Stray", 0.2
    ).otherwise(0.0) + F.when(F.col("intake_at") >= F.lit("2023-04-01").cast("timestamp_ntz"), 0.15).otherwise(0.0)
    return materialize(base.withColumn("is_long_stay", (draw < chance).cast("int")), "signal")


def test_categories(rows_with_signal):
    fitted = Categories.fit(rows_with_signal)
    assert len(fitted.kept["primary_breed"]) == 39 and fitted.bucketed == {"primary_breed"}
    assert fitted.kept["animal_type"] == ["Cat", "Dog"]
    unseen = rows_with_signal.limit(1).withColumns({"primary_breed": F.lit("New"), "animal_type": F.lit("Bird")})
    row = fitted.index(unseen).first()
    assert (row["primary_breed_index"], row["animal_type_index"]) == (39.0, 2.0)


def test_encoders_keep_every_row(rows_with_signal):
    n = rows_with_signal.count()
    tree = TreeEncoder.fit(rows_with_signal).transform(rows_with_signal)
    assert tree.count() == n and len(tree.first()["inputs"]) == 16
    linear = LinearEncoder.fit(rows_with_signal)
    assert linear.flagged == ["age_at_intake_days"]
    encoded = linear.transform(rows_with_signal)
    assert encoded.count() == n
    means = encoded.agg(*[F.avg(c) for c in linear.scales]).first()
    assert list(means) == pytest.approx([0.0] * len(linear.scales), abs=1e-9)


def test_models_find_signal_and_recalibration_moves_the_level(rows_with_signal):
    config = ModelConfig(max_iter=15, logistic_iter=100)
    window = windows.Window(
        datetime(2020, 1, 1), datetime(2023, 4, 1), datetime(2023, 8, 1), datetime(2023, 8, 1), datetime(2024, 1, 1)
    )
    test = rows_with_signal.where(windows.within(window.score_start, window.score_end))
    main = fit_recalibrated(rows_with_signal, window, config)
    assert main.slope > 0
    scorers = {"base": main.base(), "main": main, "linear": fit_baseline(
        rows_with_signal.where(windows.within(None, window.train_end)), config)}
    measured = {}
    for name, scorer in scorers.items():
        scored = materialize(
            scorer.score(test).select("stay_key", F.col("is_long_stay").alias("y"), "p", F.lit(name).alias("m")), "s"
        )
        measured[name] = metrics.evaluate(metrics.rank_scores(scored, ["m"], "stay_key"), ["m"]).first()
    assert measured["main"]["roc_auc"] > 0.65 and measured["linear"]["roc_auc"] > 0.6
    # A positive slope keeps the ranking; the level follows the recent months.
    assert measured["main"]["roc_auc"] == pytest.approx(measured["base"]["roc_auc"], abs=1e-9)
    gap = {k: abs(m["mean_predicted"] - m["base_rate"]) for k, m in measured.items()}
    assert gap["main"] < gap["base"]


def test_rounds_stop_after_patience():
    assert stopping_round([3.0, 2.0, 1.0], 2) == (3, False)
    assert stopping_round([3.0, 1.0, 2.0, 2.0, 0.5], 2) == (2, True)
    assert stopping_round([3.0, 1.0, 2.0, 1.0, 0.5], 4) == (5, False)
    assert stopping_round([1.0], 25) == (1, False)


def test_boosting_goes_on_past_worse_rounds_and_ignores_the_layout(rows_with_signal):
    rows = rows_with_signal.where("stay_key >= '4'")
    held_out = rows_with_signal.where("stay_key < '4'")

    def loss(scorer):
        p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("p")))
        y = F.col("is_long_stay")
        return scorer.score(held_out).agg(-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).first()[0]

    # Single splits need many small steps to add up the effects of several columns.
    full, short = (fit_boosted(rows, ModelConfig(max_depth=1, max_iter=n)) for n in (400, 4))
    assert full.learner.getNumTrees > 4 >= short.learner.getNumTrees and loss(full) < loss(short)
    quick = ModelConfig(max_iter=6)
    a, b = (fit_boosted(rows.repartition(n), quick).score(held_out) for n in (1, 7))
    far = a.join(b.withColumnRenamed("p", "q").select("stay_key", "q"), "stay_key").where("abs(p - q) > 1e-9")
    assert far.count() == 0


def test_population_rules(spark, fact):
    horizon = features.horizon_of(fact)
    frame = features.training_frame(fact)
    assert frame.count() == fact.count()
    known = features.labelled(frame, horizon)
    assert known.where("is_open_stay and is_long_stay = 0").count() == 0
    assert known.where("intake_type in ('Wildlife', 'Euthanasia Request')").count() == 0
    nameless = features.eligible(fact.withColumn("intake_type", F.lit(None).cast("string")))
    assert nameless.count() == fact.where("animal_type in ('Dog', 'Cat')").count()


def test_backtest_windows(fact):
    calendar = windows.collect_windows(windows.backtest_calendar(features.horizon_frame(fact)))
    horizon = features.horizon_of(fact)
    assert len(calendar) == 12 and calendar[-1].score_end <= horizon.label_cutoff
    assert all((w.score_start - w.train_end).days == 30 for w in calendar)


def test_run_stores_tables_that_hold_their_promises(spark, fact, tmp_path, monkeypatch):
    built, warnings = publish_model(fact, str(tmp_path), QUICK)
    assert sorted(built) == sorted(MODEL_TABLES) and warnings == []
    late = built["monthly_performance"].withColumn("train_end", F.col("intake_month"))
    old = built["stay_scores"].withColumn("days_in_care", F.lit(30))
    damaged = model_assertions(built["model_evaluation"], late, old, fact).collect()
    assert sorted(r["failing_rows"] for r in damaged) == sorted([12, 0, built["stay_scores"].count()])
    assert built["feature_importance"].count() == 13 and built["calibration"].count() == 10
    assert built["monthly_performance"].count() == 12 and built["feature_drift"].count() == 60
    assert {r["model_version"] for r in built["stay_scores"].collect()} == {QUICK.version()}
    # Signal where none can be is a failure, and what was published stays.
    leaky = built | {"model_evaluation": built["model_evaluation"].withColumn("roc_auc", F.lit(0.9))}
    monkeypatch.setattr(pipeline, "run_model", lambda fact, config: leaky)
    with pytest.raises(training.LeakageError):
        publish_model(fact, str(tmp_path), QUICK, expect_no_signal=True)
    kept = read_published(spark, str(tmp_path), "model_evaluation")
    assert kept.where("roc_auc = 0.9").count() == 0 and kept.count() == 3


def test_no_signal_gate(spark):
    """Labels of the derived feed are random. On 1,400 held-out rows an honest AUC stays
    within a few hundredths of one half; on the 140 of the smallest tables it does not."""
    fact = stored_fact(spark, "/root/testdata/sf0.01")
    inputs = training.prepare(fact)
    (window,) = windows.collect_windows(windows.holdout_calendar(inputs.horizon_row))
    scorers = training.in_parallel(spark, training.holdout_fits(inputs, window, QUICK), QUICK)
    evaluation = training.evaluate_holdout(inputs, window, scorers, QUICK).evaluation
    assert training.no_signal_gate(evaluation) <= training.NO_SIGNAL_MAX_AUC
    for bad in (F.lit(0.9), F.lit(None).cast("double")):
        with pytest.raises(training.LeakageError):
            training.no_signal_gate(evaluation.withColumn("roc_auc", bad))


def test_nobody_waiting_gives_an_empty_table(spark, fact):
    horizon = features.horizon_of(fact)
    later = replace(horizon, label_cutoff=horizon.as_of.replace(year=horizon.as_of.year + 1))
    waiting = features.scoring_population(features.training_frame(fact), later)
    assert waiting.count() == 0 and "days_in_care" in waiting.columns
