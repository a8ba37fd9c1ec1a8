"""The monitored-model run: holdout, importance, backtest, current scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sojourn.functions.time import ntz
from sojourn.operators import metrics
from sojourn.plans import drift, features, windows
from sojourn.plans.encoding import FIT
from sojourn.plans.model import (
    ALL,
    EXCLUDING_SNR,
    LABEL_COLUMN,
    BoostedFits,
    ModelConfig,
    Scorer,
    Span,
    fit_baseline,
    fit_boosted,
    fit_recalibrated,
    fit_relabelled,
    fit_windows,
    risk_band,
    rows_of_fits,
    score_relabelled,
    with_sensitivity_slice,
)
from sojourn.plans.model_store import ModelStore
from sojourn.plans.staging import ENTITY, KEY
from sojourn.plans.windows import Window, within
from sojourn.sources.scratch import materialize
from sojourn.sources.tables import stamp

RECALIBRATED = "gradient_boosting_recalibrated"
# Fixed value: the highest AUC an honest model may reach on labels without signal.
NO_SIGNAL_MAX_AUC = 0.60
PERFORMANCE_COLUMNS = [
    "intake_month", "train_start", "train_end", "calibration_start", "train_rows",
    *metrics.METRICS,
    "calibration_gap", "max_feature_psi", "drifted_features", "status", "review_reasons",
]


class LeakageError(RuntimeError):
    """The model found signal where there is none."""


@dataclass(frozen=True)
class Inputs:
    """Stored feature rows and the moments everything is measured from."""

    fact: DataFrame
    labelled: DataFrame
    open_now: DataFrame
    horizon: features.Horizon
    horizon_row: DataFrame
    excluded_open: int


def prepare(fact: DataFrame) -> Inputs:
    """Features once, for every window; `fact` is a stored table."""
    horizon = features.horizon_of(fact)
    frame = features.training_frame(fact)
    known = features.derive(
        features.labelled(frame, horizon), KEY, "intake_at", "outcome_subtype", LABEL_COLUMN
    )
    waiting = features.derive(features.scoring_population(frame, horizon), KEY, ENTITY, "intake_at", "days_in_care")
    return Inputs(
        fact,
        materialize(known, "labelled-features"),
        materialize(waiting, "open-features"),
        horizon,
        features.horizon_frame(fact),
        features.excluded_implausible_open(fact, horizon),
    )


def _scores(scorer: Scorer, rows: DataFrame, **tags) -> DataFrame:
    scored = scorer.score(rows).select(
        KEY, "outcome_subtype", F.col(LABEL_COLUMN).alias("y"), "p", *[t.alias(n) for n, t in tags.items()]
    )
    return materialize(scored, "scores")


class Holdout:
    """The scored holdout of some models; order and metrics are made when they are asked for."""

    def __init__(self, inputs: Inputs, window: Window, scorers: dict[str, Scorer], config: ModelConfig):
        self.window, self.main = window, scorers[RECALIBRATED]
        self._inputs, self._config = inputs, config
        test = inputs.labelled.where(within(window.score_start, window.score_end))
        self._scored = {name: _scores(s, test, model=F.lit(name)) for name, s in scorers.items()}

    @cached_property
    def ranked(self) -> DataFrame:
        """The recalibrated model's rows with their places by score."""
        rows = self._scored[RECALIBRATED].withColumn("slice", F.lit(ALL))
        return materialize(metrics.rank_scores(rows, ["model", "slice"], KEY), "main-ranked")

    @cached_property
    def evaluation(self) -> DataFrame:
        """One row per model."""
        return _evaluation(self._inputs, self.window, self.main, reduce(DataFrame.unionByName, self._scored.values()), self._config)


def holdout_fits(inputs: Inputs, window: Window, config: ModelConfig) -> dict[str, Callable[[], Scorer]]:
    train = inputs.labelled.where(within(window.train_start, window.train_end))
    return {
        "logistic_baseline": lambda: fit_baseline(train, config),
        "gradient_boosting": lambda: fit_boosted(train, config),
        RECALIBRATED: lambda: fit_recalibrated(inputs.labelled, window, config),
    }


def evaluate_holdout(
    inputs: Inputs, window: Window, scorers: dict[str, Scorer], config: ModelConfig
) -> Holdout:
    """The three models side by side on the last year of settled labels."""
    return Holdout(inputs, window, scorers, config)


def _evaluation(inputs: Inputs, window: Window, main: Scorer, scored: DataFrame, config: ModelConfig) -> DataFrame:
    sliced = with_sensitivity_slice(scored).where((F.col("slice") == ALL) | (F.col("model") == RECALIBRATED))
    measured = materialize(metrics.measure(sliced, ["model", "slice"], KEY), "holdout-metrics")

    # Three rows and one, joined by model; no sensitivity numbers where a class is missing.
    partial = measured.where((F.col("slice") == EXCLUDING_SNR) & F.col("roc_auc").isNotNull()).select(
        "model",
        *[
            F.col(c).alias(f"{c}_excluding_snr")
            for c in ("n", "base_rate", "roc_auc", "top_decile_precision")
        ],
    )
    is_main = F.col("model") == RECALIBRATED
    return (
        measured.where(F.col("slice") == ALL)
        .select("model", *metrics.METRICS)
        .withColumns(
            {
                "calibration_start": F.when(is_main, ntz(window.calibration_start)),
                "calibration_slope": F.when(is_main, F.lit(main.slope)),
                "calibration_intercept": F.when(is_main, F.lit(main.intercept)),
            }
        )
        .join(F.broadcast(partial), "model", "left")
        .withColumns(
            {
                "model_version": F.lit(config.version()),
                "as_of": ntz(inputs.horizon.as_of),
                "train_start": ntz(window.train_start),
                "train_end": ntz(window.train_end),
                "holdout_start": ntz(window.score_start),
                "holdout_end": ntz(window.score_end),
                "long_stay_days": F.lit(features.LONG_STAY_DAYS).cast("long"),
                "excluded_implausible_open": F.lit(inputs.excluded_open).cast("long"),
            }
        )
    )


def in_parallel(spark: SparkSession, jobs: dict, config: ModelConfig) -> dict:
    """Independent fits from a few driver threads; each fit is itself a set of Spark jobs."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=config.concurrent_fits) as pool:
        return dict(zip(jobs, pool.map(lambda job: inherit(job)(), jobs.values())))


def importance_sample(test: DataFrame, config: ModelConfig) -> DataFrame:
    """The importance_rows rows of least md5 of seed and key (all if there are fewer), with their place
    in that order. The bound makes the one window over them small."""
    draw = F.md5(F.concat_ws(":", F.lit(str(config.seed)), F.col(KEY)).cast("binary"))
    drawn = test.withColumn("draw", draw).orderBy("draw", KEY).limit(config.importance_rows)
    stored = materialize(drawn, "importance-sample")
    return stored.withColumn("place", F.row_number().over(W.orderBy("draw", KEY))).drop("draw")


def importance_donors(sample: DataFrame, config: ModelConfig) -> DataFrame:
    """(repeat, place, donor): for every repeat, whose values the row at a place gets: the sample in another order."""
    repeats = F.explode(F.sequence(F.lit(1), F.lit(config.importance_repeats)))
    again = sample.select(F.col(KEY).alias("donor"), repeats.alias("repeat"))
    draw = F.md5(F.concat_ws(":", F.lit(str(config.seed)), F.col("repeat").cast("string"), F.col("donor")).cast("binary"))
    order = W.partitionBy("repeat").orderBy(draw, "donor")
    return again.withColumn("place", F.row_number().over(order))


def permutation_importance(holdout: Holdout, inputs: Inputs, config: ModelConfig) -> DataFrame:
    """AUC lost when one raw column is shuffled, over a sample of the holdout.

    The row at each place of the sample gets its value from the row that a second seeded order has
    there. All features and repeats are scored and ranked together: features x repeats + 1 copies of the sample.
    """
    window = holdout.window
    test = inputs.labelled.where(within(window.score_start, window.score_end))
    placed = materialize(importance_sample(test, config), "importance-rows")
    values = placed.select(F.col(KEY).alias("donor"), F.struct(*features.FEATURES).alias("given"))
    donors = importance_donors(placed, config).join(values, "donor").drop("donor")
    shuffled = (
        placed.join(donors, "place")
        .withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features.FEATURES])))
        .withColumns(
            {
                f: F.when(F.col("feature") == f, F.col(f"given.{f}")).otherwise(F.col(f))
                for f in features.FEATURES
            }
        )
        .drop("given")
    )
    intact = placed.withColumns({"repeat": F.lit(0), "feature": F.lit("")})
    # A few small partitions hold the sample; its copies are scored by as many tasks as there are cores.
    rows = intact.unionByName(shuffled).withColumnRenamed("feature", "shuffled_feature").repartition(
        2 * inputs.labelled.sparkSession.sparkContext.defaultParallelism, KEY, "shuffled_feature", "repeat"
    )
    scored = materialize(
        holdout.main.base()
        .score(rows)
        .select(KEY, F.col(LABEL_COLUMN).alias("y"), "p", F.col("shuffled_feature").alias("feature"), "repeat"),
        "importance-scores",
    )
    group = ["feature", "repeat"]
    aucs = materialize(
        metrics.measure(scored, group, KEY).select(*group, "roc_auc"),
        "importance-auc",
    )
    whole = aucs.where(F.col("feature") == "").first()["roc_auc"]
    drop = F.lit(whole) - F.col("roc_auc")
    return (
        aucs.where(F.col("feature") != "")
        .groupBy("feature")
        .agg(F.avg(drop).alias("auc_drop_mean"), F.stddev_pop(drop).alias("auc_drop_std"))
        .withColumn("rank", F.row_number().over(W.orderBy(F.desc("auc_drop_mean"), "feature")).cast("long"))
    )


def backtest_rows(labelled: DataFrame, calendar: list[Window]) -> DataFrame:
    """What each backtest month has to learn from and to score: train, calibration and test rows, training
    classes, and whether the month is usable (rows to score and both classes). One row per month.

    Every row is joined to the months whose windows hold it, by calendar month; nothing is counted per window.
    """
    names = {str(i): w for i, w in enumerate(calendar)}
    spans = {f"{i} train": (w.train_start, w.train_end) for i, w in names.items()}
    spans |= {f"{i} calibration": (w.calibration_start, w.train_end) for i, w in names.items()}
    spans |= {f"{i} test": (w.score_start, w.score_end) for i, w in names.items()}
    held = rows_of_fits(labelled.select("intake_at", LABEL_COLUMN), spans)
    parts = held.select(F.split(FIT, " ")[0].alias("at"), F.split(FIT, " ")[1].alias("part"), LABEL_COLUMN)
    counts = parts.groupBy("at").agg(
        *[F.count_if(F.col("part") == p).alias(f"{p}_rows") for p in ("train", "calibration", "test")],
        F.count_distinct(F.when(F.col("part") == "train", F.col(LABEL_COLUMN))).alias("classes"),
    )
    months = labelled.sparkSession.createDataFrame(
        [(i, w.score_start) for i, w in names.items()], "at string, intake_month timestamp_ntz"
    )
    zero = F.lit(0).cast("long")
    counted = ["train_rows", "calibration_rows", "test_rows", "classes"]
    return (
        months.join(counts, "at", "left")
        .select("intake_month", *[F.coalesce(c, zero).alias(c) for c in counted])
        .withColumn("usable", (F.col("test_rows") > 0) & (F.col("classes") == 2))
    )


def usable_months(inputs: Inputs, calendar: list[Window]) -> dict[Window, int]:
    """Training rows of each month that has rows to score and both classes to learn from."""
    rows = {r["intake_month"]: r for r in backtest_rows(inputs.labelled, calendar).collect()}
    return {w: rows[w.score_start]["train_rows"] for w in calendar if rows[w.score_start]["usable"]}


def backtest_fit(window: Window) -> str:
    return f"backtest {window.score_start:%Y-%m}"


def backtest_scores(inputs: Inputs, usable: dict[Window, int], fits: BoostedFits) -> DataFrame:
    """Rows of all usable months, each scored by the model staff would have had on the month's first day."""
    months = {backtest_fit(w): w for w in usable}
    rows = rows_of_fits(inputs.labelled, {f: (w.score_start, w.score_end) for f, w in months.items()})
    scored = fits.score(rows).select(KEY, F.col(LABEL_COLUMN).alias("y"), "p", F.trunc("intake_at", "month").cast("timestamp_ntz").alias("intake_month"))
    return materialize(scored, "backtest-scores")


def calendar_frame(spark: SparkSession, usable: dict[Window, int]) -> DataFrame:
    return spark.createDataFrame(
        [(w.score_start, w.score_end, w.train_start, w.calibration_start, w.train_end, n) for w, n in usable.items()],
        "score_start timestamp_ntz, score_end timestamp_ntz, train_start timestamp_ntz, "
        "calibration_start timestamp_ntz, train_end timestamp_ntz, train_rows long",
    )


def monthly_performance(calendar: DataFrame, month_scores: DataFrame | None, shifts: DataFrame) -> DataFrame:
    """All usable months, ranked and measured together."""
    spark = calendar.sparkSession
    if month_scores is not None:
        measured = metrics.measure(month_scores, ["intake_month"], KEY)
    else:
        measured = spark.createDataFrame(
            [], "intake_month timestamp_ntz, n long, " + ", ".join(f"{c} double" for c in metrics.METRICS[1:])
        )
    windows_by_month = calendar.withColumnRenamed("score_start", "intake_month").drop("score_end")
    return (
        drift.month_status(measured)
        .join(F.broadcast(drift.drift_summary(shifts)), "intake_month")
        .join(F.broadcast(windows_by_month), "intake_month")
        .select(*PERFORMANCE_COLUMNS)
    )


def score_open(holdout: Holdout, inputs: Inputs, final: Scorer) -> DataFrame:
    """Current open episodes by a model refitted up to the cutoff.

    Bands are cut at quantiles of the holdout's scores. Nobody waiting gives an empty table with the same columns.
    """
    high, elevated = metrics.score_quantiles(holdout.ranked, [0.9, 0.7])
    return final.score(inputs.open_now).select(
        KEY,
        ENTITY,
        "animal_type",
        "intake_at",
        "days_in_care",
        F.col("p").alias("long_stay_probability"),
        risk_band(F.col("p"), high, elevated).alias("risk_band"),
        ntz(inputs.horizon.as_of).alias("scored_as_of"),
    )


HOLDOUT, HOLDOUT_PLAIN, FINAL = "holdout", "holdout plain", "final"


class ModelRun:
    """The six model tables of a stored episode fact, each made when it is asked for from the fits it needs.

    Fits that are asked for together are grown together. With a `models` folder they are stored there under
    model version and window, and taken from there if they are: then nothing is fitted.
    """

    def __init__(self, fact: DataFrame, config: ModelConfig = ModelConfig(), models: str | None = None):
        self.config, self.spark = config, fact.sparkSession
        self.inputs = prepare(fact)
        (self.holdout_window,) = windows.collect_windows(windows.holdout_calendar(self.inputs.horizon_row))
        (self.final_window,) = windows.collect_windows(windows.final_calendar(self.inputs.horizon_row))
        self._store = ModelStore(self.spark, f"{models.rstrip('/')}/{config.version()}") if models else None
        self._made: dict[str, object] = {}

    def _once(self, name: str, make: Callable[[], object]):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    @property
    def usable(self) -> dict[Window, int]:
        calendar = windows.backtest_calendar(self.inputs.horizon_row)
        return self._once("usable", lambda: usable_months(self.inputs, windows.collect_windows(calendar)))

    def _windows(self, names: list[str]) -> tuple[dict[str, Window], dict[str, Span]]:
        """Fits by name: those that are recalibrated, and those on a whole span."""
        known = {HOLDOUT: self.holdout_window, FINAL: self.final_window}
        if any(n.startswith("backtest") for n in names):
            known |= {backtest_fit(w): w for w in self.usable}
        w = self.holdout_window
        plain = {HOLDOUT_PLAIN: (w.train_start, w.train_end)}
        return {n: known[n] for n in names if n in known}, {n: plain[n] for n in names if n in plain}

    def fits(self, *names: str) -> dict[str, BoostedFits]:
        """By name, what scores with that fit. Whatever is not there yet is fitted at once."""
        recalibrated_on, plain = self._windows(list(names))
        keys = {n: "; ".join(map(str, (n, w.train_start, w.calibration_start, w.train_end))) for n, w in recalibrated_on.items()}
        keys |= {n: "; ".join(map(str, (n, *span))) for n, span in plain.items()}
        if self._store:
            unknown = [n for n in names if f"fit {n}" not in self._made]
            for n, found in self._store.load({n: keys[n] for n in unknown}).items():
                self._made[f"fit {n}"] = found
        missing = [n for n in names if f"fit {n}" not in self._made]
        if missing:
            fresh = fit_windows(
                self.inputs.labelled, {n: recalibrated_on[n] for n in missing if n in recalibrated_on},
                {n: plain[n] for n in missing if n in plain}, self.config,
            )
            if self._store:
                self._store.save({n: keys[n] for n in missing}, fresh)
            self._made |= {f"fit {n}": fresh for n in missing}
        return {n: self._made[f"fit {n}"] for n in names}

    def _main(self) -> Scorer:
        return self.fits(HOLDOUT)[HOLDOUT].one(HOLDOUT)

    def _ranked(self) -> Holdout:
        """The recalibrated model's holdout rows by score, without the models it is compared with."""

        def make() -> Holdout:
            scorers = {RECALIBRATED: self._main()}
            return evaluate_holdout(self.inputs, self.holdout_window, scorers, self.config)

        return self._once("ranked", make)

    def _baseline(self) -> Scorer:
        train = self.inputs.labelled.where(within(self.holdout_window.train_start, self.holdout_window.train_end))
        return self._once("baseline", lambda: fit_baseline(train, self.config))

    def _evaluation(self) -> DataFrame:
        def make() -> Holdout:
            jobs = {
                "logistic_baseline": self._baseline,
                HOLDOUT_PLAIN: lambda: self.fits(HOLDOUT, HOLDOUT_PLAIN)[HOLDOUT_PLAIN].one(HOLDOUT_PLAIN),
            }
            done = in_parallel(self.spark, jobs, self.config)
            scorers = {"logistic_baseline": done["logistic_baseline"], "gradient_boosting": done[HOLDOUT_PLAIN], RECALIBRATED: self._main()}
            return evaluate_holdout(self.inputs, self.holdout_window, scorers, self.config)

        self._made["ranked"] = whole = self._once("evaluation", make)
        return whole.evaluation

    def _drift(self) -> DataFrame:
        return drift.feature_drift(self.inputs.labelled, calendar_frame(self.spark, self.usable))

    def _performance(self) -> DataFrame:
        names = [backtest_fit(w) for w in self.usable]
        scores = None
        if names:
            by_name = self.fits(*names)
            # Fits from a store and fresh ones come apart.
            parts = {id(f): (f, [w for w in self.usable if by_name[backtest_fit(w)] is f]) for f in by_name.values()}
            found = [backtest_scores(self.inputs, {w: self.usable[w] for w in those}, f) for f, those in parts.values()]
            scores = reduce(DataFrame.unionByName, found)
        return monthly_performance(calendar_frame(self.spark, self.usable), scores, self.table("feature_drift"))

    def _open(self) -> DataFrame:
        final = self.fits(FINAL, HOLDOUT)[FINAL].one(FINAL)
        return score_open(self._ranked(), self.inputs, final)

    def table(self, name: str) -> DataFrame:
        makers = {
            "model_evaluation": self._evaluation,
            "calibration": lambda: metrics.calibration_table(self._ranked().ranked),
            "feature_importance": lambda: permutation_importance(self._ranked(), self.inputs, self.config),
            "monthly_performance": self._performance,
            "feature_drift": self._drift,
            "stay_scores": self._open,
        }
        return self._once(f"table {name}", lambda: materialize(stamp(makers[name](), self.config.version()), name))

    def tables(self) -> dict[str, DataFrame]:
        """All six; their fits are grown together, the baseline beside them."""
        fits = [HOLDOUT, HOLDOUT_PLAIN, FINAL, *[backtest_fit(w) for w in self.usable]]
        in_parallel(self.spark, {"boosted": lambda: self.fits(*fits), "baseline": self._baseline}, self.config)
        names = ["model_evaluation", "calibration", "feature_importance", "monthly_performance", "feature_drift", "stay_scores"]
        return {name: self.table(name) for name in names}


def run_model(fact: DataFrame, config: ModelConfig = ModelConfig(), models: str | None = None) -> dict[str, DataFrame]:
    """The six model tables, each stored, from a stored episode fact."""
    return ModelRun(fact, config, models).tables()


def dealt_labels(labelled: DataFrame, seeds: Sequence[int]) -> list[Column]:
    """For every seed the labels dealt anew: as many rows as have the label get it, those that come first in a seeded order
    of the keys, which are unique.

    Nothing is sorted: rows are counted by the upper bits of their draw, and only the bucket in which the last of
    the labels falls is put in order.
    """
    draws = [F.xxhash64(F.col(KEY), F.lit(seed)) for seed in seeds]
    ones = labelled.agg(F.sum(F.col(LABEL_COLUMN).cast("long")).alias("ones")).first()["ones"] or 0
    if not ones:
        return [F.lit(0) for _ in seeds]
    drawn = labelled.select(KEY, F.posexplode(F.array(*draws)).alias("deal", "draw")).withColumn("bucket", F.shiftright("draw", 48))
    counts = drawn.groupBy("deal", "bucket").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.partitionBy("deal").orderBy("bucket"))
    edges = counts.withColumn("before", upto - F.col("n")).where((F.col("before") < ones) & (F.col("before") + F.col("n") >= ones))
    found = {r["deal"]: r for r in edges.collect()}
    at_edge = reduce(Column.__or__, [(F.col("deal") == d) & (F.col("bucket") == r["bucket"]) for d, r in found.items()])
    place = F.row_number().over(W.partitionBy("deal").orderBy("draw", KEY))
    last = reduce(Column.__or__, [(F.col("deal") == d) & (F.col("place") == ones - r["before"]) for d, r in found.items()])
    cuts = {r["deal"]: r for r in drawn.where(at_edge).withColumn("place", place).where(last).collect()}
    return [
        ((draw < cuts[k]["draw"]) | ((draw == cuts[k]["draw"]) & (F.col(KEY) <= cuts[k][KEY]))).cast("int")
        for k, draw in enumerate(draws)
    ]


def shuffled_labels(labelled: DataFrame, seed: int) -> DataFrame:
    """The rows with labels dealt anew."""
    return labelled.withColumn(LABEL_COLUMN, dealt_labels(labelled, [seed])[0])


def holdout_auc(inputs: Inputs, window: Window, config: ModelConfig) -> DataFrame:
    """One row per model with the AUC of the recalibrated model alone: what the gate looks at."""
    fits = fit_windows(inputs.labelled, {HOLDOUT: window}, {}, config)
    return evaluate_holdout(inputs, window, {RECALIBRATED: fits.one(HOLDOUT)}, config).evaluation


def no_signal_run(inputs: Inputs, config: ModelConfig = ModelConfig(), deals: int = 8) -> float:
    """The gate on labels that were dealt anew: the mean AUC over some deals, so that a small holdout does not decide
    by chance. All deals are fitted together, and differ in nothing but their labels, so rows are neither copied nor shuffled
    for a deal, and are scored once by all models. Recalibration keeps the order of scores, so the gate needs none.

    Returns the AUC; raises if the model finds signal.
    """
    (window,) = windows.collect_windows(windows.holdout_calendar(inputs.horizon_row))
    names = [f"deal {k}" for k in range(deals)]
    dealt = dict(zip(names, dealt_labels(inputs.labelled, [config.seed + k for k in range(deals)]), strict=True))
    fits = fit_relabelled(inputs.labelled.where(within(window.train_start, window.calibration_start)), dealt, config)
    test = inputs.labelled.where(within(window.score_start, window.score_end))
    measured = metrics.measure(score_relabelled(fits, test, dealt), [FIT], KEY)
    return no_signal_gate(measured.agg(F.avg("roc_auc").alias("roc_auc")).withColumn("model", F.lit(RECALIBRATED)))


def no_signal_gate(evaluation: DataFrame, limit: float = NO_SIGNAL_MAX_AUC) -> float:
    """For data whose labels are random: raise if the holdout AUC is missing or too good."""
    row = evaluation.where(F.col("model") == RECALIBRATED).select("roc_auc").first()
    auc = row["roc_auc"] if row else None
    if auc is None or auc > limit:
        raise LeakageError(f"holdout AUC {auc} on data without signal, limit {limit}")
    return auc
