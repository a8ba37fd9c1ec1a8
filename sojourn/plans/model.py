"""Long-stay models: baseline, boosted trees, recalibration, scoring."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass
from datetime import datetime
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.numbers import logit, recalibrated, sigmoid
from sojourn.functions.time import ntz
from sojourn.operators import boosting
from sojourn.operators.boosting import Boosted, BoostSettings, stopping_round  # noqa: F401 - the rule is part of the model
from sojourn.plans.encoding import FIT, MAX_BINS, MAX_CATEGORIES, VECTOR, LinearEncoder, TreeEncoder
from sojourn.plans.features import CATEGORICAL, FEATURES, LONG_STAY_DAYS, NUMERIC
from sojourn.plans.staging import KEY
from sojourn.plans.windows import TRAIN_YEARS, Window
from sojourn.sources.scratch import materialize
from sojourn.sources.tables import model_version

LABEL_COLUMN = "is_long_stay"
ALL, EXCLUDING_SNR = "all", "excluding_snr"
# Fixed value: the transfer programme whose animals leave within days by design.
SNR = "Snr"
SHIFT_BOUND = 20.0


@dataclass(frozen=True)
class ModelConfig:
    """Learner settings."""

    max_iter: int = 400
    step_size: float = 0.05
    max_leaves: int = 31
    max_depth: int | None = None
    min_rows_per_node: int = 40
    leaf_l2: float = 1.0
    validation_share: int = 10
    logistic_iter: int = 2000
    logistic_c: float = 0.5
    calibration_c: float = 100.0
    importance_rows: int = 15_000
    importance_repeats: int = 5
    patience: int = 25
    concurrent_fits: int = 6
    rows_in_task: int = 1_000_000
    seed: int = 20261005

    def version(self) -> str:
        """Changes with whatever can change a score. How rows and fits are spread cannot."""
        settings = {k: v for k, v in asdict(self).items() if k not in ("concurrent_fits", "rows_in_task")} | {
            "features": FEATURES,
            "long_stay_days": LONG_STAY_DAYS,
            "train_years": TRAIN_YEARS,
            "max_categories": MAX_CATEGORIES,
            "max_bins": MAX_BINS,
        }
        return model_version(settings)

    def boosting(self) -> BoostSettings:
        return BoostSettings(
            rounds=self.max_iter, step=self.step_size, leaves=self.max_leaves, depth=self.max_depth,
            least_rows=self.min_rows_per_node, l2=self.leaf_l2, patience=self.patience,
            nominal=tuple(range(len(CATEGORICAL))), rows_in_task=self.rows_in_task,
        )


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col(LABEL_COLUMN).cast("double"))


def _halves() -> tuple[Column, Column]:
    """Codes, and numbers with their flags. Because the vector is used twice, Spark makes it before rows go to Python;
    used once it would be made on the way, and rows would wait there with the codes' maps of their fit."""
    return F.slice(VECTOR, 1, len(CATEGORICAL)), F.slice(VECTOR, len(CATEGORICAL) + 1, 2 * len(NUMERIC))


def _inputs(codes: pa.Array, numbers: pa.Array) -> np.ndarray:
    """The vectors of a batch from their halves."""
    return np.hstack([x.flatten().to_numpy().reshape(len(x), w) for x, w in ((codes, len(CATEGORICAL)), (numbers, 2 * len(NUMERIC)))])


@dataclass(frozen=True)
class BoostedFits:
    """Boosted models by the name of their fit, their common encoder, and corrections on the log-odds."""

    encoder: TreeEncoder
    models: Mapping[str, Boosted]
    corrections: Mapping[str, tuple[float, float]]

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds p to rows that name their fit. Write the result before ranking it."""
        encoder, models = self.encoder.detached(), dict(self.models)

        @F.arrow_udf("double")
        def margin(fits: pa.Array, codes: pa.Array, numbers: pa.Array) -> pa.Array:
            bins = encoder.bins(fits, _inputs(codes, numbers))
            out = np.zeros(len(fits))
            for f, at in boosting.places_of(fits):
                out[at] = models[f].margins(np.asfortranarray(bins[at]))
            return pa.array(out, pa.float64())

        p = sigmoid(margin(F.col(FIT), *_halves()))
        encoded = self.encoder.transform(rows)
        # A batch of many fits would ask every tree for few rows.
        scored = (encoded.sortWithinPartitions(FIT) if len(models) > 1 else encoded).withColumn("p", p)
        if self.corrections:
            # A handful of fits.
            chosen = F.col("p")
            for f, (slope, intercept) in self.corrections.items():
                chosen = F.when(F.col(FIT) == f, recalibrated(F.col("p"), slope, intercept)).otherwise(chosen)
            scored = scored.withColumn("p", chosen)
        return scored.select(*rows.columns, "p")

    def score_each(self, rows: DataFrame) -> DataFrame:
        """Adds ps, uncorrected probabilities by fit, in their order, to rows that are encoded once: for fits that share
        an encoder. Write the result before ranking it."""
        encoder, models = self.encoder.detached(), dict(self.models)
        first = next(iter(models))

        @F.arrow_udf("array<double>")
        def margins(codes: pa.Array, numbers: pa.Array) -> pa.Array:
            bins = np.asfortranarray(encoder.bins([first] * len(codes), _inputs(codes, numbers)))
            each = np.stack([m.margins(bins) for m in models.values()], axis=1)
            return pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * len(models), each.ravel())

        encoded = self.encoder.transform(rows.withColumn(FIT, F.lit(first)))
        return encoded.withColumn("ps", F.transform(margins(*_halves()), sigmoid)).select(*rows.columns, "ps")

    def log_odds(self, binned: DataFrame) -> DataFrame:
        """Adds z, the uncorrected log-odds, to rows that name their fit and have their bins."""
        models = dict(self.models)

        @F.arrow_udf("double")
        def margin(fits: pa.Array, packed: pa.Array) -> pa.Array:
            bins = boosting.bins_of(packed, len(CATEGORICAL) + len(NUMERIC))
            out = np.zeros(len(fits))
            for f, at in boosting.places_of(fits):
                out[at] = models[f].margins(np.asfortranarray(bins[at]))
            return pa.array(out, pa.float64())

        return binned.sortWithinPartitions(FIT).withColumn("z", logit(sigmoid(margin(F.col(FIT), F.col("bins")))))

    def one(self, fit: str) -> Scorer:
        slope, intercept = self.corrections.get(fit, (None, None))
        return Scorer(self.encoder, self.models[fit], slope, intercept, fit)

    def base(self) -> BoostedFits:
        return BoostedFits(self.encoder, self.models, {})


@dataclass(frozen=True)
class Linear:
    """A weight for every place of the linear encoder's vector."""

    weights: list[float]
    intercept: float


@dataclass(frozen=True)
class Scorer:
    """An encoder, a fitted learner and an optional correction on the log-odds."""

    encoder: TreeEncoder | LinearEncoder
    learner: object
    slope: float | None = None
    intercept: float | None = None
    fit: str = ""

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds p, the probability of a long stay. Write the result before ranking it."""
        if isinstance(self.learner, Boosted):
            corrections = {} if self.slope is None else {self.fit: (self.slope, self.intercept)}
            fits = BoostedFits(self.encoder, {self.fit: self.learner}, corrections)
            return fits.score(rows.withColumn(FIT, F.lit(self.fit))).select(*rows.columns, "p")
        weighted = F.zip_with(vector_to_array(VECTOR), F.array(*map(F.lit, self.learner.weights)), lambda x, w: x * w)
        margin = F.aggregate(weighted, F.lit(self.learner.intercept), lambda a, x: a + x)
        return self.encoder.transform(rows).select(*rows.columns, sigmoid(margin).alias("p"))

    def base(self) -> Scorer:
        return Scorer(self.encoder, self.learner, fit=self.fit)


def counted(train: DataFrame) -> DataFrame:
    """Rows with equal features and label as one, with their number n."""
    return train.groupBy(*FEATURES, LABEL_COLUMN).agg(F.count(F.lit(1)).cast("double").alias("n"))


def fit_baseline(train: DataFrame, config: ModelConfig) -> Scorer:
    """Ridge logistic regression; the penalty is per row, hence the count. Equal rows are one weighted row."""
    encoder = LinearEncoder.fit(train)
    rows = train.count()
    learner = LogisticRegression(
        featuresCol=VECTOR,
        weightCol="n",
        regParam=1.0 / (config.logistic_c * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=config.logistic_iter,
        tol=1e-14,
    )
    different = materialize(_labelled(counted(train)), "baseline-rows")
    fitted = learner.fit(encoder.transform(different).select(VECTOR, "label", "n"))
    return Scorer(encoder, Linear([float(w) for w in fitted.coefficients], float(fitted.intercept)))


def baseline_optimality(scorer: Scorer, train: DataFrame, config: ModelConfig) -> DataFrame:
    """(slot, observed, fitted): sums of every input over labels, and over fitted probabilities with the
    penalty's share. The two are equal where the penalised log-loss is least, and only there.
    """
    weights = [
        (slot, w / config.logistic_c)
        for slot, w in zip(scorer.encoder.slots(), scorer.learner.weights, strict=True)
        if slot is not None
    ]
    scored = materialize(scorer.score(counted(train)), "baseline-scores")
    inputs = scorer.encoder.long(scored, LABEL_COLUMN, "p", "n").unionAll(
        scored.select(LABEL_COLUMN, "p", "n", F.lit("intercept").alias("slot"), F.lit(1.0).alias("value"))
    )
    value = F.col("value") * F.col("n")
    sums = inputs.groupBy("slot").agg(
        F.sum(value * F.col(LABEL_COLUMN)).alias("observed"), F.sum(value * F.col("p")).alias("fitted")
    )
    # One row per slot, of which there are at most MAX_CATEGORIES per column.
    known = train.sparkSession.createDataFrame(weights, "slot string, share double")
    return sums.join(F.broadcast(known), "slot", "left").select(
        "slot", "observed", (F.col("fitted") + F.coalesce("share", F.lit(0.0))).alias("fitted")
    )


Span = tuple[datetime, datetime]


def rows_of_fits(rows: DataFrame, spans: Mapping[str, Span]) -> DataFrame:
    """Every row once for each fit whose half-open span holds its intake_at, with the fit's name.

    An equi-join on the month with one row for each month a span touches.
    """
    months = []
    for fit, (start, end) in spans.items():
        first, last = start.year * 12 + start.month, end.year * 12 + end.month
        months += [(fit, m, start, end) for m in range(first, last + 1)]
    spark = rows.sparkSession
    touched = spark.createDataFrame(months, f"{FIT} string, month_number int, span_start timestamp_ntz, span_end timestamp_ntz")
    month_number = F.year("intake_at") * 12 + F.month("intake_at")
    return (
        rows.withColumn("month_number", month_number)
        .join(F.broadcast(touched), "month_number")
        .where((F.col("intake_at") >= F.col("span_start")) & (F.col("intake_at") < F.col("span_end")))
        .drop("month_number", "span_start", "span_end")
    )


def different_rows(rows: DataFrame, spans: Mapping[str, Span], *more: str) -> DataFrame:
    """What rows_of_fits gives, but rows that are equal in features, label and `more` as one with their number n.

    They are counted once for all fits, by the time between two neighbouring ends of spans, before they come once for each fit.
    """
    counts, held = counted_periods(rows, spans, *more)
    return counts.join(F.broadcast(held), "period").drop("period")


def counted_periods(rows: DataFrame, spans: Mapping[str, Span], *more: str) -> tuple[DataFrame, DataFrame]:
    """Rows by the time between two neighbouring ends of spans, those of a period that are equal in features, label and `more` as
    one with their number n; and (period, fit), which periods a fit's span holds. Others have no rows."""
    ends = sorted({t for span in spans.values() for t in span})
    period = reduce(Column.__add__, [(F.col("intake_at") >= ntz(t)).cast("int") for t in ends], F.lit(0))
    counts = rows.groupBy(period.alias("period"), LABEL_COLUMN, *more, *FEATURES).agg(F.count(F.lit(1)).alias("n"))
    held = [
        (k, fit)
        for k, (low, high) in enumerate(zip(ends, ends[1:], strict=False), 1)
        for fit, (start, end) in spans.items()
        if start <= low and high <= end
    ]
    # A handful of fits and twice as many ends at most.
    names = rows.sparkSession.createDataFrame(held, f"period int, {FIT} string")
    return counts.where(F.col("period").isin(sorted({k for k, _ in held}))), names


def fit_all_boosted(rows: DataFrame, fits: Iterable[str], config: ModelConfig) -> BoostedFits:
    """One model for each fit that rows name; all are encoded and grown together.

    A tenth of a fit's rows is held back by a hash of the key and tells when to stop.
    """
    encoder = TreeEncoder.fit_all(rows, fits)
    binned = _binned(encoder, rows.withColumn("held_back", _held_back(config)))
    return _grown(encoder, binned.withColumn("y", F.col(LABEL_COLUMN).cast("double")).select(FIT, "y", "held_back", "bins"), fits, config)


def fit_relabelled(rows: DataFrame, labels: Mapping[str, Column], config: ModelConfig) -> BoostedFits:
    """One model for each label (0 or 1) that the rows can have. What the models see is encoded and counted once."""
    marks = {f"_label{k}": label for k, label in enumerate(labels.values())}
    encoder = TreeEncoder.fit(rows)
    binned = _binned(encoder, rows.withColumns({FIT: F.lit(""), "held_back": _held_back(config), **marks}))
    counts = binned.groupBy("held_back", "bins").agg(F.count(F.lit(1)).alias("all"), *[F.sum(F.col(m).cast("long")).alias(m) for m in marks])
    sides = [
        F.struct(F.lit(f).alias(FIT), F.lit(y).alias("y"), (F.col(m) if y else F.col("all") - F.col(m)).alias("n"))
        for f, m in zip(labels, marks, strict=True)
        for y in (0.0, 1.0)
    ]
    weighted = counts.select("held_back", "bins", F.inline(F.array(*sides))).where("n > 0")
    return _grown(encoder.shared(list(labels)), weighted, labels, config)


def score_relabelled(fits: BoostedFits, rows: DataFrame, labels: Mapping[str, Column]) -> DataFrame:
    """(fit, key, y, p) of rows for each label and the model fitted to it. Rows are scored and stored once for all."""
    # The order of models and labels is one.
    named = BoostedFits(fits.encoder, {f: fits.models[f] for f in labels}, {})
    scored = named.score_each(rows.withColumn("ys", F.array(*labels.values()))).select(KEY, "ys", "ps")
    stored = materialize(scored, "relabelled-scores")
    each = F.inline(F.arrays_zip(F.array(*[F.lit(f) for f in labels]).alias(FIT), F.col("ys").alias("y"), F.col("ps").alias("p")))
    return stored.select(KEY, each.alias(FIT, "y", "p")).select(FIT, KEY, "y", "p")


def _held_back(config: ModelConfig) -> Column:
    return F.pmod(F.xxhash64(F.col(KEY), F.lit(config.seed)), F.lit(config.validation_share)) == 0


def _binned(encoder: TreeEncoder, rows: DataFrame) -> DataFrame:
    """Rows that name their fit, with their bins."""
    detached = encoder.detached()

    @F.arrow_udf("binary")
    def bins(names: pa.Array, codes: pa.Array, numbers: pa.Array) -> pa.Array:
        return boosting.packed_rows(detached.bins(names, _inputs(codes, numbers)))

    return encoder.transform(rows).withColumn("bins", bins(F.col(FIT), *_halves()))


def _grown(encoder: TreeEncoder, binned: DataFrame, fits: Iterable[str], config: ModelConfig) -> BoostedFits:
    grown = boosting.grow_models(binned, len(CATEGORICAL) + len(NUMERIC), config.boosting(), config.concurrent_fits)
    missing = {f: Boosted(math.log(1e-6), []) for f in fits if f not in grown}
    return BoostedFits(encoder, grown | missing, {})


def fit_boosted(train: DataFrame, config: ModelConfig) -> Scorer:
    """Boosted trees up to the round of least loss on a held-back tenth of the rows."""
    return fit_all_boosted(train.withColumn(FIT, F.lit("")), [""], config).one("")


def level_shift(log_odds: DataFrame, tolerance: float = 1e-10, max_steps: int = 100) -> float:
    """b such that mean(sigmoid(z + b)) equals mean(y), for a stored (z, y) table."""
    return level_shifts(log_odds.withColumn(FIT, F.lit("")), [""], tolerance, max_steps)[""]


def level_shifts(
    log_odds: DataFrame, fits: Iterable[str], tolerance: float = 1e-10, max_steps: int = 100
) -> dict[str, float]:
    """By fit, b such that mean(sigmoid(z + b)) equals mean(y), for a stored (fit, z, y) table, or one that says in n how many
    rows each stands for.

    Newton steps kept inside a shrinking bracket; each is one aggregate over the table for all fits.
    """
    bounds, shifts, open_ = {f: (-SHIFT_BOUND, SHIFT_BOUND) for f in fits}, dict.fromkeys(fits, 0.0), set(fits)
    n = _number(log_odds)
    for _ in range(max_steps):
        if not open_:
            break
        here = log_odds.sparkSession.createDataFrame([(f, shifts[f]) for f in open_], f"{FIT} string, shift double")
        s = sigmoid(F.col("z") + F.col("shift"))
        sums = log_odds.join(F.broadcast(here), FIT).groupBy(FIT).agg(
            (F.sum(n * (s - F.col("y"))) / F.sum(n)).alias("gap"), (F.sum(n * s * (F.lit(1.0) - s)) / F.sum(n)).alias("slope")
        )
        rows = {r[FIT]: r for r in sums.collect()}
        for f in list(open_):
            if f not in rows:
                open_.remove(f)
                continue
            gap, slope = rows[f]["gap"], rows[f]["slope"]
            low, high = bounds[f]
            low, high = (low, shifts[f]) if gap > 0 else (shifts[f], high)
            newton = shifts[f] - gap / slope if slope else low - 1.0
            following = newton if low < newton < high else (low + high) / 2.0
            if abs(following - shifts[f]) < tolerance:
                open_.remove(f)
            bounds[f], shifts[f] = (low, high), following
    return shifts


def platt(log_odds: DataFrame, c: float, tolerance: float = 1e-10, max_steps: int = 100) -> dict[str, tuple[float, float]]:
    """By fit, (slope, intercept) of the least ridge-penalised log-loss over a stored (fit, z, y) table, or one that
    says in n how many rows each stands for.

    The penalty is slope^2 / (2 c) against the sum over rows. Newton steps from zero, halved where the loss does not
    fall; a step is one aggregate of six sums for all fits. One class only gives the identity, and so does no
    row; a slope that is not positive gives slope one and the level that matches the mean.
    """
    spread = log_odds.groupBy(FIT).agg(F.min("y").alias("least"), F.max("y").alias("most")).collect()
    at = {r[FIT]: (0.0, 0.0) for r in spread if r["least"] != r["most"]}
    found, best = {r[FIT]: (1.0, 0.0) for r in spread}, {}
    for _ in range(max_steps):
        if not at:
            break
        sums = {r[FIT]: r for r in _newton_sums(log_odds, at).collect()}
        for fit, (slope, intercept) in list(at.items()):
            r = sums[fit]
            loss = r["loss"] + slope * slope / (2 * c)
            if fit in best and loss > best[fit][0] + 1e-12 * abs(best[fit][0]):
                kept = best[fit][1]
                at[fit] = tuple((x + k) / 2 for x, k in zip((slope, intercept), kept, strict=True))
                moved = max(abs(x - k) for x, k in zip(at[fit], kept, strict=True))
                if moved < tolerance:
                    found[fit] = kept
                    del at[fit]
                continue
            best[fit] = (loss, (slope, intercept))
            g1, g0 = r["gz"] + slope / c, r["g"]
            h11, h01, h00 = r["wzz"] + 1 / c, r["wz"], r["w"]
            det = h11 * h00 - h01 * h01
            if det <= 0:
                found[fit] = (slope, intercept)
                del at[fit]
                continue
            d1, d0 = (h00 * g1 - h01 * g0) / det, (h11 * g0 - h01 * g1) / det
            at[fit] = (slope - d1, intercept - d0)
            if max(abs(d1), abs(d0)) < tolerance:
                found[fit] = at.pop(fit)
    found |= at
    # Scores that do not rise with the label: keep their order, match the mean.
    falling = [fit for fit, (slope, _) in found.items() if slope <= 0]
    return found | {fit: (1.0, b) for fit, b in level_shifts(log_odds, falling).items()}


def _number(log_odds: DataFrame) -> Column:
    return F.col("n").cast("double") if "n" in log_odds.columns else F.lit(1.0)


def _newton_sums(log_odds: DataFrame, at: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Loss, gradient and curvature of every fit at its (slope, intercept)."""
    here = log_odds.sparkSession.createDataFrame([(f, *x) for f, x in at.items()], f"{FIT} string, slope double, intercept double")
    margin = F.col("slope") * F.col("z") + F.col("intercept")
    rows = log_odds.join(F.broadcast(here), FIT).withColumn("margin", margin).withColumn("s", sigmoid(F.col("margin")))
    w, gap = F.col("s") * (F.lit(1.0) - F.col("s")), F.col("s") - F.col("y")
    # log(1 + e^m) - y m, without overflow.
    loss = F.greatest(F.col("margin"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("margin"))) - F.col("y") * F.col("margin")
    n = _number(log_odds)
    return rows.groupBy(FIT).agg(
        F.sum(n * loss).alias("loss"), F.sum(n * gap).alias("g"), F.sum(n * gap * F.col("z")).alias("gz"),
        F.sum(n * w).alias("w"), F.sum(n * w * F.col("z")).alias("wz"), F.sum(n * w * F.col("z") * F.col("z")).alias("wzz"),
    )


def recalibrate(fits: BoostedFits, features: DataFrame, recent: Mapping[str, Span], config: ModelConfig) -> BoostedFits:
    """Corrections from labelled rows of each fit's recent span; other fits have none."""
    binned = _binned(fits.encoder, different_rows(features, recent))
    counts = binned.groupBy(FIT, LABEL_COLUMN, "bins").agg(F.sum("n").alias("n"))
    log_odds = materialize(
        fits.log_odds(counts).select(FIT, "z", F.col(LABEL_COLUMN).cast("double").alias("y"), "n"), "log-odds"
    )
    identity = dict.fromkeys(recent, (1.0, 0.0))
    return BoostedFits(fits.encoder, fits.models, identity | platt(log_odds, config.calibration_c))


def fit_windows(
    features: DataFrame, recalibrated_on: Mapping[str, Window], plain: Mapping[str, Span], config: ModelConfig
) -> BoostedFits:
    """All fits at once. Those on windows learn from before calibration_start, are corrected on the rest
    and see nothing after it; the plain ones learn from their whole span."""
    spans = dict(plain) | {f: (w.train_start, w.calibration_start) for f, w in recalibrated_on.items()}
    counts, held = counted_periods(features.withColumn("held_back", _held_back(config)), spans, "held_back")
    # Read by the encoder, twice, and by the bins.
    stored = materialize(counts, "different-rows")
    encoder = TreeEncoder.fit_periods(stored, held, list(spans))
    binned = _binned(encoder, stored.join(F.broadcast(held), "period").drop("period"))
    counts = binned.groupBy(FIT, F.col(LABEL_COLUMN).cast("double").alias("y"), "held_back", "bins").agg(F.sum("n").alias("n"))
    fits = _grown(encoder, counts, list(spans), config)
    if not recalibrated_on:
        return fits
    return recalibrate(fits, features, {f: (w.calibration_start, w.train_end) for f, w in recalibrated_on.items()}, config)


def fit_recalibrated(features: DataFrame, window: Window, config: ModelConfig) -> Scorer:
    """Fit on the window before calibration_start, correct on the rest, see nothing after it."""
    return fit_windows(features, {"": window}, {}, config).one("")


def with_sensitivity_slice(scored: DataFrame) -> DataFrame:
    """Every row in slice 'all', and again in 'excluding_snr' unless it left by that programme."""
    outside = F.coalesce(F.col("outcome_subtype"), F.lit("")) != SNR
    slices = F.when(outside, F.array(F.lit(ALL), F.lit(EXCLUDING_SNR))).otherwise(F.array(F.lit(ALL)))
    return scored.withColumn("slice", F.explode(slices))


def risk_band(p: Column, high: float, elevated: float) -> Column:
    return F.when(p >= high, "High").when(p >= elevated, "Elevated").otherwise("Typical")
