"""Feature encoding, fitted on one training window and applied to any rows."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sojourn.operators import boosting
from sojourn.operators.categories import INFREQUENT, category_counts, frequent_categories
from sojourn.operators.joins import broadcast_if_small
from sojourn.operators.quantiles import percentile_of, with_ranks
from sojourn.plans.features import CATEGORICAL, NUMERIC
from sojourn.sources.scratch import materialize

# Categories per column, the infrequent bucket included; bins of a number; the code of a category
# that training did not have.
MAX_CATEGORIES, MAX_BINS, UNKNOWN = 40, 255, -1
# What stands in a vector where there is no number.
MISSING = -1.0
VECTOR, FIT = "inputs", boosting.FITS


@dataclass(frozen=True)
class Categories:
    """Categories each column keeps; at most MAX_CATEGORIES names per column."""

    kept: dict[str, list[str]]
    bucketed: frozenset[str]

    @classmethod
    def fit(cls, train: DataFrame) -> Categories:
        rows = frequent_categories(category_counts(train, CATEGORICAL), MAX_CATEGORIES).collect()
        kept = {c: sorted(r["category"] for r in rows if r["feature"] == c) for c in CATEGORICAL}
        return cls(kept, frozenset(r["feature"] for r in rows if r["has_infrequent"]))

    def _grouped(self, column: str) -> Column:
        value = F.col(column)
        if column not in self.bucketed:
            return value
        return F.when(value.isin(self.kept[column]), value).otherwise(INFREQUENT)

    def labels(self, column: str) -> list[str]:
        return self.kept[column] + ([INFREQUENT] if column in self.bucketed else [])

    def index(self, df: DataFrame) -> DataFrame:
        """Adds one index column per category column, typed as nominal for the tree learner.

        A category first seen after training joins the infrequent bucket where the column has
        one; elsewhere it gets the index past the last, which no training row carries.
        """
        indexed = df.withColumns({f"{c}_grouped": self._grouped(c) for c in CATEGORICAL})
        for c in CATEGORICAL:
            labels = self.labels(c)
            # One model per column: the many-column constructor pads short label lists.
            indexed = StringIndexerModel.from_labels(
                labels, inputCol=f"{c}_grouped", outputCol=f"{c}_index", handleInvalid="keep"
            ).transform(indexed)
        return indexed.drop(*[f"{c}_grouped" for c in CATEGORICAL])


@dataclass(frozen=True)
class Numbers:
    """What one training window says about one number."""

    rows: int
    gaps: int
    median: float
    mean: float
    sd: float
    edges: list[float]


def number_counts(rows: DataFrame, group: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """(*group, feature, value, n): how many rows have a number, or no number; `n` names the column that says how many rows each is."""
    inputs = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in NUMERIC]))
    number = F.count(F.lit(1)) if n is None else F.sum(n)
    return rows.select(*group, *([n] if n else []), inputs).groupBy(*group, "feature", "value").agg(number.alias("n"))


def number_summaries(rows: DataFrame, group: Sequence[str] = ()) -> dict[tuple, Numbers]:
    """By (*group, number): rows, missing rows, median, mean and deviation with the median in the gaps, and the upper
    edges of at most MAX_BINS bins of about equal size. Read off the distinct values, which are counted first."""
    return summaries_of(number_counts(rows, group), group)


def summaries_of(counts: DataFrame, group: Sequence[str] = ()) -> dict[tuple, Numbers]:
    """What number_summaries gives, from number_counts."""
    by = [*group, "feature"]
    counted = materialize(counts, "number-counts")
    ranked = with_ranks(counted.where("value is not null"), by, "value")
    members = W.partitionBy(*by)
    place = F.row_number().over(members.orderBy("value"))
    by_rank = F.floor((F.col("_upto") - 1) * MAX_BINS / F.col("_total"))
    few = F.count(F.lit(1)).over(members) <= MAX_BINS
    binned = ranked.withColumn("bin", F.when(few, place).otherwise(by_rank)).groupBy(*by, "bin").agg(F.max("value").alias("edge"))
    edges = binned.groupBy(*by).agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    medians = ranked.groupBy(*by).agg(percentile_of("value", 0.5).alias("median"))
    known = medians.join(edges, by)
    filled = counted.join(F.broadcast(medians), by, "left").withColumn("shift", F.coalesce(F.col("value") - F.col("median"), F.lit(0.0)))
    moments = filled.groupBy(*by).agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("gaps"),
        F.sum(F.col("n") * F.col("shift")).alias("first"),
        F.sum(F.col("n") * F.col("shift") * F.col("shift")).alias("second"),
    )
    out = {}
    for r in moments.join(known, by, "left").collect():
        n, median = r["rows"], r["median"] or 0.0
        mean = r["first"] / n
        sd = math.sqrt(max(r["second"] / n - mean * mean, 0.0))
        out[tuple(r[c] for c in by)] = Numbers(n, r["gaps"], median, median + mean, sd, (r["edges"] or [])[:-1])
    return out


@dataclass(frozen=True)
class TreeEncoder:
    """Ordinal codes and binned numbers of any number of fits.

    A category that training had gets its place among the kept ones, or the place after the last if it
    was infrequent; one that training did not have, and a missing one, gets UNKNOWN. All that is kept per fit
    but `seen`, the categories of training, is bounded.
    """

    kept: dict[str, dict[str, list[str]]]
    bucketed: dict[str, frozenset[str]]
    edges: dict[str, dict[str, list[float]]]
    seen: DataFrame

    @classmethod
    def fit(cls, train: DataFrame, fit: str = "") -> TreeEncoder:
        return cls.fit_all(train.withColumn(FIT, F.lit(fit)), [fit])

    @classmethod
    def fit_all(cls, rows: DataFrame, fits: Iterable[str]) -> TreeEncoder:
        """From rows that name the fit they train."""
        return cls._fitted(category_counts(rows, CATEGORICAL, [FIT]), number_counts(rows, [FIT]), fits)

    @classmethod
    def fit_periods(cls, rows: DataFrame, held: DataFrame, fits: Iterable[str]) -> TreeEncoder:
        """From rows that say in n how many they are and in which period, and (period, fit), the fits that train on a period.
        Values are counted by period, and only their counts come once for each fit."""

        def by_fit(counts: DataFrame) -> DataFrame:
            columns = [c for c in counts.columns if c not in ("period", "n")]
            return counts.join(F.broadcast(held), "period").groupBy(FIT, *columns).agg(F.sum("n").alias("n"))

        categories = by_fit(category_counts(rows, CATEGORICAL, ["period"], "n"))
        return cls._fitted(categories, by_fit(number_counts(rows, ["period"], "n")), fits)

    @classmethod
    def _fitted(cls, categories: DataFrame, values: DataFrame, fits: Iterable[str]) -> TreeEncoder:
        seen = materialize(categories, "categories-seen")
        found = frequent_categories(seen, MAX_CATEGORIES, [FIT]).collect()
        kept = {f: {c: [] for c in CATEGORICAL} for f in fits}
        bucketed: dict[str, set[str]] = {f: set() for f in fits}
        for r in found:
            if r["category"] is not None:
                kept[r[FIT]][r["feature"]].append(r["category"])
            if r["has_infrequent"]:
                bucketed[r[FIT]].add(r["feature"])
        numbers = summaries_of(values, [FIT])
        edges = {f: {c: numbers[(f, c)].edges if (f, c) in numbers else [] for c in NUMERIC} for f in fits}
        ordered = {f: {c: sorted(names) for c, names in of.items()} for f, of in kept.items()}
        return cls(ordered, {f: frozenset(b) for f, b in bucketed.items()}, edges, seen)

    def codes(self, df: DataFrame) -> DataFrame:
        """Adds <column>_code for every category column of rows that name their fit."""
        spark, columns = df.sparkSession, [f"{c}_codes map<string,int>" for c in CATEGORICAL]
        # One row per fit, with at most MAX_CATEGORIES names per column.
        maps = [(f, *[{x: i for i, x in enumerate(of[c])} for c in CATEGORICAL]) for f, of in self.kept.items()]
        out = df.join(F.broadcast(spark.createDataFrame(maps, f"{FIT} string, {', '.join(columns)}")), FIT, "left")
        known = broadcast_if_small(self.seen)
        for c in CATEGORICAL:
            code = F.try_element_at(F.col(f"{c}_codes"), F.col(c))
            places = {f: len(self.kept[f][c]) for f, some in self.bucketed.items() if c in some}
            if places:
                trained = known.where(F.col("feature") == c).select(FIT, F.col("category").alias(c), F.lit(True).alias(f"{c}_seen"))
                place = reduce(lambda w, f: w.when(F.col(FIT) == f, F.lit(places[f])), places, F.when(F.lit(False), F.lit(0)))
                out = out.join(trained, [FIT, c], "left")
                code = F.coalesce(code, F.when(F.col(f"{c}_seen"), place))
            out = out.withColumn(f"{c}_code", F.coalesce(code, F.lit(UNKNOWN))).drop(f"{c}_seen")
        return out.drop(*[f"{c}_codes" for c in CATEGORICAL])

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds inputs: codes, numbers (MISSING where there is none) and flags of the missing ones."""
        named = df if FIT in df.columns else df.withColumn(FIT, F.lit(next(iter(self.kept))))
        parts = [F.col(f"{c}_code").cast("double") for c in CATEGORICAL]
        parts += [F.coalesce(F.col(c), F.lit(MISSING)) for c in NUMERIC]
        parts += [F.col(c).isNull().cast("double") for c in NUMERIC]
        return self.codes(named).select(*named.columns, F.array(*parts).alias(VECTOR))

    def bins(self, fits: list[str] | pa.Array, inputs: np.ndarray) -> np.ndarray:
        """One byte per column for rows of `inputs`; what is unknown or missing gets the bin for that."""
        codes, numbers = len(CATEGORICAL), len(NUMERIC)
        out = np.full((len(inputs), codes + numbers), boosting.MISSING, np.uint8)
        known = inputs[:, :codes] >= 0
        out[:, :codes][known] = inputs[:, :codes][known]
        for f, rows in boosting.places_of(fits):
            for k, c in enumerate(NUMERIC, codes):
                there = rows[inputs[rows, k + numbers] == 0]
                out[there, k] = np.searchsorted(self.edges[f][c], inputs[there, k])
        return out

    def shared(self, fits: Sequence[str]) -> TreeEncoder:
        """The encoder of one fit as that of others on the same rows."""
        ((one, kept),) = self.kept.items()
        seen = self.seen.withColumn(FIT, F.explode(F.array(*[F.lit(f) for f in fits])))
        return TreeEncoder(
            dict.fromkeys(fits, kept), dict.fromkeys(fits, self.bucketed[one]), dict.fromkeys(fits, self.edges[one]),
            materialize(seen, "categories-seen"),
        )

    def detached(self) -> TreeEncoder:
        """Without the table, to be sent to tasks."""
        return replace(self, seen=None)


@dataclass(frozen=True)
class LinearEncoder:
    """One-hot categories without a dropped level; imputed, flagged and scaled numbers."""

    categories: Categories
    medians: dict[str, float]
    flagged: list[str]
    scales: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, train: DataFrame) -> LinearEncoder:
        found = {c: n for (c,), n in number_summaries(train).items()}
        medians = {c: found[c].median if c in found else 0.0 for c in NUMERIC}
        flagged = [c for c in NUMERIC if c in found and found[c].gaps]
        scales = {f"{c}_value": (found[c].mean, found[c].sd or 1.0) if c in found else (0.0, 1.0) for c in NUMERIC}
        for c in flagged:
            share = found[c].gaps / found[c].rows
            scales[f"{c}_missing"] = (share, math.sqrt(share * (1.0 - share)) or 1.0)
        return cls(Categories.fit(train), medians, flagged, scales)

    @staticmethod
    def _numbers(medians: dict[str, float], flagged: list[str]) -> dict[str, Column]:
        return {
            **{f"{c}_value": F.coalesce(F.col(c), F.lit(medians[c])) for c in NUMERIC},
            **{f"{c}_missing": F.col(c).isNull().cast("double") for c in flagged},
        }

    def transform(self, df: DataFrame) -> DataFrame:
        numbers = {
            name: (value - F.lit(self.scales[name][0])) / F.lit(self.scales[name][1])
            for name, value in self._numbers(self.medians, self.flagged).items()
        }
        indexed = self.categories.index(df).withColumns(numbers)
        hot = OneHotEncoder(
            inputCols=[f"{c}_index" for c in CATEGORICAL],
            outputCols=[f"{c}_hot" for c in CATEGORICAL],
            dropLast=False,
        )
        # The index columns carry their number of levels, so this fit reads no rows.
        encoded = hot.fit(indexed).transform(indexed)
        parts = [f"{c}_hot" for c in CATEGORICAL] + list(numbers)
        return VectorAssembler(inputCols=parts, outputCol=VECTOR).transform(encoded)

    def slots(self) -> list[str | None]:
        """Names of the vector's places; that of a category which training did not have has none."""
        hot = [x for c in CATEGORICAL for x in [*(f"{c}={label}" for label in self.categories.labels(c)), None]]
        return hot + list(self._numbers(self.medians, self.flagged))

    def long(self, df: DataFrame, *keep: str) -> DataFrame:
        """(*keep, slot, value) of whatever is not zero."""
        return _in_slots(self.transform(df).withColumn(VECTOR, vector_to_array(VECTOR)), self.slots(), keep).where("value <> 0")


def _in_slots(encoded: DataFrame, names: Sequence[str | None], keep: Sequence[str]) -> DataFrame:
    """(*keep, slot, value) of every named place of the vector."""
    places = encoded.select(*keep, F.posexplode(VECTOR).alias("place", "value"))
    slot = F.element_at(F.array(*[F.lit(n).cast("string") for n in names]), F.col("place") + 1)
    return places.select(*keep, slot.alias("slot"), "value").where("slot is not null")


def tree_long(encoder: TreeEncoder, df: DataFrame, *keep: str) -> DataFrame:
    """(*keep, slot, value): codes, numbers and flags of rows, one row for each."""
    names = [*CATEGORICAL, *NUMERIC, *[f"{c}_missing" for c in NUMERIC]]
    return _in_slots(encoder.transform(df), names, keep)
