"""Fitted models as tables, so that a later application can score without fitting."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.operators.boosting import Boosted
from sojourn.plans.encoding import FIT, TreeEncoder
from sojourn.plans.model import BoostedFits

_MODELS = "key string, model string, encoder string, slope double, intercept double"
_SEEN = "key string, feature string, category string, n long"


class ModelStore:
    """Two tables in a folder: models by key, and the categories each was trained with.

    A key says all that a fit depends on but the settings, which the folder's name stands for, and the
    data, which the folder belongs to. Categories are appended first, so a key that is there is whole; one
    that two writers stored is read once.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root

    def _read(self, table: str, schema: str) -> DataFrame | None:
        try:
            return self._spark.read.schema(schema).parquet(f"{self._root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def save(self, keys: Mapping[str, str], fits: BoostedFits) -> None:
        """Stores the named fits under their keys."""
        named = self._spark.createDataFrame(list(keys.items()), f"{FIT} string, key string")
        seen = fits.encoder.seen.join(F.broadcast(named), FIT).select("key", "feature", "category", "n")
        seen.write.mode("append").parquet(f"{self._root}/categories")
        rows = []
        for fit, key in keys.items():
            encoder = {"kept": fits.encoder.kept[fit], "bucketed": sorted(fits.encoder.bucketed[fit]), "edges": fits.encoder.edges[fit]}
            rows.append((key, fits.models[fit].dump(), json.dumps(encoder), *fits.corrections.get(fit, (None, None))))
        self._spark.createDataFrame(rows, _MODELS).coalesce(1).write.mode("append").parquet(f"{self._root}/models")

    def load(self, keys: Mapping[str, str]) -> dict[str, BoostedFits]:
        """Those of the named fits that are stored."""
        stored = self._read("models", _MODELS)
        if stored is None or not keys:
            return {}
        names = {key: fit for fit, key in keys.items()}
        rows = {names[r["key"]]: r for r in stored.where(F.col("key").isin(list(names))).dropDuplicates(["key"]).collect()}
        if not rows:
            return {}
        named = self._spark.createDataFrame([(fit, keys[fit]) for fit in rows], f"{FIT} string, key string")
        seen = self._read("categories", _SEEN).join(F.broadcast(named), "key").groupBy(FIT, "feature", "category").agg(F.max("n").alias("n"))
        parts = {fit: json.loads(r["encoder"]) for fit, r in rows.items()}
        encoder = TreeEncoder(
            {f: p["kept"] for f, p in parts.items()}, {f: frozenset(p["bucketed"]) for f, p in parts.items()},
            {f: p["edges"] for f, p in parts.items()}, seen,
        )
        found = BoostedFits(
            encoder, {f: Boosted.load(r["model"]) for f, r in rows.items()},
            {f: (r["slope"], r["intercept"]) for f, r in rows.items() if r["slope"] is not None},
        )
        return dict.fromkeys(rows, found)
