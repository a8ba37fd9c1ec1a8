"""The whole run: warehouse, checks, model, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sojourn.operators.checks import enforce
from sojourn.plans import marts
from sojourn.plans.assertions import model_assertions, warehouse_assertions
from sojourn.plans.contracts import check_results, model_contracts, warehouse_contracts
from sojourn.plans.episodes import EPISODE_COLUMNS, RawFeeds, pair_events
from sojourn.plans.model import ModelConfig
from sojourn.plans.training import no_signal_gate, run_model
from sojourn.sources.scratch import materialize
from sojourn.sources.tables import publish

MARTS = ["episode_fact", "entity_dimension", "monthly_outcomes", "quality_issues"]


def build_warehouse(raw: RawFeeds, raw_starts: DataFrame, raw_ends: DataFrame) -> dict[str, DataFrame]:
    """Every warehouse table by name.

    The staged events and their pairing with its orphans are stored once: the pairing reads the staged
    events, the fact and the issues read the pairing, and the dimension, the mart and the checks read those.
    """
    staged_starts = materialize(raw.staged_starts(), "staged_intakes")
    staged_ends = materialize(raw.staged_ends(), "staged_outcomes")
    paired = materialize(pair_events(staged_starts, staged_ends, keep_orphans=True), "paired")
    fact = marts.episode_fact(paired.where(F.col("has_start")).select(*EPISODE_COLUMNS))
    return {
        "raw_intakes": raw_starts,
        "raw_outcomes": raw_ends,
        "staged_intakes": staged_starts,
        "staged_outcomes": staged_ends,
        "episode_fact": fact,
        "entity_dimension": marts.entity_dimension(fact),
        "monthly_outcomes": marts.monthly_outcomes(fact),
        "quality_issues": marts.quality_issues(paired),
    }


def publish_warehouse(raw_starts: DataFrame, raw_ends: DataFrame, root: str) -> tuple[dict[str, DataFrame], list[str]]:
    """Check the raw and staged tables, store the marts aside, check them, then publish all four.

    Returns the tables and the warnings. An error-level failure raises; what was published
    before then stays current.
    """
    built = build_warehouse(RawFeeds.of(raw_starts, raw_ends), raw_starts, raw_ends)
    contracts = warehouse_contracts()
    sources = {name: c for name, c in contracts.items() if name not in MARTS}
    warnings = enforce(check_results(built, sources))

    def checked(stored: dict[str, DataFrame]) -> list[str]:
        found = check_results(built | stored, {name: contracts[name] for name in MARTS})
        return enforce(
            found.unionByName(
                warehouse_assertions(
                    built["staged_outcomes"],
                    stored["episode_fact"],
                    stored["monthly_outcomes"],
                    stored["quality_issues"],
                )
            )
        )

    stored, more = publish({name: built[name] for name in MARTS}, root, checked)
    return built | stored, sorted(warnings + more)


def publish_model(
    fact: DataFrame,
    root: str,
    config: ModelConfig = ModelConfig(),
    expect_no_signal: bool = False,
    models: str | None = None,
) -> tuple[dict[str, DataFrame], list[str]]:
    """Train on a stored fact, store the six model tables aside, check them, publish them.

    With a `models` folder fits are stored there, and those that are there are not made again.

    With `expect_no_signal` (labels known to be random) a model that finds signal is a failure too.
    """

    def checked(tables: dict[str, DataFrame]) -> list[str]:
        found = check_results(tables | {"episode_fact": fact}, model_contracts()).unionByName(
            model_assertions(
                tables["model_evaluation"], tables["monthly_performance"], tables["stay_scores"], fact
            )
        )
        warnings = enforce(found)
        if expect_no_signal:
            no_signal_gate(tables["model_evaluation"])
        return warnings

    return publish(run_model(fact, config, models) if models else run_model(fact, config), root, checked)
