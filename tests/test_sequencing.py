"""Heavy entities, event numbers and pairing."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sojourn.operators.pairing import unmatched
from sojourn.operators.ranking import positions
from sojourn.operators.sequencing import heavy_keys
from sojourn.plans import episodes, marts, pipeline
from sojourn.plans.episodes import RawFeeds, pair_events
from sojourn.plans.staging import collapse_repeats, stage_ends, stage_starts
from sojourn.sources.landing import END_COLUMNS, START_COLUMNS, text_schema


def starts_of(spark, *events):
    rows = [tuple({"animal_id": a, "datetime": t, "animal_type": "dog"}.get(c) for c in START_COLUMNS) for a, t in events]
    return spark.createDataFrame(rows, text_schema(START_COLUMNS))


def ends_of(spark, *events):
    rows = [
        tuple({"animal_id": a, "datetime": t, "outcome_type": kind}.get(c) for c in END_COLUMNS)
        for a, t, kind in events
    ]
    return spark.createDataFrame(rows, text_schema(END_COLUMNS))


def test_positions_match_a_plain_row_number(spark):
    """One group holds most rows and many equal scores; several chunks share it."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, (F.col("id") % 7).cast("string")).otherwise("hot").alias("g"),
        ((F.col("id") * 37) % 50).alias("score"),
        F.col("id"),
        (F.col("id") % 3).alias("y"),
    )
    out = positions(rows, ["g"], ["score", "id"], running={"so_far": "y"}, totals={"n": "*", "total": "y"}).collect()
    by_group = {}
    for r in out:
        by_group.setdefault(r["g"], []).append(r)
    assert sum(map(len, by_group.values())) == 4000
    for members in by_group.values():
        members.sort(key=lambda r: (r["score"], r["id"]))
        running = 0
        for place, r in enumerate(members, 1):
            running += r["y"]
            assert (r["position"], r["so_far"], r["n"]) == (place, running, len(members))
            assert r["total"] == sum(m["y"] for m in members)


def test_heavy_keys(spark):
    keys = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert [r["k"] for r in heavy_keys(keys, "k", 100).collect()] == ["hot"]
    assert heavy_keys(keys, "k", 400) is None


def test_heavy_entities_give_the_same_episodes(spark, feeds):
    plain = RawFeeds.of(*feeds)
    spread = RawFeeds.of(*feeds, max_rows=12)
    assert plain.heavy_starts is None
    assert spread.heavy_starts is not None and 0 < spread.starts.count() < feeds[0].count()
    for side in ("staged_starts", "staged_ends"):
        assert Counter(getattr(plain, side)().collect()) == Counter(getattr(spread, side)().collect())
    for orphans in (False, True):
        assert Counter(plain.episodes(orphans).collect()) == Counter(spread.episodes(orphans).collect())


def test_pairing_three_starts_two_ends(spark):
    starts = stage_starts(starts_of(spark, ("A", "2024-01-01"), ("A", "2024-02-01"), ("A", "2024-03-01")))
    ends = stage_ends(ends_of(spark, ("A", "2024-01-05", "adoption"), ("A", "2024-02-03", None)))
    rows = sorted(pair_events(starts, ends).collect(), key=lambda r: r["stay_sequence"])
    assert [r["is_open_stay"] for r in rows] == [False, False, True]
    assert [r["length_of_stay_days"] for r in rows] == [4, 2, None]
    assert [r["outcome_class"] for r in rows] == ["Live", None, None]


def test_orphans_and_issues(spark):
    raw = RawFeeds.of(
        starts_of(spark, ("A", "2024-01-02"), ("B", "2024-01-01")),
        ends_of(spark, ("A", "2024-01-01", "relocate"), ("A", "2024-01-09", "died"), ("B", "2024-01-03", "adoption")),
    )
    orphans = unmatched(raw.staged_ends(), raw.staged_starts(), ["animal_id", "stay_sequence"]).collect()
    assert [(r["animal_id"], r["stay_sequence"]) for r in orphans] == [("A", 2)]
    issues = marts.quality_issues(raw.episodes(keep_orphans=True)).collect()
    # The first episode of A has three problems at once.
    assert Counter((r["animal_id"], r["issue_type"]) for r in issues) == Counter(
        [("A", "outcome_before_intake"), ("A", "unrecognised_outcome_type"), ("A", "unusable_age_at_intake"),
         ("A", "outcome_without_intake"), ("B", "unusable_age_at_intake")]
    )
    fact = marts.episode_fact(raw.episodes())
    assert [r["animal_id"] for r in marts.entity_dimension(fact).collect()] == ["B"]


def test_only_exact_repeats_collapse(spark):
    raw = starts_of(spark, ("A", "2024-01-01"), ("A", "2024-01-01"), ("A", "2024-01-01 00:00:00"))
    assert collapse_repeats(raw).count() == 2
    assert collapse_repeats(raw.withColumn("datetime", F.lit("t")), ["animal_id", "datetime"]).count() == 1


def test_latest_attributes_win(spark):
    raw = RawFeeds.of(starts_of(spark, ("A", "2024-01-01"), ("A", "2024-05-01")), ends_of(spark, ("A", "2024-01-09", "x")))
    row = marts.entity_dimension(marts.episode_fact(raw.episodes())).first()
    assert (row["stay_count"], row["has_returned"], row["is_currently_in_care"]) == (2, True, True)
    assert row["last_intake_at"] == datetime(2024, 5, 1)
    assert row["total_days_in_care"] == 8


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_core_needs_two_exchanges(spark, feeds):
    """De-duplication, numbering and pairing of both feeds: one exchange per feed."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = RawFeeds.of(*feeds)
        assert _exchanges(raw.episodes()) == 2
        assert _exchanges(raw.episodes(keep_orphans=True)) == 2
        assert _exchanges(marts.entity_dimension(marts.episode_fact(raw.episodes()))) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_anchor_counts(spark, feeds):
    raw = RawFeeds.of(*feeds)
    episodes = raw.episodes(keep_orphans=True).cache()
    assert raw.staged_starts().count() == 1487
    assert raw.staged_ends().count() == 1460
    assert episodes.where("not has_start").count() == 12
    assert episodes.where("has_start and is_open_stay").count() == 39
    assert episodes.where("has_start and has_invalid_duration").count() == 81
    episodes.unpersist()


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago"])
def test_times_do_not_depend_on_the_session_zone(spark, feeds, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        mart = marts.monthly_outcomes(marts.episode_fact(RawFeeds.of(*feeds).episodes()))
        assert mart.agg(F.min("outcome_month")).first()[0] == datetime(1995, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_task_pairs_a_set_number_of_events(spark, feeds, monkeypatch):
    """However well the events compress, there are as many partitions as their number asks for."""
    plain = episodes.RawFeeds.of(*feeds)
    assert plain.parts is None
    monkeypatch.setattr(episodes, "ROWS_IN_TASK", 100)
    split = episodes.RawFeeds.of(*feeds)
    assert split.parts == -(-(feeds[0].count() + feeds[1].count()) // 100) > spark.sparkContext.defaultParallelism
    assert split.episodes().rdd.getNumPartitions() == split.parts
    for built in (lambda raw: raw.episodes(keep_orphans=True), lambda raw: raw.staged_starts(), lambda raw: raw.staged_ends()):
        assert built(split).exceptAll(built(plain)).isEmpty() and built(plain).exceptAll(built(split)).isEmpty()


def test_the_warehouse_stages_events_once(feeds, monkeypatch):
    """The pairing reads the staged events that were stored, and comes out as it does from the raw ones."""
    raw, stored = episodes.RawFeeds.of(*feeds), {}
    keep = pipeline.materialize
    monkeypatch.setattr(pipeline, "materialize", lambda df, label: stored.setdefault(label, keep(df, label)))
    tables = pipeline.build_warehouse(raw, *feeds)
    assert tables["staged_intakes"] is stored["staged_intakes"] and tables["staged_outcomes"] is stored["staged_outcomes"]
    expected = raw.episodes(keep_orphans=True).select(*stored["paired"].columns)
    assert expected.exceptAll(stored["paired"]).isEmpty() and stored["paired"].exceptAll(expected).isEmpty()
