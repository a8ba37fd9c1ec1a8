"""Landing guards and data-quality checks."""

import json

import pytest
from pyspark.sql import functions as F

from sojourn.operators import checks
from sojourn.plans import assertions
from sojourn.plans.contracts import check_results, model_contracts, warehouse_contracts
from sojourn.plans.episodes import RawFeeds
from sojourn.plans.pipeline import MARTS, build_warehouse, publish_warehouse
from sojourn.sources import landing, tables


def land(path, *objects):
    path.mkdir()
    (path / "part.json").write_text("".join(json.dumps(o) + "\n" for o in objects))
    return str(path)


def test_absent_keys_and_numbers_land_as_text(spark, tmp_path):
    source = land(tmp_path / "in", {"animal_id": "A1", "name": 7}, {"animal_id": "A2", "extra": 1})
    report = landing.replace_snapshot(spark, source, str(tmp_path / "out"), ["animal_id", "name", "breed"])
    assert (report.expected_rows, report.loaded_rows, report.absent_columns) == (2, 2, ["breed"])
    rows = sorted(map(tuple, tables.read_published(spark, str(tmp_path / "out"), "snapshot").collect()))
    assert rows == [("A1", "7", None), ("A2", None, None)]


def test_empty_source_keeps_the_old_snapshot(spark, tmp_path):
    out = str(tmp_path / "out")
    landing.replace_snapshot(spark, land(tmp_path / "a", {"animal_id": "A1"}), out, ["animal_id"])
    with pytest.raises(landing.LandingError, match="no rows"):
        landing.replace_snapshot(spark, land(tmp_path / "b"), out, ["animal_id"])
    assert tables.read_published(spark, out, "snapshot").count() == 1


def test_count_mismatch_and_bad_records_keep_the_old_snapshot(spark, tmp_path):
    out = str(tmp_path / "out")
    source = land(tmp_path / "in", {"animal_id": "A1"})
    landing.replace_snapshot(spark, source, out, ["animal_id"])
    with pytest.raises(landing.LandingError, match="5 rows landed but 1"):
        landing.replace_snapshot(spark, source, out, ["animal_id"], expected=5)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.json").write_text('{"animal_id": "A2"}\n{"animal_id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.replace_snapshot(spark, str(tmp_path / "bad"), out, ["animal_id"])
    assert [tuple(r) for r in tables.read_published(spark, out, "snapshot").collect()] == [("A1",)]


def test_replace_table_and_version(spark, tmp_path):
    root = str(tmp_path)
    stored = tables.replace_table(spark.range(3), root, "t")
    tables.replace_table(spark.range(2), root, "t")
    assert tables.read_published(spark, root, "t").count() == 2 and stored.columns == ["id"]
    # A publication whose manifest is not whole does not count.
    half = spark.createDataFrame([("x", 99, "t", "nowhere", 2)], tables._MANIFEST)
    half.write.mode("append").parquet(f"{root}/_published")
    assert tables.read_published(spark, root, "t").count() == 2
    a, b = tables.model_version({"x": 1}, "abcdefgh12"), tables.model_version({"x": 2}, "abcdefgh12")
    assert a.startswith("abcdefg-") and a != b


def test_rules(spark):
    df = spark.createDataFrame([(1, "a"), (5, "b"), (None, None), (9, "b")], "n int, s string")
    rules = [
        checks.not_null("n"),
        checks.accepted_values("s", ["a"], checks.WARN),
        checks.accepted_range("n", 1, 5),
        checks.accepted_range("n", 1, 5, inclusive=False),
    ]
    assert [r["failing_rows"] for r in checks.count_row_rules(df, "t", rules).collect()] == [1, 2, 1, 3]
    values = {(r["failing_value"], r["failing_rows"]) for r in checks.failing_values(df, rules[1]).collect()}
    assert values == {("b", 2)}
    with pytest.raises(ValueError):
        checks.accepted_range("n")


def test_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in checks.duplicate_values(child, "k").collect()] == [(1, 2)]
    assert [tuple(r) for r in checks.missing_parents(child, "k", parent, "id").collect()] == [(2, 1)]


def test_severity(spark):
    schema = "check_name string, table_name string, column_name string, severity string, failing_rows long"
    warn = ("accepted_values", "t", "c", "warn", 3)
    assert checks.enforce(spark.createDataFrame([warn, ("unique", "t", "k", "error", 0)], schema)) == [
        "accepted_values t.c: 3 rows"
    ]
    with pytest.raises(checks.CheckFailure, match="unique t.k: 2 rows"):
        checks.enforce(spark.createDataFrame([warn, ("unique", "t", "k", "error", 2)], schema))


def test_declared_checks_count(spark):
    def size(contracts):
        return sum(len(c.rules) + len(c.unique) + len(c.parents) for c in contracts.values())

    assert size(warehouse_contracts()) == 43
    assert size(model_contracts()) == 25


def test_warehouse_holds_its_promises(spark, feeds):
    built = build_warehouse(RawFeeds.of(*feeds), *feeds)
    results = check_results(built, warehouse_contracts()).collect()
    errors = [r for r in results if r["severity"] == "error" and r["failing_rows"]]
    # The feed has start rows without a time; staging drops them.
    assert [(r["table_name"], r["column_name"]) for r in errors] == [("raw_intakes", "datetime")]
    found = assertions.warehouse_assertions(
        built["staged_outcomes"], built["episode_fact"], built["monthly_outcomes"], built["quality_issues"]
    ).collect()
    assert len(found) == 5 and not any(r["failing_rows"] for r in found)


def test_assertions_notice_damage(spark, feeds):
    built = build_warehouse(RawFeeds.of(*feeds), *feeds)
    fact, mart = built["episode_fact"], built["monthly_outcomes"]
    lost = fact.where("stay_sequence <> 1")
    assert assertions.monthly_counts_reconcile(mart, lost).count() == 1
    assert assertions.outcomes_accounted(built["staged_outcomes"], lost, built["quality_issues"]).count() == 1
    wrong = mart.withColumn("live_release_rate_pct", F.col("live_release_rate_pct") + 1)
    assert assertions.live_rate_matches_components(wrong).count() > 0
    flipped = fact.withColumn("is_open_stay", ~F.col("is_open_stay"))
    assert assertions.open_flag_agrees(flipped).count() == fact.count()
    negative = fact.withColumn("length_of_stay_days", F.lit(-1))
    assert assertions.no_negative_duration(negative).count() == fact.count()


def test_publishing_stores_the_marts_and_stops_on_errors(spark, feeds, tmp_path):
    starts, ends = feeds
    root = str(tmp_path)
    built, warnings = publish_warehouse(starts.dropna(subset=["datetime"]), ends, root)
    assert [w.split(":")[0] for w in warnings] == ["accepted_values staged_outcomes.outcome_type"]
    before = {name: tables.read_published(spark, root, name).count() for name in MARTS}
    assert all(before[name] == built[name].count() > 0 for name in MARTS)
    with pytest.raises(checks.CheckFailure, match="not_null raw_intakes.datetime"):
        publish_warehouse(starts, ends.limit(10), root)
    assert {name: tables.read_published(spark, root, name).count() for name in MARTS} == before
