"""Metrics against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sojourn.operators import census, metrics
from sojourn.operators.categories import category_counts, category_map
from sojourn.operators.ranking import positions
from sojourn.plans import drift
from sojourn.plans.model import level_shift


def brute(rows):
    """rows: (y, p, key), straight from the definitions."""
    n, positives = len(rows), sum(y for y, _, _ in rows)
    pos = [p for y, p, _ in rows if y]
    neg = [p for y, p, _ in rows if not y]
    auc = None
    if pos and neg:
        auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, recall = 0.0, 0.0
    for t in sorted({p for _, p, _ in rows}, reverse=True):
        above = [y for y, p, _ in rows if p >= t]
        if positives:
            now = sum(above) / positives
            ap += (now - recall) * sum(above) / len(above)
            recall = now
    top = sorted(rows, key=lambda r: (r[1], r[2]), reverse=True)[: max(1, round(n * 0.10))]
    precision = sum(y for y, _, _ in top) / len(top)
    return {
        "n": n,
        "base_rate": positives / n,
        "mean_predicted": sum(p for _, p, _ in rows) / n,
        "roc_auc": auc,
        "average_precision": ap if positives else None,
        "brier": sum((p - y) ** 2 for y, p, _ in rows) / n,
        "top_decile_precision": precision,
        "top_decile_lift": precision / (positives / n) if positives else None,
    }


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    groups = {
        "ties": [(rng.random() < 0.3, rng.randrange(8) / 8) for _ in range(235)],
        "one class": [(False, rng.random()) for _ in range(25)],
        "single": [(True, 0.4)],
        "hot score": [(i % 3 == 0, 0.5 if i % 4 else rng.random()) for i in range(400)],
    }
    rows = [(g, f"k{i:04d}", int(y), float(p)) for g, members in groups.items() for i, (y, p) in enumerate(members)]
    return rows, spark.createDataFrame(rows, "g string, key string, y int, p double")


def test_metrics_from_distinct_scores(spark, scored):
    """The same numbers without an order of the rows, also where ties lie at the edge of the top and groups are null."""
    _, df = scored
    both = df.unionAll(df.withColumn("g", F.lit(None).cast("string"))).unionAll(df.withColumns({"g": F.lit("all tied"), "p": F.lit(0.5)}))
    ranked = metrics.evaluate(metrics.rank_scores(both, ["g"], "key"), ["g"])
    want = {r["g"]: r for r in ranked.collect()}
    got = {r["g"]: r for r in metrics.measure(both, ["g"], "key").collect()}
    assert set(got) == set(want) and len(got) == 6
    for g, row in got.items():
        for name in metrics.METRICS:
            assert row[name] == pytest.approx(want[g][name], abs=1e-12) or row[name] is want[g][name] is None, (g, name)
    assert metrics.measure(both.limit(0), ["g"], "key").collect() == []
    (whole,) = metrics.measure(df, [], "key").collect()
    assert whole["n"] == df.count()


def test_metrics_match_brute_force(scored):
    rows, df = scored
    got = {r["g"]: r for r in metrics.evaluate(metrics.rank_scores(df, ["g"], "key"), ["g"]).collect()}
    for g in {r[0] for r in rows}:
        want = brute([(y, p, k) for h, k, y, p in rows if h == g])
        for name, value in want.items():
            assert got[g][name] == (value if value is None else pytest.approx(value, abs=1e-12)), (g, name)


def test_deciles_follow_quantile_cuts(spark):
    ranks = spark.range(1, 26).select(F.col("id").alias("position"), F.lit(25).cast("long").alias("n"))
    rows = ranks.select("position", metrics.decile(F.col("position"), F.col("n")).alias("d")).collect()
    cut = {r["position"]: r["d"] for r in rows}
    assert [k for k, d in cut.items() if d == 1] == [1, 2, 3]
    assert [k for k, d in cut.items() if d == 2] == [4, 5]
    assert max(cut.values()) == 10


def test_calibration_and_quantiles(scored):
    rows, df = scored
    ranked = metrics.rank_scores(df.where("g = 'hot score'"), ["g"], "key")
    table = metrics.calibration_table(ranked).collect()
    assert sum(r["n"] for r in table) == 400 and len(table) == 10
    import numpy as np

    scores = [p for g, _, _, p in rows if g == "hot score"]
    assert metrics.score_quantiles(ranked, [0.9, 0.7]) == pytest.approx(list(np.quantile(scores, [0.9, 0.7])))


def test_stability_index(spark):
    counts = spark.createDataFrame([("m", "a", 10, 1), ("m", "b", 0, 1)], "g string, category string, expected long, actual long")
    got = metrics.stability_index(counts, ["g"]).first()["psi"]
    assert got == pytest.approx((0.5 - 1) * math.log(0.5) + (0.5 - 0.005) * math.log(0.5 / 0.005))


def test_census_counts_the_morning(spark):
    df = spark.sql(
        "select * from values ('Dog', timestamp_ntz'2024-01-01 09:00:00', timestamp_ntz'2024-01-01 18:00:00'),"
        "('Dog', timestamp_ntz'2024-01-02 09:00:00', null), ('Dog', timestamp_ntz'2024-01-05 09:00:00', null) as t(g, s, e)"
    )
    rows = census.daily_census(df, "g", "s", "e").orderBy("event_date").collect()
    assert [(r["net_change"], r["census_morning"]) for r in rows] == [(0, 0), (1, 0), (1, 1)]


def test_category_grouping(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("b", "x")] * 2 + [("c", "x")] + [("d", "x")], "u string, v string")
    grouped = {
        (r["feature"], r["category"]): r["grouped"]
        for r in category_map(category_counts(df, ["u", "v"]), 3).collect()
    }
    assert grouped == {
        ("u", "a"): "a", ("u", "b"): "b", ("u", "c"): "infrequent", ("u", "d"): "infrequent", ("v", "x"): "x",
    }


def test_level_shift(spark):
    z = spark.range(200).select((F.col("id") / 50.0 - 3).alias("z"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    shift = level_shift(z.cache())
    mean = sum(1 / (1 + math.exp(-(i / 50 - 3 + shift))) for i in range(200)) / 200
    assert mean == pytest.approx(0.2, abs=1e-9)


def test_month_status(spark):
    df = spark.createDataFrame(
        [(1, 100, 0.2, 0.4, 0.5), (2, 300, 0.2, 0.22, 0.5), (3, 300, 0.2, 0.22, None), (4, 300, 0.2, 0.5, 0.9)],
        "m int, n long, base_rate double, mean_predicted double, roc_auc double",
    )
    rows = {r["m"]: (r["status"], r["review_reasons"]) for r in drift.month_status(df).collect()}
    assert rows == {
        1: ("insufficient_data", "auc_below_floor, calibration_gap"),
        2: ("review", "auc_below_floor"),
        3: ("ok", None),
        4: ("review", "calibration_gap"),
    }


def test_drift_summary_keeps_reporting_order(spark):
    df = spark.createDataFrame(
        [("m", "census_band", 0.9), ("m", "intake_type", 0.3), ("m", "age_band", 0.1), ("q", "age_band", 0.2)],
        "intake_month string, feature string, psi double",
    )
    rows = {r["intake_month"]: (r["max_feature_psi"], r["drifted_features"]) for r in drift.drift_summary(df).collect()}
    assert rows == {"m": (0.9, "intake_type, census_band"), "q": (0.2, None)}


def test_weighted_percentiles(spark):
    from sojourn.operators.quantiles import percentile_of, with_ranks

    rng = random.Random(3)
    values = {g: [rng.randrange(40) for _ in range(n)] for g, n in (("a", 1), ("b", 8), ("c", 333))}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v long")
    weighted = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = with_ranks(weighted, ["g"], "v")
    for share in (0.0, 0.2, 0.5, 0.9, 1.0):
        got = {r["g"]: r["q"] for r in ranked.groupBy("g").agg(percentile_of("v", share).alias("q")).collect()}
        for g, vs in values.items():
            ordered, at = sorted(vs), (len(vs) - 1) * share
            low, high = ordered[int(at)], ordered[math.ceil(at)]
            fraction = at - int(at)
            assert got[g] == low * (1.0 - fraction) + high * fraction


def test_rows_of_a_null_group_are_ranked_too(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 2 == 0, F.lit("a")).alias("g"), F.col("id"))
    got = positions(rows, ["g"], ["id"], totals={"n": "*"}).collect()
    assert len(got) == 3000 and {r["n"] for r in got} == {1500}
    assert sorted(r["position"] for r in got if r["g"] is None) == list(range(1, 1501))


def test_a_null_group_has_a_stability_index(spark):
    counts = spark.createDataFrame(
        [(None, "x", 1, 1), (None, "y", 1, 3), ("m", "x", 2, 2)], "g string, category string, expected long, actual long"
    )
    got = {r["g"]: r["psi"] for r in metrics.stability_index(counts, ["g"]).collect()}
    assert got["m"] == 0 and got[None] > 0.1
