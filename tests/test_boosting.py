"""Histogram boosting, the encoders' codes, recalibration and stored models."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sojourn.catalogue import stored_fact
from sojourn.operators import boosting as b
from sojourn.plans import features, model, training
from sojourn.plans.encoding import LinearEncoder, TreeEncoder, number_summaries
from sojourn.plans.model import ModelConfig, platt
from sojourn.sources import landing

QUICK = ModelConfig(max_iter=4, max_leaves=5, logistic_iter=50, importance_repeats=2, importance_rows=300)


def binned(n, seed, inputs=4):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 12, (n, inputs)).astype(np.uint8)
    bins[rng.random(bins.shape) < 0.1] = b.MISSING
    z = 1.5 * (bins[:, 0] % 3 == 0) + 0.1 * np.minimum(bins[:, 2], 12) - 1
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(float)
    return bins, y, rng.random(n) < 0.2


def stored(spark, fits):
    rows = [(f, float(y), bool(h), bytes(x)) for f, (bins, ys, held) in fits.items() for x, y, h in zip(bins, ys, held, strict=True)]
    return spark.createDataFrame(rows, "fit string, y double, held_back boolean, bins binary").repartition(5)


def test_models_do_not_depend_on_where_they_are_grown(spark):
    noise = np.random.default_rng(5).integers(0, 2, 400).astype(float)
    fits = {"a": binned(900, 1), "noise": (binned(400, 2)[0], noise, binned(400, 2)[2]), "none held": (*binned(300, 3)[:2], np.zeros(300, bool))}
    rows = stored(spark, fits).persist()
    s = b.BoostSettings(rounds=14, leaves=6, least_rows=10, nominal=(0, 1), patience=5, block=3)
    whole = b.grow_models(rows, 4, s)
    spread = b.grow_models(rows, 4, b.BoostSettings(**{**s.__dict__, "rows_in_task": 350}))
    assert {f: m.dump() for f, m in whole.items()} == {f: m.dump() for f, m in spread.items()}
    assert len(whole["none held"].trees) == 14 and 1 <= len(whole["noise"].trees) < 9
    again = b.Boosted.load(whole["a"].dump())
    assert (again.margins(fits["a"][0]) == whole["a"].margins(fits["a"][0])).all()
    rows.unpersist()


def test_equal_rows_are_counted(spark, monkeypatch):
    """A model is grown in a task if its different rows fit there, and is the model of all the rows."""
    bins, y, held = binned(150, 4)
    many = np.tile(bins, (12, 1)), np.tile(y, 12), np.tile(held, 12)
    s = b.BoostSettings(rounds=6, leaves=5, least_rows=20, nominal=(0,), rows_in_task=150)
    monkeypatch.setattr(b, "_over_tasks", lambda *_: pytest.fail("1,800 rows, but 150 different ones"))
    counted = b.grow_models(stored(spark, {"a": many}), 4, s)["a"]
    share = y[~held].mean()
    assert counted.start == pytest.approx(math.log(share / (1 - share)))
    rows, model, answer = b._Rows(*many, np.full(len(many[1]), counted.start)), b._growing(True, s), None
    with pytest.raises(StopIteration) as end:
        while True:
            answer = rows.answer(*model.send(answer))
    assert counted.dump() == b.Boosted(counted.start, end.value.value).dump() and counted.trees


def gain_of(g, h, left, l2):
    part = lambda m: g[m].sum() ** 2 / (h[m].sum() + l2)
    return part(left) + part(~left) - part(np.ones(len(g), bool))


@pytest.mark.parametrize("seed", range(6))
def test_best_split_is_the_best_of_all(seed):
    """Of every cut of a number with the missing on either side, and of codes in the order of their gradients."""
    bins, y, _ = binned(300, seed)
    s = b.BoostSettings(least_rows=20, nominal=(1,))
    rows = b._Rows(bins, y, np.zeros(300, bool), np.full(300, -0.3))
    leaf = b.best_split(rows.sums(b.Tree(), [0])[0], s)
    g, h = rows._g / b.SCALE, rows._h / b.SCALE
    best = 0.0
    for f in (0, 2, 3):
        for cut in range(12):
            for with_missing in (False, True):
                left = (bins[:, f] <= cut) | (with_missing & (bins[:, f] == b.MISSING))
                if min(left.sum(), (~left).sum()) >= 20:
                    best = max(best, gain_of(g, h, left, 1.0))
    codes = sorted(set(bins[:, 1].tolist()), key=lambda c: g[bins[:, 1] == c].sum() / (h[bins[:, 1] == c].sum() + b.SMOOTHING))
    for k in range(1, len(codes)):
        left = np.isin(bins[:, 1], codes[:k])
        if min(left.sum(), (~left).sum()) >= 20:
            best = max(best, gain_of(g, h, left, 1.0))
    assert leaf.gain == pytest.approx(best, rel=1e-9)
    left = leaf.goes_left[bins[:, leaf.feature]]
    assert gain_of(g, h, left, 1.0) == pytest.approx(best, rel=1e-9) and min(left.sum(), (~left).sum()) >= 20


def test_trees_grow_best_leaf_first():
    """Against splitting one leaf at a time, always the one that gains most."""
    bins, y, held = binned(1500, 9)
    s = b.BoostSettings(leaves=7, least_rows=15, nominal=(0,))
    rows = b._Rows(bins, y, held, np.zeros(1500))
    model, answer = b._growing(False, b.BoostSettings(**{**s.__dict__, "rounds": 1})), None
    with pytest.raises(StopIteration) as end:
        while True:
            answer = rows.answer(*model.send(answer))
    (grown,) = end.value.value
    rows = b._Rows(bins, y, held, np.zeros(1500))
    plain = b.Tree()
    known = {0: b.best_split(rows.sums(plain, [0])[0], s)}
    leaves = {0}
    while len(leaves) < s.leaves and max(known[k].gain for k in leaves) > 0:
        node = max(leaves, key=lambda k: (known[k].gain, -k))
        pair = plain.split(node, known[node].feature, known[node].goes_left)
        known |= {k: b.best_split(x, s) for k, x in zip(pair, rows.sums(plain, list(pair)), strict=True)}
        leaves = leaves - {node} | set(pair)
    for k in leaves:
        plain.value[k] = known[k].value
    assert sum(f < 0 for f in grown.feature) == 7
    assert grown.margins(bins) == pytest.approx(plain.margins(bins), abs=1e-12)


def test_codes_of_what_training_did_not_have(spark):
    base = "Dog", "Stray", "Normal", "Intact", "Mix", "b", "c", "j", "1", "Monday", 10.0, 1.0, None
    columns = features.CATEGORICAL + features.NUMERIC
    schema = ", ".join(f"{c} string" for c in features.CATEGORICAL) + ", " + ", ".join(f"{c} double" for c in features.NUMERIC)
    rows = [base[:5] + (f"breed{i:02}",) + base[6:] for i in range(45)] + [base[:5] + ("breed00",) + base[6:]]
    encoder = TreeEncoder.fit(spark.createDataFrame(rows, schema))
    asked = [base[:5] + (x,) + base[6:] for x in ("breed00", "breed44", "new", None)] + [("Bird",) + base[1:]]
    got = [r["inputs"] for r in encoder.transform(spark.createDataFrame(asked, schema)).select("inputs").collect()]
    place = columns.index("primary_breed")
    assert [r[place] for r in got][:4] == [0.0, 39.0, -1.0, -1.0] and got[4][0] == -1.0 and got[0][0] == 0.0
    assert got[0][12] == -1.0 and got[0][15] == 1.0
    bins = encoder.bins([""] * 5, np.array(got))
    assert bins[:4, place].tolist() == [0, 39, b.MISSING, b.MISSING] and (bins[:, 12] == b.MISSING).all()
    # Unknown breeds share the infrequent place of the linear encoder, unknown animals have none.
    slots = {r.slot for r in LinearEncoder.fit(spark.createDataFrame(rows, schema)).long(spark.createDataFrame(asked[2:3] + asked[4:], schema)).collect()}
    assert "primary_breed=infrequent" in slots and "animal_type=Dog" in slots and not any("Bird" in s for s in slots)


def test_number_summaries(spark):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 2000, 3000).astype(float)
    rows = [(float(v) if i % 7 else None, float(i % 3), None) for i, v in enumerate(values)]
    found = number_summaries(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in features.NUMERIC)))
    there = np.array([r[0] for r in rows if r[0] is not None])
    filled = np.array([np.median(there) if r[0] is None else r[0] for r in rows])
    age = found[("age_at_intake_days",)]
    assert (age.rows, age.gaps, age.median) == (3000, 3000 - len(there), np.median(there))
    assert age.mean == pytest.approx(filled.mean()) and age.sd == pytest.approx(filled.std())
    counts = np.bincount(np.searchsorted(age.edges, there))
    assert len(age.edges) == 254 and counts.max() <= 3 * len(there) / 255
    assert found[("stay_sequence",)].edges == [0.0, 1.0] and found[("census_same_type",)].edges == []


def test_platt_finds_the_least_penalised_loss(spark):
    rng = np.random.default_rng(8)
    rows = []
    for fit, slope in (("up", 1.4), ("down", -0.8)):
        z = rng.normal(size=400)
        rows += [(fit, float(x), float(rng.random() < 1 / (1 + math.exp(-(slope * x - 0.5))))) for x in z]
    rows += [("one class", 0.3, 1.0), ("one class", -0.3, 1.0), ("apart", -2.0, 0.0), ("apart", 2.0, 1.0)]
    found = platt(spark.createDataFrame(rows, "fit string, z double, y double").persist(), 100.0)
    assert found["one class"] == (1.0, 0.0) and found["down"][0] == 1.0
    z, y = (np.array([r[k] for r in rows if r[0] == "up"]) for k in (1, 2))
    p = 1 / (1 + np.exp(-(found["up"][0] * z + found["up"][1])))
    assert abs(((p - y) * z).sum() + found["up"][0] / 100) < 1e-6 and abs((p - y).sum()) < 1e-6
    z, y = (np.array([r[k] for r in rows if r[0] == "down"]) for k in (1, 2))
    assert (1 / (1 + np.exp(-(z + found["down"][1])))).mean() == pytest.approx(y.mean(), abs=1e-8)
    assert 1 < found["apart"][0] < 100


@pytest.fixture(scope="module")
def fact(spark):
    return stored_fact(spark, "/root/testdata/sf0.001")


def test_each_table_makes_its_own_fits_and_stored_ones_none(spark, fact, tmp_path, monkeypatch):
    fitted = []
    fit = training.fit_windows
    monkeypatch.setattr(training, "fit_windows", lambda rows, on, plain, config: fitted.append([*on, *plain]) or fit(rows, on, plain, config))
    first = training.ModelRun(fact, QUICK, str(tmp_path))
    first.table("feature_drift")
    assert fitted == []
    scores = first.table("stay_scores").orderBy("stay_key").collect()
    assert [sorted(x) for x in fitted] == [["final", "holdout"]]
    months = first.table("monthly_performance").orderBy("intake_month").collect()
    assert len(fitted) == 2 and all(x.startswith("backtest") for x in fitted[1])
    second = training.ModelRun(fact, QUICK, str(tmp_path))
    assert second.table("stay_scores").orderBy("stay_key").collect() == scores
    assert second.table("monthly_performance").orderBy("intake_month").collect() == months and len(fitted) == 2
    # Other settings are another model.
    training.ModelRun(fact, ModelConfig(max_iter=2, max_leaves=3), str(tmp_path)).table("stay_scores")
    assert len(fitted) == 3


def test_a_planted_leak_is_found(spark):
    """A feature that knows the label, dealt anew or not, has to show."""
    inputs = training.prepare(stored_fact(spark, "/root/testdata/sf0.01"))
    dealt = training.shuffled_labels(inputs.labelled, 1)
    assert dealt.count() == inputs.labelled.count()
    assert dealt.agg(F.sum("is_long_stay")).first() == inputs.labelled.agg(F.sum("is_long_stay")).first()
    (window,) = training.windows.collect_windows(training.windows.holdout_calendar(inputs.horizon_row))
    leaky = training.replace(inputs, labelled=inputs.labelled.withColumn("stay_sequence", F.col("is_long_stay") + 0.0))
    with pytest.raises(training.LeakageError):
        training.no_signal_gate(training.holdout_auc(leaky, window, QUICK))


def test_deals_share_their_rows(spark, fact, monkeypatch):
    """Labels dealt anew keep their number, deals differ, and no deal stores or shuffles the rows again."""
    inputs = training.prepare(fact)
    dealt = training.dealt_labels(inputs.labelled, range(8))
    sums = inputs.labelled.agg(F.sum("is_long_stay"), *[F.sum(x) for x in dealt]).first()
    assert len(set(sums)) == 1 and inputs.labelled.where(dealt[0] != dealt[1]).count() > 0
    assert len(training.dealt_labels(inputs.labelled.withColumn("is_long_stay", F.lit(0)), [1, 2])) == 2
    # The models of two deals are those that each deal's rows give on their own.
    labels = {"one": dealt[0], "two": dealt[1]}
    fits = training.fit_relabelled(inputs.labelled, labels, QUICK)
    for name, label in labels.items():
        alone = training.fit_boosted(inputs.labelled.withColumn("is_long_stay", label), QUICK)
        assert alone.learner.dump() == fits.models[name].dump()
    written = []
    monkeypatch.setattr(b, "materialize", lambda df, label, keep=b.materialize: written.append(keep(df, label)) or written[-1])
    monkeypatch.setattr(training, "materialize", lambda *_: pytest.fail("a copy of the rows"))
    monkeypatch.setattr(training, "no_signal_gate", lambda evaluation: evaluation.first()["roc_auc"])
    assert 0 < training.no_signal_run(inputs, QUICK) < 1
    assert [w.columns for w in written] == [["held_back", "bins", "fit", "y", "n"]]


def test_baseline_is_fitted_to_different_rows(spark, fact):
    """Rows given three times over are as many different ones, and weigh three times as much."""
    rows = training.prepare(fact).labelled
    thrice = rows.withColumn("copy", F.explode(F.array(*map(F.lit, range(3))))).drop("copy")
    assert model.counted(thrice).count() == model.counted(rows).count() <= rows.count()
    assert model.counted(thrice).agg(F.sum("n")).first()[0] == 3 * rows.count()
    config = ModelConfig()
    sums = model.baseline_optimality(model.fit_baseline(thrice, config), thrice, config).collect()
    assert [r["fitted"] for r in sums] == pytest.approx([r["observed"] for r in sums], abs=0.01)
    assert next(r["observed"] for r in sums if r["slot"] == "intercept") == 3 * rows.agg(F.sum("is_long_stay")).first()[0]


def test_importance_sample_is_of_exact_size(spark, fact):
    rows = training.prepare(fact).labelled
    sample = training.importance_sample(rows, ModelConfig(importance_rows=50))
    donors = training.importance_donors(sample, ModelConfig(importance_rows=50, importance_repeats=3)).collect()
    assert sample.count() == 50 and sorted(r.place for r in sample.collect()) == list(range(1, 51))
    for repeat in (1, 2, 3):
        mine = [r for r in donors if r.repeat == repeat]
        assert sorted(r.place for r in mine) == list(range(1, 51)) and len({r.donor for r in mine}) == 50


def test_landed_keys(spark, tmp_path):
    lines = [{"animal_id": "A1", "name": None, "extra": {"a": 1}}, {"animal_id": "A2", "name": None}, {"animal_id": None, "x y": 3}]
    (tmp_path / "part.json").write_text("\n".join(map(json.dumps, lines)) + "\n \n")
    got = {r.key: (r.status, r.objects, r.filled) for r in landing.landed_keys(spark, str(tmp_path), ["animal_id", "name", "breed"]).collect()}
    assert got == {
        "animal_id": ("present", 3, 2), "name": ("null", 2, 0), "breed": ("absent", 0, 0),
        "extra": ("unexpected", 1, 1), "x y": ("unexpected", 1, 1),
    }


def test_every_model_has_a_task_to_itself(spark, monkeypatch):
    """a hash of the names put several models into one task, one after the other."""
    in_task = b._in_task

    def counted(inputs, starts, s):
        run = in_task(inputs, starts, s)

        def named(batches):
            found = [x for batch in run(batches) for x in batch.to_pylist()]
            # Each partition answers for the models it has made.
            yield from (b.pa.RecordBatch.from_pydict({"fit": [x["fit"]], "model": [x["model"]]}) for x in found if len(found) == 1)

        return named

    monkeypatch.setattr(b, "_in_task", counted)
    made = b.grow_models(stored(spark, {f"m{k}": binned(120, k) for k in range(12)}), 4, b.BoostSettings(rounds=1, leaves=3, least_rows=10))
    assert sorted(made) == sorted(f"m{k}" for k in range(12))


def test_histograms_of_joint_inputs_are_those_of_each():
    rng = np.random.default_rng(3)
    bins = np.stack([rng.choice([0, 3, b.MISSING], 700), rng.integers(0, 12, 700), rng.integers(0, 255, 700), np.full(700, 7)], axis=1).astype(np.uint8)
    y, held = (rng.random(700) < 0.4).astype(float), rng.random(700) < 0.2
    margin = rng.normal(size=700)
    joint, alone = (b._Rows(bins, y, held, margin, cells=c) for c in (b.CELLS, 1))
    assert len(joint._joint) == 2 and len(alone._joint) == 4
    found = joint.sums(b.Tree(), [0])
    assert (found == alone.sums(b.Tree(), [0])).all() and (found.sum(axis=2) == found[:, :1].sum(axis=2)).all()


def test_equal_rows_are_encoded_once_for_all_fits(spark, monkeypatch):
    """rows came once for each fit, each was encoded and scored, and only then were equal ones counted."""
    years = [(model.datetime(2020, 1, 1), model.datetime(2021, 1, 11)), (model.datetime(2020, 6, 5), model.datetime(2021, 3, 1))]
    base = spark.range(4000).withColumn("i", F.col("id") % 40).select(
        F.md5(F.col("id").cast("string")).alias("stay_key"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(i * 12 as int))").alias("intake_at"),
        *[F.when(F.col("i") % 7 > 0, F.concat(F.lit("x"), F.col("i") % 3)).alias(c) for c in features.CATEGORICAL],
        *[F.when(F.col("i") % 5 > 0, (F.col("i") % 4).cast("double")).alias(c) for c in features.NUMERIC],
        (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int").alias("is_long_stay"),
    )
    spans = dict(zip(("one", "two"), years, strict=True))
    columns = ["fit", "is_long_stay", *features.FEATURES]
    plain = model.rows_of_fits(base, spans).groupBy(*columns).count()
    once = model.different_rows(base, spans)
    assert once.count() < 40 * 2 * 2 < plain.agg(F.sum("count")).first()[0]
    summed = once.groupBy(*columns).agg(F.sum("n").alias("count"))
    assert summed.exceptAll(plain).isEmpty() and plain.exceptAll(summed).isEmpty()

    encoded = []
    into_bins = model._binned
    monkeypatch.setattr(model, "_binned", lambda encoder, rows: encoded.append(rows.count()) or into_bins(encoder, rows))
    window = model.Window(*years[0], years[1][1], years[1][1], model.datetime(2021, 6, 1))
    fits = model.fit_windows(base, {"main": window}, {"plain": years[1]}, QUICK)
    assert len(encoded) == 2 and max(encoded) < 40 * 2 * 2 * 2
    # As fitted and corrected row by row.
    spans = {"main": years[0], "plain": years[1]}
    slow = model.fit_all_boosted(model.rows_of_fits(base, spans), list(spans), QUICK)
    assert {f: m.dump() for f, m in slow.models.items()} == {f: m.dump() for f, m in fits.models.items()}
    recent = slow.score(model.rows_of_fits(base, {"main": (years[0][1], years[1][1])}))
    z = model.materialize(recent.select("fit", model.logit(F.col("p")).alias("z"), F.col("is_long_stay").cast("double").alias("y")), "z")
    assert fits.corrections["main"] == pytest.approx(platt(z, QUICK.calibration_c)["main"], rel=1e-6)


def grown(rows, judged, s, **how):
    model, answer, asked = b._growing(judged, s, **how), None, []
    with pytest.raises(StopIteration) as end:
        while True:
            question = model.send(answer)
            asked.append(question[2])
            answer = rows.answer(*question)
    return b.Boosted(0.2, end.value.value).dump(), asked


def test_rows_of_equal_bins_are_one_in_a_task(spark, monkeypatch):
    """rows that differ only in label or in being held back were grown apart, and past the limit in a job per level."""
    bins, y, held = binned(1200, 12, inputs=9)
    bins[:, 2:] = bins[:, 2:] // 12
    bins[:, 0] = bins[:, 0] % 5
    different = len(np.unique(bins, axis=0))
    rows = b._Rows.merged(bins, y, held, 0.2, np.arange(1200) % 3 + 1)
    s = b.BoostSettings(rounds=8, leaves=7, least_rows=10, nominal=(0,), rows_in_task=different)
    assert len(rows.bins) == different < len(np.unique(np.column_stack([bins, y, held]), axis=0))
    alone = b._Rows(bins, y, held, np.full(1200, 0.2), np.arange(1200) % 3 + 1)
    assert grown(rows, True, s)[0] == grown(alone, True, s)[0]
    monkeypatch.setattr(b, "_over_tasks", lambda *_: pytest.fail("no more bins than fit a task"))
    assert b.grow_models(stored(spark, {"a": (bins, y, held)}), 9, s)["a"].trees


@pytest.mark.parametrize("seed", range(3))
def test_a_task_splits_no_leaf_before_its_turn(seed):
    """a task counted more than twice the leaves that its trees have, as if every question were a job."""
    bins, y, held = binned(1500, seed)
    s = b.BoostSettings(rounds=5, leaves=9, least_rows=10, nominal=(0,))
    ahead, turn = (grown(b._Rows(bins, y, held, np.full(1500, 0.2)), False, s, **how) for how in ({}, {"ahead": False}))
    assert ahead[0] == turn[0]
    splits = sum(sum(f >= 0 for f in tree.feature) for tree in b.Boosted.load(turn[0]).trees)
    assert sum(map(len, turn[1])) == splits + 6 < sum(map(len, ahead[1]))


def test_what_a_tree_adds_is_read_off_its_rows():
    bins, y, held = binned(1500, 21)
    rows = b._Rows(bins, y, held, np.full(1500, 0.2))
    dump, _ = grown(rows, False, b.BoostSettings(rounds=4, leaves=6, least_rows=10), ahead=True)
    assert (rows.margin == b.Boosted.load(dump).margins(bins)).all()


def test_deals_are_scored_once(spark, fact, monkeypatch):
    """rows were encoded and scored for every deal, and again for each pass of the metrics."""
    rows = training.prepare(fact).labelled
    labels = dict(zip(("two", "one"), training.dealt_labels(rows, range(2)), strict=True))
    fits = model.fit_relabelled(rows, dict(reversed(labels.items())), QUICK)
    kept = []
    monkeypatch.setattr(model, "materialize", lambda df, label, keep=model.materialize: kept.append(keep(df, label)) or kept[-1])
    found = model.score_relabelled(fits, rows, labels)
    got = {(r["fit"], r["stay_key"]): (r["y"], r["p"]) for r in found.collect()}
    assert len(kept) == 1 and kept[0].count() == rows.count() and len(got) == 2 * rows.count() == found.count()
    for name, label in labels.items():
        plain = fits.score(rows.withColumn("fit", F.lit(name)).withColumn("is_long_stay", label)).collect()
        assert all(got[name, r["stay_key"]] == (r["is_long_stay"], r["p"]) for r in plain)


def test_encoders_read_values_counted_by_period(spark, fact, monkeypatch):
    """every row came once for each fit before its categories and numbers were counted."""
    rows = training.prepare(fact).labelled
    low, high = rows.agg(F.min("intake_at"), F.max("intake_at")).first()
    step = (high - low) / 4
    spans = {f"m{k}": (low + step * k / 4, low + step * (k + 8) / 4) for k in range(4)}
    slow = TreeEncoder.fit_all(model.rows_of_fits(rows, spans), list(spans))
    came = []
    counts, held = model.counted_periods(rows, spans)
    monkeypatch.setattr(model, "rows_of_fits", lambda *_: pytest.fail("rows once for each fit"))
    periods = TreeEncoder.fit_periods
    monkeypatch.setattr(TreeEncoder, "fit_periods", lambda stored, *more: came.append(stored.agg(F.sum("n")).first()[0]) or periods(stored, *more))
    once = TreeEncoder.fit_periods(counts, held, list(spans))
    assert came == [rows.where(F.col("intake_at") < spans["m3"][1]).count()]
    assert (once.kept, once.bucketed, once.edges) == (slow.kept, slow.bucketed, slow.edges)
    assert once.seen.exceptAll(slow.seen.select(once.seen.columns)).isEmpty() and once.seen.count() == slow.seen.count()
    model.fit_windows(rows, {}, spans, QUICK)
    assert len(came) == 2


def test_bins_are_packed_as_rows():
    bins = np.asfortranarray(np.random.default_rng(1).integers(0, 256, (50, 13)).astype(np.uint8))
    assert b.packed_rows(bins).to_pylist() == [bytes(r) for r in bins.tolist()] and (b.bins_of(b.packed_rows(bins), 13) == bins).all()
    assert len(b.packed_rows(bins[:0])) == 0
    assert [(f, at.tolist()) for f, at in b.places_of(["x", "y", "x"])] == [("x", [0, 2]), ("y", [1])] and b.places_of([]) == []


def test_rows_go_to_python_without_the_maps_of_codes(spark, fact):
    """the vector was made on the way to Python, where rows waited with ten maps of codes each."""
    rows = training.prepare(fact).labelled.withColumn("fit", F.lit("a"))
    encoder = TreeEncoder.fit_all(rows, ["a"])
    fits = model.BoostedFits(encoder, {"a": b.Boosted(0.1, [])}, {})
    for made in (model._binned(encoder, rows).select("fit", "bins"), fits.score(rows).select("stay_key", "p"), fits.score_each(rows).select("ps")):
        plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
        (at,) = [k for k, line in enumerate(plan) if "ArrowEvalPython" in line]
        outputs = plan[at + 1].split(" AS inputs#")[-1]
        assert "Project [" in plan[at + 1] and "AS inputs#" in plan[at + 1] and "_codes#" not in outputs
