import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sojourn.llm import language_id as L


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy_and_scores(spark, documents):
    got = {r.doc_id: r for r in L.identify(documents).collect()}
    truth = {r.doc_id: (r.lang, r.text) for r in documents.collect()}
    assert set(got) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    held = [d for d, r in got.items() if r.held_out]
    right = [got[d].lang_pred == truth[d][0] for d in held]
    assert len(held) > 200 and np.mean(right) >= 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_only_the_training_fold_is_learnt_from(spark):
    rows = [(k, "aaa bbb abab" if k % 2 else "xyx yyy xxx", "ab" if k % 2 else "xy", "s") for k in range(400)]
    held = {k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2}
    rows = [(k, t, "never" if k in held else lang, s) for k, t, lang, s in rows]
    got = L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.lang_pred for r in got} == {"ab", "xy"}
    assert all(r.lang_pred == ("ab" if r.doc_id % 2 else "xy") for r in got)


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, p string, score string, lang_pred string"
    rows = [(1, "aa bb", "x"), (3, "cc dd", "y"), (None, "aa", "z"), (4, None, "x"), (5, "", None), (6, "12 - 3", "x"), (1, "aa bb", "x"), (7, "b " * 300_000, None)]
    got = L.identify(spark.createDataFrame([(*r, "p", "s", "l") for r in rows], schema)).collect()
    assert len(got) == len(rows)
    unknown = sorted((r.doc_id, r.score) for r in got if r.lang_pred == "und")
    assert unknown == [(4, 0.0), (5, 0.0), (6, 0.0)]
    assert "z" not in {r.lang_pred for r in got}
    nothing = L.identify(spark.createDataFrame([(1, "abc", None, "", "", "")], schema)).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert L.identify(spark.createDataFrame([], schema)).collect() == []


def plain_cells(text, buckets):
    """Counts by cell, gram by gram."""
    shown = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    codes = [ord(c) for c in f" {' '.join(shown)} "]
    mask, out = (1 << 64) - 1, {}
    for size in (1, 2, 3):
        for at in range(len(codes) - size + 1):
            gram = 0
            for c in codes[at : at + size]:
                gram = (gram * 0x100000001B3 + c) & mask
            cell = (((gram + size) * 0x9E3779B97F4A7C15) & mask) >> (64 - buckets.bit_length() + 1)
            out[cell] = out.get(cell, 0) + 1
    return out


def plain_model(rows, languages, s):
    """(weights, bias, temperature) of (lang, text) in training order, with dicts and loops."""
    counts = [plain_cells(text, s.buckets) for _, text in rows]
    df = {}
    for c in counts:
        for cell in c:
            df[cell] = df.get(cell, 0) + 1
    idf = {cell: math.log((1 + len(rows)) / (1 + n)) + 1 for cell, n in df.items()}
    vectors = []
    for c in counts:
        x = {cell: (1 + math.log(n)) * idf[cell] for cell, n in c.items()}
        length = math.sqrt(sum(v * v for v in x.values()))
        vectors.append({cell: v / length for cell, v in x.items()} | {"bias": 1.0})
    z, n = {}, {}

    def weight(at):
        if abs(z.get(at, 0.0)) <= s.l1:
            return 0.0
        return -(z[at] - math.copysign(s.l1, z[at])) / ((s.beta + math.sqrt(n[at])) / s.alpha + s.l2)

    def probabilities(x, t=1.0):
        scores = [sum(v * weight((cell, k)) for cell, v in x.items()) / t for k in range(len(languages))]
        top = max(scores)
        e = [math.exp(v - top) for v in scores]
        return [v / sum(e) for v in e]

    for _ in range(s.epochs):
        for k, ((lang, _), x) in enumerate(zip(rows, vectors)):
            if k % 5 == 4:
                continue
            p = probabilities(x)
            steps = []
            for j, name in enumerate(languages):
                for cell, v in x.items():
                    g = v * (p[j] - (name == lang))
                    old = n.get((cell, j), 0.0)
                    steps.append(((cell, j), g - (math.sqrt(old + g * g) - math.sqrt(old)) / s.alpha * weight((cell, j)), old + g * g))
            for at, dz, new in steps:
                z[at], n[at] = z.get(at, 0.0) + dz, new
    held = [(languages.index(rows[k][0]), vectors[k]) for k in range(4, len(rows), 5)]

    def loss(t):
        total = 0.0
        for label, x in held:
            p = probabilities(x, t)
            for j, q in enumerate(p):
                share = 1 / (len(held) + 1) / len(languages) + (j == label) * len(held) / (len(held) + 1)
                total -= share * math.log(max(q, 1e-300))
        return total

    best = min((math.exp(math.log(0.02) + k * math.log(1000) / 300) for k in range(301)), key=loss)
    return weight, best, loss


def test_model_is_that_of_plain_loops(spark):
    s = L.LanguageSettings(buckets=128, epochs=2)
    rng = np.random.default_rng(3)
    words = {"aa": ["der", "die", "und", "ein"], "bb": ["the", "and", "of", "a"], "cc": ["le", "la", "et", "un"]}
    rows = []
    for k in range(60):
        lang = list(words)[k % 3]
        mixed = words[lang] * 3 + words[list(words)[(k + 1) % 3]]
        rows.append((k, " ".join(rng.choice(mixed, int(rng.integers(2, 9)))) + ("!" if k % 4 else ""), lang))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(frame, s)
    order = [r.doc_id for r in frame.orderBy(F.xxhash64("doc_id")).collect()]
    weight, temperature, loss = plain_model([(rows[d][2], rows[d][1]) for d in order], model.languages, s)
    for j in range(3):
        assert model.bias[j] == pytest.approx(weight(("bias", j)), abs=1e-5)
        for cell in range(s.buckets):
            assert model.weights[cell, j] == pytest.approx(weight((cell, j)), abs=1e-5)
    assert loss(model.temperature) <= loss(temperature) + 1e-6


def test_too_many_languages_are_none(spark):
    rows = [(k, "some text", f"lang {k}") for k in range(12)]
    with pytest.raises(ValueError, match="more than 5 values"):
        L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), L.LanguageSettings(most_languages=5))


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Über den Wolken, 3 mal — fliegt ein Vogel. " * 40
    whole = L.gram_counts(text, 1 << 14)
    monkeypatch.setattr(L, "PIECE", 97)
    assert (L.gram_counts(text, 1 << 14) == whole).all()


def test_penalties_make_weights_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    rows = [(np.array([y, 2 + rng.integers(50)]), np.array([0.9, 0.4])) for y in (0, 1) * 200]
    labels = np.array([0, 1] * 200)
    settings = L.LanguageSettings(buckets=64)
    weights, bias = L.fit_ftrl(rows, labels, 2, settings)
    assert weights[0, 0] > weights[0, 1] and weights[1, 1] > weights[1, 0]
    strict, _ = L.fit_ftrl(rows, labels, 2, L.LanguageSettings(buckets=64, l1=2.0))
    assert (strict != 0).sum() < (weights != 0).sum()
    logits = rng.normal(size=(500, 2)) * 6
    p = 1 / (1 + np.exp((logits[:, 1] - logits[:, 0]) / 3))
    y = (rng.random(500) > p).astype(int)
    assert L.fit_temperature(logits, y) == pytest.approx(3, rel=0.3)
    assert L.fit_temperature(np.empty((0, 2)), np.empty(0, int)) == 1.0
