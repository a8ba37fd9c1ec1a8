import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from conftest import TABLES
from sojourn.llm.quality import QualityRules, accepted, judge, ratio_table

WORDS, TOKENS = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\W]+|[^\w\s]+")


def base(text):
    words = WORDS.findall(text or "")
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed
    )


def awkward():
    rnd = random.Random(1)
    out = [None, "", " ", "\n\n", "a " * 7, "a " * 8, "a " * 9, "a b " * 30, "x\ny\nx\n\ny\nx\r", "##|<>", "é ü   b", "w " * 30_000]
    for _ in range(150):
        out.append("".join(rnd.choice(["ab", "cd", "e", " ", " ", "\n", "\t", "#", "\x0b"]) for _ in range(rnd.randint(1, 300))))
    return list(enumerate(out))


def test_counts_match_brute_force(spark):
    rows = awkward()
    labels = spark.createDataFrame([(12, 1)], "doc_id long, quality int")
    got = judge(spark.createDataFrame(rows, "doc_id long, text string"), labels).select("row.doc_id", "*").collect()
    assert {r.doc_id: tuple(r[2:8]) for r in got} == {d: base(t) for d, t in rows}


def _hash(value, seed=42):
    data = value.encode() if isinstance(value, str) else (value % 2**64).to_bytes(8, "little")
    return xxhash.xxh64_intdigest(data, seed)


def _signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_score_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    rules = QualityRules(buckets=1024)

    def grams(text):
        tokens = [_hash(t) for t in re.findall(r"[^\W]+|[^\w\s]+", text or "")]
        pairs = [_hash(b, a_seed) for a_seed, b in ((_hash(a), b) for a, b in zip(tokens, tokens[1:]))]
        return [_signed(x) % 1024 for x in tokens + pairs]

    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    raw, trusted = Counter(), Counter()
    for d, t in docs:
        raw.update(grams(t))
        if d in good:
            trusted.update(grams(t))
    total, good_total = sum(raw.values()) + 1024, sum(trusted.values()) + 1024
    ratio = [math.log((trusted[b] + 1) / good_total) - math.log((raw[b] + 1) / total) for b in range(1024)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for r in judge(frame, labels, rules).select("row.doc_id", "row.text", "score", "kept", "base_failed").collect():
        g = grams(r.text)
        assert r.score == pytest.approx(sum(ratio[b] for b in g) / len(g), abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= rules.min_ratio)


def test_rejects_what_labels_reject(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in accepted(judge(docs, labels)).select("doc_id").collect()}
    failed = {r.doc_id for r in docs.select("doc_id", "text").collect() if base(r.text)[5]}
    by = {q: {r.doc_id for r in labels.where(f"quality = {q}").collect()} - failed for q in (0, 1)}
    assert len(by[1] & kept) >= 0.99 * len(by[1])
    assert len(by[0] & kept) <= 0.2 * len(by[0])


def test_odd_tables(spark):
    schema = "doc_id long, text string, row string, kept boolean, _words string, score string"
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(None, "word " * 20 + str(k), "r", True, "w", "s") for k in (1, 1)] + [(3, None, None, None, None, None)], schema)
    judged = judge(docs, no_labels)
    assert sorted((r.n_words, r.kept, r.score) for r in judged.collect()) == [(0, False, 0.0), (21, False, 0.0), (21, False, 0.0)]
    assert accepted(judged).columns == docs.columns
    assert judge(docs.limit(0), no_labels).collect() == []
    mixed = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 1)], "doc_id long, quality int")
    assert ratio_table(docs, mixed).count() == QualityRules().buckets


def test_plan_has_no_python(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    plan = judge(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_trusted_sample_is_of_documents_that_are_here(spark):
    """Labels of other documents and of empty ones take no place in it; without any the ratio is 0, with a warning."""
    good, bad = "the words of a good text that reads on and on", "buy cheap pills now click here win win money"
    rows = [(i, f"{good if i % 2 else bad} {i} " * 4) for i in range(1, 41)] + [(41, ""), (42, None), (43, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = QualityRules(trusted_documents=20, min_ratio=0.0)
    mine = [(i, 1) for i in range(1, 41, 2)]
    others = [(i, 1) for i in [*range(1000, 4000), 41, 42, 43]]
    scores = [
        {r.doc_id: r.score for r in judge(docs, spark.createDataFrame(labels, "doc_id long, quality int"), few).select("row.doc_id", "score").collect()}
        for labels in (mine, mine + others)
    ]
    assert scores[0] == scores[1] and min(scores[0][i] for i in range(1, 41, 2)) > max(scores[0][i] for i in range(2, 41, 2))
    with pytest.warns(UserWarning, match="no trusted document"):
        unknown = judge(docs, spark.createDataFrame(others, "doc_id long, quality int"), few)
    assert {r.score for r in unknown.select("score").collect()} == {0.0}


def test_a_filter_does_not_count_again(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    judged = judge(docs, labels)

    def evaluations(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("array_distinct")

    plain = evaluations(judged)
    for some in (judged.where("kept"), judged.where("not base_failed and not kept"), judged.where("n_repeat_words > 0 and score < 0")):
        assert evaluations(some) <= plain
    assert accepted(judged).count() == judged.where("kept").count()
