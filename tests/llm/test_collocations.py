import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from sojourn.llm import collocations as c
from sojourn.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute_force(rows, s):
    """rows: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, s.longest + 1):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= s.least_count}
    inside = Counter()
    for (lang, *words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = (lang, *words[i : i + size])
                inside[key] = max(inside[key], a)
    out = {}
    for g, a in candidates.items():
        lang, *words = g
        if 100 * inside[g] >= s.absorbed * a:
            continue
        score, _, left, right = min(
            (1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k, f[(lang, *words[:k])], f[(lang, *words[k:])])
            for k in range(1, len(words))
        )
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return [
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang in sorted(out)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(out[lang])[: s.best], 1)
    ]


def computed(spark, rows, s):
    df = spark.createDataFrame([(t, x, "extra", 1) for t, x in rows], "text string, lang string, word string, n int").repartition(3)
    out = c.collocations(df, s)
    assert out.columns == COLUMNS
    assert [f.dataType for f in out.schema] == [T.StringType(), T.LongType(), T.StringType()] + [T.LongType()] * 5
    return sorted(tuple(r) for r in out.collect())


def random_texts(seed, docs, words):
    rng = np.random.default_rng(seed)
    vocabulary = ["of", "THE", "the", "Äh", "äh", "a", "new", "york", "\x0bx", "b\tc"] + [f"w{i}" for i in range(40)]
    weights = 1.0 / np.arange(1, len(vocabulary) + 1)
    ends = [" ", " ", " ", "  ", ". ", ", ", "\n", "! ", "-"]
    rows = []
    for _ in range(docs):
        picked = rng.choice(len(vocabulary), int(rng.integers(0, words)), p=weights / weights.sum())
        text = "".join(vocabulary[i] + ends[int(rng.integers(len(ends)))] for i in picked)
        rows.append((text + " new york city hall now" * int(rng.integers(0, 2)), [None, "en", "de", ""][int(rng.integers(4))]))
    return rows


SMALL = c.PhraseSettings(least_count=8, best=15, table_bits=12, pending=50, held=120, word_bucket_bits=2, bucket_load_bits=6, chunk=60)


@pytest.mark.parametrize("s", [c.PhraseSettings(least_count=6, best=40), SMALL, c.PhraseSettings(least_count=4, best=500, table_bits=6, absorbed=60)])
def test_equals_brute_force(spark, s):
    """Also with filters that spill early, chunks inside texts, and a table that is full."""
    rows = random_texts(s.best, 150, 60)
    want = brute_force(rows, s)
    assert len(want) > 20
    assert computed(spark, rows, s) == want


def test_odd_rows(spark):
    s = c.PhraseSettings(least_count=3, best=10, chunk=1000)
    rows = [(None, "en"), ("", None), (" \t .,", "en"), ("x y " * 3000, None), ("same row", "de"), ("same row", "de"), ("same row", "de")]
    assert computed(spark, rows, s) == brute_force(rows, s)
    assert computed(spark, [], s) == []
    assert computed(spark, [("one two", "en")], s) == []


def test_exact_beyond_64_bits(spark):
    """1000 * a * n passes 64 bits."""
    grams = spark.createDataFrame([(3_000_000_000, 4_000_000_000_000, 3_100_000_000, 3_200_000_000)], "a long, n long, l long, r long")
    text = "cast(cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as bigint)"
    assert grams.selectExpr(text).first()[0] == 1000 * 3_000_000_000 * 4_000_000_000_000 // (3_100_000_000 * 3_200_000_000)


@pytest.mark.parametrize("n, bits", [(1, 2), (2, 4), (5, 9)])
def test_filters_lose_nothing(n, bits):
    rng = np.random.default_rng(n)
    ids = rng.integers(1, 2**63, (40, n)).astype(np.uint64)[rng.integers(0, 40, 3000)]
    ids[::7, 0] = ids[3, 0]
    first, rest = c.permuted(ids)
    assert (c.restored(first, rest) == ids).all()
    words = np.array([b"w%d" % i for i in ids[:, 0]], object) if n == 1 else None
    grams = c._counted(first, rest, None, words)
    want = Counter(map(tuple, ids.tolist()))
    got = {}
    for _, bucket, *filled in c.filter_rows("en", grams, bits):
        x, others, counts, spelled = c.filter_grams(bucket, *filled, n, bits)
        back = c.restored(x, others)
        got |= dict(zip(map(tuple, back.tolist()), counts.tolist(), strict=True))
        if n == 1:
            assert [b"w%d" % i for i in back[:, 0]] == spelled.tolist()
    assert got == want


def test_equal_first_parts_are_told_apart():
    rest = np.array([[1], [2], [1], [2], [3]], np.uint64)
    first, others, counts, _ = c._counted(np.full(5, 9, np.uint64), rest, None)
    assert first.tolist() == [9] * 3 and others.ravel().tolist() == [1, 2, 3] and counts.tolist() == [2, 2, 1]


def test_query_on_all_documents(spark):
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text", "lang"])
    rows = list(zip(*(x.to_pylist() for x in table.columns), strict=True))
    got = sorted(tuple(r) for r in QUERIES["op11_collocations"](spark, "/root/testdata/sf0.001").collect())
    assert got == brute_force(rows, c.PhraseSettings())
