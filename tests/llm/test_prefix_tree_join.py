import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import types as T

from sojourn.llm import prefix_tree_join as j
from sojourn.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_force(rows, s=j.JoinSettings()):
    sets = [shingles(t, s.width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, x in enumerate(sets):
        for token in x:
            holders.setdefault(token, []).append(i)
    pairs = {p for those in holders.values() for p in combinations(those, 2)}
    for a, b in pairs:
        if s.den * len(sets[a] & sets[b]) >= s.num * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if sets[i] and doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(
        ((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str
    )


def computed(spark, rows, s=j.JoinSettings()):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n long, fa string").repartition(3)
    out = j.similar_components(df, s)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert [f.dataType for f in out.schema] == [T.LongType()] * 3
    return sorted((tuple(r) for r in out.collect()), key=str)


def families(seed, groups, most):
    """Texts with edited copies; many quote the same passage."""
    rng = np.random.default_rng(seed)
    passage = " ".join(f"p{i}" for i in range(30))
    rows, doc_id = [], 0
    for _ in range(groups):
        base = [f"w{int(x)}" for x in rng.integers(0, 3000, int(rng.integers(3, 90)))]
        for _ in range(int(rng.integers(1, most))):
            words = list(base)
            for _ in range(int(rng.integers(0, 5))):
                words[int(rng.integers(len(words)))] = f"W{int(rng.integers(3000))}"
            text = " ".join(words) + (" " + passage if rng.random() < 0.5 else "")
            rows.append((doc_id, text.upper() if rng.random() < 0.1 else text))
            doc_id += 1
    rows = [rows[i] for i in rng.permutation(len(rows))]
    return rows


@pytest.mark.parametrize(
    "s", [j.JoinSettings(), j.JoinSettings(width=2, num=50, block=200, pivots=1, sampled=2, hot=3, counted=4, copies=1, table_bits=8)]
)
def test_equals_brute_force(spark, s):
    """Also with clusters in many blocks, hot shingles, and a table of texts that is full."""
    rows = families(s.width, 60, 6) + [(1000 + i, "same text that is here very often indeed") for i in range(5)]
    want = brute_force(rows, s)
    assert sum(r[0] != r[2] for r in want) > 20
    assert computed(spark, rows, s) == want


def test_chains_and_one_large_family(spark):
    """Neighbours in a chain are similar, ends are not; blocks hold a few sets each."""
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(100)]
    rows += [(500 + i, " ".join(words[:100]).replace(f"c{i + 20} ", f"x{i} ")) for i in range(70)]
    s = j.JoinSettings(block=300, pivots=2, counted=20)
    assert computed(spark, rows, s) == brute_force(rows, s)


def test_odd_rows(spark):
    long = " ".join(f"l{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three four"), (7, "one two three four five"),
        (8, "a b c d e f g"), (8, "h i j k l m n"), (9, "h i j k l m n"), (10, "a b c d e f g"), (10, "a b c d e f g"),
        (None, "a b c d e f g"), (None, "q r s t u v"), (None, "q r s t u v"), (None, None), (11, long), (12, long + " end"), (-3, "one"),
    ]
    assert computed(spark, rows) == brute_force(rows)
    assert computed(spark, []) == []


def test_tree_finds_what_comparing_finds():
    rng = np.random.default_rng(3)
    for case in range(60):
        universe = int(rng.integers(3, 60))
        sets = {tuple(sorted(set(rng.integers(0, universe, int(rng.integers(1, 25))).tolist()))) for _ in range(int(rng.integers(1, 25)))}
        sets = [np.array(x, np.int64) for x in sets]
        num = int(rng.integers(30, 101))
        tree = j.PrefixTree(sets)
        probes = [*sets, np.unique(rng.integers(0, 2 * universe, 12))]
        for probe in probes:
            want = [i for i, y in enumerate(sets) if 100 * len(np.intersect1d(probe, y)) >= num * len(np.union1d(probe, y))]
            assert sorted(tree.similar(tree.places(probe), len(probe), num, 100).tolist()) == want, case


def test_query_on_all_documents(spark):
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(*(x.to_pylist() for x in table.columns), strict=True))
    got = sorted((tuple(r) for r in QUERIES["op13_ngram_join"](spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute_force(rows)
