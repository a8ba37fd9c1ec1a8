import random
import re
from itertools import combinations

import pytest

from conftest import TABLES
from sojourn.llm import near_dedup
from sojourn.llm.components import connected_components
from sojourn.llm.near_dedup import near_duplicates, needed_overlap

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_force(rows, width, num, den):
    """Every pair of distinct sets, compared in full."""
    of = {d: shingles(t, width) for d, t in rows}
    least = {}
    for d, s in sorted(of.items()):
        least.setdefault(s, d)
    parent = {d: d for d in least.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations([(s, d) for s, d in least.items() if s], 2):
        both = len(a & b)
        if den * both >= num * (len(a) + len(b) - both):
            x, y = sorted((root(x), root(y)))
            parent[y] = x
    return {d: (len(s), root(least[s]) if s else d) for d, s in of.items()}


def planted(seed=3):
    """Groups of copies with few to many edits, one shared passage, and tiny texts."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(12)]
    rows = []
    for size in (2, 3, 40, 130):
        origin = [word() for _ in range(rnd.randint(30, 160))]
        for _ in range(size):
            copy = list(origin)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [" ".join([word() for _ in range(rnd.randint(3, 30))] + passage) for _ in range(80)]
    rows += ["One", "one", "ONE two", "one  two\n", "a b c", "a b c d", "", " \t", "É b c", "é b c"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("width", "num"), [(3, 85), (5, 80)])
def test_same_components_as_brute_force(spark, width, num, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 50)  # long lists are dealt in several blocks
    rows = planted()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, num, 100).collect()
    want = brute_force(rows, width, num, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_query_over_documents(spark):
    from sojourn.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()]
    got = QUERIES["op4_near_dedup"](spark, TABLES).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(rows, 3, 85, 100)


def test_odd_tables(spark):
    schema = "doc_id long, text string, node long, v string, kept boolean"
    text = "some words that stand in a row here"
    rows = [(5, text), (5, text), (4, None), (3, ""), (None, text), (None, None), (9, text.upper()), (8, text + " x" * 40_000)]
    got = near_duplicates(spark.createDataFrame([(*r, 1, "v", False) for r in rows], schema)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == sorted(
        [(5, 4, 5, True), (5, 4, 5, True), (4, 0, 4, True), (3, 0, 3, True), (0, 4, 0, True), (0, 0, 0, True), (9, 4, 5, False), (8, 9, 8, True)]
    )
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_rows_count_by_what_they_hold(spark):
    """One id with two texts is two sets; each links for itself."""
    a, b = ("a" + " a".join(map(str, range(60))), "b" + " b".join(map(str, range(60))))
    rows = [(1, a), (1, b), (2, a + " and more"), (3, b + " and more"), (None, a + " or more"), (7, "c d e")]
    frame = spark.createDataFrame([(*r, "x", i) for i, r in enumerate(rows)], "doc_id long, text string, source string, _id int")
    got = {(r.doc_id, r.component_id) for r in near_duplicates(frame).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (None, None), (7, 7)}
    kept = near_dedup.one_of_each(frame.withColumnRenamed("_id", "row")).collect()
    assert sorted((r.doc_id, r.row) for r in kept) == [(1, 0), (1, 1), (7, 5)]


def test_one_of_each(spark):
    text = "words that stand in a row in this text here"
    rows = [(None, text), (None, text), (4, text + " x" * 2), (None, "other text that has no copy at all"), (5, ""), (5, ""), (6, None), (None, None), (8, "one two"), (8, "one two")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", near_dedup.F.lit("en"))
    kept = sorted(((r.doc_id, r.text) for r in near_dedup.one_of_each(frame, num=60).collect()), key=str)
    want = [(4, text + " x" * 2), (None, rows[3][1]), (5, ""), (6, None), (None, None), (8, "one two")]
    assert kept == sorted(want, key=str)
    assert near_dedup.one_of_each(frame.limit(0)).collect() == []


def test_one_of_each_is_the_least_of_each_component(spark):
    rows = planted(5)
    want = brute_force(rows, 5, 80, 100)
    kept = {r.doc_id for r in near_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {d for d, (_, c) in want.items() if d == c}


@pytest.mark.parametrize("members", [100, 400])
def test_rows_are_linear_in_a_family(spark, members, monkeypatch):
    """Every candidate and every link of a family of different near copies counts one member in."""
    counted = []
    components = near_dedup.connected_components
    monkeypatch.setattr(near_dedup, "connected_components", lambda edges: counted.append(edges.count()) or components(edges))
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[:250] + [f"own{i}"] + base[250:])) for i in range(members)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and counted[1] == members - 1
    assert counted[0] <= 30 * members


def test_links_of_full_sets():
    """Both ways to compare give what brute force gives."""
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(30):
        sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30))) for _ in range(25)]
        sets = list({x.tobytes(): x for x in sets}.values())
        ok = [[100 * len(np.intersect1d(x, y)) >= 60 * len(np.union1d(x, y)) for y in sets] for x in sets]
        parent = list(range(len(sets)))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        links = near_dedup.compared(sets, 60, 100)
        assert all(ok[x][y] for x, y in links)
        for x, y in links:
            assert root(x) != root(y)
            parent[root(x)] = root(y)
        assert all(root(x) == root(y) for x in range(len(sets)) for y in range(len(sets)) if ok[x][y])
        half = len(sets) // 2
        groups = np.arange(half, len(sets)) % 3
        found = near_dedup.compared_between(sets[:half], np.full(half, 1), sets[half:], groups, 60, 100)
        want = {(x, g) for x in range(half) for y, g in enumerate(groups.tolist()) if g != 1 and ok[x][half + y]}
        assert {(x, int(groups[y])) for x, y in found} == want and len(found) == len(want)


def test_overlap_bound():
    assert [needed_overlap(s, 32) for s in (0.8, 0.85)] == [11, 13]
    assert needed_overlap(1.0, 32) == 32


def test_components_of_a_long_path(spark):
    path = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (101, 101), (7, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert got == {k: 1 for k in range(1, 61)} | {100: 100, 101: 100}
