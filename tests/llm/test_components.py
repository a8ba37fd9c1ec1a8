"""Components against union by hand, and the rounds they take."""

import numpy as np
import pytest

from sojourn.llm import components


def by_hand(pairs):
    root = {x: x for pair in pairs for x in pair if pair[0] != pair[1]}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in pairs:
        if u != v:
            a, b = top(u), top(v)
            root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root}


def some_pairs(seed):
    rng = np.random.default_rng(seed)
    ids = rng.permutation(3000) - 500
    path = list(zip(ids[:300], ids[1:301], strict=True))
    star = [(ids[400], x) for x in ids[401:700]]
    loose = [(ids[i], ids[j]) for i, j in rng.integers(800, 3000, (1500, 2))]
    pairs = [tuple(map(int, x)) for x in path + star + loose + [(ids[0], ids[0]), (ids[5], ids[5])]]
    return pairs + [(v, u) for u, v in pairs[::3]] + pairs[::5]


@pytest.mark.parametrize("in_task,together", [(50_000, 1_000_000), (400, 1_000_000), (50, 40)])
def test_as_by_hand_however_edges_are_spread(spark, monkeypatch, in_task, together):
    monkeypatch.setattr(components, "IN_TASK", in_task)
    monkeypatch.setattr(components, "TOGETHER", together)
    pairs = some_pairs(in_task)
    edges = spark.createDataFrame(pairs, "u long, v long").repartition(12)
    got = components.connected_components(edges).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.component for r in got} == by_hand(pairs)


def test_edges_that_fit_a_task_take_no_rounds(spark, monkeypatch):
    """op13: rounds of many small tasks over a few thousand edges took most of the time."""
    written = []
    materialize = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, label: written.append(label) or materialize(df, label))
    pairs = some_pairs(1)
    components.connected_components(spark.createDataFrame(pairs, "u long, v long").repartition(12)).collect()
    assert len(written) == 2


def test_no_edges(spark):
    assert components.connected_components(spark.createDataFrame([(3, 3)], "u long, v long")).collect() == []
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
