import random

import numpy as np
import pytest

from conftest import TABLES
from sojourn.llm import decontamination as D
from sojourn.llm.decontamination import Index, LeakSettings, find_leaks, reduced, without_leaks


def best_alignment(window, text):
    """Least edits of the whole window against any part of the text."""
    cost = np.zeros(len(text) + 1, int)
    for i, c in enumerate(window):
        new = np.empty_like(cost)
        new[0] = i + 1
        for j, t in enumerate(text):
            new[j + 1] = min(cost[j] + (c != t), cost[j + 1] + 1, new[j] + 1)
        cost = new
    return int(cost.min())


def best_alignments(windows, text):
    """The same for many windows of one length."""
    cost = np.zeros((len(text) + 1, len(windows)), int)
    for i in range(windows.shape[1]):
        new = np.empty_like(cost)
        new[0] = i + 1
        for j, t in enumerate(text):
            new[j + 1] = np.minimum(np.minimum(cost[j] + (windows[:, i] != t), cost[j + 1] + 1), new[j] + 1)
        cost = new
    return cost.min(axis=0)


def brute_force(item, text, s):
    """The least edits of any window of the item, at whatever start, if within its budget."""
    a, b = reduced(item)[0], reduced(text)[0]
    if len(a) < s.shortest:
        return None
    m = min(len(a), s.window)
    least = int(best_alignments(np.lib.stride_tricks.sliding_window_view(a, m), b).min())
    return least if least <= s.edits(m) else None


def edited(rnd, text, edits):
    text = list(text)
    for _ in range(edits):
        p = rnd.randrange(len(text))
        text[p : p + 1] = rnd.choice([[], [rnd.choice("abcdef")], [text[p], rnd.choice("abcdef")]])
    return "".join(text)


def test_same_verdicts_as_aligning_everything():
    rnd = random.Random(4)
    s = LeakSettings(window=40)
    phrase = lambda n: " ".join("".join(rnd.choice("abcdef") for _ in range(rnd.randint(2, 6))) for _ in range(n))
    items = [(k, phrase(rnd.randint(4, 25))) for k in range(30)]
    index = Index.build(items, s)
    verdicts = []
    for _ in range(120):
        k, item = rnd.choice(items)
        cut = rnd.randint(0, len(item) // 2)
        text = phrase(8) + " " + edited(rnd, item[cut:], rnd.randint(0, 7)) + " " + phrase(8)
        got = {x[0]: x[3] for x in index.leaks(text)}
        want = brute_force(item, text, s)
        verdicts.append(want is not None)
        assert got.get(k) == want
    assert 20 < sum(verdicts) < 110


@pytest.mark.parametrize("length, edits", [(100, 0), (100, 2), (100, 4), (105, 4), (110, 4), (100, 8)])
def test_quotes_are_found_wherever_they_begin(length, edits):
    rnd = random.Random(length + edits)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8)))
    items = [(k, " ".join(word() for _ in range(60))) for k in range(20)]
    index = Index.build(items, LeakSettings())
    for _ in range(60):
        k, item = rnd.choice(items)
        begin = rnd.randrange(len(item) - length)
        quote = list(item[begin : begin + length])
        for p in rnd.sample(range(1, length - 1), edits):
            quote[p] = "z"
        quote = "".join(quote).strip()
        if len(quote) == length:
            text = " ".join(word() for _ in range(30)) + " " + quote + " " + " ".join(word() for _ in range(30))
            found = {x[0]: x[1:] for x in index.leaks(text)}
            assert list(found) == [k] and found[k][2] <= edits
            assert found[k][0] <= text.index(quote) + edits + 9 and found[k][1] >= text.index(quote) + length - edits - 9


def test_query_finds_whole_items_and_leaves_other_documents(spark):
    from sojourn.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()}
    flat = lambda t: "".join(map(chr, reduced(t)[0]))
    whole = {(d, i) for d, t in docs.items() for i, b in items.items() if flat(b) in flat(t)}
    rows = QUERIES["op2_decontamination"](spark, TABLES).collect()
    assert whole and {(r.doc_id, r.item_id) for r in rows if r.edits == 0} == whole
    for r in rows:
        assert flat(docs[r.doc_id][r.start : r.end])[:40] in flat(docs[r.doc_id])


def test_pieces_and_blocks_change_nothing(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "benchmark"))
    want = {(r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()}
    small = LeakSettings(block_chars=1500)
    assert {(r.doc_id, r.item_id) for r in find_leaks(docs, bench, small).collect()} == want
    kept = {r.doc_id for r in without_leaks(docs, bench, small).collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} - {d for d, _ in want}
    index = Index.build([(1, "x" * 30 + " the quick brown fox jumps over the lazy dog and runs away")], LeakSettings())
    text = "filler " * 300 + index_text(index) + " filler" * 300
    whole = index.leaks(text)
    monkeypatch.setattr(D, "PIECE", 700)
    assert [x[0] for x in index.leaks(text)] == [x[0] for x in whole] == [1]


def test_leaks_across_pieces_however_wide(monkeypatch):
    item = "the quick brown fox jumps over the lazy dog and runs away from the hunter and all of his hounds at once"
    index = Index.build([(1, item)], LeakSettings())
    wide = ("\n|" + " " * 300).join(item.split())
    monkeypatch.setattr(D, "PIECE", 5000)
    for before in range(0, 5000, 450):
        text = "x" * before + " " + wide + " filler" * 900
        ((item_id, start, end, edits),) = index.leaks(text)
        # Places are exact give or take the edits of windows cut by a border.
        begin = before + 1
        assert (item_id, edits) == (1, 0) and begin - 9 <= start <= begin and begin + len(wide) <= end <= begin + len(wide) + 9
        codes, at = zip(*D.pieces(text, 1 << 30), strict=True)
        whole = reduced(text)
        assert (codes[-1] == whole[0]).all() and (at[-1] == whole[1]).all()


def index_text(index):
    return "".join(map(chr, index.codes[0])).upper()


def test_banded_cost_equals_full_alignment():
    rnd = np.random.default_rng(1)
    pattern = rnd.integers(0, 3, (50, 12))
    text = rnd.integers(0, 3, (50, 12 + 30))
    cost = D.banded_cost(pattern, text, 30)
    for p, t, c in zip(pattern, text, cost, strict=True):
        assert c.min() >= best_alignment(p, t)
    same = np.concatenate([np.zeros((50, 9), int), pattern, np.zeros((50, 21), int)], axis=1)
    assert (D.banded_cost(pattern, same, 30)[:, 9] == 0).all()


def test_odd_tables(spark):
    docs_schema, items_schema = "doc_id long, text string, item_id long, start string", "item_id long, text string, doc_id long"
    item = "a sentence of the benchmark that is long enough to be found"
    docs = spark.createDataFrame(
        [(1, item.upper(), 9, "x"), (1, item.upper(), 9, "x"), (None, f"x {item}", 9, "x"), (2, None, 9, "x"), (3, "", 9, "x"), (4, "y" * 400_000 + item, 9, "")],
        docs_schema,
    )
    items = spark.createDataFrame([(7, item, 1), (8, None, 1), (None, "", 1), (6, "short", 1)], items_schema)
    rows = find_leaks(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in rows) == [(0, 7), (1, 7), (1, 7), (4, 7)]
    assert sorted(r.doc_id for r in without_leaks(docs, items).collect()) == [2, 3]
    assert find_leaks(docs, items.limit(0)).collect() == [] and find_leaks(docs.limit(0), items).collect() == []
    assert without_leaks(docs, items.limit(0)).count() == 6


@pytest.mark.parametrize("length", [24, 60, 100, 400])
def test_lemma_threshold_is_reachable(length):
    index = Index.build([(1, "ab " * length)], LeakSettings())
    assert index._least.min() >= 1
