import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from sojourn.llm import prefix_trie
from sojourn.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, words string, depth int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def turns_of(rows):
    """conv_id -> ordered (role, text); ties are only made of equal rows here."""
    out = {}
    for conv_id, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1] or 0)):
        if conv_id is not None:
            out.setdefault(conv_id, []).append((role or "", text or ""))
    return out


def truncated_rest(c, n):
    return c - n * int(c / n)


def brute_rebuild(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - truncated_rest(c, 20), [])[:h] + turns[h:]
    return out


def brute_nodes(sequences):
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def below(path):
        """(leaves, saved) of the subtree."""
        saved = (len(members[path]) - 1) * (len(WORDS.findall(path[-1][1])) if path else 0)
        parts = [below(c) for c in children.get(path, [])]
        return (sum(p[0] for p in parts) if parts else 1), saved + sum(p[1] for p in parts)

    rows = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(sequences[c]) == len(path)))
        rows.append(
            (
                min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
                len(children.get(path, [])), *below(path), hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def computed(spark, rows, size=prefix_trie.Sizes()):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = prefix_trie.prefix_nodes(*prefix_trie.rebuilt(prefix_trie.ordered_turns(df)), size)
    assert out.columns == COLUMNS
    assert [f.dataType for f in out.schema] == [T.LongType()] * 7 + [T.StringType()]
    return sorted((tuple(r) for r in out.collect()), key=str)


def random_rows(seed, convs, longest, texts):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(np.arange(-40, 4 * convs), convs, replace=False).tolist():
        for turn in range(int(rng.integers(1, longest + 1))):
            rows.append((c, turn, ["user", "assistant"][turn % 2], texts[int(rng.integers(len(texts)))]))
    return rows


@pytest.mark.parametrize("size", [prefix_trie.Sizes(), prefix_trie.Sizes(2, ends_bits=2), prefix_trie.Sizes(3, 4, 3, 1)])
def test_equals_brute_force(spark, size):
    """Small segments and tries, so that nodes are shared by several of them; the last salts every group."""
    rows = random_rows(size.band, 60, 7, ["a", "b c", "", "d\te\x0bf"])
    assert computed(spark, rows, size) == brute_nodes(brute_rebuild(turns_of(rows)))


def test_odd_rows(spark):
    rows = [
        (20, None, None, None), (20, 0, "user", "one two"), (20, 0, "user", "one two"), (20, 5, None, "x"),
        (21, 0, "user", "same"), (22, 0, "user", "same"), (23, 0, "user", "same"), (None, 0, "user", "lost"),
        (-7, 3, "ab", "c"), (-8, 3, "a", "bc"), (9, 1, "user", "word " * 200_000), (2**62, 0, "user", "é"),
    ]
    assert computed(spark, rows) == brute_nodes(brute_rebuild(turns_of(rows)))


def test_nothing(spark):
    assert computed(spark, []) == []
    assert computed(spark, [(None, 1, "user", "x")]) == []


def test_long_and_common(spark):
    """One long conversation, and many that share all of another."""
    rows = [(0, t, "user", f"turn {t}") for t in range(333)]
    rows += [(c, t, "user", f"turn {t}") for c in range(100, 160) for t in range(33 + c % 2)]
    assert computed(spark, rows, prefix_trie.Sizes(16)) == brute_nodes(brute_rebuild(turns_of(rows)))


def test_double_array_holds_what_it_was_given():
    rng = np.random.default_rng(5)
    sequences = sorted({tuple(rng.integers(1, 30, rng.integers(1, 6)).tolist()) for _ in range(400)})
    flat = np.array([c for s in sequences for c in s])
    trie = prefix_trie.DoubleArray(flat, np.cumsum([0] + [len(s) for s in sequences]))
    prefixes = {s[:d] for s in sequences for d in range(1, len(s) + 1)}
    reached = {}
    for _ in range(2000):
        probe = tuple(rng.integers(1, 32, rng.integers(1, 6)).tolist())
        for p in (probe, sequences[int(rng.integers(len(sequences)))]):
            state = np.zeros(1, np.int64)
            for d, c in enumerate(p):
                state = trie.step(state, np.array([c]))
                assert (state[0] >= 0) == (p[: d + 1] in prefixes)
                if state[0] < 0:
                    break
                assert reached.setdefault(int(state[0]), p[: d + 1]) == p[: d + 1]
    assert int((trie.check >= 0).sum()) == len(prefixes)


def test_query_on_all_conversations(spark):
    import pyarrow.parquet as pq

    rows = [tuple(r.values()) for r in pq.read_table("/root/testdata/sf0.001/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    got = sorted((tuple(r) for r in QUERIES["op12_prefix_trie"](spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute_nodes(brute_rebuild(turns_of(rows)))
