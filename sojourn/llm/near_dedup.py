"""Near duplicates from bottom-k sketches of one hash function.

1. Every document becomes the set of its hashed word shingles. Equal sets collapse to one
   node; so copies of any number cost one node.
2. A node's sketch is the k least hashes of its set. Sets as similar as asked share at least
   `needed_overlap` of them (a binomial tail below 1e-8 bounds the exceptions; small sets are
   kept whole and have none). So, with values ordered by how many sketches hold them, two
   such nodes share one of the rarest few. Only those are put into inverted lists: a passage
   that many documents quote is in nobody's rare end unless it makes up the document.
3. The lists give the pairs, the sketch of the union filters them, and each pair counts in
   one list only. What leaves a list is a forest of its pairs; the members of a very long
   list are put together by size without a look at pairs. That makes clusters.
4. The full sets of a cluster are compared, a large one block by block, and what comes out is a
   forest of true links. So rows are linear in list members, whatever the size of a family.

Shingles and sets are compared by 64-bit hashes; a collision needs two of some 2^64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.llm.components import connected_components
from sojourn.llm.prefix_tree_join import JoinSettings, cluster_links, fingerprint, joined_apart
from sojourn.llm.shingles import shingle_set
from sojourn.sources.scratch import materialize

SKETCH = 32
#: Documents of an inverted list whose pairs are looked at.
BLOCK = 4096
#: Pairs looked at together, which bounds the temporary arrays.
PAIRS_AT_ONCE = 50_000


def needed_overlap(similarity: float, k: int = SKETCH, risk: float = 1e-8) -> int:
    """Values that the sketches of two sets this similar share, but for a chance below `risk`."""
    tail, t = 0.0, 0
    while True:
        tail += math.comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if tail > risk:
            return max(1, t)
        t += 1


def _signatures(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch.column(2).to_pylist()]
            prints = np.array([fingerprint(x) for x in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array([x[:k] for x in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n", "fa", "fb", "sketch"],
            )

    return run


def _by_unit(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole units only: tables of consecutive rows and the row at which each unit begins.
    Rows come sorted by their first `keys` columns."""
    left: pa.Table | None = None

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for c in range(keys):
            x = table.column(c).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([left, table]).combine_chunks() if left is not None else table
        at = starts(table)
        if at[-1]:
            yield table.slice(0, int(at[-1])), at[:-1]
        left = table.slice(int(at[-1]))
    if left is not None and left.num_rows:
        yield left, np.zeros(1, np.int64)


def _padded(column: pa.ChunkedArray, fill: int) -> np.ndarray:
    """Lists as rows of equal length; empty places hold a value per column that no hash is likely to have."""
    lists = column.combine_chunks()
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.full((len(sizes), max(1, int(sizes.max(initial=0)))), fill, np.int64)
    place = np.arange(out.shape[1]) < sizes[:, None]
    out[place] = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    return out


def _pairs(starts: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one unit, for all units, a bounded number at a time."""
    ends = np.append(starts[1:], rows)
    end_of = np.repeat(ends, ends - starts)
    counts = end_of - np.arange(rows) - 1
    cut = np.searchsorted(np.cumsum(counts), np.arange(PAIRS_AT_ONCE, counts.sum() + PAIRS_AT_ONCE, PAIRS_AT_ONCE))
    begin = 0
    for end in np.unique(np.minimum(cut + 1, rows)):
        some = counts[begin:end]
        left = np.repeat(np.arange(begin, end), some)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(some) - some, some)
        if len(left):
            yield left, right
        begin = end


def _union_matches(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the k least values of each union of two sketches: how many there are, and are in both."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both < _PAD
    new = np.ones(both.shape, bool)
    new[:, 1:] = both[:, 1:] != both[:, :-1]
    twice = np.zeros(both.shape, bool)
    twice[:, :-1] = ~new[:, 1:]
    inside = real & new & (np.cumsum(new, axis=1) <= k)
    return inside.sum(axis=1), (inside & twice).sum(axis=1)


_PAD = np.iinfo(np.int64).max


def _root(parent: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The tree each row is in; paths get shorter on the way."""
    while True:
        up = parent[rows]
        if (parent[up] == up).all():
            return up
        parent[rows] = parent[up]


def _candidates(num: int, den: int, k: int, least: int):
    """Per list, a forest of the pairs that pass owner, size and union-sketch tests. Pairs that are
    connected already are not looked at, so a family of any size gives one row per member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _by_unit(batches, 1):
            v, node, n = (table.column(c).to_numpy() for c in range(3))
            sketch, prefix = _padded(table.column(3), _PAD), _padded(table.column(4), _PAD)
            parent, found = np.arange(table.num_rows), []
            for a, b in _pairs(starts, table.num_rows):
                small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
                ok = (_root(parent, a) != _root(parent, b)) & (den * small >= num * large)
                a, b = a[ok], b[ok]
                if not len(a):
                    continue
                # The pair belongs to the first value of both prefixes, in the order of the prefixes.
                mine, theirs = prefix[a], prefix[b]
                shared = (mine[:, :, None] == theirs[:, None, :]).any(axis=2) & (mine != _PAD)
                ok = mine[np.arange(len(a)), shared.argmax(axis=1)] == v[a]
                a, b = a[ok], b[ok]
                if not len(a):
                    continue
                size, match = _union_matches(sketch[a], sketch[b], k)
                ok = np.where(size < k, den * match >= num * size, match >= least)
                for x, y in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
                    one, other = _root(parent, np.array([x, y])).tolist()
                    if one != other:
                        parent[one] = other
                        found.append((x, y))
            pairs = node[np.array(found, np.int64).reshape(-1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    return run


def compared(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected, by counting common shingles: each set that was found
    is compared with those not found yet."""
    flat, ids = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    ids, mark = ids.ravel(), np.zeros(len(flat), np.int64)
    unseen, links = np.arange(len(sets)), []
    while len(unseen):
        waiting, unseen = [int(unseen[0])], unseen[1:]
        while waiting and len(unseen):
            x = waiting.pop()
            mine = ids[ends[x] - sizes[x] : ends[x]]
            mark[mine] = 1
            near = unseen[(den * np.minimum(sizes[unseen], sizes[x]) >= num * np.maximum(sizes[unseen], sizes[x]))]
            common = _common(mark, ids, ends[near] - sizes[near], sizes[near])
            mark[mine] = 0
            hit = near[den * common >= num * (sizes[near] + sizes[x] - common)]
            links += [(x, y) for y in hit.tolist()]
            waiting += hit.tolist()
            unseen = np.setdiff1d(unseen, hit, assume_unique=True)
    return links


def _common(mark: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    if not len(begin):
        return np.empty(0, np.int64)
    first = np.cumsum(size) - size
    at = np.repeat(begin - first, size) + np.arange(int(size.sum()))
    return np.add.reduceat(mark[ids[at]], first)


def compared_between(
    probes: list[np.ndarray], labels: np.ndarray, sets: list[np.ndarray], groups: np.ndarray, num: int, den: int
) -> list[tuple[int, int]]:
    """(probe, set) links, one for each probe and group other than its own that it links with."""
    flat, ids = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    ids, begin, mark, links = ids.ravel(), np.cumsum(sizes) - sizes, np.zeros(len(flat) + 1, np.int64), []
    for i, probe in enumerate(probes):
        at = np.searchsorted(flat, probe)
        at[at == len(flat)] = 0
        at = at[flat[at] == probe]
        mark[at] = 1
        other = np.flatnonzero(groups != labels[i])
        common = _common(mark, ids, begin[other], sizes[other])
        mark[at] = 0
        hit = other[den * common >= num * (sizes[other] + len(probe) - common)]
        _, first = np.unique(groups[hit], return_index=True)
        links += [(i, y) for y in hit[first].tolist()]
    return links


def _prefix_size(n: Column, size: Column, num: int, den: int, k: int, least: int) -> Column:
    """How many of a sketch's rarest values must be listed for no similar pair to be missed."""
    whole = F.ceil(n * F.lit(num) / F.lit(den))
    partners_whole = n * F.lit(den) < F.lit(num * k)
    kept = F.when(partners_whole, whole).otherwise(F.least(F.lit(least), whole))
    return (size - kept + 1).cast("int")


def _listed(nodes: DataFrame, num: int, den: int, k: int, least: int) -> DataFrame:
    """(node, n, sketch, prefix): nodes with values that other sketches hold, and which of them are listed."""
    values = nodes.select("node", F.explode("sketch").alias("v"))
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = values.join(counts, "v").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("shared"))
    size = F.size("sketch")
    take = _prefix_size(F.col("n"), size, num, den, k, least) - (size - F.size("shared"))
    return materialize(
        nodes.join(shared, "node")
        .withColumn("take", take)
        .where("take > 0")
        .select("node", "n", "sketch", F.slice(F.col("shared.v"), F.lit(1), F.col("take")).alias("prefix")),
        "members",
    )


def _clusters(members: DataFrame, num: int, den: int, k: int, least: int) -> DataFrame:
    """(node, cluster): whatever the lists and sketches cannot tell from a similar pair is in one cluster."""
    listed = members.select("node", "n", F.explode("prefix").alias("v"))
    lists = materialize(listed.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "lists")
    short, long = lists.where(F.col("m") <= BLOCK), lists.where(F.col("m") > BLOCK)
    within = (
        listed.drop("n").join(short.select("v"), "v")
        .join(members, "node")
        .select("v", "node", "n", "sketch", "prefix")
        .repartition("v")
        .sortWithinPartitions("v")
        .mapInArrow(_candidates(num, den, k, least), "u long, v long")
    )
    # A list with very many members is a family or a text that all of them quote: those of about one size are put
    # together through the least of them, and with the next size. There is one long list per BLOCK rows at most.
    step = math.log(1.05 * den / num)
    common = listed.join(F.broadcast(long.select("v")), "v").withColumn("class", F.floor(F.log("n") / F.lit(step)))
    heads = materialize(common.groupBy("v", "class").agg(F.min("node").alias("head")), "list-heads")
    through = common.join(heads, ["v", "class"]).where("node <> head").select(F.col("node").alias("u"), F.col("head").alias("v"))
    above = heads.select("v", (F.col("class") - 1).alias("class"), F.col("head").alias("other"))
    across = above.join(heads, ["v", "class"]).where("other <> head").select(F.col("other").alias("u"), F.col("head").alias("v"))
    edges = within.unionAll(through).unionAll(across)
    return connected_components(edges).select("node", F.col("component").alias("cluster"))


def components_of_sets(
    docs: DataFrame, width: int, num: int, den: int, k: int = SKETCH, unnamed: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(signatures, sets): every row's doc_id, text_hash, n and set (fa, fb); and every set with its copies, the first
    of its rows (those without doc_id last) and its component, a number of its own. `unnamed` tells whether
    rows without doc_id take part."""
    least = needed_overlap(num / den, k)
    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"), text.alias("text"))
    signatures = materialize(
        slim.mapInArrow(_signatures(width, k), "doc_id long, text_hash long, n long, fa long, fb long, sketch array<long>"), "signatures"
    )
    part = signatures.where("n > 0") if unnamed else signatures.where("n > 0 and doc_id is not null")
    nodes = part.groupBy("fa", "fb").agg(
        F.first("n").alias("n"),
        F.first("sketch").alias("sketch"),
        F.min("text_hash").alias("text_hash"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first"),
        F.count(F.lit(1)).alias("copies"),
    )
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    clusters = _clusters(_listed(nodes.select("node", "n", "sketch"), num, den, k, least), num, den, k, least)
    wanted = nodes.select(F.col("node").alias("id"), "fa", "fb", "n", "text_hash").join(clusters.withColumnRenamed("node", "id"), "id")
    settings = JoinSettings(width=width, num=num, den=den)
    found = connected_components(cluster_links(materialize(wanted, "clusters"), slim, settings, compared, compared_between))
    component = F.coalesce("component", "node").alias("component")
    linked = F.col("component").isNotNull().alias("linked")
    sets = nodes.join(found, "node", "left").select("fa", "fb", "copies", "first", component, linked)
    return signatures, materialize(sets, "set-components")


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, k: int = SKETCH) -> DataFrame:
    """Component of every document under links of den * |A & B| >= num * |A | B|.

    Input: doc_id (long) and text; other columns are not read. One row comes out per input
    row: doc_id, n_shingles, component_id (least doc_id reachable), kept.

    Null, empty and word-less texts have no shingles and link with nothing. Rows count by what they hold: rows of
    one doc_id with different texts link each for itself. Repeated rows come
    out as often as they came in, with equal values. A null doc_id is its own component: null,
    kept. An empty table gives an empty result. Texts of any length are read whole.
    """
    signatures, sets = components_of_sets(docs, width, num, den, k, unnamed=False)
    least = sets.groupBy("component").agg(F.min("first.doc_id").alias("least_id"))
    # Sets without a link or a copy need no looking up.
    moved = sets.where("linked or copies > 1").join(least, "component").select("fa", "fb", "copies", "least_id")
    found = joined_apart(signatures.select("doc_id", "n", "fa", "fb"), materialize(moved, "moved"))
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.coalesce("least_id", "doc_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs, whole, but of every component only one: that of least doc_id, then of least text hash;
    rows without doc_id come last, and take part. Rows equal in doc_id and text count as one, whatever else they
    hold. Texts without words link with nothing and stay, each once. An empty table gives an empty result."""
    signatures, sets = components_of_sets(docs, width, num, den)
    chosen = sets.groupBy("component").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")
    wordless = signatures.where("n = 0").select("doc_id", "text_hash")
    id_, unnamed = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_unnamed")
    wanted = chosen.unionAll(wordless).select(id_, unnamed, F.col("text_hash").alias("_hash")).distinct()
    key = ["_id", "_unnamed", "_hash"]
    keyed = docs.select("*", id_, unnamed, F.coalesce(F.xxhash64(F.col("text").cast("string")), F.lit(0)).alias("_hash"))
    # One exchange on the key serves both; the hint keeps one plan at every size.
    return keyed.join(wanted.hint("merge"), key, "left_semi").dropDuplicates(key).select(*docs.columns)
