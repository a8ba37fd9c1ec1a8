"""Similarity join of n-gram sets with prefix trees. Exact, but for equal 64-bit hashes.

1. Every text becomes its set of hashed shingles; equal sets are one node. Two sets as similar as
   asked share at least l of their n - ceil(s n) + l least hashes, whatever l is. These pools
   are what is shuffled; l is a tenth of the set.
2. Shingles in one pool only are dropped, the others of a pool are put in a global order, rarest
   first. Two similar sets have one in common among all but the last few, by the pigeonhole
   principle; so text that most sets quote brings sets together only where little else is there.
   Sets that could be similar by size and such a shingle form clusters.
3. A cluster comes to one task with its whole sets, a large one block by block. The task stores them
   in a prefix tree, commonest shingle first, and walks it with each set as probe: overlaps are
   summed once for all sets below a branch, and a branch goes when what remains of its longest
   set cannot make up for what is missing, or when all its sets are connected already.
4. All blocks of a large cluster hold the same few sets. What these do not tie together is compared
   with the whole cluster, block by block. So there is no row for a pair, only for links that connect.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sojourn.llm.components import connected_components
from sojourn.llm.shingles import shingle_set
from sojourn.sources.scratch import materialize


@dataclass(frozen=True)
class JoinSettings:
    """Results do not depend on what is below `den`."""

    width: int = 5
    num: int = 80
    den: int = 100
    #: Shingles two similar sets share in their pools: one for so many of the set.
    pool: int = 10
    #: Shingles of one block of a cluster, and the sets all its blocks hold.
    block: int = 500_000
    pivots: int = 16
    #: One node in so many is looked at for hot shingles; from so many of these on, a shingle is hot. At most so many are.
    sampled: int = 64
    hot: int = 32
    hot_most: int = 10_000
    #: Rows of one shingle that are held to count them.
    counted: int = 10_000
    #: Bits of the table of texts that are read again, and copies of a set from which on they are joined apart.
    table_bits: int = 25
    copies: int = 100_000

    def least(self, n: int) -> int:
        """Common shingles of a set of n with any similar one."""
        return -(-n * self.num // self.den)

    def shared(self, n: int) -> int:
        return -(-n // self.pool)


# --- sets, pools -------------------------------------------------------------------------


def _signatures(s: JoinSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, s.width) for t in batch.column(2).to_pylist()]
            prints = np.array([fingerprint(x) for x in sets], np.int64).reshape(-1, 2)
            pools = [x[: len(x) - s.least(len(x)) + s.shared(len(x))] for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array(pools, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n", "fa", "fb", "pool"],
            )

    return run


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), "<i8")


def _pool_rows(hot):
    """(token, node, n, salt) of every pool. Hot tokens are dealt by node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value
        for batch in batches:
            pools = batch.column(2)
            sizes = np.diff(pools.offsets.to_numpy())
            token = pools.flatten().to_numpy()
            node, n = (np.repeat(batch.column(c).to_numpy(), sizes) for c in range(2))
            salt = np.where(np.isin(token, known), 1 + (node & 1023), 0).astype(np.int32)
            columns = [token, node, n, salt]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["token", "node", "n", "salt"])

    return run


def _count_tokens(most: int):
    """Rows sorted by token get its count, or most + 1 where it is above that or hot; tokens of one row go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4
        overflowing: int | None = None
        for last, batch in _with_last(batches):
            token, node, n, salt = (np.concatenate([h, batch.column(c).to_numpy()]) for c, h in enumerate(held))
            if not len(token):
                continue
            at = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            sizes = np.diff(np.append(at, len(token)))
            counts = np.where(salt[at] > 0, most + 1, np.minimum(sizes, most + 1))
            if token[0] == overflowing:
                counts[0] = most + 1
            overflowing, done = None, len(token)
            # The last token may go on in the next batch.
            if not last and counts[-1] > most:
                overflowing = int(token[-1])
            elif not last:
                done = int(at[-1])
            df = np.repeat(counts, sizes)[:done]
            keep = np.flatnonzero(df > 1)
            held = [x[done:] for x in (token, node, n, salt)]
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, node, n, df)], ["token", "node", "n", "df"])

    return run


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    waiting = None
    for batch in batches:
        if waiting is not None:
            yield False, waiting
        waiting = batch
    if waiting is not None:
        yield True, waiting


def _listed_tokens(signatures: DataFrame, s: JoinSettings) -> DataFrame:
    """(token, node, n, df): of every pool, the tokens of other pools too by which no partner is missed."""
    some = signatures.where("n > 0").select("fa", "fb", "n", "pool").dropDuplicates(["fa", "fb"])
    # Which tokens are hot decides how rows are spread and in which order tokens are taken, not what comes out.
    counts = (
        some.where(F.pmod("fa", F.lit(s.sampled)) == 0)
        .select(F.explode("pool").alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    found = counts.where(F.col("c") >= s.hot).orderBy(F.desc("c"), "token").limit(s.hot_most).select("token").toArrow()
    hot = signatures.sparkSession.sparkContext.broadcast(found.column("token").to_numpy())
    shared = (
        some.select("fa", "n", "pool")
        .mapInArrow(_pool_rows(hot), "token long, node long, n long, salt int")
        .repartition("token", "salt")
        .sortWithinPartitions("token")
        .mapInArrow(_count_tokens(s.counted), "token long, node long, n long, df long")
    )
    # A partner may be smaller and have fewer tokens in common with this pool, which counts.
    least = f"(n * {s.num} + {s.den - 1}) div {s.den}"
    surplus = F.expr(f"cast(({least} + {s.pool - 1}) div {s.pool} as int) - 1")
    tokens = F.sort_array(F.collect_list(F.struct("df", "token")))
    return materialize(
        shared.groupBy("node", "n")
        .agg(tokens.alias("tokens"))
        .where(F.size("tokens") > surplus)
        .select("node", "n", F.inline(F.slice("tokens", F.lit(1), F.size("tokens") - surplus))),
        "listed-tokens",
    )


def _clusters(signatures: DataFrame, s: JoinSettings) -> DataFrame:
    """(node, cluster) of the sets that may have a partner. Similar sets are in one cluster."""
    listed = _listed_tokens(signatures, s)
    # Partners lie between two neighbours by size whose sizes fit, or are such neighbours.
    by_size = Window.partitionBy("token").orderBy("n", "node")
    beside = (
        listed.where(F.col("df") <= s.counted)
        .withColumns({"other": F.lag("node").over(by_size), "smaller": F.lag("n").over(by_size)})
        .where((F.col("smaller") * s.den >= F.col("n") * s.num) & (F.col("other") != F.col("node")))
        .select("node", "other")
    )
    # A common token: all of about one size through their least, and from there to the next size. Steps
    # are wider than sizes of partners can differ.
    step = float(np.log(1.05 * s.den / s.num))
    common = listed.where(F.col("df") > s.counted).withColumn("class", F.floor(F.log("n") / F.lit(step)))
    least = materialize(common.groupBy("token", "class").agg(F.min("node").alias("other")), "common-tokens")
    through = common.join(least, ["token", "class"]).where("node <> other").select("node", "other")
    above = least.select("token", (F.col("class") - 1).alias("class"), F.col("other").alias("node"))
    across = above.join(least, ["token", "class"]).where("node <> other").select("node", "other")
    edges = beside.unionAll(through).unionAll(across).select(F.col("node").alias("u"), F.col("other").alias("v"))
    return connected_components(edges).select("node", F.col("component").alias("cluster"))


# --- prefix trees ------------------------------------------------------------------------


class PrefixTree:
    """Sets of numbers as paths of one tree, with runs of numbers on its branches.

    Numbers are ordered by how many of the sets have them, most first, then by value.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.vocabulary, local, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.empty(len(counts), np.int64)
        place[np.lexsort([self.vocabulary, -counts])] = np.arange(len(counts))
        self._place = place
        self.sizes = np.array([len(x) for x in sets])
        starts = np.cumsum(self.sizes) - self.sizes
        ranked = place[local.ravel()]
        self.sets = [np.sort(ranked[b : b + k]) for b, k in zip(starts.tolist(), self.sizes.tolist(), strict=True)]
        self.flat, self._starts = np.concatenate(self.sets), starts
        self._grow()

    def _grow(self) -> None:
        order = sorted(range(len(self.sets)), key=lambda i: self.sets[i].astype(">u4").tobytes())
        low, high, source, parent = [0], [0], [0], [-1]
        path, last, self.end = [0], None, np.zeros(len(self.sets), np.int64)
        for i in order:
            mine, size = self.sets[i], len(self.sets[i])
            common = 0
            if last is not None:
                k = min(size, len(last))
                other = np.flatnonzero(mine[:k] != last[:k])
                common = int(other[0]) if len(other) else k
            while len(path) > 1 and low[path[-1]] >= common:
                path.pop()
            top = path[-1]
            if high[top] > common:
                # The branch parts here: a new one takes its upper half.
                upper = len(low)
                low.append(low[top])
                high.append(common)
                source.append(source[top])
                parent.append(parent[top])
                low[top], parent[top] = common, upper
                path[-1] = top = upper
            if size > common:
                parent.append(top)
                low.append(common)
                high.append(size)
                source.append(int(self._starts[i]))
                top = len(low) - 1
                path.append(top)
            self.end[i] = top
            last = mine
        self.low, self.high, self.source, self.parent = (np.array(x) for x in (low, high, source, parent))
        self._bounds()

    def _bounds(self) -> None:
        """Children, and the number, least and largest size of the sets below each branch."""
        nodes = len(self.low)
        level = np.zeros(nodes, np.int64)
        at = np.flatnonzero(self.parent >= 0)
        above = self.parent.copy()
        while len(at):
            level[at] += 1
            above[at] = self.parent[above[at]]
            at = at[above[at] >= 0]
        self.alive = np.bincount(self.end, minlength=nodes)
        self.least, self.most = np.full(nodes, np.iinfo(np.int64).max), np.zeros(nodes, np.int64)
        np.minimum.at(self.least, self.end, self.sizes)
        np.maximum.at(self.most, self.end, self.sizes)
        for depth in range(int(level.max()), 0, -1):
            here = np.flatnonzero(level == depth)
            np.add.at(self.alive, self.parent[here], self.alive[here])
            np.minimum.at(self.least, self.parent[here], self.least[here])
            np.maximum.at(self.most, self.parent[here], self.most[here])
        self.children = np.argsort(self.parent, kind="stable")[1:]
        first = np.searchsorted(self.parent[self.children], np.arange(nodes + 1))
        self._first, self._fan = first[:-1], np.diff(first)
        self._ends = np.argsort(self.end, kind="stable")
        ends = np.searchsorted(self.end[self._ends], np.arange(nodes + 1))
        self._end_first, self._end_fan = ends[:-1], np.diff(ends)
        self._mark = np.zeros(len(self.vocabulary) + 1, np.int64)

    def remove(self, i: int) -> None:
        """The set is not looked for any more."""
        at = int(self.end[i])
        while at >= 0:
            self.alive[at] -= 1
            at = int(self.parent[at])

    def places(self, values: np.ndarray) -> np.ndarray:
        """The tree's numbers for a probe from outside; those it does not have are left out."""
        at = np.searchsorted(self.vocabulary, values)
        at[at == len(self.vocabulary)] = 0
        return np.sort(self._place[at[self.vocabulary[at] == values]])

    def similar(self, probe: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """Sets y with den * |x & y| >= num * |x | y|; `probe` is x in the tree's numbers, of `size` in all."""
        self._mark[probe] = 1
        branches, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(branches):
            fan = self._end_fan[branches]
            if fan.any():
                some = np.flatnonzero(fan)
                sets = self._ends[_ranges(self._end_first[branches[some]], fan[some])]
                common = np.repeat(overlap[some], fan[some])
                found.append(sets[den * common >= num * (size + self.sizes[sets] - common)])
            fan = self._fan[branches]
            children = self.children[_ranges(self._first[branches], fan)]
            overlap = np.repeat(overlap, fan)
            # Sizes that cannot fit, and branches without a set that is looked for.
            fits = (self.alive[children] > 0) & (self.least[children] * num <= size * den) & (self.most[children] * den >= size * num)
            children, overlap = children[fits], overlap[fits]
            if not len(children):
                break
            runs = self.high[children] - self.low[children]
            marks = self._mark[self.flat[_ranges(self.source[children] + self.low[children], runs)]]
            overlap = overlap + np.add.reduceat(marks, np.cumsum(runs) - runs)
            # What is left of the probe past the branch, and of the longest set below it.
            last = self.flat[self.source[children] + self.high[children] - 1]
            left = np.minimum(len(probe) - np.searchsorted(probe, last, side="right"), self.most[children] - self.high[children])
            needed = num * (size + np.maximum(self.least[children], -(-size * num // den)))
            fits = (num + den) * (overlap + left) >= needed
            branches, overlap = children[fits], overlap[fits]
        self._mark[probe] = 0
        return np.concatenate(found) if found else np.empty(0, np.int64)


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of every pair, one after the other."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def forest(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected among different sets, each set found once."""
    tree, unseen, links = PrefixTree(sets), np.ones(len(sets), bool), []
    for start in range(len(sets)):
        if not unseen[start]:
            continue
        unseen[start] = False
        tree.remove(start)
        waiting = [start]
        while waiting and tree.alive[0]:
            x = waiting.pop()
            for y in tree.similar(tree.sets[x], len(sets[x]), num, den).tolist():
                if unseen[y]:
                    unseen[y] = False
                    tree.remove(y)
                    waiting.append(y)
                    links.append((x, y))
    return links


def bridges(probes: list[np.ndarray], labels: np.ndarray, sets: list[np.ndarray], groups: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """(probe, set) links, one for each probe and group other than the probe's own that it links with."""
    tree, links = PrefixTree(sets), []
    for i, probe in enumerate(probes):
        found = tree.similar(tree.places(probe), len(probe), num, den)
        found = found[groups[found] != labels[i]]
        _, first = np.unique(groups[found], return_index=True)
        links += [(i, y) for y in found[first].tolist()]
    return links


# --- the join ----------------------------------------------------------------------------


def _units(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of each unit; they come sorted by their first `keys` columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key and rows:
                yield rows
                rows = []
            key = row[:keys]
            rows.append(row[keys:])
    if rows:
        yield rows


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[c] for x in links], pa.int64()) for c in (0, 1)], ["u", "v"])


def _within(num: int, den: int, forest=forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches, 2):
            ids = [r[0] for r in rows]
            found = forest([np.frombuffer(r[1], np.int64) for r in rows], num, den) if len(rows) > 1 else []
            yield _link_batch([(ids[x], ids[y]) for x, y in found])

    return run


def _between(num: int, den: int, bridges=bridges):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches, 3):
            asking, asked = ([r for r in rows if r[0] == flag] for flag in (True, False))
            if asking and asked:
                found = bridges(
                    [np.frombuffer(r[3], np.int64) for r in asking], np.array([r[2] for r in asking]),
                    [np.frombuffer(r[3], np.int64) for r in asked], np.array([r[2] for r in asked]), num, den,
                )
                yield _link_batch([(asking[x][1], asked[y][1]) for x, y in found])

    return run


def _full_sets(width: int, table, bits: int):
    """Sets of the texts whose hash the table has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = table.value
        for batch in batches:
            place = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            hit = (wanted[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)
            texts = batch.column(1).filter(pa.array(hit.astype(bool)))
            sets = [shingle_set(t, width) for t in texts.to_pylist()]
            prints = np.array([fingerprint(x) for x in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array([x.tobytes() for x in sets], pa.binary())], ["fa", "fb", "hashes"]
            )

    return run


def _bit_table(hashes: DataFrame, bits: int) -> np.ndarray:
    """Marks for one long column; at most 2 ** (bits - 6) words reach the driver. A mark too many costs time only."""
    place = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - bits)
    mark = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = hashes.select(place.alias("place")).select(F.shiftright("place", 6).alias("word"), mark.alias("mark"))
    got = words.groupBy("word").agg(F.bit_or("mark").alias("marks")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[got.column("word").to_numpy()] = got.column("marks").to_numpy().view(np.uint64)
    return table


def cluster_links(wanted: DataFrame, slim: DataFrame, s: JoinSettings, forest=forest, bridges=bridges) -> DataFrame:
    """(u, v) between ids of a stored table (id, cluster, n, fa, fb, text_hash), enough to connect what is connected.
    Texts are in slim (text_hash, text). `forest` finds the links inside a block, `bridges` those between parts
    that the blocks left apart."""
    members = with_sets(slim, wanted, s).select("id", "cluster", "n", "hashes")
    volumes = wanted.groupBy("cluster").agg(F.sum("n").alias("volume"), F.count(F.lit(1)).alias("m")).where("m > 1")
    blocked = materialize(
        members.join(volumes.drop("m"), "cluster")
        .withColumn("blocks", F.expr(f"cast(volume div {s.block} as int) + 1"))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .drop("volume"),
        "cluster-members",
    )
    large = blocked.where("blocks > 1")
    first = Window.partitionBy("cluster").orderBy(F.xxhash64("id"), "id")
    pivots = (
        large.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= s.pivots)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .where("other <> block")
        .select("cluster", F.col("other").alias("block"), "id", "hashes")
    )
    units = blocked.select("cluster", "block", "id", "hashes").unionAll(pivots)
    inside = materialize(
        units.repartition("cluster", "block").sortWithinPartitions("cluster", "block").mapInArrow(_within(s.num, s.den, forest), "u long, v long"),
        "links",
    )
    if large.isEmpty():
        return inside
    # What the blocks left apart, but for the largest part of each cluster, is compared with all of it.
    parts = connected_components(inside).select(F.col("node").alias("id"), F.col("component").alias("part"))
    labelled = materialize(
        large.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id")), "cluster-parts"
    )
    sizes = labelled.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("cluster").agg(F.max_by("part", F.struct("m", "part")).alias("largest"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    apart = labelled.join(largest.drop("parts"), "cluster").where("part <> largest")
    if apart.isEmpty():
        return inside
    asking = (
        apart.groupBy("cluster").agg(F.expr(f"cast(sum(n) div {s.block} as int) + 1").alias("rows"))
    )
    probes = (
        apart.join(asking, "cluster")
        .withColumn("i", F.pmod(F.xxhash64("id", F.lit(1)), F.col("rows")).cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", "i", "j", F.lit(True).alias("asking"), "id", "part", "hashes")
    )
    asked = (
        labelled.join(asking, "cluster")
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
        .select("cluster", "i", F.col("block").alias("j"), F.lit(False).alias("asking"), "id", "part", "hashes")
    )
    across = (
        probes.unionAll(asked)
        .repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j")
        .mapInArrow(_between(s.num, s.den, bridges), "u long, v long")
    )
    return inside.unionAll(across)


def with_sets(slim: DataFrame, wanted: DataFrame, s: JoinSettings) -> DataFrame:
    """Rows of `wanted` (fa, fb, text_hash and more) with their hashes, from the texts of slim (text_hash, text)."""
    table = slim.sparkSession.sparkContext.broadcast(_bit_table(wanted.select("text_hash"), s.table_bits))
    sets = (
        slim.select("text_hash", "text")
        .mapInArrow(_full_sets(s.width, table, s.table_bits), "fa long, fb long, hashes binary")
        .groupBy("fa", "fb")
        .agg(F.first("hashes").alias("hashes"))
    )
    return wanted.join(sets, ["fa", "fb"])


def joined_apart(rows: DataFrame, moved: DataFrame, copies: int = JoinSettings.copies) -> DataFrame:
    """rows left-joined by (fa, fb) with a stored table that has `copies`. Sets with very many copies are joined
    by broadcast: there is one for each `copies` rows at most, and their rows stay where they are."""
    many = F.broadcast(moved.where(F.col("copies") > copies).drop("copies"))
    few = moved.where(F.col("copies") <= copies).drop("copies")
    rest = rows.join(many.select("fa", "fb"), ["fa", "fb"], "left_anti")
    return rows.join(many, ["fa", "fb"]).unionByName(rest.join(few, ["fa", "fb"], "left"))


def similar_components(docs: DataFrame, s: JoinSettings = JoinSettings()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least doc_id it reaches by links.

    Two rows link when den * |A & B| >= num * |A | B| for their sets of `width`-word shingles, A-Z
    lower-cased; a text of fewer words is one shingle. Null, empty and word-less texts have no
    shingles and link with nothing: component_id is their doc_id.

    Input: doc_id (long) and text; other columns are not read. Repeated rows come out as often as
    they came in. Rows count by what they hold: rows of one doc_id with different texts link each for itself and
    rows without doc_id take part; component_id is null only if no row of the component has a doc_id.
    An empty table gives an empty result; texts of any length are read whole.
    """
    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"), text.alias("text"))
    signatures = materialize(
        slim.mapInArrow(_signatures(s), "doc_id long, text_hash long, n long, fa long, fb long, pool array<long>"), "set-signatures"
    )
    nodes = materialize(
        signatures.where("n > 0")
        .groupBy("fa", "fb", "n")
        .agg(F.min("text_hash").alias("text_hash"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies")),
        "set-nodes",
    )
    wanted = materialize(
        nodes.join(_clusters(signatures, s).withColumnRenamed("node", "fa"), "fa").withColumn("id", F.monotonically_increasing_id()),
        "set-clusters",
    )
    components = connected_components(cluster_links(wanted, slim, s)).select(F.col("node").alias("id"), "component")
    joined = materialize(wanted.join(components, "id").select("fa", "fb", "component", "least_id"), "set-components")
    least = joined.groupBy("component").agg(F.min("least_id").alias("component_id"))
    # Sets without a link or a copy need no looking up.
    moved = (
        nodes.join(joined.drop("least_id").join(least, "component"), ["fa", "fb"], "left")
        .where("copies > 1 or component is not null")
        .select("fa", "fb", "copies", F.when(F.col("component").isNotNull(), F.col("component_id")).otherwise(F.col("least_id")).alias("found"))
    )
    moved = materialize(moved.withColumn("moved", F.lit(True)), "moved")
    found = joined_apart(signatures.select("doc_id", "n", "fa", "fb"), moved, s.copies)
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("moved"), F.col("found")).otherwise(F.col("doc_id")).alias("component_id")
    )
