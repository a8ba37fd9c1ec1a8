"""The prefix tree of conversations, from double-array tries.

1. Turns become 128-bit ids and are numbered within their conversation (range partitions, so a
   conversation of any length spreads). A conversation is cut into segments of 256 turns; what
   lies before a segment is its root. Equal segments under one root collapse to one row.
2. Segments are dealt by root and first turn; a first turn that very many segments share is
   salted. Every task packs its segments into tries of bounded size: turns get dense ids, BASE and
   CHECK are packed over them, and walking all segments through the arrays gives the nodes.
3. A node that several tries share is merged by its key, the chained hash of its turns: members
   add up, the smallest member wins. Its children are counted after that.
4. A node is named by its smallest member and its depth, and a member that is the smallest stays so
   further down. So the tree falls into one vertical path per conversation, hung onto another
   path. Subtree sums are totals of paths, found by doubling, and running sums along a path.

Nothing is held per conversation or per node but in segments and tries of bounded size; the
digest of a node's ends streams over the ids in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sojourn.operators.ranking import positions
from sojourn.sources.scratch import materialize


@dataclass(frozen=True)
class Sizes:
    """What one segment, trie, piece or task holds. Results do not depend on them."""

    #: Turns in a segment.
    band: int = 256
    #: Turns in one trie.
    trie_turns: int = 200_000
    #: Turns under one first turn, or children of one node, after which they are dealt over tasks.
    hot: int = 100_000
    #: Conversation ids in one piece of a digest's input: at most 2 ** this.
    ends_bits: int = 12


_WORDS = r"[^\x20\x09-\x0D]+"
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_P, _Q, _R = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_NODE = (
    "ka long, kb long, pa long, pb long, depth long, words long, n long, conv_id long, e1 long, e2 long"
)


class DoubleArray:
    """A trie over sequences of dense ids 1, 2, ...: the child of state s by id c is BASE[s] + c,
    if CHECK there is s. State 0 is the root; free slots have CHECK -1."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        """Packs sequences flat[offsets[i]:offsets[i + 1]], which must be in lexicographic order."""
        size = int(flat.max(initial=0)) + len(flat) + 2
        self._used = bytearray(size)
        self._used[0] = 1
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self._low, lengths = 1, np.diff(offsets)
        alive, states = np.flatnonzero(lengths > 0), np.zeros(len(lengths), np.int64)
        depth = 0
        while len(alive):
            codes, parents = flat[offsets[alive] + depth], states[alive]
            # Sorted sequences: those that share state and id are neighbours.
            fresh = np.ones(len(alive), bool)
            fresh[1:] = (codes[1:] != codes[:-1]) | (parents[1:] != parents[:-1])
            at = np.flatnonzero(fresh)
            edge_codes, edge_parents = codes[at], parents[at]
            first = np.flatnonzero(np.append(True, edge_parents[1:] != edge_parents[:-1]))
            bases = np.zeros(len(at), np.int64)
            for begin, end in zip(first.tolist(), np.append(first[1:], len(at)).tolist(), strict=True):
                bases[begin:end] = self._place(edge_codes[begin:end].tolist())
            slots = bases + edge_codes
            self._grow(int(slots.max()) + 1)
            self.base[edge_parents], self.check[slots] = bases, edge_parents
            states[alive] = slots[np.cumsum(fresh) - 1]
            depth += 1
            alive = alive[lengths[alive] > depth]

    def _grow(self, size: int) -> None:
        if size > len(self._used):
            self._used.extend(bytes(max(size - len(self._used), len(self._used) // 2)))
        if len(self.base) < len(self._used):
            more = len(self._used) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _place(self, codes: list[int]) -> int:
        """The first base at which all children find free slots; takes them."""
        least, most, used = codes[0], codes[-1], self._used
        slot = from_slot = max(self._low, least + 1)
        while True:
            slot = used.find(0, slot)
            if slot < 0:
                slot = len(used)
            if slot - least + most >= len(used):
                self._grow(slot - least + most + 1)
            base = slot - least
            if not any(used[base + c] for c in codes):
                break
            slot += 1
        for c in codes:
            used[base + c] = 1
        # Everything between was taken, so no later search needs to look there.
        if from_slot == self._low and len(codes) == 1:
            self._low = slot
        return base

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Child states; -1 where the trie has none."""
        slots = self.base[states] + codes
        inside = (codes > 0) & (slots < len(self.check))
        slots = np.where(inside, slots, 0)
        return np.where(inside & (self.check[slots] == states), slots, -1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _Q
    x = (x ^ (x >> np.uint64(32))) * _R
    return x ^ (x >> np.uint64(30))


def _chained(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Keys one level down; column by column, so both halves of 128 bits go their own way."""
    with np.errstate(over="ignore"):
        return _mixed(keys * _P + ids + np.array([1, 2], np.uint64))


def _nodes_of(above: int, root: np.ndarray, flat: np.ndarray, words: np.ndarray, offsets: np.ndarray,
              n: np.ndarray, conv: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    """All nodes of the trie over some segments with one root, `above` turns from the start.
    `flat` holds (a, b) ids as rows; `ends` is (final, e1, e2) per segment."""
    pairs = flat.view([("a", np.uint64), ("b", np.uint64)]).ravel()
    _, first, dense = np.unique(pairs, return_index=True, return_inverse=True)
    codes = dense.astype(np.int64).ravel() + 1
    ids_of, words_of = flat[first], words[first]
    sequences = [codes[b:e].tolist() for b, e in zip(offsets[:-1], offsets[1:], strict=True)]
    order = sorted(range(len(sequences)), key=sequences.__getitem__)
    lengths = np.diff(offsets)[order]
    packed = np.concatenate([codes[:0], *[codes[offsets[i] : offsets[i + 1]] for i in order]])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    trie, n, conv, ends = DoubleArray(packed, bounds), n[order], conv[order], ends[order]

    states = np.zeros(len(order), np.int64)
    with np.errstate(over="ignore"):
        top = _mixed(root.view(np.uint64) + np.array([above, above], np.uint64) * _P)[None, :]
    size = len(trie.check)
    members, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    keys, tails = np.zeros((size, 2), np.uint64), np.full(size, -1, np.int64)
    keys[0] = top[0]
    found, parents, depths, turn_words = [np.zeros(1, np.int64)], [np.full(1, -1)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    alive, depth = np.arange(len(order)), 0
    while True:
        at = states[alive]
        np.add.at(members, at, n[alive])
        np.minimum.at(least, at, conv[alive])
        done = alive[(lengths[alive] == depth) & (ends[alive, 0] == 1)]
        tails[states[done]] = done
        alive = alive[lengths[alive] > depth]
        if not len(alive):
            break
        code = packed[bounds[alive] + depth]
        before, after = states[alive], trie.step(states[alive], code)
        fresh, where = np.unique(after, return_index=True)
        keys[fresh] = _chained(keys[before[where]], ids_of[code[where] - 1])
        states[alive] = after
        depth += 1
        found.append(fresh)
        parents.append(before[where])
        depths.append(np.full(len(fresh), depth))
        turn_words.append(words_of[code[where] - 1])
    node, parent = np.concatenate(found), np.concatenate(parents)
    signed, is_root, tail = keys.view(np.int64), parent < 0, tails[node]

    def masked(values: np.ndarray, empty: np.ndarray) -> pa.Array:
        return pa.array(values, pa.int64(), mask=empty)

    return pa.RecordBatch.from_arrays(
        [
            pa.array(signed[node, 0]), pa.array(signed[node, 1]),
            masked(signed[parent, 0], is_root), masked(signed[parent, 1], is_root),
            pa.array(np.concatenate(depths) + above), pa.array(np.concatenate(turn_words)),
            pa.array(members[node]), pa.array(least[node]),
            masked(ends[tail, 1], tail < 0), masked(ends[tail, 2], tail < 0),
        ],
        ["ka", "kb", "pa", "pb", "depth", "words", "n", "conv_id", "e1", "e2"],
    )


def _tries(size: Sizes):
    """Rows come with equal roots together. A trie ends with its root, its batch or its share of turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            band, ra, rb, n, conv, final, e1, e2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(8))
            lists = batch.column(8)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            a, b, words = (lists.values.field(c).to_numpy() for c in range(3))
            flat = np.stack([a, b], axis=1).view(np.uint64)
            ends = np.stack([final.astype(np.int64), e1, e2], axis=1)
            volume = np.cumsum(np.diff(offsets) + 1) // size.trie_turns
            new = np.ones(len(band), bool)
            new[1:] = (ra[1:] != ra[:-1]) | (rb[1:] != rb[:-1]) | (band[1:] != band[:-1]) | (volume[1:] != volume[:-1])
            at = np.flatnonzero(new)
            for begin, end in zip(at.tolist(), np.append(at[1:], len(band)).tolist(), strict=True):
                lo, hi = offsets[begin], offsets[end]
                yield _nodes_of(
                    int(band[begin]) * size.band, np.array([ra[begin], rb[begin]]), np.ascontiguousarray(flat[lo:hi]),
                    words[lo:hi], offsets[begin : end + 1] - lo, n[begin:end], conv[begin:end], ends[begin:end],
                )

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each end, which come one after the other; a state is all that is kept."""
    key, state = None, None
    for batch in batches:
        done: list[tuple[int, int, str]] = []
        for e1, e2, piece in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            if (e1, e2) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (e1, e2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        yield _digest_rows(done)
    if key is not None:
        yield _digest_rows([(*key, state.hexdigest())])


def _digest_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = [[r[c] for r in rows] for c in range(3)]
    types = [pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], ["e1", "e2", "ends_sha256"])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place, of (its turns), a, b (the 128-bit id of role and text) and words of every turn.

    By turn, null first; equal turn numbers by id. Null role or text count as empty. Rows without
    conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # Stored once without the texts: a range partitioning reads its input twice.
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit("second half"), role, text).alias("b"),
        F.regexp_count(text, F.lit(_WORDS)).cast("long").alias("words"),
    )
    numbered = positions(materialize(turns, "turn-ids"), ["conv_id"], ["turn", "a", "b"], "place", totals={"of": "*"}, label="turns")
    return materialize(numbered.drop("turn"), "numbered-turns")


def rebuilt(numbered: DataFrame, every: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after every conversation c took its first turns from a shared opening.

    They are the first h of conversation c - c % every, all if it has fewer, none if there is no
    such conversation; then follow c's own turns after its first h. h is crc32 of the decimal c,
    modulo most + 1. Turns come as conv_id, depth (from 1), a, b, words; conversations as conv_id, length.
    """
    of = numbered.where("place = 1").select("conv_id", "of")
    openers = of.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("opener"), F.col("of").alias("offered"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    plan = (
        of.withColumn("h", taken)
        .withColumn("opener", F.col("conv_id") - F.col("conv_id") % every)
        .join(openers, "opener", "left")
        .withColumn("head", F.least("h", F.coalesce("offered", F.lit(0).cast("long"))))
    )
    conversations = plan.select("conv_id", (F.col("head") + F.greatest(F.col("of") - F.col("h"), F.lit(0))).alias("length"))
    own = (
        numbered.join(plan.select("conv_id", "h", "head"), "conv_id")
        .where("place > h")
        .select("conv_id", (F.col("place") - F.col("h") + F.col("head")).alias("depth"), "a", "b", "words")
    )
    offered = numbered.where((F.col("conv_id") % every == 0) & (F.col("place") <= most)).withColumnRenamed("conv_id", "opener")
    heads = (
        offered.join(plan.select("opener", "conv_id", "head"), "opener")
        .where("place <= head")
        .select("conv_id", F.col("place").alias("depth"), "a", "b", "words")
    )
    return own.unionAll(heads), conversations


def _segments(turns: DataFrame, conversations: DataFrame, band: int) -> DataFrame:
    """Every conversation in pieces of `band` turns, the last one shorter (it may be empty), with their roots."""
    cut = F.expr(f"(depth - 1) div {band}")
    items = F.sort_array(F.collect_list(F.struct("depth", "a", "b", "words")))
    slim = F.transform(items, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["words"].alias("words")))
    full = turns.groupBy("conv_id", cut.alias("band")).agg(slim.alias("items"))
    none = F.array().cast("array<struct<a:bigint,b:bigint,words:bigint>>")
    ended = conversations.where(F.col("length") % band == 0).select("conv_id", F.expr(f"length div {band}").alias("band"), none.alias("items"))
    cuts = materialize(
        full.unionAll(ended).withColumns({"s1": F.xxhash64("items"), "s2": F.xxhash64(F.lit(1), F.col("items"))}), "segments"
    )
    whole = (F.col("band") == 0) & (F.size("items") < band)
    zero = F.lit(0).cast("long")
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)

    def upto(*parts: Column | str) -> Column:
        return F.coalesce(F.bit_xor(F.xxhash64(*parts)).over(before), zero)

    short = cuts.where(whole).withColumns({"ra": zero, "rb": zero})
    long = cuts.where(~whole).withColumns({"ra": upto("band", "s1", "s2"), "rb": upto("s2", "band", "s1")})
    return short.unionAll(long)


def _ends(segments: DataFrame, size: Sizes) -> DataFrame:
    """(e1, e2, ends_sha256) of every distinct whole conversation: its conversations' ids, in order."""
    last = segments.where(F.size("items") < size.band).select("conv_id", *_end_key())
    pieces = last.groupBy("e1", "e2", F.shiftright("conv_id", size.ends_bits).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    return (
        pieces.select("e1", "e2", "ids", "piece")
        .repartition("e1", "e2")
        .sortWithinPartitions("e1", "e2", "piece")
        .mapInArrow(_digests, "e1 long, e2 long, ends_sha256 string")
    )


def _end_key() -> list[Column]:
    return [F.xxhash64("band", "ra", "s1").alias("e1"), F.xxhash64("rb", "s2", "band").alias("e2")]


def _merged_nodes(segments: DataFrame, size: Sizes) -> DataFrame:
    """Nodes of all tries, one row per key."""
    root = ["band", "ra", "rb"]
    groups = segments.groupBy(*root, "s1", "s2").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.first("items").alias("items")
    )
    groups = materialize(groups.withColumn("first", F.coalesce(F.try_element_at("items", F.lit(1))["a"], F.lit(0))), "segment-groups")
    # One row for each `hot` turns at most, so this is small whatever the input.
    hot = (
        groups.groupBy(*root, "first")
        .agg(F.expr(f"sum(size(items)) div {size.hot} + 1").cast("int").alias("salts"))
        .where("salts > 1")
    )
    dealt = groups.join(F.broadcast(hot), [*root, "first"], "left").withColumn(
        "salt", F.pmod(F.xxhash64("s1", "s2"), F.coalesce("salts", F.lit(1)))
    )
    columns = [*root, "n", "conv_id", (F.size("items") < size.band).alias("final"), *_end_key(), "items"]
    tries = (
        dealt.repartition(*root, "first", "salt")
        .sortWithinPartitions(*root, "first")
        .select(*columns)
        .mapInArrow(_tries(size), _NODE)
    )
    same = ["pa", "pb", "depth", "words"]
    merged = tries.groupBy("ka", "kb").agg(
        *[F.first(c).alias(c) for c in same],
        F.sum("n").alias("n"),
        F.min("conv_id").alias("conv_id"),
        F.max("e1").alias("e1"),
        F.max("e2").alias("e2"),
    )
    return materialize(merged, "trie-nodes")


def _linked(nodes: DataFrame, size: Sizes) -> DataFrame:
    """Nodes by (conv_id, depth), with parent and number of children."""
    children = nodes.where("pa is not null").groupBy("pa", "pb").agg(F.count(F.lit(1)).alias("n_children"))
    children = materialize(children, "children")
    # One row for each `hot` nodes at most.
    hot = F.broadcast(children.where(F.col("n_children") > size.hot).select("pa", "pb", F.expr(f"cast(n_children div {size.hot} + 1 as int)").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    counted = nodes.join(children.select(F.col("pa").alias("ka"), F.col("pb").alias("kb"), "n_children"), ["ka", "kb"], "left")
    parents = (
        nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
        .join(children.select("pa", "pb"), ["pa", "pb"], "left_semi")
        .join(hot, ["pa", "pb"], "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("salts")
    )
    salted = counted.where("pa is not null").join(hot, ["pa", "pb"], "left").withColumn("salt", F.pmod(F.xxhash64("ka", "kb"), salts).cast("int"))
    columns = ["conv_id", "depth", "parent_conv_id", "words", "n", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "e1", "e2"]
    inner = salted.join(parents, ["pa", "pb", "salt"]).select(*columns)
    roots = counted.where("pa is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns)
    # Where conversations go on past a segment, its last node and the next one's root are the same node.
    every = materialize(inner.unionAll(roots), "linked-nodes")
    cut = (F.col("depth") > 0) & (F.col("depth") % size.band == 0)
    joined = every.where(cut).groupBy("conv_id", "depth").agg(
        *[F.max(c).alias(c) for c in ("parent_conv_id", "words", "n")],
        F.sum("n_children").alias("n_children"),
        *[F.max(c).alias(c) for c in ("e1", "e2")],
    )
    return every.where(~cut).unionAll(joined)


def _path_totals(paths: DataFrame) -> DataFrame:
    """(path, leaves, saved) of each path and all paths hung below it; up is the path it hangs on.

    After k rounds sums reach 2^k paths down, and up points as far up.
    """
    state = materialize(paths.select("path", "up", "leaves", "saved"), "paths")
    while not state.where("up is not null").isEmpty():
        below = state.where("up is not null").groupBy(F.col("up").alias("path")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        # A path that hangs on the root's path has none further up, so it needs no looking up.
        higher = state.where("up is not null").select(F.col("path").alias("up"), F.col("up").alias("higher"))
        zero = F.lit(0).cast("long")
        state = materialize(
            state.join(below, "path", "left")
            .join(higher, "up", "left")
            .select(
                "path",
                F.col("higher").alias("up"),
                (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"),
            ),
            "paths",
        )
    return state.select("path", "leaves", "saved")


def prefix_nodes(turns: DataFrame, conversations: DataFrame, size: Sizes = Sizes()) -> DataFrame:
    """One row per distinct prefix of the conversations, from the empty one down.

    Input: turns as conv_id, depth (1, 2, ... without gaps), a, b (id) and words; conversations as
    conv_id and length, also those without turns. Output, all long but the last: conv_id (smallest
    member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. No conversations give no rows, not even a root.
    """
    segments = _segments(turns, conversations, size.band)
    tree = materialize(_linked(_merged_nodes(segments, size), size), "tree")
    own = tree.withColumns(
        {"leaf": (F.col("n_children") == 0).cast("long"), "gain": (F.col("n") - 1) * F.col("words")}
    )
    paths = materialize(
        own.groupBy(F.col("conv_id").alias("path")).agg(
            F.sum("leaf").alias("leaves"),
            F.sum("gain").alias("saved"),
            F.min("depth").alias("top"),
            F.min_by("parent_conv_id", "depth").alias("up"),
        ),
        "own-paths",
    )
    hung = (
        _path_totals(paths)
        .join(paths.select("path", "top", "up"), "path")
        .where("up is not null")
        .groupBy(F.col("up").alias("conv_id"), (F.col("top") - 1).alias("depth"))
        .agg(F.sum("leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved"))
    )
    zero = F.lit(0).cast("long")
    weighed = own.join(hung, ["conv_id", "depth"], "left").withColumns(
        {"leaf": F.col("leaf") + F.coalesce("hung_leaves", zero), "gain": F.col("gain") + F.coalesce("hung_saved", zero)}
    )
    summed = positions(
        weighed.drop("hung_leaves", "hung_saved", "words"),
        ["conv_id"],
        ["depth"],
        running={"leaves_upto": "leaf", "gain_upto": "gain"},
        totals={"leaves": "leaf", "gains": "gain"},
        label="tree-paths",
    )
    columns = [
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        (F.col("leaves") - F.col("leaves_upto") + F.col("leaf")).alias("n_leaves"),
        (F.col("gains") - F.col("gain_upto") + F.col("gain")).alias("saved_tokens"),
    ]
    inside = summed.where("e1 is null").select(*columns, F.lit(_NO_ENDS).alias("ends_sha256"))
    return inside.unionAll(summed.where("e1 is not null").join(_ends(segments, size), ["e1", "e2"]).select(*columns, "ends_sha256"))
