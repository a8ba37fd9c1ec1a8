"""Benchmark decontamination by the q-gram lemma.

Texts are reduced to lower-case letters and digits with single spaces. A benchmark item leaks
into a document where a window of the item (`window` characters, or the whole of a shorter
item, at any start) aligns with some place of the document in at most `budget` edits per character.

Such an alignment keeps m - q + 1 - e * q of the window's q-grams, all on diagonals at most e
apart. So the shared q-grams of document and item are counted in bands of diagonals, any two
neighbouring bands together; regions and windows with fewer are impossible, the others are
aligned in a band around their diagonals, unless they stand in the document as they are.
Nothing else is filtered: the result is that of aligning all windows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sojourn.llm.rows import keep_rows


@dataclass(frozen=True)
class LeakSettings:
    """`block_chars` bounds the benchmark text that is searched for in one pass over the documents."""

    q: int = 8
    window: int = 100
    budget: float = 0.08
    shortest: int = 24
    block_chars: int = 1_000_000

    def edits(self, length: int) -> int:
        return int(self.budget * length + 1e-9)


#: Characters of a document looked at together.
PIECE = 1 << 20
_FILTER_BITS = 22
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case where that is one character, and whether it is a letter or digit."""
    lower = np.fromiter((ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x110000)), np.uint32, 0x110000)
    return lower, np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def reduced(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(code points, their places in the text): lower-case letters and digits, single spaces between."""
    lower, visible = _tables()
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    shown = visible[codes]
    keep = shown.copy()
    keep[1:] |= shown[:-1]
    at = np.flatnonzero(keep)
    codes = np.where(shown, lower[codes], np.uint32(32))[at]
    if len(codes) and codes[-1] == 32:
        codes, at = codes[:-1], at[:-1]
    return codes, at


def pieces(text: str, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The reduced text in pieces, each beginning with the last `overlap` reduced characters of the one before."""
    codes, at = np.empty(0, np.uint32), np.empty(0, np.int64)
    for offset in range(0, len(text), PIECE):
        more, places = reduced(text[offset : offset + PIECE])
        if not len(more):
            continue
        places = places + offset
        codes, at = codes[-overlap:], at[-overlap:]
        if len(at) and places[0] > at[-1] + 1:
            codes, at = np.append(codes, np.uint32(32)), np.append(at, at[-1] + 1)
        codes, at = np.concatenate([codes, more]), np.concatenate([at, places])
        yield codes, at


def q_grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of each run of q code points."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    # Hashes of runs of 1, 2, 4 ... code points, put together by the bits of q.
    power, size, out, done = codes.astype(np.uint64), 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            if q & size:
                part = power[done : done + len(codes) - q + 1]
                out = part if out is None else out * _A + part
                done += size
            size *= 2
            if size > q:
                return (out ^ (out >> np.uint64(32))) * _A
            power = (power[: len(power) - size // 2] * _A) ^ power[size // 2 :]
            power = power * _B


@dataclass
class Region:
    """Two neighbouring bands of diagonals of one item: the least diagonal, the windows that can leak
    there, and the shared q-grams by place in the item and diagonal."""

    item: int
    diagonal: int
    windows: np.ndarray
    places: np.ndarray
    diagonals: np.ndarray


@dataclass
class Index:
    """The q-grams of one block of items, sorted by hash."""

    items: np.ndarray
    codes: list[np.ndarray]
    grams: np.ndarray
    item_of: np.ndarray
    place: np.ndarray
    present: np.ndarray
    settings: LeakSettings

    @staticmethod
    def build(items: Sequence[tuple[int | None, str | None]], settings: LeakSettings) -> Index:
        kept = [(i, c) for i, t in items if t and len(c := reduced(t)[0]) >= settings.shortest]
        grams = [q_grams(c, settings.q) for _, c in kept]
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        present = np.zeros(1 << _FILTER_BITS, bool)
        present[flat >> np.uint64(64 - _FILTER_BITS)] = True
        sizes = np.array([len(g) for g in grams], np.int64)
        return Index(
            np.array([i for i, _ in kept], object),
            [c for _, c in kept],
            flat[order],
            np.repeat(np.arange(len(kept)), sizes)[order].astype(np.int32),
            (np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order].astype(np.int32),
            present,
            settings,
        )

    def regions(self, codes: np.ndarray) -> list[Region]:
        """Every pair of neighbouring bands that can hold a leak, with the item's windows to align there."""
        s = self.settings
        hashes = q_grams(codes, s.q)
        maybe = np.flatnonzero(self.present[hashes >> np.uint64(64 - _FILTER_BITS)])
        low = np.searchsorted(self.grams, hashes[maybe], "left")
        n = np.searchsorted(self.grams, hashes[maybe], "right") - low
        maybe, low, n = maybe[n > 0], low[n > 0], n[n > 0]
        # A leak has at least that many of the item's q-grams within the length it can take up.
        least, reach = int(self._least.min()), s.window + s.edits(s.window)
        dense = np.zeros(len(maybe) + 1, np.int64)
        first = np.flatnonzero(maybe[least - 1 :] - maybe[: max(0, len(maybe) - least + 1)] <= reach)
        np.add.at(dense, first, 1)
        np.add.at(dense, first + least, -1)
        near = np.cumsum(dense[:-1]) > 0
        maybe, low, n = maybe[near], low[near], n[near]
        if not len(maybe):
            return []
        entry = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        item, place = self.item_of[entry], self.place[entry]
        diagonal = np.repeat(maybe, n) - place
        # Bands of one item follow each other; the room between items fits any text of this length.
        below = max(map(len, self.codes)) // self._width() + 3
        room = len(codes) // self._width() + below + 3
        keys = item.astype(np.int64) * room + diagonal // self._width() + below
        key, count = np.unique(keys, return_counts=True)
        both = np.concatenate([key, key - 1])
        start = np.unique(both)
        total = np.zeros(len(start), np.int64)
        for k in (key, key - 1):
            total[np.searchsorted(start, k)] += count
        which = start // room
        start = start[total >= self._least[np.clip(which, 0, len(self.codes) - 1)]]
        if not len(start):
            return []
        order = np.argsort(keys, kind="stable")
        keys, place, diagonal = keys[order], place[order], diagonal[order]
        begin, middle, end = (np.searchsorted(keys, start + k) for k in range(3))
        out = []
        for k, a, b, c in zip(start.tolist(), begin.tolist(), middle.tolist(), end.tolist(), strict=True):
            found = self._windows(k // room, place[a:c], b - a)
            if len(found):
                out.append(Region(k // room, (k % room - below) * self._width(), found, place[a:c], diagonal[a:c]))
        return out

    def _windows(self, item: int, place: np.ndarray, lower: int) -> np.ndarray:
        """Starts of the item's windows that hold enough of the shared q-grams at these places, of which the
        first `lower` lie in the lower band. A window with none in the upper band is the lower neighbour's."""
        s = self.settings
        length = len(self.codes[item])
        m = min(length, s.window)
        # Only windows that hold one of the places.
        least = max(0, int(place.min()) - (m - s.q))
        most = min(length - m, int(place.max()))
        if most < least:
            return np.empty(0, np.int64)
        size = most - least + m - s.q + 1
        upper = np.bincount(place[lower:] - least, minlength=size)
        counts = np.bincount(place[:lower] - least, minlength=size) + upper
        starts = np.arange(most - least + 1)
        within = [(c := np.concatenate([[0], np.cumsum(x)]))[starts + m - s.q + 1] - c[starts] for x in (counts, upper)]
        return np.flatnonzero((within[0] >= self._least[item]) & (within[1] > 0)) + least

    def _width(self) -> int:
        return self.settings.edits(self.settings.window) + 1

    @functools.cached_property
    def _least(self) -> np.ndarray:
        """Shared q-grams without which no window of the item leaks."""
        s = self.settings
        m = np.minimum([len(c) for c in self.codes], s.window)
        return np.maximum(1, m - s.q + 1 - np.array([s.edits(int(x)) for x in m], np.int64) * s.q)

    def leaks(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item_id, start, end, edits) of every item that leaks into the text, by first place.
        start and end are character offsets that hold the leaking windows, give or take the edits."""
        if not text or not self.codes:
            return []
        found: dict[int, list[int]] = {}
        # As long as any leak, and as far as the bands reach beyond it.
        overlap = self.settings.window + 2 * self._width() + 3 * self.settings.edits(self.settings.window)
        for codes, at in pieces(text, overlap):
            for item, first, last, edits in self._aligned(codes, self.regions(codes)):
                begin, end = int(at[first]), int(at[last]) + 1
                old = found.get(item, [begin, end, edits])
                found[item] = [min(old[0], begin), max(old[1], end), min(old[2], edits)]
        return sorted(((self.items[k], *v) for k, v in found.items()), key=lambda x: (x[1], x[2], str(x[0])))

    def _aligned(self, codes: np.ndarray, regions: list[Region]) -> Iterator[tuple[int, int, int, int]]:
        """(item, first, last, edits) of the windows that align, all windows of a length together."""
        s = self.settings
        work: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for region in regions:
            m = min(len(self.codes[region.item]), s.window)
            starts = region.windows
            for first, last, diagonal in self._copied(codes, region, m):
                yield region.item, first + diagonal, last + diagonal + m - 1, 0
                starts = starts[(starts < first) | (starts > last)]
            for cut in range(0, len(starts), 2000):
                work.setdefault(m, []).append((region.item, region.diagonal, starts[cut : cut + 2000]))
        for m, parts in work.items():
            e = s.edits(m)
            reach = 2 * self._width() + 2 * e
            while parts:
                some, rows = [], 0
                while parts and rows < 2000:
                    some.append(parts.pop())
                    rows += len(some[-1][2])
                windows = np.concatenate([np.lib.stride_tricks.sliding_window_view(self.codes[i], m)[p] for i, _, p in some])
                item = np.repeat([i for i, _, _ in some], [len(p) for _, _, p in some])
                begin = np.concatenate([p + d - e for _, d, p in some])
                place = begin[:, None] + np.arange(m + reach)
                inside = (place >= 0) & (place < len(codes))
                there = np.where(inside, codes[np.clip(place, 0, len(codes) - 1)], np.uint32(0))
                cost = banded_cost(windows, there, reach, e)
                best = cost.argmin(axis=1)
                for k in np.flatnonzero(cost[np.arange(len(cost)), best] <= e):
                    last = min(int(begin[k] + best[k]) + m - 1, len(codes) - 1)
                    yield int(item[k]), max(0, last - m + 1), max(last, 0), int(cost[k, best[k]])

    def _copied(self, codes: np.ndarray, region: Region, m: int) -> Iterator[tuple[int, int, int]]:
        """(first, last, diagonal) of every run of windows that stand in the text as they are."""
        q, own = self.settings.q, self.codes[region.item]
        order = np.lexsort((region.places, region.diagonals))
        place, diagonal = region.places[order].astype(np.int64), region.diagonals[order].astype(np.int64)
        new = np.flatnonzero((np.diff(place) != 1) | (np.diff(diagonal) != 0)) + 1
        for a, b in zip([0, *new.tolist()], [*new.tolist(), len(place)], strict=True):
            if b - a < m - q + 1:
                continue
            first, end, d = int(place[a]), int(place[b - 1]) + q, int(diagonal[a])
            # Equal hashes are no proof.
            if np.array_equal(own[first:end], codes[first + d : end + d]):
                yield first, end - m, d


def banded_cost(pattern: np.ndarray, text: np.ndarray, width: int, most: int | None = None) -> np.ndarray:
    """Edits to align each pattern row so that it ends on each of `width` diagonals of its text
    row, beginning on any of them. Rows that can't stay within `most` edits may be given up: they have most + 1."""
    rows, length = pattern.shape
    kind = np.int16 if length + width < 30_000 else np.int64
    # Diagonals by rows, so that every step runs along whole arrays.
    pattern, text = np.ascontiguousarray(pattern.T), np.ascontiguousarray(text.T)
    alive, cost = np.arange(rows), np.zeros((width, rows), kind)
    shifts = [kind(1 << k) for k in range((width - 1).bit_length())]
    out = None if most is None else np.full((width, rows), most + 1, kind)
    for i in range(length):
        new = cost + (text[i : i + width] != pattern[i])
        np.minimum(new[:-1], cost[1:] + 1, out=new[:-1])
        # A further character of the text costs one to the right: by runs of 1, 2, 4 ... of them.
        for k in shifts:
            np.minimum(new[k:], new[:-k] + k, out=new[k:])
        cost = new
        if out is not None and i % 8 == 7:
            good = cost.min(axis=0) <= most
            if 4 * good.sum() < 3 * len(good):
                alive, cost, pattern, text = alive[good], cost[:, good], pattern[:, good], text[:, good]
    if out is None:
        return cost.T
    out[:, alive] = cost
    return out.T


def _blocks(benchmark: DataFrame, settings: LeakSettings) -> Iterator[Index]:
    """Indexes of at most block_chars characters (or one item), read one block at a time."""
    block, chars = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for item_id, text in rows.toLocalIterator():
        if block and chars + len(text or "") > settings.block_chars:
            yield Index.build(block, settings)
            block, chars = [], 0
        block.append((item_id, text))
        chars += len(text or "")
    if block:
        yield Index.build(block, settings)


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings()) -> DataFrame:
    """One row per document row and benchmark item that leaks into it: doc_id, item_id, start, end, edits.

    Input: doc_id and text, item_id and text; other columns are not read. Null and empty texts
    leak nothing and are leaked into by nothing, nor are items shorter than `shortest` reduced
    characters. Repeated rows and items each give their own rows. Empty tables give an empty
    result. Whole texts are searched. Null ids pass through.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, start long, end long, edits int"
    out = spark.createDataFrame([], schema)
    for index in _blocks(benchmark, settings):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (doc_id, *leak)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for leak in shared.value.leaks(text)
                ]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "item_id", "start", "end", "edits"],
                )

        out = out.unionAll(slim.mapInArrow(run, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings()) -> DataFrame:
    """The rows into which no item leaks, with all their columns."""
    for index in _blocks(benchmark, settings):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = keep_rows(docs, lambda texts, shared=shared: [not shared.value.leaks(t) for t in texts])
    return docs
