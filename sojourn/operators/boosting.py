"""Boosted trees on binned rows, many models over one table.

A row is a string of bins, one byte per input. Trees grow best leaf first from histograms of
gradients, curvatures and rows, which are sums of whole numbers: they come out the same in any
order, so a model does not depend on how rows are spread. Equal rows are one row with their number. A model
whose different rows fit a task is grown there, all such models at once, leaf by leaf; a larger one takes a Spark job per
level of a tree, in which every task sums its rows and the driver sees histograms only. Both make the same
trees. Of two new leaves only the smaller one is summed; the other is what is left of the leaf they come from.
"""

from __future__ import annotations

import json
import math
from collections.abc import Generator, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sojourn.sources.scratch import materialize

BINS, MISSING = 256, 255
#: Gradients are rounded to this part of one. A task adds up to 2 ** 29 of them without rounding again.
SCALE, MOST_IN_TASK = float(1 << 24), 1 << 29
#: Least curvature of a leaf, and rows of curvature that draw a rare category to the middle of the order.
MIN_CURVATURE, SMOOTHING = 1e-3, 10.0
#: Bins up to which inputs count as having few, and cells of the histograms that several inputs share.
FEW_BINS, CELLS = 64, 2048
FITS = "fit"
_HISTOGRAMS = "fit string, sums binary, loss long"


@dataclass(frozen=True)
class BoostSettings:
    rounds: int = 400
    step: float = 0.05
    leaves: int = 31
    depth: int | None = None
    least_rows: int = 40
    l2: float = 1.0
    patience: int = 25
    #: Inputs whose bins are codes without an order.
    nominal: tuple[int, ...] = ()
    #: Rows of different bins up to which a model is grown in one task, and trees after which a larger one stores its margins.
    rows_in_task: int = 1_000_000
    block: int = 10


@dataclass
class Tree:
    """Nodes as columns. feature is -1 at leaves; left holds, per node, the bins that go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    left: list[bytes] = field(default_factory=lambda: [b""])
    children: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, goes_left: np.ndarray) -> tuple[int, int]:
        low = len(self.feature)
        self.feature[node], self.left[node], self.children[node] = feature, np.packbits(goes_left).tobytes(), (low, low + 1)
        for _ in range(2):
            self.feature.append(-1)
            self.left.append(b"")
            self.children.append((0, 0))
            self.value.append(0.0)
        return low, low + 1

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        at, waiting = np.zeros(len(bins), np.int64), [(0, np.arange(len(bins)))]
        while waiting:
            node, rows = waiting.pop()
            if self.feature[node] < 0:
                at[rows] = node
            else:
                waiting += zip(self.children[node], self.parted(node, bins, rows), strict=True)
        return at

    def parted(self, node: int, bins: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the given rows of a node, those that go left and those that go right."""
        goes_left = np.unpackbits(np.frombuffer(self.left[node], np.uint8)).astype(bool).take(bins[:, self.feature[node]].take(rows))
        return rows[goes_left], rows[~goes_left]

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


@dataclass
class Boosted:
    """A start on the log-odds and the trees that are added to it."""

    start: float
    trees: list[Tree]

    @property
    def getNumTrees(self) -> int:  # noqa: N802 - as ensembles in Spark name it
        return len(self.trees)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.start)
        for tree in self.trees:
            out += tree.margins(bins)
        return out

    def dump(self) -> str:
        trees = [[t.feature, [x.hex() for x in t.left], t.children, t.value] for t in self.trees]
        return json.dumps({"start": self.start, "trees": trees})

    @classmethod
    def load(cls, text: str) -> Boosted:
        raw = json.loads(text)
        trees = [Tree(f, [bytes.fromhex(x) for x in left], [tuple(c) for c in children], v) for f, left, children, v in raw["trees"]]
        return cls(raw["start"], trees)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-z))


def places_of(names: Sequence[str] | pa.Array) -> list[tuple[str, np.ndarray]]:
    """Every name with the places where it stands."""
    coded = (names if isinstance(names, pa.Array) else pa.array(names, pa.string())).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return [(f, np.flatnonzero(codes == k)) for k, f in enumerate(coded.dictionary.to_pylist())]


def packed_rows(bins: np.ndarray) -> pa.Array:
    """Rows of bins as binary values."""
    offsets = np.arange(len(bins) + 1, dtype=np.int32) * np.int32(bins.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(bins))])


def bins_of(packed: pa.Array, inputs: int) -> np.ndarray:
    """Rows of bins from binary values of equal length."""
    if not len(packed):
        return np.empty((0, inputs), np.uint8)
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    return np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(packed), inputs)


def stopping_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(best round, whether `patience` rounds without a better one followed it), counting from 1."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


# --- one tree ----------------------------------------------------------------------------


@dataclass
class _Leaf:
    """What a histogram says about a leaf: its value and its best split."""

    value: float
    gain: float = 0.0
    feature: int = -1
    goes_left: np.ndarray | None = None


def best_split(sums: np.ndarray, s: BoostSettings) -> _Leaf:
    return best_splits(sums[None], s)[0]


def widths_of(sums: np.ndarray) -> np.ndarray:
    """By input, the bins up to the last one with a row, without that for missing."""
    return (sums[..., 2].any(axis=0)[:, :MISSING] * np.arange(1, BINS)).max(axis=1)


def best_splits(sums: np.ndarray, s: BoostSettings, widths: np.ndarray | None = None) -> list[_Leaf]:
    """`sums` holds gradient, curvature and rows by (leaf, input, bin). `widths` are those of the leaves or of one above them."""
    leaves = len(sums)
    counts = sums[..., 2]
    total = sums[:, 0].sum(axis=1).astype(np.float64)
    total[:, :2] /= SCALE
    # Most inputs have few bins; those are looked at apart, without the bins that none of them has.
    widths = widths_of(sums) if widths is None else widths
    few = widths <= FEW_BINS
    cuts = [_Cuts(sums, np.flatnonzero(x), int(widths[x].max()), total, s) for x in (few, ~few) if x.any()]
    out = []
    for k in range(leaves):
        leaf = _Leaf(-s.step * total[k, 0] / (total[k, 1] + s.l2))
        out.append(leaf)
        # Of equal gains the first input's.
        bests = [max(((c.gains[way][k], -c.place(way, k)[0], c) for c in cuts), key=lambda x: x[:2]) for way in (0, 1)]
        with_missing = bool(bests[1][0] > bests[0][0] + 1e-12)
        gain, _, found = bests[with_missing]
        leaf.gain = float(gain)
        if leaf.gain <= 1e-12:
            leaf.gain = 0.0
            continue
        leaf.feature, there, here = found.chosen(with_missing, k)
        goes_left = np.zeros(BINS, bool)
        goes_left[there] = True
        if leaf.feature in s.nominal:
            # Codes without a row here go with the greater part.
            goes_left[counts[k, leaf.feature] == 0] = here * 2 >= total[k, 2]
        elif counts[k, leaf.feature, MISSING]:
            goes_left[MISSING] = with_missing
        else:
            goes_left[MISSING] = here * 2 >= total[k, 2]
        leaf.goes_left = goes_left
    return out


class _Cuts:
    """Gains of all cuts of some inputs, of which only the first `width` bins and that for missing have rows."""

    def __init__(self, sums: np.ndarray, inputs: np.ndarray, width: int, total: np.ndarray, s: BoostSettings):
        self.inputs, self.bins = inputs, np.append(np.arange(width), MISSING)
        leaves, last = len(sums), width
        parts = sums[:, inputs[:, None], self.bins].transpose(3, 0, 1, 2).astype(np.float64, order="C")
        parts[:2] /= SCALE
        # Codes are ordered by their mean gradient (missing is one of them), numbers as they are, with the missing apart.
        self.order = np.tile(np.arange(width + 1), (leaves, len(inputs), 1))
        nominal = np.array([k in s.nominal for k in inputs.tolist()])
        if nominal.any():
            codes = parts[:, :, nominal]
            g, h, n = codes
            order = np.argsort(np.where(n > 0, g / (h + SMOOTHING), np.inf), axis=2, kind="stable")
            self.order[:, nominal] = order
            parts[:, :, nominal] = np.take_along_axis(codes, order[None], axis=3)
        self.missing = np.zeros((3, leaves, len(inputs), 1))
        self.missing[:, :, ~nominal, 0] = parts[:, :, ~nominal, last]
        parts[:, :, ~nominal, last] = 0
        self.left = np.cumsum(parts, axis=3)
        whole = total.T[:, :, None, None]
        alone = whole[0] ** 2 / (whole[1] + s.l2)
        self.gains, self._places = [], []
        # Where nothing is missing both sides come to the same.
        for here in (self.left, self.left + self.missing) if self.missing[2].any() else (self.left,):
            there = whole - here
            ok = (np.minimum(here[2], there[2]) >= s.least_rows) & (np.minimum(here[1], there[1]) >= MIN_CURVATURE)
            gain = np.where(ok, here[0] ** 2 / (here[1] + s.l2) + there[0] ** 2 / (there[1] + s.l2) - alone, 0.0).reshape(leaves, -1)
            self._places.append(gain.argmax(axis=1))
            self.gains.append(gain[np.arange(leaves), self._places[-1]])
        self.gains, self._places = (x * 2 if len(x) == 1 else x for x in (self.gains, self._places))

    def place(self, way: int, k: int) -> tuple[int, int]:
        """Input and cut of a leaf's best split, with the missing on the right (0) or on the left (1)."""
        at, cut = divmod(int(self._places[way][k]), len(self.bins))
        return int(self.inputs[at]), cut

    def chosen(self, way: int, k: int) -> tuple[int, np.ndarray, float]:
        """Input, bins that go left, and rows that do."""
        at, cut = divmod(int(self._places[way][k]), len(self.bins))
        here = self.left[2, k, at, cut] + (self.missing[2, k, at, 0] if way else 0)
        return int(self.inputs[at]), self.bins[self.order[k, at, : cut + 1]], here


Asked = tuple[list[Tree], Tree, list[int]]


def _one_tree(trees: list[Tree], root: np.ndarray, s: BoostSettings, ahead: bool) -> Generator[Asked, tuple[np.ndarray, int], Tree | None]:
    """Grows best leaf first. With `ahead`, leaves that may be split soon are split before their turn, so that one pass
    serves a whole level; what the order did not get to is cut off again."""
    widths = widths_of(root[None])
    tree, known = Tree(), {0: best_splits(root[None], s, widths)[0]}
    depth, sums_of, place = {0: 0}, {0: root}, {0: 1}
    if known[0].gain <= 0:
        return None

    def following(queue: list[int]) -> int | None:
        """The leaf that gains most; of equal ones that nearest to the root, then the leftmost. Others that cannot be split go."""
        while queue:
            node = max(queue, key=lambda k: (known[k].gain, -place[k]))
            if known[node].gain > 0 and (s.depth is None or depth[node] < s.depth):
                return node
            queue.remove(node)
        return None

    queue, splits = [0], []
    while True:
        while len(splits) < s.leaves - 1 and (node := following(queue)) is not None and tree.feature[node] >= 0:
            queue.remove(node)
            splits.append(node)
            queue += tree.children[node]
        if len(splits) >= s.leaves - 1 or node is None:
            return _pruned(tree, set(splits), known)
        asked = [node]
        if ahead:
            # Which of the others come next depends on leaves not yet known.
            later, used = [k for k in queue if k != node], len(splits) + 1
            while used < s.leaves - 1 and (node := following(later)) is not None:
                later.remove(node)
                used += 1
                if tree.feature[node] < 0:
                    asked.append(node)
                else:
                    later += tree.children[node]
        fresh: list[int] = []
        smaller: dict[int, tuple[int, np.ndarray]] = {}
        for node in asked:
            feature, goes_left, whole = known[node].feature, known[node].goes_left, sums_of.pop(node)
            pair = tree.split(node, feature, goes_left)
            depth |= dict.fromkeys(pair, depth[node] + 1)
            place |= {pair[0]: 2 * place[node], pair[1]: 2 * place[node] + 1}
            fresh += pair
            few, many = pair if whole[feature, goes_left, 2].sum() * 2 <= whole[feature, :, 2].sum() else pair[::-1]
            smaller[few] = many, whole
        sums, _ = yield trees, tree, list(smaller)
        for few, found in zip(smaller, sums, strict=True):
            many, whole = smaller[few]
            sums_of |= {few: found, many: whole - found}
        known |= dict(zip(fresh, best_splits(np.stack([sums_of[k] for k in fresh]), s, widths), strict=True))


def _pruned(tree: Tree, splits: set[int], known: dict[int, _Leaf]) -> Tree:
    out, waiting = Tree(), [(0, 0)]
    while waiting:
        old, new = waiting.pop()
        if old in splits:
            pair = out.split(new, tree.feature[old], np.unpackbits(np.frombuffer(tree.left[old], np.uint8)).astype(bool))
            waiting += zip(tree.children[old], pair, strict=True)
        else:
            out.value[new] = known[old].value
    return out


def _growing(judged: bool, s: BoostSettings, ahead: bool = True) -> Generator[Asked, tuple[np.ndarray, int], list[Tree]]:
    """Asks for the histograms of some leaves of a tree, on top of the trees so far, until the model is
    done. A root comes with the loss of the held-back rows under the trees so far. Splitting `ahead` asks for more in
    fewer steps; the trees are the same."""
    trees: list[Tree] = []
    losses: list[int] = []
    while True:
        sums, loss = yield trees, Tree(), [0]
        if trees:
            losses.append(loss)
        best, settled = stopping_round(losses, s.patience) if judged and losses else (len(trees), False)
        if settled or len(trees) >= s.rounds:
            return trees[:best]
        tree = yield from _one_tree(trees, sums[0], s, ahead)
        if tree is None:
            return trees[:best]
        trees = [*trees, tree]


# --- rows --------------------------------------------------------------------------------


class _Rows:
    """Rows of one task with what the trees so far make of them. `n` says how many rows each stands for."""

    def __init__(
        self, bins: np.ndarray, y: np.ndarray, held_back: np.ndarray, margin: np.ndarray, n: np.ndarray | None = None, cells: int = CELLS
    ):
        n = np.ones(len(bins)) if n is None else n.astype(np.float64)
        self._begin(bins, [np.where(side, n, 0.0) for side in _sides(y, held_back)], margin, cells)

    @classmethod
    def merged(cls, bins: np.ndarray, y: np.ndarray, held_back: np.ndarray, start: float, n: np.ndarray) -> _Rows:
        """Rows with equal bins as one, whatever their labels, held back or not: trees give them the same margin."""
        of = np.zeros((len(bins), -(-bins.shape[1] // 8) * 8), np.uint8)
        of[:, : bins.shape[1]] = bins
        words = of.view(np.uint64)
        order = np.lexsort(words.T)
        words = words[order]
        new = np.append(True, (words[1:] != words[:-1]).any(axis=1))[: len(bins)]
        at = np.cumsum(new) - 1
        counts = [np.bincount(at, np.where(side, n, 0)[order], int(new.sum())) for side in _sides(y, held_back)]
        out = cls.__new__(cls)
        out._begin(bins[order[new]], counts, np.full(int(new.sum()), start), CELLS)
        return out

    def _begin(self, bins: np.ndarray, counts: list[np.ndarray], margin: np.ndarray, cells: int) -> None:
        """`counts` are by row the number of fitted zeros and ones, and of held-back zeros and ones."""
        self.bins, self.margin, self.trees = np.asfortranarray(bins), margin, 0
        self._zeros, self._ones = counts[:2]
        self._n = self._zeros + self._ones
        self._judging = [(rows, held[rows].astype(np.int64), sign) for held, sign in zip(counts[2:], (1.0, -1.0), strict=True) if len(rows := np.flatnonzero(held))]
        self._joint = _joint_inputs(self.bins, cells)
        self._root_counts = [np.bincount(place, self._n, math.prod(map(len, values))) for _, values, place in self._joint]
        self._tree: Tree | None = None
        self._leaves: dict[int, np.ndarray] = {}
        self._fresh()

    def add(self, trees: list[Tree]) -> None:
        """Takes over the trees that are new since the last call."""
        if len(trees) > self.trees:
            for added in trees[self.trees :]:
                self.margin = self.margin + self._added(added)
            self.trees = len(trees)
            self._fresh()

    def _added(self, added: Tree) -> np.ndarray:
        """What a tree adds to the margins. Rows lie by leaf already if it is the one that grew last, some leaves apart."""
        grown, out, waiting = self._tree, np.empty(len(self.bins)), [(0, 0)]
        while waiting:
            node, there = waiting.pop()
            if added.feature[node] < 0:
                under = [there]
                while under:
                    if (k := under.pop()) in self._leaves:
                        out[self._leaves[k]] = added.value[node]
                    else:
                        under += grown.children[k]
            elif grown is None or there in self._leaves or (grown.feature[there], grown.left[there]) != (added.feature[node], added.left[node]):
                return added.margins(self.bins)
            else:
                waiting += zip(added.children[node], grown.children[there], strict=True)
        return out

    def _fresh(self) -> None:
        p = _sigmoid(self.margin)
        self._g = np.rint(p * SCALE) * self._zeros + np.rint((p - 1.0) * SCALE) * self._ones
        self._h = np.rint(p * (1 - p) * SCALE) * self._n

    def loss(self) -> int:
        """Of the held-back rows, as a whole number."""
        total = 0
        for rows, n, sign in self._judging:
            losses = np.rint(np.logaddexp(0.0, sign * self.margin[rows]) * SCALE).astype(np.int64)
            total += int((losses * n).sum())
        return total

    def _rows_of(self, tree: Tree) -> dict[int, np.ndarray]:
        """Rows by leaf. While a tree grows only the leaves split since the last call are parted."""
        if tree is not self._tree:
            self._tree, self._leaves = tree, {0: np.arange(len(self.bins))}
        waiting = [k for k in self._leaves if tree.feature[k] >= 0]
        while waiting:
            node = waiting.pop()
            pair = tree.children[node]
            self._leaves |= zip(pair, tree.parted(node, self.bins, self._leaves.pop(node)), strict=True)
            waiting += [k for k in pair if tree.feature[k] >= 0]
        return self._leaves

    def sums(self, tree: Tree, wanted: list[int]) -> np.ndarray:
        """Histograms of the fitted rows of the wanted leaves, as whole numbers."""
        leaves = self._rows_of(tree)
        out = np.zeros((len(wanted), self.bins.shape[1], BINS, 3), np.int64)
        for k, leaf in enumerate(wanted):
            rows, weights = leaves[leaf], (self._g, self._h, self._n)
            if leaf:
                weights = [w.take(rows) for w in weights]
            for (inputs, values, place), root_counts in zip(self._joint, self._root_counts, strict=True):
                shape = [len(v) for v in values]
                cells = np.empty((3, math.prod(shape)))
                here = place.take(rows) if leaf else place
                for i in range(3):
                    # How many rows the root has does not change from tree to tree.
                    cells[i] = root_counts if i == 2 and not leaf else np.bincount(here, weights[i], cells.shape[1])
                for f, bins, found in zip(inputs, values, _along_each(cells.reshape(3, *shape)), strict=True):
                    out[k, f, bins] = found.T
        return out

    def answer(self, trees: list[Tree], tree: Tree, wanted: list[int]) -> tuple[np.ndarray, int]:
        self.add(trees)
        return self.sums(tree, wanted), self.loss() if wanted == [0] else 0


def _sides(y: np.ndarray, held_back: np.ndarray) -> list[np.ndarray]:
    """Which rows are fitted zeros, fitted ones, held-back zeros and held-back ones."""
    return [(held_back == held) & ((y > 0) == one) for held in (False, True) for one in (False, True)]


def _along_each(cells: np.ndarray) -> list[np.ndarray]:
    """For every axis but the first, the sums over the others but the first."""
    out = []
    while cells.ndim > 2:
        out.append(cells.reshape(*cells.shape[:2], -1).sum(axis=2))
        cells = cells.sum(axis=1)
    return [*out, cells]


def _joint_inputs(bins: np.ndarray, cells: int) -> list[tuple[list[int], list[np.ndarray], np.ndarray]]:
    """Inputs put together so that the bins they have make up to `cells` combinations: (inputs, their bins, the rows'
    combinations). One count by combination serves all of them, and whole numbers add up to the same sums."""
    values = [np.flatnonzero(np.bincount(bins[:, f], minlength=BINS)) for f in range(bins.shape[1])]
    groups: list[tuple[list[int], int]] = []
    for f in sorted(range(len(values)), key=lambda f: -len(values[f])):
        size = max(len(values[f]), 1)
        for i, (some, made) in enumerate(groups):
            if made * size <= cells:
                groups[i] = some + [f], made * size
                break
        else:
            groups.append(([f], size))
    out = []
    # The input with most bins comes last, where sums run along neighbouring cells.
    for some in (some[::-1] for some, _ in groups):
        place = np.zeros(len(bins), np.int64)
        for f in some:
            code = np.zeros(BINS, np.int64)
            code[values[f]] = np.arange(len(values[f]))
            place = place * len(values[f]) + code[bins[:, f]]
        out.append((some, [values[f] for f in some], place))
    return out


def _columns(batch: pa.RecordBatch | pa.Table, inputs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if isinstance(batch, pa.Table):
        batch = batch.combine_chunks().to_batches()[0] if batch.num_rows else pa.RecordBatch.from_pylist([], schema=batch.schema)
    by_name = dict(zip(batch.schema.names, batch.columns, strict=True))
    held_back = by_name["held_back"].to_numpy(zero_copy_only=False)
    return bins_of(by_name["bins"], inputs), by_name["y"].to_numpy().astype(np.float64), held_back, by_name["n"].to_numpy()


def _in_task(inputs: int, starts: dict[str, float], s: BoostSettings):
    """A whole model from the rows of a partition, which are those of one fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not sum(len(x) for x in parts):
            return
        table = pa.Table.from_batches(parts)
        fit = table.column(FITS)[0].as_py()
        bins, y, held_back, n = _columns(table, inputs)
        judged = bool(held_back.any())
        rows = _Rows.merged(bins, y, held_back, starts[fit], n)
        del parts, table, bins, y, held_back, n
        model, answer = _growing(judged, s, ahead=False), None
        try:
            while True:
                answer = rows.answer(*model.send(answer))
        except StopIteration as end:
            yield pa.RecordBatch.from_pydict({"fit": [fit], "model": [Boosted(starts[fit], end.value).dump()]})

    return run


def _task_sums(inputs: int, trees: list[Tree], tree: Tree, wanted: list[int], fit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss = None, 0
        for batch in batches:
            bins, y, held_back, n = _columns(batch, inputs)
            rows = _Rows(bins, y, held_back, batch.column(batch.schema.names.index("margin")).to_numpy(), n, cells=1)
            sums, more = rows.answer(trees, tree, wanted)
            total, loss = sums if total is None else total + sums, loss + more
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([fit]), pa.array([total.tobytes()], pa.binary()), pa.array([loss], pa.int64())], ["fit", "sums", "loss"]
            )

    return run


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fit, total, loss = None, None, 0
    for batch in batches:
        for name, raw, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums = np.frombuffer(raw, np.int64)
            fit, total, loss = name, sums if total is None else total + sums, loss + more
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([fit]), pa.array([total.tobytes()], pa.binary()), pa.array([loss], pa.int64())], ["fit", "sums", "loss"]
        )


def _over_tasks(rows: DataFrame, fit: str, start: float, judged: bool, inputs: int, s: BoostSettings) -> Boosted:
    """The same steps with a job per question. Tasks add up first, then a few add up theirs, so what
    comes back does not grow with the rows."""
    stored = materialize(rows.withColumn("margin", F.lit(start)), "margins")
    model, answer, kept = _growing(judged, s), None, 0
    some = max(1, int(stored.rdd.getNumPartitions() ** 0.5))
    try:
        while True:
            trees, tree, wanted = model.send(answer)
            if len(trees) - kept >= s.block:
                stored = materialize(stored.mapInArrow(_more_margin(inputs, trees[kept:]), stored.schema), "margins")
                kept = len(trees)
            sums = stored.mapInArrow(_task_sums(inputs, trees[kept:], tree, wanted, fit), _HISTOGRAMS)
            parts = sums.repartition(some).mapInArrow(_added_up, _HISTOGRAMS).collect()
            total = sum((np.frombuffer(r["sums"], np.int64) for r in parts), np.zeros(len(wanted) * inputs * BINS * 3, np.int64))
            answer = total.reshape(len(wanted), inputs, BINS, 3), sum(r["loss"] for r in parts)
    except StopIteration as end:
        return Boosted(start, end.value)


def _more_margin(inputs: int, trees: list[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("margin")
            bins = _columns(batch, inputs)[0]
            margin = batch.column(at).to_numpy().copy()
            for added in trees:
                margin += added.margins(bins)
            yield batch.set_column(at, "margin", pa.array(margin))

    return run


def counted(rows: DataFrame) -> DataFrame:
    """Equal rows (fit, y, held_back, bins) as one, with their number n."""
    return rows.groupBy(FITS, "y", "held_back", "bins").agg(F.count(F.lit(1)).alias("n"))


def grow_models(rows: DataFrame, inputs: int, s: BoostSettings, concurrent: int = 4) -> dict[str, Boosted]:
    """A model for every `fit` of rows (fit, y, held_back, bins), or of rows that say in n how many they are.

    Held-back rows only judge: rounds stop once `patience` of them in a row are no better, and the
    trees up to the best stay. Without them all rounds are grown. One model per fit, so the driver gets few.
    """
    rows = materialize(rows if "n" in rows.columns else counted(rows), "binned-rows")
    n, fitted = F.col("n"), ~F.col("held_back")
    counts = rows.groupBy(FITS).agg(
        F.sum(F.when(fitted, n).otherwise(0)).alias("fitted"),
        F.sum(F.when(fitted & (F.col("y") > 0), n).otherwise(0)).alias("positives"),
        F.sum(n).alias("all"), F.count(F.lit(1)).alias("different"),
    ).collect()
    different = {r[FITS]: r["different"] for r in counts}
    if many := [f for f, n in different.items() if n > s.rows_in_task]:
        # In a task rows that differ only in label or in being held back are one.
        of_them = rows.where(F.col(FITS).isin(many)).groupBy(FITS, "bins").agg(F.lit(1)).groupBy(FITS).count()
        different |= {r[FITS]: r["count"] for r in of_them.collect()}
    starts, small = {}, []
    # The largest come first, so that the last to start are the shortest.
    for r in sorted(counts, key=lambda r: (-different[r[FITS]], r[FITS])):
        # A class without a row would make the start infinite.
        share = min(max(r["positives"] / max(r["fitted"], 1), 1e-6), 1 - 1e-6)
        starts[r[FITS]] = float(np.log(share / (1 - share)))
        if different[r[FITS]] <= s.rows_in_task and r["all"] <= MOST_IN_TASK:
            small.append(r[FITS])
    models = {}
    if small:
        # One model is one task: a hash of the names would put several models into one partition.
        task = F.element_at(F.create_map(*[F.lit(x) for pair in zip(small, range(len(small)), strict=True) for x in pair]), F.col(FITS))
        dealt = rows.where(F.col(FITS).isin(small)).select(FITS, "y", "held_back", "bins", "n").repartitionById(len(small), task)
        grown = dealt.mapInArrow(_in_task(inputs, starts, s), "fit string, model string").collect()
        models = {r["fit"]: Boosted.load(r["model"]) for r in grown}
    large = [(f, r["all"] > r["fitted"]) for r in counts if (f := r[FITS]) not in models]
    if large:
        inherit = inheritable_thread_target(rows.sparkSession)
        with ThreadPoolExecutor(max_workers=concurrent) as pool:
            grow = inherit(lambda f, judged: _over_tasks(rows.where(F.col(FITS) == f), f, starts[f], judged, inputs, s))
            models |= dict(zip([f for f, _ in large], pool.map(lambda x: grow(*x), large), strict=True))
    return models


def settings_for_version(s: BoostSettings) -> dict:
    """Those that can change a model."""
    return {k: v for k, v in asdict(s).items() if k not in ("rows_in_task", "block")}
