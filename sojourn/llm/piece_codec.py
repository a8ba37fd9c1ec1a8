"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The vocabulary comes from the public model file; its encoder is not called. A text is cut in
front of every space symbol that follows another symbol, which no piece of a supported
vocabulary spans. Distinct words are encoded together: all their symbols lie in one flat
array, and every round finds each word's best pair rank (a segmented minimum), merges all
its leftmost occurrences at once, closes the gaps, and drops the words that have no pair
left. Runs of spaces, whose pieces tie for the last rank, are cut up at the end.

Merging all occurrences at once equals the one-at-a-time order unless a merge gives a pair of
better rank. The first occurrence that does so is found, and later ones wait for the next round.
"""

from __future__ import annotations

import codecs
import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_NONE = np.int64(1) << 40
#: Words kept between batches, and characters in them; beyond either the cache starts anew.
CACHE_WORDS, CACHE_CHARS = 400_000, 8_000_000
#: Characters of text handled together.
CHARS_AT_ONCE = 1_000_000

codecs.register_error("piece", lambda e: ("�" * (e.end - e.start), e.end))


class PieceCodec:
    """Encoder and decoder of one BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        if model.normalize("A  ﬁ") != SPACE + "A" + SPACE * 2 + "ﬁ":
            raise ValueError("only models without text normalisation are supported")
        self.bos, self.eos = model.bos_id(), model.eos_id()
        kinds = [
            "byte" if model.is_byte(i) else "control" if model.is_control(i) else "unknown" if model.is_unknown(i) else "piece"
            for i in range(size)
        ]
        pieces = [model.id_to_piece(i) for i in range(size)]
        self.size = size
        self.byte_ids = np.zeros(256, np.int64)
        surfaces = []
        for i, (kind, piece) in enumerate(zip(kinds, pieces, strict=True)):
            if kind == "byte":
                self.byte_ids[int(piece[3:5], 16)] = i
                surfaces.append(bytes([int(piece[3:5], 16)]))
            else:
                surfaces.append({"control": "", "unknown": " ⁇ "}.get(kind, piece.replace(SPACE, " ")).encode())
        self.opens_with_space = np.array([k == "piece" and p.startswith(SPACE) for k, p in zip(kinds, pieces, strict=True)])
        self.silent = np.array([k == "control" for k in kinds])
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_len = np.array([len(x) for x in surfaces])
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len

        known = {p: i for i, (k, p) in enumerate(zip(kinds, pieces, strict=True)) if k == "piece"}
        runs = {p for p in known if not p.strip(SPACE)}
        if any(SPACE in p.lstrip(SPACE) or p.startswith(SPACE * 2) for p in known if p not in runs):
            raise ValueError("a piece spans a word boundary")
        self.space = known[SPACE]
        self.run_id = {len(p): known[p] for p in runs}
        self.run_pieces = functools.lru_cache(maxsize=4096)(self._run_pieces)
        self.char_id = {p: i for p, i in known.items() if len(p) == 1}
        ranks = {p: -int(model.get_score(i)) for p, i in known.items() if p not in runs}
        table = sorted(
            (known[p[:j]] * size + known[p[j:]], known[p], ranks[p])
            for p in ranks
            for j in range(1, len(p))
            if p[:j] in known and p[j:] in known
        )
        self.pair_keys, self.pair_piece, self.pair_rank = (np.array(x, np.int64) for x in zip(*table, strict=True))
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.word_chars = 0
        self.flat, self.at, self.length = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and rank of each pair; rank _NONE where there is no such piece."""
        key = np.where((left < self.size) & (right < self.size), left * self.size + right, -1)
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = self.pair_keys[place] == key
        return np.where(hit, self.pair_piece[place], -1), np.where(hit, self.pair_rank[place], _NONE)

    def merge_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids per word); each word gets its space symbol first."""
        lengths = np.array([len(w) + 1 for w in words])
        text = SPACE + SPACE.join(words)
        chars, inverse = np.unique(np.frombuffer(text.encode("utf-32-le"), np.uint32), return_inverse=True)
        # A character without a piece is carried as a number past the vocabulary.
        symbols = np.array([self.char_id.get(chr(c), self.size + int(c)) for c in chars], np.int64)[inverse]
        word = np.repeat(np.arange(len(words)), lengths)
        piece, rank = self._pair_state(symbols, word)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(rank, starts)
            over = np.repeat(best == _NONE, sizes)
            if over.any():
                done.append((symbols[over], word[over]))
                symbols, word, piece, rank = (x[~over] for x in (symbols, word, piece, rank))
                best, sizes = best[best != _NONE], sizes[best != _NONE]
                if not len(symbols):
                    break
            chosen = self._chosen(symbols, word, piece, rank, np.repeat(best, sizes))
            symbols = np.where(chosen, piece, symbols)
            keep = np.append(True, ~chosen[:-1])
            # Pairs to look up again: those that begin with a merged symbol or stand before one.
            stale = chosen | np.append(chosen[1:], False) | np.append(chosen[2:] & chosen[:-2], [False] * min(2, len(chosen)))[: len(chosen)]
            symbols, word, piece, rank, stale = (x[keep] for x in (symbols, word, piece, rank, stale))
            stale |= np.append(stale[1:], False)
            again = np.flatnonzero(stale)
            piece[again], rank[again] = self._pairs_at(symbols, word, again)
        ids, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return self._with_bytes(ids[order], word[order], len(words))

    def _pairs_at(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        after = np.minimum(at + 1, len(symbols) - 1)
        piece, rank = self._look_up(symbols[at], symbols[after])
        rank[(after == at) | (word[after] != word[at])] = _NONE
        return piece, rank

    def _pair_state(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._pairs_at(symbols, word, np.arange(len(symbols)))

    def _chosen(self, symbols, word, piece, rank, best) -> np.ndarray:
        """Pairs to merge now: each word's best, leftmost first, not overlapping."""
        match = rank == best
        place = np.arange(len(match))
        first = match & ~np.append(False, match[:-1])
        run = np.maximum.accumulate(np.where(first, place, 0))
        chosen = match & ((place - run) % 2 == 0)
        at = np.flatnonzero(chosen)
        repeated = np.zeros(len(at), bool)
        repeated[1:] = word[at[1:]] == word[at[:-1]]
        repeated[:-1] |= repeated[1:]
        at = at[repeated]
        if not len(at):
            return chosen
        # Where words have several occurrences, none may follow one that opens a better pair.
        merged, here = piece[at], word[at]
        right = np.minimum(at + 2, len(symbols) - 1)
        _, to_right = self._look_up(merged, symbols[right])
        to_right[(at + 2 >= len(symbols)) | (word[right] != here)] = _NONE
        left = np.maximum(at - 1, 0)
        touching = np.append(False, (at[1:] - at[:-1] == 2) & (here[1:] == here[:-1]))
        _, to_left = self._look_up(np.where(touching, merged, symbols[left]), merged)
        to_left[(at == 0) | (word[left] != here)] = _NONE
        better = np.minimum(to_right, to_left) < rank[at]
        if better.any():
            total = np.cumsum(better) - better
            begins = np.append(True, here[1:] != here[:-1])
            before = total - np.repeat(total[begins], np.diff(np.append(np.flatnonzero(begins), len(at))))
            chosen[at[before > 0]] = False
        return chosen

    def _with_bytes(self, ids: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        foreign = ids >= self.size
        if foreign.any():
            kinds, inverse = np.unique(ids[foreign], return_inverse=True)
            spelled = [self.byte_ids[np.frombuffer(chr(c - self.size).encode(), np.uint8)] for c in kinds]
            sizes = np.ones(len(ids), np.int64)
            sizes[foreign] = np.array([len(s) for s in spelled])[inverse]
            out = np.repeat(ids, sizes)
            out[np.repeat(foreign, sizes)] = np.concatenate([spelled[k] for k in inverse])
            ids, word = out, np.repeat(word, sizes)
        return ids, np.bincount(word, minlength=words)

    def _learn(self, texts: list[list[str]]) -> None:
        new = {w for words in texts for w in words if w not in self.words}
        if not new:
            return
        chars = sum(map(len, new)) + len(new)
        if self.words and (len(self.words) + len(new) > CACHE_WORDS or self.word_chars + chars > CACHE_CHARS):
            self._forget()
            new = {w for words in texts for w in words}
            chars = sum(map(len, new)) + len(new)
        listed = list(new)
        ids, sizes = self.merge_words(listed)
        at = len(self.flat) + np.cumsum(sizes) - sizes
        self.words.update(zip(listed, range(len(self.words), len(self.words) + len(listed)), strict=True))
        self.word_chars += chars
        self.flat, self.at, self.length = (
            np.concatenate(x) for x in ((self.flat, ids), (self.at, at), (self.length, sizes))
        )

    def _gather(self, words: list[str]) -> np.ndarray:
        which = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        return _ragged(self.flat, self.at[which], self.length[which])

    def _run_pieces(self, length: int) -> np.ndarray:
        """Pieces of a run of spaces: all tie, so the leftmost pair that has a piece merges first."""
        stack: list[int] = []
        for _ in range(length):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.run_id:
                stack[-2:] = [stack[-2] + stack[-1]]
        return np.array([self.run_id[n] for n in stack], np.int64)

    def _spaces(self, ids: np.ndarray) -> np.ndarray:
        """Cut runs of the single space symbol into their pieces."""
        space = ids == self.space
        if not (space[1:] & space[:-1]).any():
            return ids
        edge = np.flatnonzero(np.diff(np.concatenate([[0], space.astype(np.int8), [0]])))
        out, last = [], 0
        for begin, end in edge.reshape(-1, 2):
            if end - begin > 1:
                out += [ids[last:begin], self.run_pieces(int(end - begin))]
                last = end
        return np.concatenate([*out, ids[last:]])

    def encode_batch(self, texts: Sequence[str | None], bos: bool = True, eos: bool = True) -> list[np.ndarray]:
        """Ids of every text; null counts as empty, and an empty text has no ids but begin and end."""
        words = [t.replace(" ", SPACE).split(SPACE) if t else [] for t in texts]
        self._learn(words)
        head, tail = [self.bos] * bos, [self.eos] * eos
        return [np.concatenate([head, self._spaces(self._gather(w)) if w else [], tail]).astype(np.int64) for w in words]

    def decode(self, ids: np.ndarray) -> str:
        spoken = np.flatnonzero(~self.silent[ids])
        if not len(spoken):
            return ""
        raw = _ragged(self.surface, self.surface_at[ids], self.surface_len[ids]).tobytes()
        if self.opens_with_space[ids[spoken[0]]]:
            raw = raw[1:]
        return raw.decode("utf-8", "piece")


def _ragged(flat: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices flat[at : at + size], one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(at - (ends - sizes), sizes)]


@functools.lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def _portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    begin, chars = 0, 0
    for k, t in enumerate(texts):
        chars += len(t or "")
        if chars >= CHARS_AT_ONCE or k == len(texts) - 1:
            yield texts[begin : k + 1]
            begin, chars = k + 1, 0


def encode_decode(docs: DataFrame, path: str, bos: bool = True, eos: bool = True) -> DataFrame:
    """Ids of every whole text and the text they decode to, one row per input row.

    Input: doc_id (long) and text; other columns are not read. Output: doc_id, n_tokens,
    ids (little-endian unsigned 32-bit integers), decoded. A null or empty text has only the
    begin and end ids and decodes to an empty text. Null and repeated doc_ids pass through.
    An empty table gives an empty result. `path` is the model file, on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(path)
        for batch in batches:
            done = 0
            for texts in _portions(batch.column(1).to_pylist()):
                ids = pieces.encode_batch(texts, bos, eos)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(texts)),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                        pa.array([pieces.decode(x) for x in ids], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )
                done += len(texts)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
