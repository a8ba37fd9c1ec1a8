"""Phrases that belong together, counted in counting quotient filters.

A word's id is its 64-bit hash, and an n-gram is its n ids in a row. The first id is permuted, in
a way that the others allow to undo; its leading bits are the quotient, and the rest of it with
the other ids the remainder. A filter keeps the remainders sorted, how many fall to each quotient,
and a counter for each: nothing is lost, the quotient takes no room.

Lengths are counted one after the other. Every task counts its n-grams into filters of bounded
size and writes them bucket by bucket (a bucket is a range of quotients); the filters of a bucket
are merged in one task. A longer n-gram can only be frequent if both its shorter halves are, so
tasks skip those that miss in a bit table of the frequent ones. The table has a fixed size: where
it fills up, more is counted than needed, never less. Texts are read three times: for words, for
pairs, and for the stretches of frequent pairs, from which all longer n-grams are counted.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sojourn.operators.joins import broadcast_if_small
from sojourn.sources.scratch import materialize


@dataclass(frozen=True)
class PhraseSettings:
    longest: int = 5
    least_count: int = 100
    best: int = 2000
    #: A phrase goes if a longer one around it has this share of its count, in hundredths.
    absorbed: int = 100
    #: Bits of the table of frequent n-grams.
    table_bits: int = 25
    #: Occurrences a task collects before it counts them; distinct n-grams it keeps before it writes them.
    pending: int = 400_000
    held: int = 400_000
    #: Words whose ids a task remembers.
    remembered: int = 200_000
    #: Buckets of words; of longer n-grams, occurrences per bucket.
    word_bucket_bits: int = 10
    bucket_load_bits: int = 18
    #: Bytes of text looked at together.
    chunk: int = 1_000_000


_P, _Q, _R = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
_Q_BACK, _R_BACK = (np.uint64(pow(x, -1, 2**64)) for x in (_Q, _R))
_P, _Q, _R = np.uint64(_P), np.uint64(_Q), np.uint64(_R)
#: Bytes that end a piece become one that no UTF-8 text holds. What bytes.split() parts words by is then space and tab.
_BREAK = b"\xff"
_BREAKS = bytes(0xFF if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_BOUNDARY = re.compile(rb"[ \t-\r.,;:!?]")
_FILTER = "lang string, bucket long, slot_bits int, fills binary, remainders binary, counts binary, words binary"
_GRAM = "lang string, gram array<long>, f long, word string"
Grams = tuple[np.ndarray, np.ndarray, np.ndarray, "np.ndarray | None"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _Q
    x = (x ^ (x >> np.uint64(32))) * _R
    return x ^ (x >> np.uint64(30))


def _unmixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))) * _R_BACK
    x = (x ^ (x >> np.uint64(32))) * _Q_BACK
    return x ^ (x >> np.uint64(29)) ^ (x >> np.uint64(58))


def _chained(ids: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of each row of ids."""
    x = np.full(len(ids), seed, np.uint64)
    with np.errstate(over="ignore"):
        for column in ids.T:
            x = _mixed((x ^ column) * _P + np.uint64(1))
    return x


def permuted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(permuted first ids, other ids) of n-grams given as rows; `restored` undoes it."""
    with np.errstate(over="ignore"):
        return _mixed(ids[:, 0] ^ _chained(ids[:, 1:])), ids[:, 1:]


def restored(first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([(_unmixed(first) ^ _chained(rest))[:, None], rest], axis=1)


def _counted(first: np.ndarray, rest: np.ndarray, counts: np.ndarray | None, words: np.ndarray | None = None) -> Grams:
    """Sorted distinct n-grams with the sums of their counts (one each if none are given)."""
    order = np.argsort(first)
    first, rest = first[order], rest[order]
    same = first[1:] == first[:-1]
    if rest.shape[1] and (rest[1:][same] != rest[:-1][same]).any():
        # Equal first parts only; sorting by all of them puts equal n-grams together.
        again = np.lexsort([*rest.T[::-1], first])
        order, first, rest = order[again], first[again], rest[again]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (rest[1:] != rest[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    if counts is None:
        sums = np.diff(np.append(at, len(first)))
    else:
        sums = np.add.reduceat(counts[order], at) if len(at) else counts[:0]
    return first[at], rest[at], sums, None if words is None else words[order[at]]


def _joined(parts: list[Grams]) -> Grams:
    if len(parts) == 1:
        return parts[0]
    words = None if parts[0][3] is None else np.concatenate([p[3] for p in parts])
    return _counted(*(np.concatenate([p[c] for p in parts]) for c in range(3)), words)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Unsigned integers of the least width that holds all of them."""
    most = int(x.max(initial=0))
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def filter_rows(lang: str, grams: Grams, bits: int) -> Iterator[tuple]:
    """One row of _FILTER for every bucket of sorted distinct n-grams; `bits` are the bucket's."""
    first, rest, counts, words = grams
    buckets = first >> np.uint64(64 - bits)
    at = np.flatnonzero(np.append(len(buckets) > 0, buckets[1:] != buckets[:-1]))
    for begin, end in zip(at.tolist(), np.append(at[1:], len(buckets)).tolist(), strict=True):
        slot_bits = min((end - begin).bit_length() - 1, 63 - bits)
        left = 64 - bits - slot_bits
        x = first[begin:end]
        slots = (x >> np.uint64(left)) & np.uint64((1 << slot_bits) - 1)
        fills = _narrow(np.bincount(slots.astype(np.int64), minlength=1 << slot_bits))
        low = (x & np.uint64((1 << left) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (left + 7) // 8]
        yield (
            lang, int(buckets[begin]), slot_bits, fills.tobytes(),
            np.ascontiguousarray(low).tobytes() + rest[begin:end].astype("<u8").tobytes(),
            _narrow(counts[begin:end]).tobytes(),
            b"\n".join(words[begin:end]) if words is not None else None,
        )


def filter_grams(bucket: int, slot_bits: int, fills: bytes, remainders: bytes, counts: bytes, words: bytes | None, n: int, bits: int) -> Grams:
    """What filter_rows was given."""
    fill = np.frombuffer(fills, f"<u{len(fills) >> slot_bits}").astype(np.int64)
    m, left = int(fill.sum()), 64 - bits - slot_bits
    width = (left + 7) // 8
    low = np.zeros((m, 8), np.uint8)
    low[:, :width] = np.frombuffer(remainders, np.uint8, m * width).reshape(m, width)
    slots = np.repeat(np.arange(1 << slot_bits, dtype=np.uint64), fill)
    first = low.view("<u8").ravel() | (slots << np.uint64(left)) | (np.uint64(bucket) << np.uint64(64 - bits))
    rest = np.frombuffer(remainders, "<u8", m * (n - 1), m * width).reshape(m, n - 1)
    spelled = None if words is None else np.array(words.split(b"\n"), object)
    return first, rest, np.frombuffer(counts, f"<u{len(counts) // m}").astype(np.int64), spelled


class _WordIds(dict):
    """Ids by word, and words by id; 0 is the end of a piece."""

    def __init__(self) -> None:
        self.words: dict[int, bytes] = {}

    def __missing__(self, word: bytes) -> int:
        self[word] = got = 0 if word == _BREAK else xxhash.xxh64_intdigest(word) or 1
        self.words[got] = word
        return got

    def forget(self, above: int) -> None:
        if len(self) > above:
            self.clear()
            self.words.clear()


def _chunks(texts: list[tuple[str, bytes]], size: int) -> Iterator[tuple[str, bytes, bool]]:
    """(lang, text, whether the next chunk goes on in the same piece). Short texts come together, and
    texts longer than `size` in several chunks, cut between words."""
    waiting: dict[str, list[bytes]] = defaultdict(list)
    volume: dict[str, int] = defaultdict(int)
    for lang, text in texts:
        begin = 0
        while len(text) - begin > size:
            cut = _BOUNDARY.search(text, begin + size)
            if cut is None:
                break
            yield lang, text[begin : cut.start()], True
            begin = cut.start()
        if begin:
            yield lang, text[begin:], False
            continue
        waiting[lang].append(text)
        volume[lang] += len(text)
        if volume[lang] > size:
            yield lang, b"\n".join(waiting.pop(lang)), False
            volume[lang] = 0
    for lang, some in waiting.items():
        yield lang, b"\n".join(some), False


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))


def _table_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return hashes >> np.uint64(64 - bits), _mixed(hashes) >> np.uint64(64 - bits)


def _windows(ids: np.ndarray, n: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(ids, n)


def _held(ids: np.ndarray, n: int, seed: int, table: np.ndarray, bits: int) -> np.ndarray:
    """Whether an n-gram begins at each place (but the last n - 1), in a piece, that the table has."""
    grams = _windows(ids, n) if len(ids) >= n else np.empty((0, n), np.uint64)
    held = (grams != 0).all(axis=1)
    at = np.flatnonzero(held)
    one, two = _table_places(_chained(grams[at], seed), bits)
    marks = [(table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) for p in (one, two)]
    held[at] = (marks[0] & marks[1]).astype(bool)
    return held


def _grams(ids: np.ndarray, n: int, seed: int, table: np.ndarray | None, bits: int) -> np.ndarray:
    """All n-grams within pieces, as rows; of n > 1 those whose two halves of n - 1 ids the table has."""
    if len(ids) < n:
        return np.empty((0, n), np.uint64)
    if n == 1:
        return ids[ids != 0][:, None]
    halves = _held(ids, n - 1, seed, table, bits)
    return _windows(ids, n)[np.flatnonzero(halves[:-1] & halves[1:])]


def _text_ids(batch: pa.RecordBatch, carried: int, ids_of: _WordIds, s: PhraseSettings) -> Iterator[tuple[str, np.ndarray, int]]:
    """(lang, ids, lead) of (lang, text) rows; the first `lead` ids, at most `carried`, have been there before."""
    texts = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
    carry = np.empty(0, np.uint64)
    for lang, text, goes_on in _chunks(texts, s.chunk):
        words = text.lower().translate(_BREAKS).replace(_BREAK, b" \xff ").split()
        ids = np.concatenate([carry, np.fromiter(map(ids_of.__getitem__, words), np.uint64, len(words))])
        lead = len(carry)
        # The last ids begin n-grams that end in the next chunk.
        carry = ids[max(0, len(ids) - carried) :] if goes_on else carry[:0]
        yield lang, ids, lead


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _run_ids(batch: pa.RecordBatch, n: int) -> Iterator[tuple[str, np.ndarray, int]]:
    """(lang, ids, 0) of (lang, lead, ids) rows, a 0 after every row; n-grams that end in the lead are left out."""
    langs = np.array(batch.column(0).to_pylist(), object)
    lists = batch.column(2)
    offsets, flat = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy().view(np.uint64)
    begin = offsets[:-1] + np.maximum(batch.column(1).to_numpy().astype(np.int64) - (n - 1), 0)
    count = offsets[1:] - begin
    for lang in set(langs.tolist()):
        of = np.flatnonzero(langs == lang)
        out = np.zeros(int(count[of].sum()) + len(of), np.uint64)
        out[_ranges(np.cumsum(count[of] + 1) - count[of] - 1, count[of])] = flat[_ranges(begin[of], count[of])]
        yield lang, out, 0


def _runs_pass(s: PhraseSettings, table):
    """Of (lang, text) rows, the stretches of three words or more whose neighbours are frequent pairs, as
    (lang, lead, ids). Whatever longer n-gram is frequent lies in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _WordIds()
        for batch in batches:
            for lang, ids, lead in _text_ids(batch, s.longest - 1, ids_of, s):
                ids_of.forget(s.remembered)
                held = np.concatenate([[False], _held(ids, 2, _seed(lang), table.value, s.table_bits), [False]])
                begin, end = np.flatnonzero(~held[:-1] & held[1:]), np.flatnonzero(held[:-1] & ~held[1:]) + 1
                use = (end - begin > 2) & (end > lead)
                begin, count = begin[use], (end - begin)[use]
                offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                flat = pa.array(ids[_ranges(begin, count)].view(np.int64))
                leads = np.maximum(lead - begin, 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(begin), pa.string()), pa.array(leads), pa.ListArray.from_arrays(offsets, flat)], ["lang", "lead", "ids"]
                )

    return run


def _count_pass(n: int, bits: int, s: PhraseSettings, table, of_text: bool):
    """Filters of the n-grams of (lang, text) rows, or of (lang, lead, ids) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _WordIds()
        pending: dict[str, list[np.ndarray]] = defaultdict(list)
        held: dict[str, Grams] = {}
        waiting, shared = 0, table.value if table else None

        def count() -> None:
            for lang, parts in pending.items():
                first, rest = permuted(np.concatenate(parts))
                words = None
                grams = _counted(first, rest, None)
                if n == 1:
                    words = np.array([ids_of.words[i] for i in restored(*grams[:2])[:, 0].tolist()], object)
                grams = (*grams[:3], words)
                held[lang] = _joined([held[lang], grams]) if lang in held else grams
            pending.clear()
            ids_of.forget(s.remembered)

        def written() -> pa.RecordBatch:
            rows = [row for lang, grams in held.items() for row in filter_rows(lang, grams, bits)]
            held.clear()
            return _as_batch(rows)

        for batch in batches:
            for lang, ids, _ in _text_ids(batch, n - 1, ids_of, s) if of_text else _run_ids(batch, n):
                found = _grams(ids, n, _seed(lang), shared, s.table_bits)
                if len(found):
                    pending[lang].append(found)
                    waiting += len(found)
                if waiting >= s.pending:
                    count()
                    waiting = 0
                    if sum(len(g[0]) for g in held.values()) >= s.held:
                        yield written()
        count()
        yield written()

    return run


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["lang", "bucket", "slot_bits", "fills", "remainders", "counts", "words"]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names)


def _merge_pass(n: int, bits: int, s: PhraseSettings):
    """Of filters sorted by (lang, bucket), the frequent n-grams; for words also one row per bucket
    with no gram, which holds the number of all of them."""

    def frequent(lang: str, grams: Grams) -> tuple[list, list, list, list]:
        first, rest, counts, words = grams
        at = np.flatnonzero(counts >= s.least_count)
        gram = restored(first[at], rest[at]).view(np.int64).tolist()
        spelled = [w.decode("utf-8", "replace") for w in words[at]] if words is not None else [None] * len(at)
        f = counts[at].tolist()
        if n == 1:
            gram, f, spelled = [*gram, []], [*f, int(counts.sum())], [*spelled, None]
        return [lang] * len(gram), gram, f, spelled

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, volume = None, [], 0
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for lang, bucket, *filled in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, bucket) != key:
                    if parts:
                        for column, more in zip(out, frequent(key[0], _joined(parts)), strict=True):
                            column += more
                    key, parts, volume = (lang, bucket), [], 0
                parts.append(filter_grams(bucket, *filled, n, bits))
                volume += len(parts[-1][0])
                if volume > s.held:
                    parts = [_joined(parts)]
                    volume = 0
            yield _gram_batch(out)
        if parts:
            yield _gram_batch(frequent(key[0], _joined(parts)))

    return run


def _gram_batch(columns: tuple[list, list, list, list]) -> pa.RecordBatch:
    types = [pa.string(), pa.list_(pa.int64()), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang", "gram", "f", "word"])


def _table_of(grams: DataFrame, bits: int) -> np.ndarray:
    """The bit table of all (lang, gram) rows. At most 2 ** (bits - 6) words reach the driver, however many rows."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            if not len(lists):
                continue
            ids = lists.flatten().to_numpy().view(np.uint64).reshape(len(lists), -1)
            langs = np.array(batch.column(0).to_pylist(), object)
            hashes = np.empty(len(ids), np.uint64)
            for lang in set(langs.tolist()):
                hashes[langs == lang] = _chained(ids[langs == lang], _seed(lang))
            at = np.unique(np.concatenate(_table_places(hashes, bits)))
            word, mark = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            marks = np.bitwise_or.reduceat(mark, first)
            yield pa.RecordBatch.from_arrays([pa.array(word[first].view(np.int64)), pa.array(marks.view(np.int64))], ["word", "marks"])

    table = np.zeros(1 << (bits - 6), np.uint64)
    marks = grams.select("lang", "gram").mapInArrow(places, "word long, marks long")
    got = marks.groupBy("word").agg(F.bit_or("marks").alias("marks")).toArrow()
    table[got.column("word").to_numpy()] = got.column("marks").to_numpy().view(np.uint64)
    return table


def frequent_grams(docs: DataFrame, s: PhraseSettings = PhraseSettings()) -> tuple[DataFrame, DataFrame]:
    """(grams, totals): every phrase of up to `longest` words that occurs `least_count` times or more,
    as lang, gram (word ids), f and word (of single words); and lang, n, the words of each language."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    slim = docs.select(lang.alias("lang"), F.col("text").cast("string").cast("binary").alias("text")).where("text is not null")

    def counted(rows: DataFrame, n: int, bits: int, table) -> DataFrame:
        filters = rows.mapInArrow(_count_pass(n, bits, s, table, rows is slim), _FILTER)
        merged = filters.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(_merge_pass(n, bits, s), _GRAM)
        return materialize(merged, f"grams-{n}")

    words = counted(slim, 1, s.word_bucket_bits, None)
    totals = materialize(words.where("size(gram) = 0").groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
    grams = last = words.where("size(gram) = 1")
    occurrences = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = min(max(math.ceil(math.log2(occurrences + 1)) - s.bucket_load_bits, 4), 40)
    rows = slim
    for n in range(2, s.longest + 1):
        table = _table_of(last, s.table_bits)
        if not table.any():
            break
        shared = spark.sparkContext.broadcast(table)
        if n == 3:
            rows = materialize(slim.mapInArrow(_runs_pass(s, shared), "lang string, lead int, ids array<long>"), "frequent-runs")
        last = counted(rows, n, bits, shared)
        grams = grams.unionAll(last)
    return grams, totals


#: Single words are looked up by very many phrases; each is there so many times, dealt by phrase.
_COPIES = 16


def _spread(single, gram) -> F.Column:
    return F.when(single, F.pmod(F.xxhash64(gram), F.lit(_COPIES))).otherwise(0).cast("int")


def collocations(docs: DataFrame, s: PhraseSettings = PhraseSettings()) -> DataFrame:
    """The `best` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Input: text and lang. A-Z are lower-cased; pieces end at .,;:!? and line breaks (\\n to \\r), words
    at spaces and tabs. Null text counts as empty, null lang as `und`; an empty table, or one in which
    nothing is frequent, gives no rows. Texts of any length are read whole; a repeated row counts each time.
    Equal 64-bit hashes of two words of a language would count as one word: among a million words, one chance in 10^7.
    """
    grams, totals = frequent_grams(docs, s)
    size = F.size("gram")
    phrases = grams.where(size > 1).select("lang", "gram", F.col("f").alias("a"))
    single = F.size("part") == 1
    known = grams.select("lang", F.col("gram").alias("part"), "f").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.when(single, _COPIES - 1).otherwise(0)))
    )

    def with_count(rows: DataFrame, part, name: str) -> DataFrame:
        asked = rows.withColumn("part", part).withColumn("copy", _spread(single, "gram"))
        return asked.join(known, ["lang", "part", "copy"]).drop("part", "copy").withColumnRenamed("f", name)

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = with_count(cuts, F.slice("gram", F.lit(1), F.col("k")), "l")
    cuts = with_count(cuts, F.slice("gram", F.col("k") + 1, size - F.col("k")), "r")
    cuts = cuts.join(broadcast_if_small(totals), "lang")
    a, left, right, n = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n"))
    cuts = cuts.withColumns({"above": F.lit(1000).cast("decimal(4,0)") * a * n, "below": left * right})
    scored = (
        cuts.withColumn("score", F.expr("cast(above div below as bigint)"))
        .groupBy("lang", "gram", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "gram", "a", "n", "cut.score", "cut.l", "cut.r")
    )
    # Around a phrase, counts only fall with length: one word more tells about all longer ones.
    around = (
        phrases.where(size > 2)
        .select("lang", F.explode(F.array(F.slice("gram", F.lit(1), size - 1), F.slice("gram", F.lit(2), size - 1))).alias("gram"), "a")
        .groupBy("lang", "gram")
        .agg(F.max("a").alias("longer"))
    )
    absorbed = F.coalesce(F.col("longer") * 100 >= F.col("a") * s.absorbed, F.lit(False))
    kept = scored.join(around, ["lang", "gram"], "left").where(~absorbed).drop("longer")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = materialize(kept.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= s.best).drop("place"), "phrases")
    spelled = grams.where("size(gram) = 1").select("lang", F.col("gram")[0].alias("id"), "word")
    copies = spelled.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(_COPIES - 1))))
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    named = (
        best.select("*", F.posexplode("gram").alias("at", "id"))
        .withColumn("copy", _spread(F.lit(True), "gram"))
        .join(copies, ["lang", "id", "copy"])
        .groupBy("lang", "gram", "a", "l", "r", "n", "score")
        .agg(phrase.alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        named.withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= s.best)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
