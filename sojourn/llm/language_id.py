"""Language identification: sparse multinomial logistic regression over TF-IDF character grams.

Texts are lower-cased; runs of anything but letters become one space. Grams of one to three
characters are hashed into `buckets` cells; a cell counts 1 + log(tf), times its idf over all
training documents, and the vector has unit length. Weights are learned by the
follow-the-regularised-leader rule with L1 and L2 penalties, and a temperature fitted on rows
kept out of that turns the scores into probabilities.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters hashed together; longer texts are taken in overlapping pieces.
PIECE = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageSettings:
    """`per_language` bounds the labelled sample the weights are fitted on (about so many rows
    of each language, by hash of doc_id); document frequencies cover every training row."""

    buckets: int = 1 << 14
    #: A column with more values than that holds something else than languages, which is an error.
    most_languages: int = 1000
    per_language: int = 600
    epochs: int = 3
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.5


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray  # buckets
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray  # languages
    temperature: float

    def logits(self, counts: np.ndarray) -> np.ndarray:
        cells = np.flatnonzero(counts)
        return _vector(cells, counts[cells], self.idf) @ self.weights[cells] + self.bias


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None, buckets: int) -> np.ndarray | None:
    """Counts per cell; None where the text is null or has no letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    # Letters, and one space for each run of other characters.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.where(letter, codes, np.uint32(32))[keep]
    codes = np.concatenate([[32], codes, [32]] if codes[-1] != 32 else [[32], codes]).astype(np.uint64)
    shift = np.uint64(64 - int(math.log2(buckets)))
    total = 0
    factor, salt = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)
    with np.errstate(over="ignore"):
        for at in range(0, len(codes), PIECE):
            piece = codes[at : at + PIECE + 2]
            gram, cells = piece, []
            for size in (1, 2, 3):
                if size > 1:
                    if len(piece) < size:
                        break
                    gram = gram[:-1] * salt + piece[size - 1 :]
                # Grams that begin in this piece; the overlap only completes them.
                cells.append(((gram[:PIECE] + np.uint64(size)) * factor) >> shift)
            total = total + np.bincount(np.concatenate(cells).view(np.int64), minlength=buckets)
    return total


def _vector(cells: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[cells]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: int, s: LanguageSettings):
    """(weights, bias) after `epochs` passes over (cells, values), in the order given.

    Per coordinate: z gathers gradients less the drift of the weights, n their squares; the
    weight is 0 while |z| <= l1, which is what makes the model sparse.
    """
    z, n = np.zeros((s.buckets + 1, languages)), np.zeros((s.buckets + 1, languages))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for (cells, values), label in zip(rows, labels, strict=True):
            at, x = np.append(cells, s.buckets), np.append(values, 1.0)
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            error = _softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            g2 = g * g
            z[at] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / s.alpha * w
            n[at] = ni + g2
    w = weights(z, n)
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm; 1 without rows.

    Targets are smoothed by one pseudo-row, so that a sample without errors does not claim certainty.
    """
    if not len(labels):
        return 1.0
    target = np.full(logits.shape, 1 / (len(labels) + 1) / logits.shape[1])
    target[np.arange(len(labels)), labels] += len(labels) / (len(labels) + 1)

    def loss(log_t: float) -> float:
        return float(-(target * np.log(np.maximum(_softmax(logits / math.exp(log_t)), 1e-300))).sum(axis=1).mean())

    low, high, ratio = math.log(0.02), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def _frequencies(buckets: int):
    """Per task one row per cell: documents that have it. Cell -1 counts the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, documents = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts = gram_counts(text, buckets)
                if counts is not None:
                    df += counts > 0
                    documents += 1
        cells = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(cells, -1), pa.int32()), pa.array(np.append(df[cells], documents), pa.int64())],
            ["cell", "documents"],
        )

    return run


def _sample_counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, lang, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                counts = gram_counts(text, buckets)
                if counts is not None:
                    cells = np.flatnonzero(counts)
                    rows.append((key, lang, cells.astype(np.int32).tobytes(), counts[cells].astype(np.int32).tobytes()))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "lang", "cells", "counts"]
            )

    return run


def _fit(languages: tuple[str, ...], idf: np.ndarray, s: LanguageSettings):
    """One task fits the bounded sample; one row in five sets the temperature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sorted(row for b in batches for row in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True))
        if not sample:
            return
        rows, labels = [], []
        for _, lang, cells, counts in sample:
            at = np.frombuffer(cells, np.int32)
            rows.append((at, _vector(at, np.frombuffer(counts, np.int32), idf)))
            labels.append(languages.index(lang))
        y = np.array(labels)
        held = np.arange(len(rows)) % 5 == 4
        weights, bias = fit_ftrl([r for r, h in zip(rows, held, strict=True) if not h], y[~held], len(languages), s)
        logits = np.array([x @ weights[at] + bias for (at, x), h in zip(rows, held, strict=True) if h])
        temperature = fit_temperature(logits, y[held])
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([bias.tobytes()], pa.binary()), pa.array([temperature])],
            ["weights", "bias", "temperature"],
        )

    return run


def train(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> LanguageModel | None:
    """Fit from doc_id, text and lang; None where no row has a lang and a letter.

    Rows without lang or doc_id do not train. What reaches the driver is of fixed size: one
    count per cell and for each of at most `most_languages` languages (more raise ValueError), and the weights.
    """
    s = settings
    usable = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").alias("lang")
    ).where("doc_id is not null and lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().limit(s.most_languages + 1).collect()}
    if not counts:
        return None
    if len(counts) > s.most_languages:
        raise ValueError(f"lang has more than {s.most_languages} values")
    languages = tuple(sorted(counts))
    found = usable.select("text").mapInArrow(_frequencies(s.buckets), "cell int, documents long")
    df = {r["cell"]: r["n"] for r in found.groupBy("cell").agg(F.sum("documents").alias("n")).collect()}
    total = df.pop(-1, 0)
    if not total:
        return None
    idf = np.full(s.buckets, math.log(1 + total) + 1)
    idf[list(df)] = np.log((1 + total) / (1 + np.array(list(df.values())))) + 1

    room = 1 << 30
    share = F.create_map(*[F.lit(x) for k, c in counts.items() for x in (k, min(room, room * s.per_language // c))])
    key = F.xxhash64("doc_id")
    sample = usable.where(F.pmod(key, F.lit(room)) < F.element_at(share, F.col("lang")))
    fitted = (
        sample.select(key.alias("key"), "lang", "text")
        .mapInArrow(_sample_counts(s.buckets), "key long, lang string, cells binary, counts binary")
        .repartition(1)
        .mapInArrow(_fit(languages, idf, s), "weights binary, bias binary, temperature double")
        .first()
    )
    if fitted is None:
        return None
    return LanguageModel(
        languages,
        idf.astype(np.float32),
        np.frombuffer(bytes(fitted["weights"]), np.float32).reshape(s.buckets, len(languages)),
        np.frombuffer(bytes(fitted["bias"])).astype(np.float32),
        fitted["temperature"],
    )


def predict(model: LanguageModel | None, texts: Iterable[str | None]) -> list[tuple[str, float]]:
    """(language, calibrated probability) of each text. One that is null or has no letter, and
    any without a model, is `und` with score 0."""
    out = []
    for text in texts:
        counts = gram_counts(text, len(model.idf)) if model is not None else None
        if counts is None:
            out.append((UNKNOWN, 0.0))
        else:
            p = _softmax(model.logits(counts) / model.temperature)
            best = int(p.argmax())
            out.append((model.languages[best], float(p[best])))
    return out


def held_out(doc_id: Column) -> Column:
    """The fold that never trains: crc32 of the id's text, mod 4, is 2. A null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; the rows not held out train the model.

    Input: doc_id, text, lang. Empty and null texts are `und`. Repeated rows come out as often
    as they came in, null doc_ids are predicted but do not train, an empty table gives an empty
    result, and whole texts are read. Equal scores go to the first language in sorted order.
    Columns other than the three are not read.
    """
    model = train(docs.where(~held_out(F.col("doc_id"))), settings)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(predict(shared.value, texts), columns=["lang_pred", "score"])

    return docs.select(
        F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), predicted(F.col("text").cast("string")).alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")
