import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from conftest import TABLES
from sojourn.llm.piece_codec import PieceCodec, encode_decode
from sojourn.llm.queries import piece_model

AWKWARD = [
    "", " ", "  ", "a", " a", "a ", "▁", "a▁ b", " " * 14, " " * 15, " " * 16, " " * 333, "a" * 5000, "the" * 400, "<s>", "</s>", "<unk>",
    "<0x41>", "ﬁ ﬃ", "日本語", "\U0001f600\U0001f600", "\x00\x01", "\r\n\t", "é é", "​", "x " * 9 + "   ", "�",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def pieces():
    return PieceCodec(piece_model())


def texts():
    rnd = random.Random(5)
    parts = AWKWARD + ["the", "in", "ing", "th", "e", "n", "0", "00", "\n", ".", "ab", " the"]
    mixed = ["".join(rnd.choice(parts[1:]) for _ in range(rnd.randint(1, 30))) for _ in range(400)]
    letters = ["".join(rnd.choice("abcdeth nio") for _ in range(rnd.randint(1, 200))) for _ in range(400)]
    return AWKWARD + mixed + letters


def test_same_as_the_library(pieces, library):
    got = pieces.encode_batch(texts())
    assert [x.tolist() for x in got] == library.encode(texts(), add_bos=True, add_eos=True)
    assert [pieces.decode(x) for x in got] == [library.decode(x.tolist()) for x in got]


def test_decodes_ids_that_no_text_gives(pieces, library):
    rnd = np.random.default_rng(2)
    for _ in range(300):
        ids = rnd.integers(0, 400, rnd.integers(0, 12))
        assert pieces.decode(ids) == library.decode(ids.tolist())


def test_a_full_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr("sojourn.llm.piece_codec.CACHE_WORDS", 50)
    small = PieceCodec(piece_model())
    for text in texts()[:150]:
        assert small.encode_batch([text])[0].tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_query_over_documents(spark, library):
    from sojourn.llm.queries import QUERIES

    want = {}
    for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        decoded = library.decode(ids)
        want[r.doc_id] = (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        )
    rows = QUERIES["op3_sentencepiece"](spark, TABLES).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def test_odd_tables(spark):
    schema = "doc_id long, text string, ids string, n_tokens string"
    rows = [(1, None, "x", "y"), (None, "a b", None, None), (2, "", "", ""), (2, "", "", ""), (3, "word " * 50_000, "", "")]
    got = encode_decode(spark.createDataFrame(rows, schema), piece_model()).collect()
    assert sorted((r.doc_id or 0, r.n_tokens > 2, r.decoded) for r in got) == sorted(
        [(1, False, ""), (0, True, "a b"), (2, False, ""), (2, False, ""), (3, True, "word " * 50_000)]
    )
    assert encode_decode(spark.createDataFrame([], schema), piece_model()).collect() == []
