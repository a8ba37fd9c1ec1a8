from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from conftest import TABLES
from sojourn.llm import token_counts as T
from sojourn.llm.queries import QUERIES
from sojourn.sources.scratch import scratch_path

SCHEMA = "source string, lang string, tokenizer string, tokens long, old_tokens long"


@pytest.fixture
def totals(spark):
    return T.TokenTotals(spark, scratch_path(spark, "test-totals"))


def read(totals):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in totals.totals().collect()}


def test_signed_batches_and_replays(spark, totals):
    rows = spark.createDataFrame([("a", "en", "v1", 5, 3), ("a", "en", "v1", 7, 7), (None, None, "v1", 1, 0), ("b", "de", "v2", None, 0)], SCHEMA)
    assert read(totals) == {}
    assert totals.commit("1", T.inserts(rows)) and not totals.commit("1", T.inserts(rows))
    assert read(totals) == {("a", "en", "v1"): (2, 12), (None, None, "v1"): (1, 1), ("b", "de", "v2"): (1, 0)}
    assert totals.commit("2", T.revisions(rows.where("source = 'a'")))
    assert totals.commit("3", T.deletes(rows.where("source is null or source = 'b'")))
    assert totals.commit("empty", T.inserts(rows.limit(0))) and not totals.commit("empty", T.inserts(rows.limit(0)))
    assert read(totals) == {("a", "en", "v1"): (2, 14)}


def test_racing_and_dying_writers(spark, totals):
    """Whoever claims a version first wins it; the other adds to that. What was not claimed does not count."""
    rows = spark.createDataFrame([("a", "en", "v1", 5, 0), ("b", "en", "v1", 6, 0)], SCHEMA)
    totals.commit("1", T.inserts(rows))
    claim, tries = totals._claim, []

    def late(version, folder):
        tries.append(version)
        if len(tries) == 1:
            assert T.TokenTotals(spark, totals.path).commit("3", T.inserts(rows.where("source = 'b'")))
        return claim(version, folder)

    totals._claim = late
    assert totals.commit("2", T.deletes(rows.where("source = 'a'"))) and tries == [2, 3]
    assert read(totals) == {("b", "en", "v1"): (2, 12)} and totals.versions() == [1, 2, 3]

    def dies(version, folder):
        raise RuntimeError("lost")

    totals._claim = dies
    with pytest.raises(RuntimeError):
        totals.commit("4", T.inserts(rows))
    totals._claim = claim
    assert read(totals) == {("b", "en", "v1"): (2, 12)}
    assert totals.commit("4", T.inserts(rows)) and read(totals)["b", "en", "v1"] == (3, 18)
    # The same batch by two writers at once counts once.
    totals._claim = lambda version, folder: T.TokenTotals(spark, totals.path).commit("5", T.inserts(rows)) and claim(version, folder)
    assert not totals.commit("5", T.inserts(rows)) and read(totals)["b", "en", "v1"] == (4, 24)


def test_a_known_batch_with_other_changes_is_refused(spark, totals):
    rows = spark.createDataFrame([("a", "en", "v1", 5, 0), (None, "en", "v1", 6, 0), ("", "en", "v1", 6, 0)], SCHEMA)
    totals.commit("1", T.inserts(rows))
    for other in (rows.where("source = 'a'"), rows.withColumn("tokens", F.col("tokens") + 1), rows.unionAll(rows), rows.fillna("x"), rows.limit(0)):
        with pytest.raises(T.ConflictingBatch):
            totals.commit("1", T.inserts(other))
    assert not totals.commit("1", T.inserts(rows.orderBy("tokens").repartition(2))) and len(read(totals)) == 3


def test_compaction_keeps_totals_and_batches(spark, totals):
    rows = spark.createDataFrame([("a", "en", "v1", 5, 0)], SCHEMA)
    for k in range(4):
        totals.commit(str(k), T.inserts(rows))
    totals.compact()
    totals.compact()
    assert totals.versions() == [3, 4] and read(totals) == {("a", "en", "v1"): (4, 20)}
    assert not totals.commit("0", T.inserts(rows)) and totals.commit("new", T.inserts(rows))
    assert read(totals) == {("a", "en", "v1"): (5, 25)}


def test_query_matches_brute_force(spark):
    import tiktoken

    ranks = {}
    import base64

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    encoding = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    toxic = {r.doc_id for r in spark.read.parquet(f"{TABLES}/labels.parquet").where("toxic = 1").collect()}
    documents, tokens = Counter(), Counter()
    for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect():
        if r.doc_id not in toxic:
            for version, n in (("words-1", len((r.text or "").encode().split())), ("byte_bpe_50k", len(encoding.encode_ordinary(r.text or "")))):
                documents[r.source, r.lang, version] += 1
                tokens[r.source, r.lang, version] += n
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in QUERIES["op9_token_counts"](spark, TABLES).collect()}
    assert got == {k: (documents[k], tokens[k]) for k in documents}


def test_odd_texts(spark):
    exact = T.bpe_tokens(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    frame = spark.createDataFrame([(None,), ("",), ("a b",), ("word " * 100_000,), (" \t\n",)], "text string")
    rows = frame.select(T.words(F.col("text")).alias("w"), exact(F.col("text")).alias("n")).collect()
    assert [r.w for r in rows] == [0, 0, 2, 100_000, 0] and [r.n for r in rows][:3] == [0, 0, 2]
