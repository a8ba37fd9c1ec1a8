"""The operators' queries over the given tables; their DuckDB SQL is in `oracles`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.llm import (
    collocations,
    decontamination,
    html_text,
    language_id,
    prefix_tree_join,
    prefix_trie,
    quality,
    sharding,
    token_counts,
    url_filter,
    warc,
)
from sojourn.llm.near_dedup import near_duplicates
from sojourn.llm.oracles import ORACLES  # noqa: F401 - what the entry registers
from sojourn.llm.piece_codec import encode_decode
from sojourn.sources.scratch import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark, sf_dir):
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def piece_model() -> str:
    """The public vocabulary file, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op3_sentencepiece(spark, sf_dir):
    coded = encode_decode(table(spark, sf_dir, "documents"), piece_model())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op4_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, num=85, den=100)


@query
def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("row.doc_id", *judged.columns[1:])


@query
def op6_warc_derivatives(spark, sf_dir):
    records = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return records.withColumn("record_sha256", F.sha2("record", 256)).drop("record")


URL_RULES = (
    url_filter.HostRule("allow", "com", "/"),
    url_filter.HostRule("block", "example.com", "/en/"),
    url_filter.HostRule("allow", "www.example.com", "/en/"),
    url_filter.HostRule("block", "net", "/es/"),
    url_filter.HostRule("block", "net", "/fr/"),
)


@query
def op7_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op8_sharding(spark, sf_dir):
    return sharding.interleave(table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark, sf_dir):
    """All documents are entered with a rough count, recounted with the vocabulary, and those
    labelled toxic are withdrawn; one batch is sent twice."""
    import public_tokenizers

    exact = token_counts.bpe_tokens(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = F.col("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", token_counts.words(text).alias("words"), exact(text).alias("exact")
    )
    counted = materialize(docs, "token-counts")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    gone = counted.join(toxic, "doc_id", "left_semi")

    def under(rows, tokenizer, tokens, old=None):
        more = [F.col(old).alias("old_tokens")] if old else []
        return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.col(tokens).alias("tokens"), *more)

    totals = token_counts.TokenTotals(spark, scratch_path(spark, "token-totals"))
    batches = {
        "load": token_counts.inserts(under(counted, "words-1", "words").unionAll(under(counted, "byte_bpe_50k", "words"))),
        "recount": token_counts.revisions(under(counted, "byte_bpe_50k", "exact", old="words")),
        "withdraw": token_counts.deletes(under(gone, "words-1", "words").unionAll(under(gone, "byte_bpe_50k", "exact"))),
    }
    for batch_id in ("load", "recount", "recount", "withdraw"):
        totals.commit(batch_id, batches[batch_id])
    return totals.totals()


@query
def op10_html_extraction(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark, sf_dir):
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_nodes(*prefix_trie.rebuilt(turns))


@query
def op13_ngram_join(spark, sf_dir):
    return prefix_tree_join.similar_components(table(spark, sf_dir, "documents"))
