"""A training corpus from documents: rules, language, near duplicates, benchmark leaks, tokens.

Each stage reads what its predecessor kept, written as Parquet. All but the last return the
columns of documents. SQL can't express them (trained models, trained vocabularies), so
ORACLE_SQL is None and tests compare the stages with brute force. An empty table goes through all
stages as an empty table, whole texts are read, and columns beyond those of documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.llm import decontamination, language_id, quality
from sojourn.llm.near_dedup import one_of_each
from sojourn.llm.piece_codec import encode_decode
from sojourn.llm.queries import piece_model, table
from sojourn.llm.rows import keep_rows
from sojourn.sources.scratch import materialize

#: How far from chance (one over the number of languages) to certainty the probability of a
#: document's language must lie. Held-out documents that pass the rules have 0.87 or more of four
#: languages; random letters and other languages have 0.49 at most.
LANGUAGE_MARGIN = 0.5


def least_language_score(languages: int) -> float:
    """The least calibrated probability a row is kept with: 0.625 of four languages."""
    chance = 1 / max(languages, 1)
    return chance + LANGUAGE_MARGIN * (1 - chance)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the likelihood ratio. Null and empty texts fail the rules; repeated rows and
    rows without doc_id are judged each for itself."""
    return quality.accepted(quality.judge(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a letter and is clearly of one of the languages of `lang`; the model is fitted
    on the rows not held out. With a single language there is nothing to tell it from, and any letter will do.
    Null and letterless texts go; repeated rows and rows without doc_id are judged each for itself."""
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    shared = spark.sparkContext.broadcast(model)
    least = least_language_score(len(model.languages) if model else 0)
    return keep_rows(docs, lambda texts: [score >= least for _, score in language_id.predict(shared.value, texts)])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component under links of 0.8 or more on five-word shingles: that of least doc_id, rows without
    one last. Rows are told apart by doc_id and text, so one id with two texts is two rows, and a repeated row
    is there once. Null and word-less texts link with nothing and stay; texts of any length are compared whole."""
    return one_of_each(docs, width=5, num=80, den=100)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows into which no benchmark item leaks. Nothing leaks into null and empty texts; repeated rows and rows without
    doc_id are judged each for itself."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and what they decode to by its digest. A null text counts as empty; rows without doc_id and
    repeated rows are encoded each for itself."""
    coded = encode_decode(docs, piece_model())
    return coded.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what comes between them lies in the scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
