"""Quality rules: counts of each text, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed one- and two-token grams are counted: one over every document,
one over documents that labels call good. A document's score is the mean, over its grams, of
log p(good) - log p(raw); being a mean, it does not depend on length. Documents below a fixed
threshold are rejected. All of it is DataFrame functions.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.sources.scratch import materialize

WORD_BREAK = "[ \\t-\\r]+"
#: A run of letters, digits and underscores, or a run of other visible characters.
TOKEN = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]+"
WINDOW = 8


@dataclass(frozen=True)
class QualityRules:
    """Thresholds and sizes. `trusted_documents` bounds the labelled sample that the trusted
    multinomial is fitted on (those of least hash); raw counts cover all documents."""

    buckets: int = 1 << 16
    smoothing: float = 1.0
    min_ratio: float = -0.25
    trusted_documents: int = 20_000
    min_words: int = 20
    max_repeat_percent: int = 30


def _counts(text: Column) -> dict[str, Column]:
    """Counts that need no array of windows."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    return {
        "_words": F.array_remove(F.split(text, WORD_BREAK), ""),
        "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
        "_lines": lines,
    }


# No lambda below refers to another column: a filter that the optimiser moves below these
# projections would then compute that column once per element.
def _next(array: str, step: int) -> str:
    """Each element hashed with the one `step` places on; the last ones have no such partner."""
    return f"zip_with({array}, slice({array}, {step} + 1, greatest(size({array}), 1)), (a, b) -> xxhash64(a, b))"


_NO_SORTED = "CAST(array() AS ARRAY<STRUCT<h: BIGINT, at: INT>>)"
# Windows in order of (hash, position), only for texts that have two equal ones.
_SORTED = f"""
    CASE WHEN size(array_distinct(_windows)) < size(_windows)
         THEN array_sort(transform(_windows, (h, k) -> struct(h AS h, k AS at))) ELSE {_NO_SORTED} END
"""
# Positions of windows found twice or more, ascending.
_REPEATED = """
    array_sort(array_distinct(flatten(
        zip_with(slice(_sorted, 1, greatest(size(_sorted) - 1, 0)), slice(_sorted, 2, greatest(size(_sorted) - 1, 0)),
                 (a, b) -> CASE WHEN a.h = b.h THEN array(a.at, b.at) ELSE CAST(array() AS ARRAY<INT>) END))))
"""
# Words under those windows, each counted once.
_COVERED = f"""
    CAST(aggregate(_repeated, named_struct('total', 0, 'last', -{WINDOW}),
        (s, at) -> named_struct('total', s.total + least({WINDOW}, at - s.last), 'last', at),
        s -> s.total) AS LONG)
"""


def _with_grams(df: DataFrame, text: Column) -> DataFrame:
    """Hashes of all tokens and of all pairs of neighbours."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda x: F.xxhash64(x))
    grams = f"concat(_tokens, slice({_next('_tokens', 1)}, 1, greatest(size(_tokens) - 1, 0)))"
    return df.withColumn("_tokens", tokens).withColumn("_grams", F.expr(grams))


def ratio_table(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """(bucket, ratio) for every bucket, a table of fixed size.

    A document is trusted where all its labels say quality 1 and a row of docs has its id and a word. The
    sample is taken from those, so labels of documents that are not here take no place in it. Without
    a trusted document nothing can be told apart: every ratio is 0, and a warning says so.
    """
    slim = docs.select(F.col("doc_id").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    here = slim.where(F.col("_text").rlike(TOKEN)).select(F.col("_id").alias("doc_id")).distinct()
    trusted = (
        labels.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"), F.count("quality").alias("n"), F.count(F.lit(1)).alias("rows"))
        .where("least = 1 and n = rows")
        .join(here, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rules.trusted_documents)
        .select(F.col("doc_id").alias("_trusted"))
    )
    # At most trusted_documents ids, so the broadcast is bounded whatever the data holds.
    marked = slim.join(F.broadcast(trusted), F.col("_id") == F.col("_trusted"), "left").select(
        "_text", F.col("_trusted").isNotNull().cast("int").alias("_good")
    )
    grams = _with_grams(marked, F.col("_text")).select("_good", F.explode_outer("_grams").alias("gram"))
    bucket = F.pmod("gram", F.lit(rules.buckets)).cast("int")
    counts = grams.where("gram is not null").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("raw"), F.sum("_good").alias("good"))
    spark = docs.sparkSession
    table = materialize(
        spark.range(rules.buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(counts, "bucket", "left")
        .select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("good", F.lit(0)).alias("good")),
        "gram-counts",
    )
    total = table.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    if total["raw"] and not total["good"]:
        warnings.warn("no trusted document among the documents: the likelihood ratio tells nothing", stacklevel=3)
    a, room = rules.smoothing, rules.smoothing * rules.buckets
    ratio = (
        F.log((F.col("good") + a) / F.lit(total["good"] + room)) - F.log((F.col("raw") + a) / F.lit(total["raw"] + room))
        if total["good"]
        else F.lit(0.0)
    )
    return table.select("bucket", ratio.alias("ratio"))


def judge(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Every input row, as a struct `row`, with its counts, score and verdict.

    Input: docs with doc_id and text, labels with doc_id and quality (0 or 1). Added columns:
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    A null text counts as empty; an empty text has zeros, score 0 and fails the base rules.
    Null and repeated doc_ids pass through, row by row. An empty table gives an empty result.
    Whole texts are read, whatever their length. Other columns stay inside `row` and cannot clash.
    Windows and tokens are compared by 64-bit hashes.
    """
    ratios = ratio_table(docs, labels, rules)
    weights = ratios.agg(F.sort_array(F.collect_list(F.struct("bucket", "ratio"))).alias("pairs")).select("pairs.ratio")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    measured = (
        docs.select(F.struct("*").alias("row"), text.alias("_text"))
        .withColumns(_counts(F.col("_text")))
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "_hashes": F.transform("_words", lambda x: F.xxhash64(x)),
            }
        )
        .withColumn("_two", F.expr(_next("_hashes", 1)))
        .withColumn("_four", F.expr(_next("_two", 2)))
        .withColumn("_eight", F.expr(_next("_four", 4)))
        .withColumn("_windows", F.expr(f"slice(_eight, 1, greatest(size(_eight) - {WINDOW - 1}, 0))"))
        .withColumn("_sorted", F.expr(_SORTED))
        .withColumn("_repeated", F.expr(_REPEATED))
        .withColumn("n_repeat_words", F.expr(_COVERED))
        .select("row", "_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    )
    n_words, share = F.col("n_words"), rules.max_repeat_percent
    failed = (n_words < rules.min_words) | (100 * F.col("n_repeat_words") > share * n_words)
    scored = (
        _with_grams(measured, F.col("_text"))
        .withColumn("_weights", weights.scalar())
        .withColumn(
            "score",
            F.expr(
                "CASE WHEN size(_grams) = 0 THEN 0D "
                f"ELSE aggregate(_grams, 0D, (s, g) -> s + _weights[CAST(pmod(g, {rules.buckets}) AS INT)]) / size(_grams) END"
            ),
        )
        .withColumn("base_failed", failed)
    )
    result = F.struct(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("score") >= rules.min_ratio)).alias("kept"),
        "score",
    )
    # An outer explode keeps the optimiser from moving a filter on these columns below the counts, which it
    # would then evaluate several times over.
    return scored.select(F.explode_outer(F.array(result)).alias("judged")).select("judged.*")


def accepted(judged: DataFrame) -> DataFrame:
    """The input columns of kept rows."""
    return judged.where("kept").select("row.*")
