"""Proportional stratified interleaving into shards.

Rows are ranked within their source in a seeded pseudo-random order; a row's place in the
whole is its fractional rank, (rank - 1/2) / (rows of the source). Cutting that order into equal
parts gives every shard its share of every source, to within one row for each source there is.

Neither order is sorted as a whole. The seeded hash deals a source's rows evenly into buckets, and
counts per bucket tell where each begins; so a hot source is ranked in many tasks. For the whole order
rows go to buckets by fraction, and how many rows lie below a bucket follows from the sizes of the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sojourn.sources.scratch import materialize

#: Hex digits of the hash that name a source's bucket, and rows of a bucket of the whole order.
BUCKET_DIGITS, BUCKET_ROWS = 3, 100_000
#: What a row takes up besides its text.
OVERHEAD = 16


def interleave(docs: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    The law is `rows`: shard sizes differ by one row at most. slot counts from 0 within a shard.
    size is the UTF-8 length of the text plus 16; a null text has none, and the crc32 of nothing.

    Input: doc_id, text and source; other columns are not read. Rows without a source are a
    source of their own. Order within a source is by md5 of seed and doc_id, then doc_id, crc32
    and size, nulls first; rows equal in all of these are interchangeable. Fewer rows than shards
    leave shards empty, and an empty table gives an empty result. Equal texts are not kept together: the law is
    about rows, so copies of a text usually lie in several shards.
    """
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary")).alias("draw"),
    )
    within = ["draw", "doc_id", "text_crc32", "size"]
    stratum = ["no_source", "source"]
    # Texts are read once.
    stored = materialize(slim.withColumn("bucket", F.substring("draw", 1, BUCKET_DIGITS)), "rows-to-shard")
    ranked, sizes = _ranked(stored, stratum, within)
    total = sizes.agg(F.sum("of").alias("rows")).first()["rows"] or 0
    cuts = total // BUCKET_ROWS + 1
    bucket = F.expr(f"((2 * rank - 1) * {cuts}) div (2 * of)")
    placed = ranked.withColumns({"fraction": (F.col("rank") * 2 - 1) / (F.col("of") * 2), "cut": bucket})
    # Of a source's rows, those with a fraction below k / cuts.
    below = (
        sizes.select("of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cuts - 1).cast("long"))).alias("cut"))
        .groupBy("cut")
        .agg(F.sum(F.expr(f"(2 * of * cut + {cuts - 1}) div (2 * {cuts})")).alias("before"))
    )
    order = Window.partitionBy("cut").orderBy("fraction", *stratum, *within)
    whole = placed.withColumn("local", F.row_number().over(order)).join(below, "cut").withColumn("place", F.col("before") + F.col("local"))
    # Integer arithmetic: the first place of a shard is the least p with p * shards >= shard * total.
    cut = whole.withColumn("shard", F.expr(f"((place - 1) * {shards}) div {max(total, 1)}").cast("int"))
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("place") - 1 - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _ranked(rows: DataFrame, stratum: list[str], within: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with rank and of, sizes): places from 1 within the stratum by `within`, which begins with the hash that
    `bucket` is the head of, and each stratum's number of rows."""
    counts = materialize(rows.groupBy(*stratum, "bucket").agg(F.count(F.lit(1)).alias("n")), "bucket-counts")
    so_far = Window.partitionBy(*stratum).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = counts.select(
        *stratum, "bucket", F.coalesce(F.sum("n").over(so_far), zero).alias("before"), F.sum("n").over(Window.partitionBy(*stratum)).alias("of")
    )
    inside = Window.partitionBy(*stratum, "bucket").orderBy(*within)
    numbered = rows.withColumn("local", F.row_number().over(inside)).join(starts, [*stratum, "bucket"])
    sizes = counts.groupBy(*stratum).agg(F.sum("n").alias("of"))
    return numbered.withColumn("rank", F.col("before") + F.col("local")).drop("before", "local", "bucket"), sizes
