"""Token totals by source, language and tokenizer version, kept up to date by signed batches.

A folder holds versions of two tables: the totals, and the batches that are in them, each with a
digest of its changes. A commit sums its batch to one signed row per group, adds those to the
totals, writes both tables aside and then claims the next version number by renaming a file to a
name that must not be there yet. So a commit is in the totals as a whole or not at all, once however often
it is sent; of two writers that race one claims the number and the other begins again on what the
first one left. Reading costs the groups there are, not the batches there were.
"""

from __future__ import annotations

import base64
import functools
import uuid
from collections.abc import Callable

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.sources.scratch import materialize

KEYS = ["source", "lang", "tokenizer"]
_TOTALS = "source string, lang string, tokenizer string, documents long, tokens long"
_BATCHES = "batch_id string, digest string"


@functools.lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def bpe_tokens(path: str, pattern: str) -> Callable[[Column], Column]:
    """Tokens of a text under a byte-level vocabulary file, which every executor has; null has none."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encoding = _encoding(path, pattern)
        return pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.size(F.array_remove(F.split(text, "[ \\t-\\r]+"), "")), F.lit(0)).cast("long")


def inserts(rows: DataFrame) -> DataFrame:
    """Signed changes for new documents: KEYS and tokens in."""
    return rows.select(*KEYS, F.lit(1).cast("long").alias("documents"), F.col("tokens").cast("long").alias("tokens"))


def deletes(rows: DataFrame) -> DataFrame:
    """Signed changes for withdrawn documents: KEYS and the tokens they were entered with."""
    return rows.select(*KEYS, F.lit(-1).cast("long").alias("documents"), (-F.col("tokens")).cast("long").alias("tokens"))


def revisions(rows: DataFrame) -> DataFrame:
    """Signed changes for recounted documents: KEYS, old_tokens and tokens."""
    return rows.select(*KEYS, F.lit(0).cast("long").alias("documents"), (F.col("tokens") - F.col("old_tokens")).cast("long").alias("tokens"))


class ConflictingBatch(ValueError):
    """A batch id that is known already comes with other changes."""


class TokenTotals:
    """A rollup in one shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        """Numbers of the versions there are, in order."""
        files, path = self._files()
        return sorted(int(s.getPath().getName()) for s in files.listStatus(path)) if files.exists(path) else []

    def _tables(self, version: int) -> tuple[DataFrame, DataFrame]:
        """(totals, batches) of a version; the one before the first is empty."""
        if not version:
            return self.spark.createDataFrame([], _TOTALS), self.spark.createDataFrame([], _BATCHES)
        files, path = self._files(f"/{version:012d}")
        stream = files.open(path)
        try:
            folder = stream.readUTF()
        finally:
            stream.close()
        root = f"{self.path}/data/{folder}"
        return self.spark.read.schema(_TOTALS).parquet(f"{root}/totals"), self.spark.read.schema(_BATCHES).parquet(f"{root}/batches")

    def _claim(self, version: int, folder: str) -> bool:
        """Makes the tables in a folder this version, unless there is one. The file that says so is written
        aside and renamed, which fails where the name is taken, so nobody sees half of it."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        files, aside = self._files(f"-aside/{folder}")
        stream = files.create(aside, False)
        stream.writeUTF(folder)
        stream.close()
        target = self._files(f"/{version:012d}")[1]
        files.mkdirs(target.getParent())
        target, aside = files.makeQualified(target), files.makeQualified(aside)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(aside, target, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Py4JJavaError:
            if files.exists(target):
                return False
            raise
        return True

    def _current(self) -> int:
        return max(self.versions(), default=0)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of signed changes; False, and nothing is done, if it is in already.

        Changes are summed map-side by group. Null keys are groups of their own, null counts
        count nothing, and a batch without changes is recorded too. A known id with other changes
        raises ConflictingBatch: what it adds is compared group by group, by a digest.
        """
        summed = changes.groupBy(*KEYS).agg(
            F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
        )
        rows = materialize(summed.where("documents <> 0 or tokens <> 0"), "token-batch")
        row_hash = F.xxhash64(*[F.coalesce(c, F.lit("")) for c in KEYS], *[F.col(c).isNull() for c in KEYS], "documents", "tokens")
        known = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(row_hash.cast("decimal(38,0)")).alias("h"), F.bit_xor(F.xxhash64(row_hash)).alias("x"))
        digest = ":".join(str(x) for x in known.first())
        while True:
            version = self._current()
            totals, batches = self._tables(version)
            before = batches.where(F.col("batch_id") == batch_id).first()
            if before and before["digest"] != digest:
                raise ConflictingBatch(f"batch {batch_id} was committed with other changes")
            if before:
                return False
            folder = uuid.uuid4().hex
            added = totals.unionByName(rows).groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
            added.where("documents <> 0 or tokens <> 0").write.parquet(f"{self.path}/data/{folder}/totals")
            mark = self.spark.createDataFrame([(batch_id, digest)], _BATCHES)
            batches.unionAll(mark).write.parquet(f"{self.path}/data/{folder}/batches")
            if self._claim(version + 1, folder):
                return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents and tokens; groups that are down to nothing are left out."""
        return self._tables(self._current())[0]

    def compact(self, keep: int = 2) -> None:
        """Deletes versions, and their tables, but for the last `keep`; readers of older ones must be done."""
        for version in self.versions()[: -max(keep, 1)]:
            files, path = self._files(f"/{version:012d}")
            stream = files.open(path)
            folder = stream.readUTF()
            stream.close()
            # The number goes last, so a compaction that was cut off can be done again.
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/{folder}"), True)
            files.delete(path, False)
