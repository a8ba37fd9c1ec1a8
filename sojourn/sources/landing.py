"""Landing of newline-delimited JSON feeds into all-text snapshot tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sojourn.sources.tables import publish

SNAPSHOT = "snapshot"
# The two feeds' column lists.
START_COLUMNS = [
    "animal_id", "name", "datetime", "found_location", "intake_type", "intake_condition",
    "animal_type", "sex_upon_intake", "age_upon_intake", "breed", "color",
]
END_COLUMNS = [
    "animal_id", "name", "datetime", "date_of_birth", "outcome_type", "outcome_subtype",
    "animal_type", "sex_upon_outcome", "age_upon_outcome", "breed", "color",
]


class LandingError(RuntimeError):
    """The landed files cannot replace the snapshot."""


@dataclass(frozen=True)
class LandingReport:
    expected_rows: int
    loaded_rows: int
    absent_columns: list[str] = field(default_factory=list)


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_landed(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Every listed column as text; keys a file does not carry read as null."""
    return (
        spark.read.schema(text_schema(columns))
        .option("mode", "FAILFAST")
        .option("primitivesAsString", "true")
        .json(path)
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """One record each; blank lines hold none."""
    return spark.read.text(path).where(F.trim("value") != "")


def landed_line_count(spark: SparkSession, path: str) -> int:
    """Records in the landed files, counted without parsing them."""
    return _lines(spark, path).count()


def landed_keys(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(key, status, objects, filled) of every key that the landed objects carry or the column list names.

    status is `present`, `null` where no object has a value for it, `absent` where no object has the key, and `unexpected`
    for a key that the list does not name. One pass over the lines; keys are counted map-side.
    """
    read = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    pairs = _lines(spark, path).select(F.explode(read).alias("key", "text"))
    counts = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("objects"), F.count("text").alias("filled"))
    named = spark.createDataFrame([(c,) for c in columns], "key string").withColumn("named", F.lit(True))
    zero = F.lit(0).cast("long")
    status = (
        F.when(F.col("named").isNull(), "unexpected").when(F.col("objects").isNull(), "absent")
        .when(F.col("filled") == 0, "null").otherwise("present")
    )
    return counts.join(F.broadcast(named), "key", "full").select(
        "key", status.alias("status"), F.coalesce("objects", zero).alias("objects"), F.coalesce("filled", zero).alias("filled")
    )


def replace_snapshot(
    spark: SparkSession, landed: str, target: str, columns: list[str], expected: int | None = None
) -> LandingReport:
    """Full-refresh load of the table `snapshot` under `target`.

    An empty source, a bad record or a wrong row count raises and leaves the old snapshot current. A column is
    reported as absent if no record has a value for it; landed_keys tells why.
    """
    if expected is None:
        expected = landed_line_count(spark, landed)
    if expected == 0:
        raise LandingError(f"no rows to load from {landed}; {target} stays as it is")

    def reconciled(stored: dict[str, DataFrame]) -> LandingReport:
        filled = stored[SNAPSHOT].agg(
            F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in columns]
        ).first()
        if filled["rows"] != expected:
            raise LandingError(f"{expected} rows landed but {filled['rows']} are in the load; {target} stays as it is")
        return LandingReport(expected, filled["rows"], [c for c in columns if filled[c] == 0])

    return publish({SNAPSHOT: read_landed(spark, landed, columns)}, target, reconciled)[1]
