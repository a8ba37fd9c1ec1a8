"""Start and end feeds derived from the order tables.

A plain view over whole tables: every order becomes a start event and, once its goods
have moved, an end event. The arithmetic on the order key plants the hazards of a real
feed (mixed case, padding, bad ages, missing keys, repeated rows, end before start); it
never thins the data out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.sources.landing import END_COLUMNS, START_COLUMNS
from sojourn.sources.tables import scan



def _messy(text: str) -> str:
    return (
        f"case when k % 33 = 0 then upper({text}) when k % 33 = 1 then concat('  ', {text}, ' ') "
        f"when k % 50 = 2 then lower({text}) else {text} end"
    )


def _stamp(moment: str) -> str:
    return f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")"


_NAME = "case k % 3 when 0 then null when 1 then '  ' else concat('Name', k % 50) end"
_TYPE = (
    "case when segment in ('HOUSEHOLD', 'BUILDING') then 'Dog' "
    "when segment in ('FURNITURE', 'AUTOMOBILE') then 'Cat' when segment = 'MACHINERY' then 'Other' end"
)
_SEX = (
    "case k % 5 when 0 then 'Neutered Male' when 1 then 'Spayed Female' "
    "when 2 then 'Intact Male' when 3 then 'Intact Female' else 'Unknown' end"
)
_AGE = (
    "case when k % 60 = 0 then 'NULL' when k % 60 = 1 then '-2 years' when k % 60 = 2 then null "
    "when k % 60 = 3 then 'unknown' when k % 60 < 20 then concat(k % 12, ' months') "
    "when k % 60 < 30 then concat(k % 4 + 1, ' weeks') when k % 60 < 33 then concat(k % 6 + 1, ' days') "
    "else concat(k % 14 + 1, ' years') end"
)
_BREED = (
    "case k % 3 when 0 then concat('Breed ', k % 60, ' Mix') "
    "when 1 then concat('Breed ', k % 60, '/Breed ', k % 7) else concat('Breed ', k % 60) end"
)
_COLOR = "case k % 4 when 0 then 'Black/White' when 1 then 'Tan' when 2 then 'Brown Tabby' else 'White' end"
_PLACE = (
    "case k % 4 when 0 then concat('City', k % 9, ' (TX)') "
    "when 1 then concat(k % 900, ' Main St in City', k % 9, ' (TX)') "
    "when 2 then 'Outside Jurisdiction' end"
)
_INTAKE_TYPE = (
    "case priority when '1-URGENT' then 'Stray' when '2-HIGH' then 'Owner Surrender' "
    "when '3-MEDIUM' then 'Public Assist' "
    "when '4-NOT SPECIFIED' then case when k % 2 = 0 then 'Wildlife' else 'Abandoned' end "
    "when '5-LOW' then case when k % 3 = 0 then 'Euthanasia Request' else 'Stray' end end"
)
_CONDITION = "case status when 'F' then 'Normal' when 'O' then 'Injured' when 'P' then 'Sick' end"
_OUTCOME_TYPE = (
    "case when k % 97 = 5 then 'Relocate' when k % 101 = 6 then null when k % 11 = 3 then 'Missing' "
    "else case rf when 'AF' then 'Adoption' when 'AO' then 'Transfer' when 'NF' then 'Return to Owner' "
    "when 'NO' then 'Rto-Adopt' when 'RF' then 'Euthanasia' when 'RO' then 'Died' end end"
)
_END_AT = (
    "case when k % 250 = 7 then ts - interval 3 days "
    "else ts + make_dt_interval(cast(q as int), 0, cast((k * 7) % 600 as int), 0) end"
)


def _with_repeats(df: DataFrame) -> DataFrame:
    """The portal sends some rows twice."""
    copies = F.when(F.col("k") % 181 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("copy", F.explode(copies))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = scan(spark, sf_dir, "orders")
    customers = scan(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")
    )
    return orders.join(customers, "o_custkey").select(
        F.col("o_orderkey").alias("k"),
        F.concat(F.lit("A"), F.col("o_custkey")).alias("animal_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        "segment",
        F.expr("o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int), 0)").alias("ts"),
    )


def _columns(spec: dict[str, str], names: list[str]) -> list[Column]:
    return [F.expr(spec[name]).alias(name) for name in names]


def start_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text start events. Some carry no time, so their ends have nothing to close."""
    spec = {
        "animal_id": "animal_id",
        "name": _NAME,
        "datetime": f"case when k % 120 <> 0 then {_stamp('ts')} end",
        "found_location": _PLACE,
        "intake_type": _messy(f"({_INTAKE_TYPE})"),
        "intake_condition": _messy(f"({_CONDITION})"),
        "animal_type": _TYPE,
        "sex_upon_intake": _SEX,
        "age_upon_intake": _AGE,
        "breed": _BREED,
        "color": _COLOR,
    }
    return _with_repeats(_orders(spark, sf_dir)).select(*_columns(spec, START_COLUMNS))


def end_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text end events known at the snapshot."""
    lines = (
        scan(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("k"))
        .agg(
            F.min("l_quantity").cast("int").alias("q"),
            F.min(F.ascii("l_returnflag") * 128 + F.ascii("l_linestatus")).alias("codes"),
        )
        # The least flag pair, compared as a number so that the aggregate hashes, not sorts.
        .select("k", "q", F.expr("concat(chr(codes div 128), chr(codes % 128))").alias("rf"))
    )
    kind = f"({_OUTCOME_TYPE})"
    subtype = (
        f"case when {kind} = 'Transfer' and {_TYPE} = 'Cat' and k % 2 = 0 then 'SNR' "
        f"when {kind} = 'Transfer' then 'Partner' end"
    )
    spec = {
        "animal_id": "animal_id",
        "name": _NAME,
        "datetime": _stamp("end_at"),
        "date_of_birth": (
            "case when k % 77 = 0 then 'not a date' when k % 77 = 1 then '2024' when k % 77 = 2 then '2024-03' "
            "when k % 77 = 3 then '2024-03-05 14' else "
            "date_format(ts - make_dt_interval(cast(k % 4000 as int)), \"yyyy-MM-dd'T'00:00:00.000\") end"
        ),
        "outcome_type": _messy(kind),
        "outcome_subtype": subtype,
        "animal_type": _TYPE,
        "sex_upon_outcome": _SEX,
        "age_upon_outcome": _AGE,
        "breed": _BREED,
        "color": _COLOR,
    }
    # The snapshot is taken on the morning after the last order.
    snapshot = scan(spark, sf_dir, "orders").agg((F.to_date(F.max("o_orderdate")) + F.expr("interval 1 day")).alias("at")).first()["at"]
    ended = (
        _orders(spark, sf_dir)
        .join(lines, "k")
        .withColumn("end_at", F.expr(_END_AT))
        .where(F.col("end_at") < F.lit(snapshot).cast("timestamp_ntz"))
    )
    return _with_repeats(ended).select(*_columns(spec, END_COLUMNS))
