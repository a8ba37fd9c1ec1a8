"""One case per trap in the cleaning and banding functions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sojourn.functions import bands, keys, numbers, rates, text, time


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_clean_label(spark):
    raw = ["  rto-adopt ", "STRAY", "return   to owner", "", "   ", None, "a - b", "x--y", "\tstray", "o'neil-mc dog"]
    want = ["Rto-Adopt", "Stray", "Return To Owner", None, None, None, "A - B", "X--Y", " Stray", "O'neil-Mc Dog"]
    assert apply(spark, text.clean_label, raw) == want


def test_age_text(spark):
    raw = ["2 years", "3 months", "1 week", "4 days", "NULL", " unknown ", "", "-1 years", "years", "5",
           "1.5 years", None, "2 YEARS 3 months", "0 days", "99999999999 days"]
    want = [730, 90, 7, 4, None, None, None, None, None, None, 365, None, 730, 0, None]
    assert apply(spark, text.age_text_to_days, raw) == want


def test_safe_timestamp(spark):
    got = apply(spark, text.safe_timestamp, ["2024-01-02T00:00:00.000", "not a date", " 2024-01-02 ", None])
    assert got == [datetime(2024, 1, 2), None, None, None]


def test_strict_timestamp_fails_the_build(spark):
    from pyspark.errors import DateTimeException

    df = spark.createDataFrame([("not a date",)], "v string").select(F.col("v").cast("timestamp_ntz"))
    with pytest.raises(DateTimeException):
        df.collect()


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("null", "x")], "a string, b string")
    digests = [r[0] for r in df.select(keys.surrogate_key(F.col("a"), F.col("b"))).collect()]
    assert len(set(digests)) == 4


def test_classes(spark):
    raw = ["Adoption", "Rto-Adopt", "Missing", "Relocate", None]
    assert apply(spark, rates.classify_outcome, raw) == ["Live", "Live", "Non-Live", "Unknown", None]


def test_rates(spark):
    rows = [(1, "Live", False), (1, "Non-Live", True), (1, "Live", None), (1, "Unknown", False), (2, "Unknown", False)]
    df = spark.createDataFrame(rows, "g int, c string, x boolean")
    out = df.groupBy("g").agg(
        rates.live_release_rate(F.col("c")).alias("all"),
        rates.live_release_rate(F.col("c"), F.col("x")).alias("adjusted"),
    )
    # A null flag leaves its row out of both sides; no classified rows give no rate.
    assert sorted(map(tuple, out.collect())) == [(1, 66.67, 100.0), (2, None, None)]


def test_rounding_uses_the_binary_value(spark):
    assert apply(spark, lambda c: numbers.round_half_away(c, 2), [0.285, 2.5, -1.005], "double") == [0.28, 2.5, -1.0]


def test_age_bands_close_on_different_sides(spark):
    days = [None, 0, 180, 181, 365, 1095, 2555, 2556]
    fact = [None, "Under 6 months", "6 to 12 months", "6 to 12 months", "1 to 3 years", "3 to 7 years",
            "7 years and over", "7 years and over"]
    drift = ["nan", "<6m", "<6m", "6-12m", "6-12m", "1-3y", "3-7y", "7y+"]
    assert apply(spark, bands.age_band, days, "int") == fact
    assert apply(spark, bands.drift_age_band, days, "int") == drift


def test_attribute_text(spark):
    assert apply(spark, bands.jurisdiction, ["12 A St in B in Millbrook (TX)", "Eastham (TX)", "Outside Jurisdiction", "(TX)", None]) == [
        "Millbrook", "Eastham", "Outside Jurisdiction", "Unknown", "Unknown"]
    assert apply(spark, bands.primary_component, ["Pit Bull Mix/Boxer", "Black/White", "/x", None]) == [
        "Pit Bull", "Black", "Unknown", "Unknown"]
    assert apply(spark, bands.is_mix, ["A Mix", "A/B", "A", None]) == ["Mix", "Mix", "Single", "Single"]
    assert apply(spark, bands.reproductive_status, ["Intact Male", "Spayed Female", "intact", None]) == [
        "Intact", "Altered", "Unknown", "Unknown"]


def test_band_index(spark):
    df = spark.createDataFrame(
        [(1, 5.0, [1.0, 5.0]), (2, None, [0.0]), (3, 9.0, None)], "i int, v double, e array<double>"
    )
    out = df.select("i", bands.band_index(F.col("v"), F.col("e")).alias("b")).orderBy("i").collect()
    assert [r["b"] for r in out] == ["2", "0", "unknown"]


def test_days(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 23:59:00' s, timestamp_ntz'2024-01-02 00:01:00' e")
    from sojourn.plans.episodes import duration_days, is_invalid

    s, e = F.col("s"), F.col("e")
    row = df.select(duration_days(s, e), time.whole_days_between(s, e), is_invalid(s, e),
                    duration_days(e, s), is_invalid(e, s), duration_days(s, s), is_invalid(s, s)).first()
    assert tuple(row) == (1, 0, False, None, True, 0, False)


def test_month_start_keeps_the_type(spark):
    df = spark.sql("select timestamp_ntz'2024-03-31 23:30:00' t").select(time.month_start(F.col("t")).alias("m"))
    assert df.schema["m"].dataType.simpleString() == "timestamp_ntz"
    assert df.first()["m"] == datetime(2024, 3, 1)


def test_recalibration_identity(spark):
    got = apply(spark, lambda c: numbers.recalibrated(c, 1.0, 0.0), [0.0, 0.25, 1.0], "double")
    assert got == pytest.approx([1e-6, 0.25, 1 - 1e-6])


def test_only_full_dates_are_times(spark):
    texts = ["2024", "2024-03", "2024-03-05 14", "2024-03-05T", "not a date", "", None, "2024-3-5", "2024-03-05 14:15", "2024-03-05T14:15:00.000"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["x"] for r in frame.select(text.safe_timestamp(F.col("t")).alias("x")).collect()]
    assert got[:7] == [None] * 7 and None not in got[7:]
    strict = frame.select(text.strict_timestamp(F.col("t")).alias("x"), "t")
    assert strict.where("t is null or length(t) > 13 or t like '%-3-%'").count() == 4
    for bad in ("2024", "2024-03-05 14", "not a date"):
        with pytest.raises(Exception, match="not a full date"):
            strict.where(F.col("t") == bad).collect()
