from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidemark.functions.columns import (
    bool_encode,
    scrub,
    to_timestamp_safe,
    utc_to_zone,
    watermark_text,
    year_month,
)


def test_scrub_parity_removes_every_substring(spark):
    df = spark.createDataFrame([("null",), ("nullify",), ("NULL",), ("",), (None,), ("a null b null",)], "s string")
    got = [r[0] for r in df.select(scrub(F.col("s"))).collect()]
    assert got == ["", "ify", "NULL", "", None, "a  b "]


def test_scrub_whole_value_only_blanks_exact_token(spark):
    df = spark.createDataFrame([("null",), ("nullify",), (None,)], "s string")
    got = [r[0] for r in df.select(scrub(F.col("s"), whole_value=True)).collect()]
    assert got == ["", "nullify", None]


def test_scrub_turns_other_types_to_text(spark):
    df = spark.createDataFrame([(7,)], "i int")
    out = df.select(scrub(F.col("i")).alias("i"))
    assert out.schema["i"].dataType.simpleString() == "string"
    assert out.first()[0] == "7"


def test_bool_encode_rules(spark):
    df = spark.createDataFrame([("true",), ("false",), ("",), (None,), ("maybe",)], "s string")
    assert [r[0] for r in df.select(bool_encode(F.col("s"))).collect()] == [1, 0, 0, 1, 1]
    assert [r[0] for r in df.select(bool_encode(F.col("s"), null_as=0)).collect()] == [1, 0, 0, 0, 1]
    assert [r[0] for r in df.select(bool_encode(F.col("s"), null_as=None)).collect()] == [1, 0, 0, None, 1]


def test_year_month_uses_date_as_written(spark):
    rows = [("2017-03-31T23:30:00.000-0700",), ("2017-11-01T00:00:00.000+0000",),
            ("2017-11-01T00:00:00.000Z",), ("",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(year_month(F.col("s"), df.schema["s"].dataType)).collect()]
    assert got == ["201703", "201711", "201711", None, None]


def test_to_timestamp_safe_on_empty_text(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("",), ("junk",)], "s string")
    got = [r[0] for r in df.select(to_timestamp_safe(F.col("s"), ntz=True)).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4, 5), None, None]


def test_utc_to_zone_winter_and_summer(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12),), (datetime(2024, 7, 1, 12),)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(utc_to_zone(F.col("ts"), "MST7MDT", TimestampNTZType())).collect()]
    assert got == [datetime(2024, 1, 1, 5), datetime(2024, 7, 1, 6)]


def test_watermark_text_cuts_to_seconds(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 25, 0, 5, 9, 245145),)], "ts timestamp_ntz")
    assert df.select(watermark_text(F.col("ts"))).first()[0] == "2024-01-25T00:05:09Z"
