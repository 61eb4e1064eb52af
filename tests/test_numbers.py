from datetime import datetime

from pyspark.sql import functions as F

from polyglint.functions import numbers as num


def test_durations(spark):
    rows = ["PT1H2M3S", "PT45S", "P1DT1S", "P1M", "", "P", "PT", "P2W", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    out = [r[0] for r in df.select(num.iso_duration_seconds(F.col("t"))).collect()]
    assert out == [3723.0, 45.0, 86401.0, None, None, None, None, 1209600.0, None]


def test_timestamps(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("x",), (None,)], "t string")
    out = [r[0] for r in df.select(num.parse_timestamp(F.col("t"))).collect()]
    assert out == [datetime(2024, 1, 2, 3, 4, 5), None, None]


def test_counts_and_ratios(spark):
    df = spark.createDataFrame([("12", 3.0, 10.0), ("", 3.0, 0.0), (None, 0.0, 5.0), ("x", 1.0, None)], "t string, a double, b double")
    out = df.select(num.to_count(F.col("t")), num.guarded_ratio(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in out] == [(12, 0.3), (0, 0.0), (0, 0.0), (0, 0.0)]


def test_human_number(spark):
    df = spark.createDataFrame([(999.9,), (1234.0,), (5.66e6,), (7.8e9,)], "v double")
    assert [r[0] for r in df.select(num.human_number(F.col("v"))).collect()] == ["999", "1.2K", "5.7M", "7.8B"]


def test_weekday(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 7),)], "t timestamp")
    out = df.select(num.weekday_name(num.weekday_number(F.col("t")))).collect()
    assert [r[0] for r in out] == ["Mon", "Sun"]
