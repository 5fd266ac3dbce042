import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import numbers, texts, times


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,want",
    [("12.5", 12.5), (" 7 ", 7.0), ("1e3", 1000.0), ("-2", -2.0), ("abc", None), ("12d", None), ("3.f", None),
     ("NaN", None), ("", None), (None, None), ("inf", float("inf")), ("Infinity", float("inf")), ("1,5", None)],
)
def test_to_number(spark, text, want):
    assert one(spark, numbers.to_number(F.col("v")), text) == want


@pytest.mark.parametrize("text", ["", "NA", "N/A", "nan", "NaN", "null", "NULL", "None", "#N/A", "<NA>", " NA "])
def test_null_tokens(spark, text):
    assert one(spark, numbers.null_tokens(F.col("v")), text) is None


def test_null_tokens_keep_other_text(spark):
    assert one(spark, numbers.null_tokens(F.col("v")), "Nadia") == "Nadia"


@pytest.mark.parametrize("text,want", [("1.5", 1.5), ("x", 0.0), (None, 0.0), ("NaN", 0.0)])
def test_safe_float(spark, text, want):
    assert one(spark, numbers.safe_float(F.col("v")), text) == want


@pytest.mark.parametrize(
    "a,b,want",
    [(1.0, 1.0 + 0.5e-6, True), (1.0, 1.0 + 2e-6, False), (None, None, True), (None, 0.0, False), (0.0, None, False),
     (float("inf"), None, True), (float("-inf"), float("inf"), True), (0.0, 0.0, True)],
)
def test_close_to(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(numbers.close_to(F.col("a"), F.col("b"))).first()[0] is want


def test_tolerance_is_strict(spark):
    df = spark.createDataFrame([(0.5, 0.25)], "a double, b double")
    assert df.select(numbers.close_to(F.col("a"), F.col("b"), 0.25)).first()[0] is False


@pytest.mark.parametrize(
    "size,one_decimal,two_decimals",
    [(0, "0.0 B", "0 B"), (512, "512.0 B", "512.0 B"), (1280, "1.2 KB", "1.25 KB"), (1500, "1.5 KB", "1.46 KB"),
     (1024**2, "1.0 MB", "1.0 MB"), (3 * 1024**3 + 5, "3.0 GB", "3.0 GB"), (2 * 1024**4, "2.0 TB", "2.0 TB"),
     (5 * 1024**5, "5120.0 TB", "5120.0 TB")],
)
def test_sizes(spark, size, one_decimal, two_decimals):
    assert one(spark, texts.size_one_decimal(F.col("v")), size, "bigint") == one_decimal
    assert one(spark, texts.size_two_decimals(F.col("v")), size, "bigint") == two_decimals


@pytest.mark.parametrize(
    "path,want",
    [("file:/raw/2012-1.csv", "2012-1.csv"), ("/raw/2012-1.csv/part-00000-a.csv", "2012-1.csv"),
     ("/raw/source_file=validation.csv/part-1.csv", "validation.csv"), ("/raw/partial.csv", "partial.csv"),
     ("/raw/source_file=a%3Ab.csv/part-1.csv", "a:b.csv")],
)
def test_source_name(spark, path, want):
    assert one(spark, texts.source_name(F.col("v")), path) == want


def test_stem_and_ids(spark):
    df = spark.createDataFrame([("2012-1.csv", 7), ("a.b.csv", 12345)], "f string, n int")
    at = F.lit("2012-03-04 05:06:07").cast("timestamp")
    got = [tuple(r) for r in df.select(texts.stem(F.col("f")), texts.stamped_batch_id(F.col("f"), F.col("n"), at)).collect()]
    assert got == [
        ("2012-1", "2012-1_batch_0007_20120304_050607"), ("a.b", "a.b_batch_12345_20120304_050607"),
    ]


def test_ceil_div_and_saving(spark):
    df = spark.createDataFrame([(0,), (1,), (1000,), (1001,)], "n bigint")
    assert [r[0] for r in df.select(numbers.ceil_div(F.col("n"), 1000)).collect()] == [0, 1, 1, 2]
    saved = spark.createDataFrame([(30, 100), (5, 0)], "a bigint, b bigint")
    assert [r[0] for r in saved.select(numbers.saved_percent(F.col("a"), F.col("b"))).collect()] == [70.0, None]


def test_round_or_zero(spark):
    assert one(spark, numbers.round_or_zero(F.col("v")), 2.345678, "double") == 2.35
    assert one(spark, numbers.round_or_zero(F.col("v")), None, "double") == 0.0


def test_stats_text(spark):
    df = spark.createDataFrame([(1500, 2.5, 1.0, 1234.5), (0, None, None, None)], "c bigint, a double, l double, h double")
    got = [r[0] for r in df.select(texts.stats_line(F.col("c"), F.col("a"), F.col("l"), F.col("h"))).collect()]
    assert got == ["Count: 1,500, Avg: $2.50, Min: $1.00, Max: $1234.50", "Count: 0, Stats: N/A"]


@pytest.mark.parametrize(
    "text,want",
    [("2012-01-05T10:11:12", dt.datetime(2012, 1, 5, 10, 11, 12)), ("2012-01-05 10:11:12.5", dt.datetime(2012, 1, 5, 10, 11, 12, 500000)),
     ("2012-01-05 10:11:12.500000", dt.datetime(2012, 1, 5, 10, 11, 12, 500000)),
     ("2012-01-05", dt.datetime(2012, 1, 5)), ("1/5/2012", dt.datetime(2012, 1, 5)),
     ("2012-01-05T10:11:12+01:00", dt.datetime(2012, 1, 5, 9, 11, 12)), ("soon", None), (None, None),
     ("10:11:12", None), ("2012", None), ("2012-13-45", None), ("1/5/2012 1:02:03", dt.datetime(2012, 1, 5, 1, 2, 3))],
)
def test_parse_timestamp(spark, text, want):
    assert one(spark, times.parse_timestamp(F.col("v")), text) == want


def test_last_day_counts_as_within(spark):
    df = spark.createDataFrame([("2012-12-31 23:59:59",), ("2013-01-01 00:00:00",), ("2011-12-31 23:59:59",)], "v string")
    inside = times.within_days(F.col("v").cast("timestamp"), "2012-01-01", "2012-12-31")
    assert [r[0] for r in df.select(inside).collect()] == [True, False, False]


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(0, None)], "count bigint, min double")
    assert df.select(texts.null_safe_json(F.struct("count", "min"))).first()[0] == '{"count":0,"min":null}'


def test_report_date(spark):
    assert one(spark, texts.date_in_name(F.col("v")), "daily_report_20250603.txt") == "20250603"


def test_statistics_text_with_times(spark):
    at = F.lit("2024-05-06 07:08:09").cast("timestamp")
    numbers = [F.lit(v) for v in (3, 6.0, 2.0, 1.0, 3.0, 2)]
    text = spark.range(1).select(texts.stats_block(*numbers, at, F.lit(None).cast("timestamp")).alias("t")).first()["t"]
    assert text.split("\n")[-3:] == ["Batches: 2", "Last update: 2024-05-06T07:08:09.000000", "Created: never"]
