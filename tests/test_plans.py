"""The physical plans that the design counts on."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import clean, quality, silver, stats
from ledgerlake.plans import inputs
from ledgerlake.settings import Feed
from ledgerlake.sinks.tables import write_bronze
from ledgerlake.sources.csvfiles import csv_sample
from ledgerlake.sources.parquetfiles import read_bronze


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def bronze_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bronze")
    raw = spark.createDataFrame(
        [(f"{i % 3}.csv", "2012-01-01", str(i), "user_1") for i in range(30)],
        "source_file string, timestamp string, price string, user_id string",
    )
    write_bronze(clean.to_bronze(raw), path)
    return path


def test_direct_stats_read_one_column_with_pushed_filters(spark, bronze_path):
    text = plan(stats.direct_stats(clean.kept(read_bronze(spark, bronze_path))))
    assert "ReadSchema: struct<price:double>" in text
    assert "IsNotNull(price)" in text and "GreaterThan(price,0.0)" in text
    assert "HashAggregate" in text


def test_naming_a_source_prunes_partitions(spark, bronze_path):
    text = plan(read_bronze(spark, bronze_path, ["1.csv"]).select("price"))
    assert "PartitionFilters" in text and "source_file" in text


def test_row_operators_do_not_shuffle(spark, bronze_path):
    bronze = read_bronze(spark, bronze_path)
    for df in (clean.judge(bronze), clean.kept(bronze), silver.to_silver(bronze, Feed()), clean.to_transactions(bronze, F.lit("x"))):
        text = plan(df)
        assert "Exchange" not in text and "Python" not in text


def test_aggregates_combine_before_the_shuffle(spark, bronze_path):
    for df in (clean.clean_counts(read_bronze(spark, bronze_path)), quality.key_counts(read_bronze(spark, bronze_path))):
        text = plan(df)
        assert "partial_count" in text and text.count("Exchange") >= 1


def test_samples_are_limited_before_the_shuffle(spark, bronze_path):
    text = plan(csv_sample(read_bronze(spark, bronze_path), ["timestamp", "price"], 3))
    assert text.count("WindowGroupLimit") >= 2


def test_dedup_keeps_one_row_per_key_and_task(spark, bronze_path):
    text = plan(quality.deduplicate(read_bronze(spark, bronze_path), ["source_file"]))
    assert "partial_min" in text and "Window" not in text


def test_no_cross_joins_anywhere(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    for name in ("outliers", "compare_sources", "per_file_reconcile", "quality_checks", "dedup", "user_analytics", "report_stats"):
        text = plan(queries()[name](spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_feed_scan_reads_needed_columns(spark):
    text = plan(inputs.transactions(spark, "/root/testdata/sf0.001").groupBy("source_file").agg(F.sum("price")))
    assert "props" not in text and "event_type" not in text
