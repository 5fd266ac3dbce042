"""Which files a layer should have, which it has, and what state that is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import ceil_div, saved_percent
from ledgerlake.settings import BATCH_SIZE, GATE_FILES, LAYER_OK_FILES
from ledgerlake.workspace import literal_rows


def expected_sources(spark: SparkSession, expected: Sequence[str]) -> DataFrame:
    return literal_rows(spark, "feed_no int, source_file string", list(enumerate(expected, 1)))


def missing_sources(present: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected sources that are not there."""
    return expected.join(present.select("source_file").distinct(), "source_file", "left_anti")


def check_layer(profile: DataFrame, expected: DataFrame) -> DataFrame:
    """Every expected source as found, missing or corrupt, with its rows and bytes."""
    state = (
        F.when(F.col("n_files").isNull(), "missing")
        .when(F.col("corrupt_files") > 0, "corrupt")
        .otherwise("found")
    )
    return expected.join(profile, "source_file", "left").select(
        "feed_no", "source_file", state.alias("state"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("file_size", F.lit(0)).alias("file_size"),
    )


def layer_totals(checked: DataFrame) -> DataFrame:
    """Files found, missing and corrupt, rows and bytes, and whether the layer is complete."""
    state = F.col("state")
    return checked.agg(
        F.count("*").alias("files_expected"),
        F.count_if(state != "missing").alias("files_found"),
        F.count_if(state == "missing").alias("missing"),
        F.count_if(state == "corrupt").alias("corrupt"),
        F.sum(F.when(state == "found", F.col("row_count")).otherwise(0)).alias("total_rows"),
        F.sum(F.when(state == "found", F.col("file_size")).otherwise(0)).alias("total_size"),
        F.bool_and(state == "found").alias("valid"),
    )


def status_of(count: Column, enough: int = LAYER_OK_FILES) -> Column:
    return F.when(count >= enough, "success").when(count > 0, "warning").otherwise("error")


def layer_status(counts: DataFrame, component: str, gate: int = GATE_FILES) -> DataFrame:
    """Status by number of sources, size in megabytes, and whether the run may go on."""
    return counts.select(
        F.lit(component).alias("component"),
        status_of(F.col("sources")).alias("status"),
        F.col("sources"),
        F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 1).alias("size_mb"),
        (F.col("sources") >= gate).alias("gate_open"),
    )


def compare_sizes(csv_files: DataFrame, parquet_files: DataFrame) -> DataFrame:
    """CSV against Parquet bytes per source."""
    before = csv_files.groupBy("file_stem").agg(F.sum("file_size").alias("csv_size"))
    after = parquet_files.groupBy("file_stem").agg(F.sum("file_size").alias("parquet_size"))
    both = F.col("csv_size").isNotNull() & F.col("parquet_size").isNotNull()
    return before.join(after, "file_stem", "full_outer").select(
        "file_stem",
        F.col("csv_size").isNotNull().alias("csv_exists"),
        F.col("parquet_size").isNotNull().alias("parquet_exists"),
        F.coalesce("csv_size", F.lit(0)).alias("csv_size"),
        F.coalesce("parquet_size", F.lit(0)).alias("parquet_size"),
        F.when(both, saved_percent(F.col("parquet_size"), F.col("csv_size"))).otherwise(0.0).alias("compression_ratio"),
        F.when(both, F.col("csv_size") - F.col("parquet_size")).otherwise(0).alias("space_saved"),
    )


def conversion_summary(converted: DataFrame, csv_files: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Totals of a CSV-to-Parquet run. Success needs one converted source; failures are counted."""
    before = csv_files.groupBy("source_file").agg(F.sum("file_size").alias("csv_size"))
    per_source = before.join(
        converted.select("source_file", "row_count", F.col("file_size").alias("parquet_size")), "source_file", "left"
    ).withColumn("batches", ceil_div(F.col("row_count"), size))
    done = F.col("row_count").isNotNull()
    rows, batches = F.coalesce(F.sum("row_count"), F.lit(0)), F.coalesce(F.sum("batches"), F.lit(0))
    return per_source.agg(
        F.count("*").alias("total_files"),
        F.count_if(done).alias("converted_files"),
        F.count_if(~done).alias("failed_files"),
        rows.alias("total_rows"),
        batches.alias("total_batches"),
        F.try_divide(rows, batches).alias("avg_batch_size"),
        F.sum(F.when(done, F.col("csv_size"))).alias("total_size_original"),
        F.sum("parquet_size").alias("total_size_compressed"),
        saved_percent(F.sum("parquet_size"), F.sum(F.when(done, F.col("csv_size")))).alias("compression_ratio"),
        (F.count_if(done) > 0).alias("success"),
    )
