"""Spikes, anomalies, degradation, retention and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.settings import (
    ARCHIVE_TIER, COUNT_ANOMALY, CREATED_BY, DATA_SOURCE, PRICE_SPIKE, PROCESSING_VERSION, QUALITY_TIER,
    RETENTION_DAYS,
)


def price_spikes(history: DataFrame, times: float = PRICE_SPIKE) -> DataFrame:
    """Batches whose mean price is more than ``times`` the running mean before them."""
    spike = F.col("batch_avg") > F.col("running_avg_before") * F.lit(times)
    return history.select(
        "source_file", "batch_number", "batch_avg", "running_avg_before",
        F.coalesce(spike, F.lit(False)).alias("is_spike"),
    )


def daily_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("transactions"))


def count_anomalies(per_day: DataFrame, threshold: float = COUNT_ANOMALY) -> DataFrame:
    """Days whose number of transactions differs from the day before by more than ``threshold``.

    The window runs over one row per calendar day.
    """
    before = F.lag("transactions").over(Window.orderBy("day"))
    change = F.try_divide(F.col("transactions").cast("double"), before) - 1
    return per_day.withColumn("change", change).withColumn(
        "is_anomaly", F.coalesce(F.abs(F.col("change")) > threshold, F.lit(False))
    )


def degradation(runs: DataFrame, worse_by: float = 0.1) -> DataFrame:
    """Flags runs that are worse than the run before.

    ``runs`` has one row per run: run_id, run_no, rows_in, rows_rejected, batches,
    failed_batches, seconds.
    """
    by_run = Window.orderBy("run_no")
    shares = runs.withColumns(
        {
            "failed_share": F.try_divide(F.col("failed_batches").cast("double"), F.col("batches")),
            "reject_share": F.try_divide(F.col("rows_rejected").cast("double"), F.col("rows_in")),
            "rows_per_second": F.try_divide(F.col("rows_in").cast("double"), F.col("seconds")),
        }
    )

    def grew(column: str) -> Column:
        return F.coalesce(F.col(column) > F.lag(column).over(by_run) * (1 + worse_by), F.lit(False))

    slower = F.col("rows_per_second") < F.lag("rows_per_second").over(by_run) * (1 - worse_by)
    return shares.select(
        "run_id", "failed_share", "reject_share", "rows_per_second",
        (F.col("failed_batches") > 0).alias("processing_failure"),
        grew("reject_share").alias("quality_degraded"),
        F.coalesce(slower, F.lit(False)).alias("performance_degraded"),
    )


def with_retention(rows: DataFrame, layer: str, at: Column, as_of: Column, days: int | None = None) -> DataFrame:
    """Adds ``tier``: ``keep``, or the archive tier of rows older than the layer retains."""
    limit = RETENTION_DAYS[layer] if days is None else days
    if limit < 0:
        return rows.withColumn("tier", F.lit("keep"))
    old = F.datediff(as_of, at.cast("date")) > limit
    return rows.withColumn("tier", F.when(old, F.lit(ARCHIVE_TIER[layer])).otherwise(F.lit("keep")))


def lineage(counts: DataFrame, layer: str) -> DataFrame:
    """Lineage rows of one layer from (source_file, rows_in, rows_out)."""
    return counts.select(
        F.lit(layer).alias("layer"), "source_file", "rows_in", "rows_out",
        F.lit(CREATED_BY[layer]).alias("created_by"), F.lit(DATA_SOURCE[layer]).alias("data_source"),
        F.lit(PROCESSING_VERSION).alias("processing_version"), F.lit(QUALITY_TIER[layer]).alias("quality_tier"),
    )
