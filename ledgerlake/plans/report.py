"""The run report: one row of figures, and the same as text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def report_row(layer_counts: DataFrame, store_stats: DataFrame, state: DataFrame, batch_size: int) -> DataFrame:
    """Files, store statistics and incremental state in one row; each side is one row."""
    files = layer_counts.select("sources").scalar()
    running = state.select(F.struct("count", "sum", "avg", "min", "max")).scalar()
    return store_stats.select(
        F.lit(batch_size).alias("batch_size"),
        files.alias("bronze_count"),
        F.col("count").alias("total_records"),
        "avg_price", "min_price", "max_price", "unique_users", "unique_files",
        running.alias("statistics"),
    )


def report_lines(report: DataFrame) -> DataFrame:
    """The report as numbered text lines."""
    def money(label: str, column: str) -> Column:
        return F.format_string(f"{label}: $%,.2f", F.col(column))

    lines = [
        F.lit("TRANSACTION LOAD REPORT"),
        F.format_string("Batch size: %,d", F.col("batch_size")),
        F.format_string("Bronze sources: %d", F.col("bronze_count")),
        F.format_string("Records in store: %,d", F.col("total_records")),
        money("Average price", "avg_price"),
        money("Minimum price", "min_price"),
        money("Maximum price", "max_price"),
        F.format_string("Distinct users: %,d", F.col("unique_users")),
        F.format_string("Sources loaded: %d", F.col("unique_files")),
        F.format_string("Incremental count: %,d", F.col("statistics.count")),
    ]
    return report.select(F.posexplode(F.array(*lines)).alias("pos", "line")).select(
        (F.col("pos") + 1).alias("line_no"), "line"
    )
