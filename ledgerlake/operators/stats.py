"""Statistics: direct, incremental, descriptive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import exact_sum, folded_sum, partial_sum, round_or_zero
from ledgerlake.operators.quantiles import quantiles
from ledgerlake.workspace import written


def direct_stats(
    transactions: DataFrame, scale: int | None = None, group: Sequence[str] = (), price: str = "price"
) -> DataFrame:
    """Recomputation over stored rows: count, sum, avg, min, max. One aggregate, one column read."""
    total = exact_sum(F.col(price), scale)
    return transactions.groupBy(*group).agg(
        F.count("*").alias("count"),
        total.alias("sum"),
        F.try_divide(total, F.count(price)).alias("avg"),
        F.min(price).alias("min"),
        F.max(price).alias("max"),
    )


def merge_partials(
    partials: DataFrame, scale: int | None = None, group: Sequence[str] = (),
    names: tuple[str, str, str, str] = ("rows_processed", "batch_sum", "batch_min", "batch_max"),
) -> DataFrame:
    """The state: partial statistics of any batches folded into one. Stored rows are not read."""
    rows, total, low, high = names
    summed = folded_sum(F.col(total), scale)
    return partials.groupBy(*group).agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("count"),
        summed.alias("sum"),
        F.try_divide(summed, F.sum(rows)).alias("avg"),
        F.min(low).alias("min"),
        F.max(high).alias("max"),
    )


def report_stats(transactions: DataFrame, scale: int | None = None) -> DataFrame:
    """Rounded statistics with distinct users and sources.

    Rows shrink to one per (source, user) first; the distinct counts run over those.
    """
    pairs = transactions.groupBy("source_file", "user_id").agg(
        F.count("*").alias("n"), F.count("price").alias("priced"), partial_sum(F.col("price"), scale).alias("total"),
        F.min("price").alias("low"), F.max("price").alias("high"),
    )
    total = folded_sum(F.col("total"), scale)
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        round_or_zero(F.try_divide(total, F.sum("priced"))).alias("avg_price"),
        round_or_zero(F.min("low")).alias("min_price"),
        round_or_zero(F.max("high")).alias("max_price"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("source_file").alias("unique_files"),
    )


def users_per_source(rows: DataFrame, approximate: bool = False) -> DataFrame:
    users = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    return rows.groupBy("source_file").agg(users.alias("unique_users"))


def record_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("total_records"))


def variance_parts(value: Column) -> tuple[Column, Column, Column]:
    """Count, mean and sum of squared deviations: what a standard deviation can be folded from."""
    return F.count(value), F.avg(value), F.var_pop(value) * F.count(value)


def std_from_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sample standard deviation per key of parts (n, mean, squares); NULL below two rows.

    Deviations are taken from the common mean, so nothing cancels at large counts.
    """
    centre = parts.groupBy(*keys).agg(
        F.sum("n").alias("_n"), F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")).alias("_mean")
    )
    away = F.col("mean") - F.col("_mean")
    spread = F.sum(F.col("squares") + F.col("n") * away * away)
    return parts.join(centre, list(keys)).groupBy(*keys).agg(
        F.when(F.max("_n") > 1, F.sqrt(spread / (F.max("_n") - 1))).alias("std")
    )


def describe_prices(rows: DataFrame, places: int = 6) -> DataFrame:
    """Count, mean, std, min, quartiles and max of the price per source."""
    basics = rows.groupBy("source_file").agg(
        F.count("price").alias("count"), F.round(F.avg("price"), places).alias("mean"),
        F.round(F.stddev_samp("price"), places).alias("std"), F.min("price").alias("min"),
        F.max("price").alias("max"),
    )
    quarters = quantiles(rows, ["source_file"], "price", [0.25, 0.5, 0.75])
    return basics.join(quarters, "source_file", "left").select(
        "source_file", "count", "mean", "std", "min",
        F.round("q_0_25", places).alias("q25"), F.round("q_0_5", places).alias("q50"),
        F.round("q_0_75", places).alias("q75"), "max",
    )


def std_and_median(rows: DataFrame, places: int = 6) -> DataFrame:
    """The two extra statistics per source: std folded from parts per task, and the exact median."""
    n, mean, squares = variance_parts(F.col("price"))
    parts = rows.groupBy("source_file", F.spark_partition_id().alias("_part")).agg(
        n.alias("n"), mean.alias("mean"), squares.alias("squares")
    )
    std = std_from_parts(written(parts, "parts"), ["source_file"]).withColumn("std", F.round("std", places))
    median = quantiles(rows, ["source_file"], "price", [0.5])
    return std.join(median, "source_file", "left").select(
        "source_file", "std", F.round("q_0_5", places).alias("median")
    )


def approximate_metrics(rows: DataFrame) -> DataFrame:
    """Metrics that cannot be folded exactly, in a form a stream can keep."""
    return rows.agg(
        F.percentile_approx("price", F.lit(0.5), F.lit(10000)).alias("approx_median"),
        F.approx_count_distinct("user_id", 0.02).alias("approx_users"),
    )
