"""Gold metrics per day, week and month, in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import exact_sum, folded_sum, partial_sum
from ledgerlake.workspace import written

# Aggregation level -> calendar unit.
LEVELS = {"daily": "day", "weekly": "week", "monthly": "month"}


def period(ts: Column, level: str) -> Column:
    """First day of the day, week (Monday) or month a row belongs to."""
    return F.date_trunc(LEVELS[level], ts).cast("date")


def _long(wide: DataFrame, metric_type: str, level: str, keep: tuple[str, ...] = ()) -> DataFrame:
    names = [c for c in wide.columns if c not in ("date_partition", *keep)]
    doubles = wide.select("date_partition", *keep, *[F.col(c).cast("double").alias(c) for c in names])
    return doubles.unpivot(["date_partition", *keep], names, "metric_name", "metric_value").withColumns(
        {"metric_type": F.lit(metric_type), "aggregation_level": F.lit(level)}
    )


def hourly_totals(rows: DataFrame, level: str, scale: int | None = None) -> DataFrame:
    """Counts and price totals per period, weekday and hour: at most 168 rows per week and level.

    Price and temporal metrics are both folded from it, so rows are read once for the two.
    """
    day = period(F.col("ts"), level).alias("date_partition")
    return rows.groupBy(day, F.hour("ts").alias("hour"), (F.weekday("ts") + 1).alias("weekday")).agg(
        F.count("*").alias("n"), F.count("price").alias("priced"), partial_sum(F.col("price"), scale).alias("s"),
        F.min("price").alias("low"), F.max("price").alias("high"),
    )


def _folded(column: str, scale: int | None) -> Column:
    return folded_sum(F.col(column), scale)


def price_metrics(rows: DataFrame, level: str, scale: int | None = None) -> DataFrame:
    """Transaction count and price statistics per period."""
    return _price_metrics(hourly_totals(rows, level, scale), level, scale)


def _price_metrics(hourly: DataFrame, level: str, scale: int | None) -> DataFrame:
    total = _folded("s", scale)
    wide = hourly.groupBy("date_partition").agg(
        F.sum("n").alias("transaction_count"), total.alias("price_sum"),
        F.try_divide(total, F.sum("priced")).alias("price_avg"),
        F.min("low").alias("price_min"), F.max("high").alias("price_max"),
    )
    return _split_types(_long(wide, "price_statistics", level))


def _split_types(long: DataFrame) -> DataFrame:
    kind = F.when(F.col("metric_name") == "transaction_count", "transaction_count").otherwise(F.col("metric_type"))
    return long.withColumn("metric_type", kind)


def user_metrics(rows: DataFrame, level: str, scale: int | None = None) -> DataFrame:
    """Distinct users, and mean spend and mean transactions per user, per period.

    Rows shrink to one per period and user before the periods are formed.
    """
    return _user_metrics(user_totals(rows, level, scale), level, scale)


def user_totals(rows: DataFrame, level: str, scale: int | None = None) -> DataFrame:
    """Transactions and spend per period and user."""
    day = period(F.col("ts"), level).alias("date_partition")
    return rows.groupBy(day, "user_id").agg(F.count("*").alias("n"), partial_sum(F.col("price"), scale).alias("spend"))


def _user_metrics(per_user: DataFrame, level: str, scale: int | None) -> DataFrame:
    """Folded from one row for each period and user."""
    spend = _folded("spend", scale)
    users = F.count("user_id")
    wide = per_user.groupBy("date_partition").agg(
        users.alias("unique_users"), F.try_divide(spend, users).alias("spend_per_user"),
        F.try_divide(F.sum("n"), users).alias("transactions_per_user"),
    )
    return _long(wide, "user_analytics", level)


def temporal_metrics(rows: DataFrame, level: str, scale: int | None = None) -> DataFrame:
    """Count and mean price by hour of day and by weekday (1 is Monday), per period."""
    return _temporal_metrics(hourly_totals(rows, level, scale), level, scale)


def _temporal_metrics(hourly: DataFrame, level: str, scale: int | None) -> DataFrame:
    total = _folded("s", scale)

    def by(column: str, prefix: str) -> DataFrame:
        wide = hourly.groupBy("date_partition", column).agg(
            F.sum("n").alias("count"), F.try_divide(total, F.sum("priced")).alias("avg_price")
        )
        named = F.format_string(f"{prefix}_%02d_%s", F.col(column), F.col("metric_name"))
        return _long(wide, "temporal_patterns", level, (column,)).withColumn("metric_name", named).drop(column)

    return by("hour", "hour").unionByName(by("weekday", "weekday"))


def gold_table(rows: DataFrame, level: str, scale: int | None = None) -> DataFrame:
    """All metrics of one level in the gold schema. Rows are read twice: by hour and by user."""
    return _all_metrics(written(hourly_totals(rows, level, scale), "hourly"), user_totals(rows, level, scale), level, scale)


def gold_of_totals(hourly: DataFrame, users: DataFrame, level: str, scale: int | None = None) -> DataFrame:
    """All metrics of one level folded from the totals of any number of loads; no rows are read."""
    sums = "sum(spend)" if scale is None else f"CAST(sum(spend) AS decimal(38,{scale}))"
    per_user = users.groupBy("date_partition", "user_id").agg(F.sum("n").alias("n"), F.expr(sums).alias("spend"))
    return _all_metrics(hourly, per_user, level, scale)


def _all_metrics(hourly: DataFrame, per_user: DataFrame, level: str, scale: int | None) -> DataFrame:
    parts = (
        _price_metrics(hourly, level, scale)
        .unionByName(_temporal_metrics(hourly, level, scale))
        .unionByName(_user_metrics(per_user, level, scale))
    )
    return parts.select(
        "metric_name", "metric_value", "metric_type", "date_partition", "aggregation_level",
        F.current_timestamp().alias("gold_created_at"),
    )


def hourly_prices(rows: DataFrame, scale: int | None = None) -> DataFrame:
    """Price statistics per hour, the finer materialisation of that metric."""
    total = exact_sum(F.col("price"), scale)
    return rows.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count("*").alias("transaction_count"), F.try_divide(total, F.count("price")).alias("price_avg"),
        F.min("price").alias("price_min"), F.max("price").alias("price_max"),
    )
