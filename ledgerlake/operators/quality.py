"""Quality rules, checks, duplicates, outliers and null filling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.times import parse_timestamp, within_days
from ledgerlake.operators.clean import MISSING, UNPARSEABLE, absent_columns, judge
from ledgerlake.operators.ordering import slice_in_order, with_neighbours, with_position
from ledgerlake.operators.quantiles import quantiles
from ledgerlake.settings import (
    DUPLICATE_TOLERANCE, METRIC_RANGE, NULL_TOLERANCE, OUTLIER_STD, PRICE_RANGE, RAW_COLUMNS,
    UNKNOWN_USER, USER_ID_PATTERN, Feed,
)
from ledgerlake.workspace import written

# Copies are rows of one source that agree in all of these; a row that lacks one of them is
# nobody's copy.
KEY = ("timestamp", "user_id", "price")


def full_key(key: Sequence[str] = KEY) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])


def standard_user(user_id: Column) -> Column:
    """Trimmed, lower case; bare digits become ``user_<digits>``."""
    plain = F.lower(F.trim(user_id))
    return F.when(plain.rlike(r"^\d+$"), F.concat(F.lit("user_"), plain)).otherwise(plain)


def parsed(bronze: DataFrame) -> DataFrame:
    """Bronze with parsed timestamps and standardised users."""
    return bronze.withColumns(
        {"timestamp": parse_timestamp(F.col("timestamp")), "user_id": standard_user(F.col("user_id"))}
    )


def rules(feed: Feed, layer: str = "silver") -> dict[str, Column]:
    """Rules on a parsed row. NULL breaks a rule."""
    low, high = PRICE_RANGE[layer]
    passed = {
        "timestamp_parsed": F.col("timestamp").isNotNull(),
        "timestamp_range": within_days(F.col("timestamp"), feed.timestamp_min, feed.timestamp_max),
        "price_range": F.col("price").between(low, high),
        "user_id_pattern": F.col("user_id").rlike(USER_ID_PATTERN),
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in passed.items()}


def schema_checks(raw: DataFrame, required: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Check of bronze rows per source: columns, unparseable prices and nulls apart.

    All rows are checked, in one aggregate; a missing column is an error, the rest warnings.
    """
    absent = absent_columns(raw, required)
    present = [c for c in required if c not in absent]
    rows = raw.withColumn("reject_reason", F.lit(None).cast("string")) if "price" in absent else judge(raw)
    reason = F.col("reject_reason")
    wide = rows.groupBy("source_file").agg(
        F.count("*").alias("row_count"),
        F.lit(len(absent)).cast("bigint").alias("missing_columns"),
        F.count_if(reason == UNPARSEABLE).alias("non_numeric_price"),
        *[
            (F.count_if(reason == MISSING) if c == "price" else F.count_if(F.col(c).isNull())).alias(f"null_{c}")
            for c in present
        ],
    )
    checks = [c for c in wide.columns if c not in ("source_file", "row_count")]
    long = wide.unpivot(["source_file", "row_count"], checks, "check_type", "affected_rows")
    result = (
        F.when(F.col("affected_rows") == 0, "passed")
        .when(F.col("check_type") == "missing_columns", "failed")
        .otherwise("warning")
    )
    share = F.round(F.try_divide(F.col("affected_rows") * F.lit(100.0), F.col("row_count")), 2)
    return long.withColumn("check_result", result).withColumn("percent", share)


def key_counts(rows: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows per key. Copies collapse inside each task before anything is shuffled."""
    return rows.groupBy("source_file", *key).agg(F.count("*").alias("copies"))


def duplicate_summary(rows: DataFrame, key: Sequence[str] = KEY, tolerance: float | None = None) -> DataFrame:
    """Surplus copies per source and whether their share is tolerated."""
    limit = DUPLICATE_TOLERANCE["quality"] if tolerance is None else tolerance
    full = full_key(key)
    extra = F.sum(F.when(full, F.col("copies") - 1).otherwise(0))
    share = F.try_divide(extra.cast("double"), F.sum("copies"))
    return key_counts(rows, key).groupBy("source_file").agg(
        F.sum("copies").alias("total_rows"),
        F.count_if((F.col("copies") > 1) & full).alias("repeated_keys"),
        extra.alias("duplicate_rows"),
        F.round(share, 6).alias("duplicate_share"),
        (share <= limit).alias("tolerated"),
    )


def deduplicate(rows: DataFrame, order: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """The first row of every key and source in the order ``order``, with its number of copies.

    Rows that lack a part of the key are told apart by ``order`` and all stay. An aggregate,
    not a window: each task keeps one row per key, so a key that holds a third of all rows
    sends one row per task.
    """
    key = [*key, *(["source_file"] if "source_file" in rows.columns and "source_file" not in key else [])]
    rest = [c for c in rows.columns if c not in key and c not in order]
    first = F.min(F.struct(*order, *rest))
    own = F.when(~full_key(key), F.struct(*order))
    return rows.groupBy(*key, own.alias("_own")).agg(first.alias("_first"), F.count("*").alias("copies")).select(
        *key, "_first.*", "copies"
    )


def handle_duplicates(
    rows: DataFrame, order: Sequence[str], action: str = "warn", tolerance: float | None = None
) -> DataFrame:
    """What to do about copies: ``warn`` leaves them, ``remove`` keeps the first, ``error`` raises
    when some source has more than is tolerated."""
    if action == "remove":
        return deduplicate(rows, order).drop("copies").select(*rows.columns)
    if action not in ("warn", "error"):
        raise ValueError(f"unknown action: {action}")
    if action == "error":
        bad = duplicate_summary(rows, tolerance=tolerance).where(~F.col("tolerated")).agg(F.sum("duplicate_rows")).first()[0]
        if bad:
            raise RuntimeError(f"{bad} duplicate rows are not tolerated")
    return rows


def outliers(rows: DataFrame, times_std: float = OUTLIER_STD) -> DataFrame:
    """Flags prices further than ``times_std`` standard deviations from the mean of the run.

    Mean and deviation come from one scalar subquery.
    """
    spread = rows.agg(F.struct(F.avg("price").alias("mean"), F.stddev_samp("price").alias("std"))).scalar()
    far = F.abs(F.col("price") - spread["mean"]) > spread["std"] * F.lit(times_std)
    return rows.withColumn("is_outlier", F.coalesce(far, F.lit(False)))


def fill_users(user_id: Column) -> Column:
    return F.coalesce(user_id, F.lit(UNKNOWN_USER))


def fill_prices(rows: DataFrame, strategy: str, order: Sequence[str]) -> DataFrame:
    """Adds ``filled_price``: missing prices by ``median`` or ``mean`` of the source, or by the
    nearest price before (``forward_fill``) or after (``backward_fill``) in ``order``."""
    if strategy in ("forward_fill", "backward_fill"):
        side = "before" if strategy == "forward_fill" else "after"
        sliced = slice_in_order(rows, ["source_file"], order)
        near = with_neighbours(sliced, ["source_file"], F.col("price"), "_price", [side])
        return near.withColumnRenamed(f"_price_{side}", "filled_price").drop("_slice", "_row")
    if strategy == "median":
        middle = quantiles(rows, ["source_file"], "price", [0.5]).withColumnRenamed("q_0_5", "_fill")
    elif strategy == "mean":
        middle = rows.groupBy("source_file").agg(F.avg("price").alias("_fill"))
    else:
        raise ValueError(f"unknown fill strategy: {strategy}")
    return rows.join(written(middle, "fill"), "source_file", "left").withColumn(
        "filled_price", F.coalesce("price", "_fill")
    ).drop("_fill")


def fill_timestamps(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``filled_timestamp``: missing ones lie on the line between their neighbours by row
    position; at the ends of a source the only neighbour counts."""
    placed = with_position(slice_in_order(rows, ["source_file"], order), ["source_file"])
    known = F.when(
        F.col("timestamp").isNotNull(),
        F.struct(F.col("position").alias("at"), F.unix_micros("timestamp").alias("us")),
    )
    near = with_neighbours(placed, ["source_file"], known, "_ts")
    before, after = F.col("_ts_before"), F.col("_ts_after")
    step = F.call_function(
        "div", (after["us"] - before["us"]) * (F.col("position") - before["at"]), after["at"] - before["at"]
    )
    line = F.when(before["us"].isNull(), after["us"]).when(after["us"].isNull(), before["us"]).when(
        after["at"] == before["at"], before["us"]
    ).otherwise(before["us"] + step)
    return near.withColumn("filled_timestamp", F.timestamp_micros(line)).drop(
        "_ts_before", "_ts_after", "_slice", "_row"
    )


def _share_check(bad: Column, total: Column, tolerance: float, action: str) -> Column:
    share = F.coalesce(F.try_divide(bad.cast("double"), total), F.lit(0.0))
    return F.when(share <= tolerance, "passed").otherwise("failed" if action == "error" else "warning")


def quality_checks(
    bronze: DataFrame, feed: Feed, layer: str = "bronze", action: str = "warn", tolerances: str | None = None
) -> DataFrame:
    """The quality report: one row per source and check, with the share of rows affected.

    Every rule depends on the key columns only, so rows first collapse to one per key; that
    one shuffle also yields the duplicates. Price range and tolerances are those of the layer;
    ``tolerances`` names another entry, such as ``quality`` for the general ones.
    """
    lenient = tolerances or layer
    low, high = PRICE_RANGE[layer]
    data = key_counts(parsed(bronze))
    n = F.col("copies")

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    at = F.col("timestamp")
    outside = ~within_days(at, feed.timestamp_min, feed.timestamp_max)
    bad = {
        "null_timestamp": rows_where(at.isNull()),
        "null_price": rows_where(F.col("price").isNull()),
        "null_user_id": rows_where(F.col("user_id").isNull()),
        "timestamp_range": rows_where(F.coalesce(outside, F.lit(False))),
        "price_range": rows_where(F.coalesce(~F.col("price").between(low, high), F.lit(False))),
        "user_id_pattern": rows_where(F.coalesce(~F.col("user_id").rlike(USER_ID_PATTERN), F.lit(False))),
        "duplicates": rows_where(full_key()) - F.count_if(full_key()),
    }
    wide = data.groupBy("source_file").agg(F.sum(n).alias("total_rows"), *[c.alias(k) for k, c in bad.items()])
    long = wide.unpivot(["source_file", "total_rows"], list(bad), "check_type", "affected_rows")
    limits = {k: NULL_TOLERANCE[lenient] if k.startswith("null_") else 0.0 for k in bad}
    limits["duplicates"] = DUPLICATE_TOLERANCE[lenient]
    result = F.lit(None).cast("string")
    for name, limit in limits.items():
        verdict = _share_check(F.col("affected_rows"), F.col("total_rows"), limit, action)
        result = F.when(F.col("check_type") == name, verdict).otherwise(result)
    return long.select(
        F.col("source_file").alias("batch_id"), "check_type", result.alias("check_result"),
        F.format_string("%d of %d rows", "affected_rows", "total_rows").alias("details"),
        F.current_timestamp().alias("checked_at"),
    )


def quality_gate(checks: DataFrame) -> DataFrame:
    """One row: how many checks passed, warned and failed, and whether the run may go on."""
    result = F.col("check_result")
    return checks.agg(
        F.count_if(result == "passed").alias("passed"),
        F.count_if(result == "warning").alias("warnings"),
        F.count_if(result == "failed").alias("failed"),
        (F.count_if(result == "failed") == 0).alias("may_continue"),
    )


def stop_on_failed_checks(checks: DataFrame) -> None:
    """Raises when a check failed; the gate is one row."""
    gate = quality_gate(checks).first()
    if not gate["may_continue"]:
        raise RuntimeError(f"{gate['failed']} quality checks failed")


def gold_rule_checks(gold: DataFrame) -> DataFrame:
    """Gold rules: values within range, no nulls, no two rows for one metric and date."""
    low, high = METRIC_RANGE
    keys = ("metric_type", "metric_name", "aggregation_level", "date_partition")
    value = F.col("metric_value")
    per_key = gold.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(value.isNull()).alias("nulls"),
        F.count_if(~value.between(low, high)).alias("outside"),
    )
    return per_key.groupBy("metric_type").agg(
        F.sum("n").alias("total_rows"), F.sum("nulls").alias("null_values"),
        F.sum("outside").alias("out_of_range"), F.sum(F.col("n") - 1).alias("duplicates"),
    )
