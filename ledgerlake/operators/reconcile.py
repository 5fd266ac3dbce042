"""Reconciliation of statistics from different sources, and the audit of the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import close_to, folded_sum, no_infinity
from ledgerlake.functions.texts import null_safe_json
from ledgerlake.settings import STATS_METRICS, TOLERANCE

ALL_METRICS = ("count", "sum", "avg", "min", "max")


def metrics_long(stats: DataFrame, group: Sequence[str] = (), value: str = "value") -> DataFrame:
    """One row per metric instead of one column per metric."""
    doubles = [F.col(m).cast("double").alias(m) for m in ALL_METRICS]
    return stats.select(*group, *doubles).unpivot(list(group), list(ALL_METRICS), "metric", value)


def reconcile(
    incremental: DataFrame, direct: DataFrame, group: Sequence[str] = (), tolerance: float = TOLERANCE
) -> DataFrame:
    """Incremental against recomputed statistics, metric by metric.

    ``sum`` is reported, but only the other four decide (``compared``). Two missing values
    match; a missing one and a number do not.
    """
    left = metrics_long(incremental, group, "incremental")
    right = metrics_long(direct, group, "direct")
    both = left.join(right, [*group, "metric"], "full_outer")
    a, b = no_infinity(F.col("incremental")), no_infinity(F.col("direct"))
    return both.select(
        *group, "metric", a.alias("incremental"), b.alias("direct"),
        F.abs(a - b).alias("difference"), close_to(a, b, tolerance).alias("matches"),
        F.col("metric").isin(*STATS_METRICS).alias("compared"),
    )


def verdict(comparison: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Whether every compared metric matches."""
    return comparison.where("compared").groupBy(*group).agg(
        F.bool_and("matches").alias("overall_match"), F.count_if(~F.col("matches")).alias("mismatches")
    )


def compare_sources(sources: Mapping[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """Every source of statistics against the first one, metric by metric.

    ``sources`` maps names to one-row statistics; the comparison is an equi-join on the
    metric between four rows per source and the four of the reference.
    """
    if len(sources) < 2:
        raise ValueError("at least two sources are needed for a comparison")
    (_, reference), *others = sources.items()
    compared = F.col("metric").isin(*STATS_METRICS)
    base = metrics_long(reference, value="reference_value").where(compared)
    named = [metrics_long(df, value="compare_value").withColumn("source", F.lit(name)) for name, df in others]
    a, b = F.col("reference_value"), F.col("compare_value")
    return reduce(DataFrame.unionByName, named).join(base, "metric").select(
        "source", "metric", "reference_value", "compare_value",
        F.abs(a - b).alias("difference"), close_to(a, b, tolerance).alias("matches"),
    )


def held_out_drift(partials: DataFrame, held_out: str, scale: int | None = None) -> DataFrame:
    """Statistics before and after the held-out source, and what it changed.

    Both states come from one pass over the batch partials.
    """
    before = F.col("source_file") != held_out

    def total(name: str, only_before: bool) -> Column:
        col = F.col(name)
        return F.when(before, col) if only_before else col

    sides = []
    for side, only in (("before", True), ("after", False)):
        rows = F.coalesce(F.sum(total("rows_processed", only)), F.lit(0))
        amount = folded_sum(total("batch_sum", only), scale)
        sides += [
            rows.alias(f"count_{side}"),
            F.try_divide(amount, rows).alias(f"avg_{side}"),
            F.min(total("batch_min", only)).alias(f"min_{side}"),
            F.max(total("batch_max", only)).alias(f"max_{side}"),
        ]
    return drift(partials.agg(*sides))


def drift(states: DataFrame) -> DataFrame:
    """Adds the changes between the ``_before`` and ``_after`` columns of a state row."""
    avg_change = F.when(F.col("count_before") > 0, F.col("avg_after") - F.col("avg_before")).otherwise(F.col("avg_after"))
    new_min = F.when(F.col("min_before").isNull(), F.col("min_after").isNotNull()).otherwise(
        F.coalesce(F.col("min_after") < F.col("min_before"), F.lit(False))
    )
    new_max = F.when(F.col("max_before").isNull(), F.col("max_after").isNotNull()).otherwise(
        F.coalesce(F.col("max_after") > F.col("max_before"), F.lit(False))
    )
    return states.select(
        "*",
        (F.col("count_after") - F.col("count_before")).alias("count_added"),
        avg_change.alias("avg_change"), new_min.alias("new_min"), new_max.alias("new_max"),
    )


def audit_row(
    incremental: DataFrame, direct: DataFrame, comparison: DataFrame, run_id: str, notes: str = ""
) -> DataFrame:
    """One audit record: both sides and the comparison as JSON, and the verdict as 0/1."""
    names = list(ALL_METRICS)
    left = incremental.select(F.lit(run_id).alias("run_id"), null_safe_json(F.struct(*names)).alias("incremental_stats"))
    right = direct.select(F.lit(run_id).alias("run_id"), null_safe_json(F.struct(*names)).alias("database_stats"))
    # Five rows at most: one per metric.
    entries = F.array_sort(F.collect_list(F.struct("metric", "incremental", "direct", "difference", "matches")))
    result = comparison.agg(
        null_safe_json(entries).alias("comparison_result"),
        F.bool_and(F.col("matches") | ~F.col("compared")).cast("int").alias("verification_passed"),
    ).select(F.lit(run_id).alias("run_id"), "*")
    return left.join(right, "run_id").join(result, "run_id").select(
        "run_id", F.current_timestamp().alias("verification_timestamp"), "incremental_stats",
        "database_stats", "comparison_result", "verification_passed", F.lit(notes).alias("notes"),
    )
