"""Positions, running totals and carried values in a given order, without one-task windows.

A window over a whole source would put a source that holds a third of all rows into one
task. Here rows are range-partitioned by the order itself, which splits such a source, and
written once. Each slice is then summed up in one small row, the small rows are windowed,
and every slice receives what came before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.workspace import written

_ROW_BITS = 33  # documented layout of monotonically_increasing_id: partition, then row number


def slice_in_order(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` in global order, written, with ``_slice`` and the row number ``_row`` inside it.

    ``order`` should identify a row, so that copies of one key cannot pile up in one slice.
    """
    keys = [F.col(c) for c in (*group, *order)]
    marked = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mark", F.monotonically_increasing_id())
    )
    return (
        written(marked, "ordered")
        .withColumn("_slice", F.shiftright("_mark", _ROW_BITS).cast("int"))
        .withColumn("_row", F.col("_mark").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_mark")
    )


def with_position(sliced: DataFrame, group: Sequence[str]) -> DataFrame:
    """Adds ``position``, the 1-based place of a row in its group."""
    heads = sliced.groupBy(*group, "_slice").agg(
        F.min("_row").alias("_first"), F.count("*").alias("_n")
    )
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = heads.select(
        *group, "_slice", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    return (
        sliced.join(written(offsets, "offsets"), [*group, "_slice"])
        .withColumn("position", F.col("_row") + F.col("_shift"))
        .drop("_shift")
    )


def with_running(sliced: DataFrame, group: Sequence[str], weight: str, name: str = "running") -> DataFrame:
    """Adds the running total of ``weight`` up to and including each row of its group."""
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(*group, "_slice").agg(F.sum(weight).alias("_total")).select(
        *group, "_slice", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before")
    )
    inside = (
        Window.partitionBy(*group, "_slice").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        sliced.join(written(totals, "offsets"), [*group, "_slice"])
        .withColumn(name, F.col("_before") + F.sum(weight).over(inside))
        .drop("_before")
    )


def with_neighbours(
    sliced: DataFrame, group: Sequence[str], value: Column, prefix: str, sides: Sequence[str] = ("before", "after")
) -> DataFrame:
    """Adds the nearest non-null ``value`` before and after each row of its group.

    ``{prefix}_before`` is the last one up to the row, ``{prefix}_after`` the first one from it.
    The latter is a running value in reverse order: a frame that reaches to the end of the
    partition would be evaluated anew for every row.
    """
    marked = sliced.withColumn("_value", value)
    place = F.when(F.col("_value").isNotNull(), F.col("_row"))
    nearest = {"before": F.max_by("_value", place), "after": F.min_by("_value", place)}
    slices = marked.groupBy(*group, "_slice").agg(*[nearest[s].alias(f"_{s}") for s in sides])

    def running(column: str, by: str, side: str, upto: int) -> Column:
        order = F.col(by).asc() if side == "before" else F.col(by).desc()
        keys = [*group] if by == "_slice" else [*group, "_slice"]
        frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, upto)
        return F.last(column, ignorenulls=True).over(frame)

    carried = slices.select(*group, "_slice", *[running(f"_{s}", "_slice", s, -1).alias(f"_from_{s}") for s in sides])
    out = marked.join(written(carried, "carried"), [*group, "_slice"])
    for side in sides:
        near = F.coalesce(running("_value", "_row", side, 0), F.col(f"_from_{side}"))
        out = out.withColumn(f"{prefix}_{side}", near).drop(f"_from_{side}")
    return out.drop("_value")
