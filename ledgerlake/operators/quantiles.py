"""Exact quantiles without sorting all rows: bounds from a sketch, a count, and a selection inside.

1. One aggregate gives the size of a group and, from a mergeable sketch, two values for each point
   between which its quantile lies, a few thousandths of the rows apart.
2. A second one counts what lies below the lower bound and between both. A bracket that missed
   its rank, which the sketch does not rule out, is opened to the whole range.
3. The values inside are counted per distinct value; they alone move. While a bracket holds more
   than ``FEW`` of them, it is cut in ``BINS`` by the same kind of sketch, and the bins that hold the rank
   stay. What is left is ranked by one window for each group and point, of at most ``FEW`` rows.

Rows are read three times and never sorted; a value that a third of all rows share is one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.workspace import written

ACCURACY = 1000  # of the sketch: its ranks are off by no more than one in so many
FEW = 100_000
BINS = 500


def _with(rows: DataFrame, state: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    """``rows`` with what is known of their group; without groups it is a scalar."""
    if keys:
        return rows.join(state.select(*keys, *columns), keys)
    return rows.withColumns({c: state.select(c).scalar() for c in columns})


def _inside(value: str, bounds: Column) -> Column:
    low, high = bounds["lo"], bounds["hi"]
    return (low.isNull() | (F.col(value) >= low)) & (high.isNull() | (F.col(value) <= high))


def _narrowed(inside: DataFrame, wanted: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """The bins of each bracket that hold its ranks, and how many rows lie below them now."""
    by = [*keys, "_k"]
    shares = F.array(*[F.lit(b / BINS) for b in range(1, BINS)])
    edges = written(inside.groupBy(*by).agg(F.percentile_approx(value, shares, 2 * BINS).alias("_edges")), "edges")
    binned = inside.join(edges, by).withColumn("_bin", F.size(F.filter("_edges", lambda e: e < F.col(value)))).drop("_edges")
    sizes = binned.groupBy(*by, "_bin").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("_upto", F.coalesce(F.sum("_size").over(before), F.lit(0))).join(wanted, by)
    start = F.col("_below") + F.col("_upto")
    holds = (start <= F.col("_high")) & (start + F.col("_size") > F.col("_low"))
    kept = written(placed.where(holds).select(*by, "_bin", start.alias("_start")), "bins")
    below = kept.groupBy(*by).agg(F.min("_start").alias("_below"))
    return binned.join(kept.select(*by, "_bin"), [*by, "_bin"]).drop("_bin"), wanted.drop("_below").join(below, by)


def quantiles(df: DataFrame, group: Sequence[str], value: str, points: Sequence[float], few: int = FEW) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group with ``q_<point>`` columns."""
    keys, rows = list(group), df.where(F.col(value).isNotNull()).select(*group, value)
    names = [f"q_{p:g}".replace(".", "_") for p in points]
    slack = 2 / ACCURACY
    ends = F.array(*[F.lit(min(1.0, max(0.0, p + s))) for p in points for s in (-slack, slack)])
    first = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), F.percentile_approx(value, ends, ACCURACY).alias("_ends"))
    rank = [(F.col("_size") - 1) * F.lit(float(p)) for p in points]
    bounds = F.array(*[F.struct(F.get("_ends", F.lit(2 * k)).alias("lo"), F.get("_ends", F.lit(2 * k + 1)).alias("hi")) for k in range(len(points))])
    state = written(first.select(*keys, "_size", bounds.alias("_bounds")), "brackets")
    near = _with(rows, state, keys, ["_bounds"])
    at = lambda k: F.get("_bounds", F.lit(k))
    counted = near.groupBy(*keys).agg(
        *[F.count_if(F.col(value) < at(k)["lo"]).alias(f"_b{k}") for k in range(len(points))],
        *[F.count_if(_inside(value, at(k))).alias(f"_i{k}") for k in range(len(points))],
    )
    missed = [(F.col(f"_b{k}") > F.floor(rank[k])) | (F.col(f"_b{k}") + F.col(f"_i{k}") <= F.ceil(rank[k])) for k in range(len(points))]
    both = counted.join(state, keys) if keys else _with(counted, state, [], ["_size", "_bounds"])
    nothing = F.lit(None).cast(df.schema[value].dataType)
    checked = written(both.select(*keys, "_size", F.array(*[
        F.struct(F.when(~missed[k], at(k)["lo"]).otherwise(nothing).alias("lo"), F.when(~missed[k], at(k)["hi"]).otherwise(nothing).alias("hi"),
                 F.when(missed[k], 0).otherwise(F.col(f"_b{k}")).cast("bigint").alias("below"),
                 F.floor(rank[k]).cast("bigint").alias("low"), F.ceil(rank[k]).cast("bigint").alias("high"))
        for k in range(len(points))]).alias("_bounds")), "brackets")
    by = [*keys, "_k"]
    wanted = checked.select(*keys, F.posexplode("_bounds").alias("_k", "_p")).select(
        *by, F.col("_p.below").alias("_below"), F.col("_p.low").alias("_low"), F.col("_p.high").alias("_high"))
    hits = F.array_compact(F.array(*[F.when(_inside(value, at(k)), F.lit(k)) for k in range(len(points))]))
    found = _with(rows, checked, keys, ["_bounds"]).select(*keys, F.explode(hits).alias("_k"), value)
    inside = written(found.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n")), "inside")
    while (inside.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0) > few:
        inside, wanted = _narrowed(inside, wanted, keys, value)
        inside, wanted = written(inside, "inside"), written(wanted, "wanted")
    upto = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.join(wanted, by).withColumn("_upto", F.col("_below") + F.sum("_n").over(upto))
    covers = lambda r: (F.col(r) >= F.col("_upto") - F.col("_n")) & (F.col(r) < F.col("_upto"))
    picked = ranked.groupBy(*by).agg(F.max(F.when(covers("_low"), F.col(value))).alias("_at_low"), F.max(F.when(covers("_high"), F.col(value))).alias("_at_high"))
    one = lambda c, k: F.max(F.when(F.col("_k") == k, F.col(c)))
    wide = picked.groupBy(*keys).agg(*[x for k in range(len(points)) for x in (one("_at_low", k).alias(f"_l{k}"), one("_at_high", k).alias(f"_h{k}"))])
    sized = wide.join(state.select(*keys, "_size"), keys) if keys else _with(wide, state, [], ["_size"])
    part = [rank[k] - F.floor(rank[k]) for k in range(len(points))]
    return sized.select(*keys, *[(F.col(f"_l{k}") + (F.col(f"_h{k}") - F.col(f"_l{k}")) * part[k]).alias(n) for k, n in enumerate(names)])
