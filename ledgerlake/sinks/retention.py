"""Expired partitions are moved to the archive, not copied.

A move goes in steps: the expired partitions are copied under the name of the run, the counts of
the copy are compared with those of the live table, the move is recorded, and only then are the
live partitions deleted; last the record is closed. Whoever reads through `live_rows` and
`archived_rows` sees every row exactly once at any time: until a move is recorded its copy does not
count, from then on the live partition does not. The next run finishes what one that died left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.settings import ARCHIVE_TIER, RETENTION_DAYS
from ledgerlake.sinks.tables import drop_partitions, overwrite_partitions
from ledgerlake.workspace import read_if_any, written

MOVES = "day string, n_rows bigint, tier string, run string, step string"


def _moves(spark: SparkSession, archive: str) -> DataFrame:
    return read_if_any(spark, f"{archive}_moves", MOVES)


def _closed(spark: SparkSession, archive: str) -> DataFrame:
    return _moves(spark, archive).where("step = 'closed'").select("run").distinct()


def _pending(spark: SparkSession, archive: str) -> DataFrame:
    """Recorded moves whose live partitions may not have been deleted yet."""
    return _moves(spark, archive).where("step = 'recorded'").join(_closed(spark, archive), "run", "left_anti")


def live_rows(spark: SparkSession, table: str, archive: str, schema: str, day: str) -> DataFrame:
    """The live table without partitions whose move is recorded."""
    rows = read_if_any(spark, table, schema)
    pending = written(_pending(spark, archive).select(F.col("day").alias(day)), "pending")
    return rows if pending.isEmpty() else rows.join(pending, day, "left_anti").select(*rows.columns)


def archived_rows(spark: SparkSession, archive: str, schema: str) -> DataFrame:
    """Rows of recorded moves, with their ``tier`` and ``run``."""
    recorded = written(_moves(spark, archive).where("step = 'recorded'").select("tier", "run").distinct(), "recorded")
    return read_if_any(spark, archive, f"{schema}, tier string, run string").join(recorded, ["tier", "run"], "left_semi")


def _finish(spark: SparkSession, table: str, archive: str, day: str) -> None:
    pending = written(_pending(spark, archive), "pending")
    if pending.isEmpty():
        return
    drop_partitions(pending.select("day"), table, day)
    overwrite_partitions(pending.withColumn("step", F.lit("closed")), f"{archive}_moves", ["run", "step"])


def move_expired(
    spark: SparkSession, table: str, archive: str, schema: str, layer: str, as_of: str, run: str,
    day: str = "day", days: int | None = None, after: Callable[[str], None] = lambda step: None,
) -> DataFrame:
    """Moves the partitions ``day=…`` of a live table that are older than its layer retains.

    ``schema`` names the columns of the table, the partition column (a date as text) last. Returns
    the day and number of rows of each moved partition. ``run`` names the run; repeated after a
    failure it goes on. Partitions whose name is no date stay. Nothing else may write to expired
    partitions meanwhile; if something did, the counts differ and nothing is deleted. ``after`` is
    called with the name of each step that is done.
    """
    limit = RETENTION_DAYS[layer] if days is None else days
    _finish(spark, table, archive, day)
    after("finished earlier moves")
    nothing = _moves(spark, archive).where("false").select("day", "n_rows")
    if limit < 0 or not _moves(spark, archive).where((F.col("run") == run) & (F.col("step") == "closed")).isEmpty():
        return _moves(spark, archive).where((F.col("run") == run) & (F.col("step") == "closed")).select("day", "n_rows") if limit >= 0 else nothing
    old = F.datediff(F.lit(as_of).cast("date"), F.try_to_date(F.col(day), "yyyy-MM-dd")) > limit
    expired = read_if_any(spark, table, schema).where(old)
    tier = ARCHIVE_TIER[layer]
    counts = written(expired.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n_rows")), "expired")
    if counts.isEmpty():
        return nothing
    copied = expired.withColumns({"tier": F.lit(tier), "run": F.lit(run)})
    overwrite_partitions(copied, archive, ["tier", "run", day])
    after("copied")
    there = read_if_any(spark, f"{archive}/tier={tier}/run={run}", schema, base=archive)
    there = there.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n_copied"))
    wrong = counts.join(there, "day", "full_outer").where(~F.col("n_rows").eqNullSafe(F.col("n_copied")))
    if not wrong.isEmpty():
        raise ValueError("the archive differs from the live table; nothing was deleted")
    record = counts.withColumns({"tier": F.lit(tier), "run": F.lit(run), "step": F.lit("recorded")})
    overwrite_partitions(record, f"{archive}_moves", ["run", "step"])
    after("recorded")
    _finish(spark, table, archive, day)
    after("deleted")
    return counts
