"""Micro-batches: numbering, per-batch aggregates and the running history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import partial_sum
from ledgerlake.functions.texts import batch_key, null_safe_json
from ledgerlake.operators.clean import judge
from ledgerlake.operators.ordering import slice_in_order, with_position
from ledgerlake.settings import BATCH_SIZE, MAX_HISTORY, PROGRESS_EVERY
from ledgerlake.sources.listing import feed_position
from ledgerlake.workspace import written

HISTORY_BLOCK = 10_000


def _whole_div(value: Column, size: int) -> Column:
    return F.call_function("div", value, F.lit(size))


def number_batches(df: DataFrame, order: Sequence[str], size: int = BATCH_SIZE) -> DataFrame:
    """Numbers rows of each source into batches of ``size``, in the given order.

    Costs one range shuffle and one written copy; a source of any size is spread over all
    tasks. `number_stored_batches` needs neither when rows already lie in files.
    """
    placed = with_position(slice_in_order(df, ["source_file"], order), ["source_file"])
    number = _whole_div(F.col("position") - 1, size) + 1
    return placed.withColumn("batch_number", number).drop("_slice", "_row")


def number_stored_batches(rows: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Numbers `stored_rows` into batches by their place in the stored files. No row moves.

    Only the row counts of the files are aggregated; the place inside a file comes from the
    Parquet reader.
    """
    per_file = rows.groupBy("source_file", "stored_file").agg(F.count("*").alias("_n"))
    earlier = (
        Window.partitionBy("source_file").orderBy("stored_file").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_file.select(
        "source_file", "stored_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    place = F.col("_before") + F.col("stored_row")
    return (
        rows.join(written(offsets, "offsets"), ["source_file", "stored_file"])
        .withColumn("position", place + 1)
        .withColumn("batch_number", _whole_div(place, size) + 1)
        .drop("_before", "stored_file", "stored_row")
    )


def stored_slice_partials(rows: DataFrame, scale: int | None = None, size: int = BATCH_SIZE) -> DataFrame:
    """Batch partials of `stored_rows`, each stored file cut into batches of its own.

    Only per-batch aggregates leave a task; numbers are given to the batches afterwards, so
    the cost does not depend on how many files there are. The last batch of a file is short.
    """
    sliced = rows.withColumn("_cut", _whole_div(F.col("stored_row"), size))
    partials = written(batch_partials(sliced, scale, ("source_file", "stored_file", "_cut")), "slices")
    per_file = partials.groupBy("source_file", "stored_file").agg((F.max("_cut") + 1).alias("_n"))
    earlier = (
        Window.partitionBy("source_file").orderBy("stored_file").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_file.select(
        "source_file", "stored_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return partials.join(offsets, ["source_file", "stored_file"]).select(
        "source_file", (F.col("_before") + F.col("_cut") + 1).alias("batch_number"),
        *[c for c in partials.columns if c not in ("source_file", "stored_file", "_cut")],
    )


def batch_partials(
    numbered: DataFrame, scale: int | None = None, keys: Sequence[str] = ("source_file", "batch_number")
) -> DataFrame:
    """One row per batch: rows in, rejected, and count, sum, min, max of the kept prices.

    ``keys`` sets how often statistics are updated: per batch, or per source.
    """
    price = F.when(F.col("reject_reason").isNull(), F.col("price"))
    return judge(numbered).groupBy(*keys).agg(
        F.count("*").alias("rows_in"),
        F.count("reject_reason").alias("rows_rejected"),
        F.count(price).alias("rows_processed"),
        partial_sum(price, scale).alias("batch_sum"),
        F.min(price).alias("batch_min"),
        F.max(price).alias("batch_max"),
    )


def running_history(
    partials: DataFrame, expected: Sequence[str], scale: int | None = None, block: int = HISTORY_BLOCK
) -> DataFrame:
    """Running count, sum, min and max before and after every batch, in processing order.

    Batches are cut into blocks; block totals are windowed, then batches inside a block.
    Only block totals (one per ``block`` batches of a source) meet in one task. Batches
    without a kept row leave the running values as they are, as an empty batch does.
    """
    stored = written(
        partials.withColumn("feed_no", feed_position(F.col("source_file"), expected))
        .withColumn("_block", _whole_div(F.col("batch_number") - 1, block)),
        "partials",
    )
    money = (lambda c: c) if scale is None else (lambda c: c.cast(f"decimal(38,{scale})"))
    blocks = stored.groupBy("feed_no", "source_file", "_block").agg(
        F.count("*").alias("_batches"),
        F.sum("rows_processed").alias("_rows"),
        F.sum(money(F.col("batch_sum"))).alias("_sum"),
        F.min("batch_min").alias("_min"),
        F.max("batch_max").alias("_max"),
    )
    earlier = (
        Window.orderBy("feed_no", "source_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = blocks.select(
        "feed_no", "source_file", "_block",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_b") for c in ("_batches", "_rows", "_sum")],
        F.min("_min").over(earlier).alias("_min_b"),
        F.max("_max").over(earlier).alias("_max_b"),
    )
    joined = stored.join(written(before, "blocks"), ["feed_no", "source_file", "_block"])
    in_block = Window.partitionBy("feed_no", "source_file", "_block").orderBy("batch_number")
    frames = {
        "before": in_block.rowsBetween(Window.unboundedPreceding, -1),
        "after": in_block.rowsBetween(Window.unboundedPreceding, 0),
    }
    zero = F.lit(0)
    columns = {"batch_seq": F.col("_batches_b") + F.row_number().over(in_block)}
    for when, frame in frames.items():
        total = F.sum(money(F.col("batch_sum"))).over(frame)
        columns[f"running_count_{when}"] = F.col("_rows_b") + F.coalesce(F.sum("rows_processed").over(frame), zero)
        columns[f"running_sum_{when}"] = (F.col("_sum_b") + F.coalesce(total, zero)).cast("double")
        columns[f"running_min_{when}"] = F.least("_min_b", F.min("batch_min").over(frame))
        columns[f"running_max_{when}"] = F.greatest("_max_b", F.max("batch_max").over(frame))
    out = joined.select(
        "source_file", "batch_number", "feed_no", "rows_in", "rows_rejected", "rows_processed",
        F.col("batch_sum").cast("double").alias("batch_sum"), "batch_min", "batch_max",
        F.try_divide(F.col("batch_sum").cast("double"), "rows_processed").alias("batch_avg"),
        *[c.alias(n) for n, c in columns.items()],
    )
    for when in frames:
        out = out.withColumn(
            f"running_avg_{when}", F.try_divide(F.col(f"running_sum_{when}"), F.col(f"running_count_{when}"))
        )
    return out.withColumn("batch_id", batch_key(F.col("source_file"), F.col("batch_number")))


def snapshots(history: DataFrame) -> DataFrame:
    """The state as it was before each batch, as JSON; NULL fields where there was no data."""
    state = F.struct(
        F.col("running_count_before").alias("count"),
        F.when(F.col("running_count_before") > 0, F.col("running_sum_before")).alias("sum"),
        F.col("running_min_before").alias("min"),
        F.col("running_max_before").alias("max"),
        F.col("running_avg_before").alias("avg"),
    )
    return history.select("batch_id", "source_file", "batch_number", null_safe_json(state).alias("stats_snapshot"))


def last_batch(history: DataFrame) -> DataFrame:
    """The record of the latest batch."""
    names = [c for c in history.columns if c != "batch_seq"]
    latest = F.max_by(F.struct("batch_seq", *names), F.col("batch_seq"))
    return history.agg(latest.alias("r")).select("r.*")


def progress(history: DataFrame, every: int = PROGRESS_EVERY) -> DataFrame:
    """A progress line at every ``every``-th batch of a source."""
    return history.where(F.pmod("batch_number", F.lit(every)) == 0).select(
        "source_file", "batch_number", "running_count_after",
        F.format_string("%s: batch %d, %,d rows so far", "source_file", "batch_number", "running_count_after").alias("line"),
    )


def recent_history(history: DataFrame, keep: int = MAX_HISTORY) -> DataFrame:
    """The newest ``keep`` entries of the history, which is what the history keeps.

    ``batch_seq`` is dense, so the cut-off is one scalar and no sort is needed.
    """
    newest = history.agg(F.max("batch_seq").alias("m")).scalar()
    return history.where(F.col("batch_seq") > newest - F.lit(keep))


def engine_metrics(partials: DataFrame) -> DataFrame:
    """Totals of the history: batches, rows, mean batch size, batches per source."""
    return partials.where(F.col("rows_processed") > 0).agg(
        F.count("*").alias("total_batches_processed"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows_processed"),
        F.avg("rows_processed").alias("avg_batch_size"),
        F.try_divide(F.count("*"), F.count_distinct("source_file")).alias("batches_per_file"),
    )


def source_rollup(partials: DataFrame) -> DataFrame:
    """Rows, batches and rejected rows per source, and in total (``source_file`` NULL)."""
    per_source = partials.groupBy("source_file").agg(
        F.sum("rows_in").alias("_in"),
        F.sum("rows_processed").alias("_kept"),
        F.sum("rows_rejected").alias("_out"),
        F.count("*").alias("_batches"),
    )
    return per_source.rollup("source_file").agg(
        F.count("*").alias("files"),
        F.sum("_in").alias("rows_in"),
        F.sum("_kept").alias("rows_processed"),
        F.sum("_out").alias("rows_filtered"),
        F.sum("_batches").alias("batches"),
    )
