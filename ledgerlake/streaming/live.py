"""Stateful streams: statistics readable at any time, calendar windows, duplicates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.numbers import exact_sum, folded_sum, partial_sum
from ledgerlake.operators.quality import full_key
from ledgerlake.sinks.tables import overwrite_partitions
from ledgerlake.workspace import literal_rows, read_if_any


def state_session(spark: SparkSession) -> SparkSession:
    """A session whose stateful streams keep one state partition per core.

    The number of state partitions is fixed by the first run of a checkpoint, and every one
    is opened in every micro-batch, so it should follow the cluster, not a default.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session


def live_stats(stream: DataFrame, scale: int | None = None) -> DataFrame:
    """Global statistics held in Spark's state store: one row of state, merged from partials."""
    return stream.agg(
        F.count("price").alias("count"), exact_sum(F.col("price"), scale).alias("sum"),
        F.min("price").alias("min"), F.max("price").alias("max"),
    ).select("count", "sum", F.try_divide("sum", "count").alias("avg"), "min", "max")


def _run(stream: DataFrame, checkpoint: str, save: Callable[[DataFrame, int], None]) -> None:
    """Hand all available input, micro-batch by micro-batch, to ``save``."""
    query: StreamingQuery = (
        stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


WINDOWS = (
    "date_partition date, transaction_count bigint, price_sum {money}, price_min double, price_max double, "
    "last_seen timestamp, late_rows bigint, ingest_batch bigint"
)


def _window_columns(scale: int | None) -> str:
    return WINDOWS.format(money="double" if scale is None else f"decimal(38,{scale})")


def _windows(spark: SparkSession, path: str, scale: int | None) -> DataFrame:
    return read_if_any(spark, path, _window_columns(scale))


def fold_windows(stream: DataFrame, path: str, checkpoint: str, scale: int | None = None, late: str = "2 days") -> None:
    """Counts and prices per day of event time, as partials of each micro-batch.

    Whatever the order in which rows arrive and the number of files in a micro-batch, no row is
    lost: late ones are merged into their day when partials are folded (`daily_windows`), and
    counted as ``late_rows``: those more than ``late`` behind the latest event time of earlier
    micro-batches. That time is a mark, which each micro-batch takes from the one before it and
    hands on, so nothing earlier is listed or read. A replayed micro-batch replaces its partials and
    its mark. Days follow the session time zone.
    """

    def save(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        mark = read_if_any(spark, f"{path}_marks/ingest_batch={number - 1}", "last_seen timestamp")
        seen = mark.agg(F.max("last_seen")).scalar()
        behind = F.coalesce(F.col("ts") < seen - F.expr(f"INTERVAL {late}"), F.lit(False))
        partials = rows.groupBy(F.to_date("ts").alias("date_partition")).agg(
            F.count("*").alias("transaction_count"), partial_sum(F.col("price"), scale).alias("price_sum"),
            F.min("price").alias("price_min"), F.max("price").alias("price_max"), F.max("ts").cast("timestamp").alias("last_seen"),
            F.count_if(behind).alias("late_rows"),
        )
        overwrite_partitions(partials.withColumn("ingest_batch", F.lit(number).cast("bigint")), path, ["ingest_batch"])
        own = read_if_any(spark, f"{path}/ingest_batch={number}", _window_columns(scale), base=path)
        latest = own.agg(F.greatest(F.max("last_seen"), seen).alias("last_seen"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{path}_marks/ingest_batch={number}")

    _run(stream, checkpoint, save)


def daily_windows(spark: SparkSession, path: str, scale: int | None = None) -> DataFrame:
    """The days that `fold_windows` has seen, folded from the partials of all micro-batches."""
    return _windows(spark, path, scale).groupBy("date_partition").agg(
        F.sum("transaction_count").alias("transaction_count"), folded_sum(F.col("price_sum"), scale).alias("price_sum"),
        F.min("price_min").alias("price_min"), F.max("price_max").alias("price_max"), F.sum("late_rows").alias("late_rows"),
    )


def unique(stream: DataFrame, key: Sequence[str]) -> DataFrame:
    """The first row of every key of a stream, by keyed state; rows without a full key are nobody's copy."""
    full = full_key(key)
    return stream.where(full).dropDuplicates(list(key)).unionByName(stream.where(~full))


def fold_unique(
    stream: DataFrame, path: str, checkpoint: str, key: Sequence[str] = ("ts", "user_id", "price", "source_file")
) -> None:
    """The first row of every key, whenever its copies arrive.

    Keys that have been seen are Spark's keyed state; open ``stream`` in a `state_session`, which
    keeps them in RocksDB on the executors' disks, with changes only in the checkpoint. A
    micro-batch looks up its own keys and writes its new rows; no stored row is listed or read.
    The state grows with the distinct keys, a few bytes each. A replayed micro-batch replaces
    what it wrote.
    """

    def save(rows: DataFrame, number: int) -> None:
        dated = rows.withColumn("day", F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("none")))
        overwrite_partitions(dated.withColumn("ingest_batch", F.lit(number).cast("bigint")), path, ["day", "ingest_batch"])

    _run(unique(stream, key), checkpoint, save)


def publish(rows: DataFrame, path: str, number: int) -> None:
    """Replaces a small table at once: written under its number first, then pointed to."""
    rows.write.mode("overwrite").parquet(f"{path}/versions/{number}")
    pointer = literal_rows(rows.sparkSession, "current bigint", [(number,)])
    overwrite_partitions(pointer.withColumn("version", F.lit(number)), f"{path}/pointers", ["version"])


def published(spark: SparkSession, path: str) -> DataFrame:
    """The latest complete version of a table that `publish` wrote."""
    current = spark.read.schema("current bigint, version bigint").parquet(f"{path}/pointers").agg(F.max("current")).first()[0]
    return spark.read.parquet(f"{path}/versions/{current}")


def run_live(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run a streaming aggregate over all available input; `published` reads its latest result
    at any time, also while the next one is written."""
    query: StreamingQuery = (
        stream.writeStream.outputMode("complete").foreachBatch(lambda rows, number: publish(rows, path, number))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
