"""Micro-batch ingestion of bronze into the store, with incremental statistics.

Every micro-batch writes under its own partition key ``(phase, ingest_batch)``. The state is
always folded from the per-batch partials, never counted up, so a batch that is replayed
after a failure overwrites itself and nothing is counted twice. A file that is converted
anew replaces its earlier rows: only the newest ``bronze_version`` of a file counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.numbers import partial_sum
from ledgerlake.operators.batches import running_history, snapshots
from ledgerlake.operators.clean import to_transactions
from ledgerlake.operators.stats import merge_partials
from ledgerlake.settings import FILES_PER_LOAD
from ledgerlake.sinks.tables import overwrite_partitions
from ledgerlake.sources import manifest
from ledgerlake.streaming import segments
from ledgerlake.workspace import literal_rows, read_if_any, written

PARTIAL_NAMES = ("count", "sum", "min", "max")
MAIN, HELD_OUT_PHASE = "main", "held_out"
BATCH_KEY = ("phase", "ingest_batch")
# Sizes of the sketches in partials, and their bounds at three standard errors.
USERS_LOG, PRICES_K = 12, 200
USERS_BOUND = 3 * 1.04 / 2 ** (USERS_LOG / 2)
RANK_BOUND = 0.02
_EVENT_ORDER = {"processing": 1, "failed": 2, "completed": 3}


@dataclass(frozen=True)
class Store:
    """Where the tables of one store lie."""

    folder: str
    scale: int | None = None
    generation: int = 1
    record: str | None = None  # the manifest of raw files, when they can be converted anew

    def _path(self, table: str) -> str:
        return f"{self.folder}/{self.generation}/{table}"

    @property
    def rows_path(self) -> str:
        return self._path("transactions")

    @property
    def partials_path(self) -> str:
        return self._path("batch_partials")

    @property
    def events_path(self) -> str:
        return self._path("batch_events")

    def checkpoint(self, phase: str) -> str:
        return self._path(f"checkpoints/{phase}")

    def reset(self) -> Store:
        """An empty store to start over with: new tables, new checkpoints, the old ones untouched."""
        return replace(self, generation=self.generation + 1)

    def all_rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(schemas.TRANSACTIONS).parquet(self.rows_path)

    def all_partials(self, spark: SparkSession) -> DataFrame:
        return segments.read_all(spark, self.partials_path, schemas.batch_partials(self.scale))

    def _dead(self, spark: SparkSession) -> DataFrame:
        """Loaded versions that no longer count, a row for each file and version.

        A file that was converted to no rows, or is gone, has no newer partials; only the manifest
        tells that its earlier rows do not count.
        """
        key = ["source_file", "file_id"]
        loaded = self.all_partials(spark).select(*key, "bronze_version").distinct()
        if not self.record:
            known = loaded.withColumn("alive", F.lit(True))
        else:
            files = manifest.current(spark, self.record)
            known = loaded.withColumn("alive", F.lit(True)).unionByName(
                files.select(*key, F.col("version").alias("bronze_version"), (F.col("state") == manifest.CONVERTED).alias("alive"))
            )
        # of equal versions the manifest's word counts: false before true
        newest = known.groupBy(*key).agg(F.max("bronze_version").alias("_newest"), F.min_by("alive", F.struct(-F.col("bronze_version"), "alive")).alias("_alive"))
        return loaded.join(newest, key).where((F.col("bronze_version") < F.col("_newest")) | ~F.col("_alive")).select(*key, "bronze_version")

    def _current(self, spark: SparkSession, rows: DataFrame) -> DataFrame:
        # Written first, so that the planner knows how small the list is; mostly it is empty.
        dead = written(self._dead(spark), "dead")
        return rows if dead.isEmpty() else rows.join(dead, ["source_file", "file_id", "bronze_version"], "left_anti")

    def _current_rows(self, spark: SparkSession, outcome: str) -> DataFrame:
        return self._current(spark, self.all_rows(spark).where(F.col("outcome") == outcome))

    def transactions(self, spark: SparkSession) -> DataFrame:
        """Kept rows; rejected ones lie in other partitions and are not read."""
        return self._current_rows(spark, "kept")

    def rejects(self, spark: SparkSession) -> DataFrame:
        return self._current_rows(spark, "rejected")

    def partials(self, spark: SparkSession) -> DataFrame:
        """Partial statistics per micro-batch and file, without replaced files."""
        return self._current(spark, self.all_partials(spark))

    def events(self, spark: SparkSession) -> DataFrame:
        return segments.read_all(spark, self.events_path, schemas.BATCH_EVENTS)

    def compact(self, spark: SparkSession, fanout: int = segments.FANOUT) -> dict[str, int]:
        """Gathers partials and events of complete batches; the state and all histories stay as they are."""
        kinds = {self.partials_path: schemas.batch_partials(self.scale), self.events_path: schemas.BATCH_EVENTS}
        return {path.rsplit("/", 1)[1]: segments.compact(spark, path, schema, fanout) for path, schema in kinds.items()}

    def sketches(self, spark: SparkSession) -> DataFrame:
        """Distinct users and price quantiles, merged from the sketches of all batches, with their bounds.

        The bounds are those at three standard errors: relative for users, in rank for quantiles.
        """
        users, prices = F.hll_union_agg("users"), F.kll_merge_agg_double("prices")
        merged = self.partials(spark).agg(users.alias("u"), prices.alias("p"))
        at = lambda q: F.kll_sketch_get_quantile_double("p", F.lit(q)).alias(f"price_{int(q * 100)}")
        return merged.select(
            F.hll_sketch_estimate("u").alias("users"), F.lit(USERS_BOUND).alias("users_bound"),
            F.kll_sketch_get_n_double("p").alias("n_prices"), *[at(q) for q in (0.05, 0.25, 0.5, 0.75, 0.95)],
            F.lit(RANK_BOUND).alias("rank_bound"),
        )

    def state(self, spark: SparkSession, phase: str | None = None) -> DataFrame:
        """Current statistics, without reading stored rows."""
        partials = self.partials(spark)
        return merge_partials(
            partials.where(F.col("phase") == phase) if phase else partials, self.scale, names=PARTIAL_NAMES
        )

    def history(self, spark: SparkSession) -> DataFrame:
        """Running history, one row per micro-batch, main phase first."""
        per_batch = self.partials(spark).groupBy(F.col("phase").alias("source_file"), "ingest_batch").agg(
            F.sum("rows_in").alias("rows_in"), F.sum("rows_rejected").alias("rows_rejected"),
            F.sum("count").alias("rows_processed"), F.sum("sum").alias("batch_sum"),
            F.min("min").alias("batch_min"), F.max("max").alias("batch_max"),
        )
        numbered = per_batch.withColumn("batch_number", F.col("ingest_batch") + 1).drop("ingest_batch")
        history = running_history(numbered, (MAIN, HELD_OUT_PHASE), self.scale)
        return history.withColumnRenamed("source_file", "phase").withColumn("ingest_batch", F.col("batch_number") - 1)

    def batch_metadata(self, spark: SparkSession) -> DataFrame:
        """Latest status of every batch, with the state as it was before the batch."""
        history = self.history(spark).withColumn("source_file", F.col("phase"))
        before = snapshots(history).select(
            F.col("source_file").alias("phase"), (F.col("batch_number") - 1).alias("ingest_batch"), "stats_snapshot"
        )
        return latest_status(self.events(spark)).join(before, list(BATCH_KEY), "left")

    def statistics(self, spark: SparkSession) -> DataFrame:
        """The statistics table: the state with its times and version."""
        times = self.events(spark).agg(
            F.min("event_time").alias("created_at"), F.max("event_time").alias("last_updated")
        )
        return self.state(spark).select(
            "*", times.select("created_at").scalar().alias("created_at"),
            times.select("last_updated").scalar().alias("last_updated"), F.lit("1.0").alias("version"),
        )


def latest_status(events: DataFrame) -> DataFrame:
    """Batch metadata: the latest event of the latest attempt of every batch.

    The log is only ever added to: each load of a batch is an attempt of its own.
    """
    names = [c for c in events.columns if c != "batch_id"]
    latest = F.max_by(F.struct(*names), F.struct("attempt", "event_no", "event_time"))
    started = F.max_by("event_time", F.when(F.col("status") == "processing", F.col("attempt")))
    return events.groupBy("batch_id").agg(
        latest.alias("r"), started.alias("processing_start"), F.max("event_time").alias("processing_end")
    ).select(
        "batch_id", "r.status", "r.rows_processed", "r.rows_rejected", "processing_start", "processing_end",
        "r.error_message", "r.phase", "r.ingest_batch",
    )


def batch_summary(batches: DataFrame) -> DataFrame:
    """Number of batches by outcome, their rows, and the success rate in percent."""
    done = F.count_if(F.col("status") == "completed")
    rate = F.try_divide(done * F.lit(100.0), F.count("*"))
    return batches.agg(
        F.count("*").alias("total_batches"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.avg("rows_processed"), F.lit(0.0)).alias("avg_batch_size"),
        done.alias("completed_batches"),
        F.count_if(F.col("status") == "failed").alias("failed_batches"),
        F.coalesce(rate, F.lit(0.0)).alias("success_rate"),
    )


def throughput(batches: DataFrame) -> DataFrame:
    """Rows per second over the time from the first start to the last end."""
    spent = F.timestamp_diff("MICROSECOND", F.min("processing_start"), F.max("processing_end")) / F.lit(1e6)
    rows = F.coalesce(F.sum("rows_processed"), F.lit(0))
    return batches.agg(
        rows.alias("rows_processed"), spent.alias("seconds"), F.try_divide(rows.cast("double"), spent).alias("rows_per_second")
    )


def _batch_id(phase: str, ingest_batch: int) -> Column:
    return F.md5(F.concat_ws("/", F.lit(phase), F.lit(str(ingest_batch))))


def _next_attempt(spark: SparkSession, store: Store, phase: str, ingest_batch: int) -> int:
    """Number of this load of a batch, from the batch's own part of the log."""
    earlier = _own_part(spark, store.events_path, schemas.BATCH_EVENTS, phase, ingest_batch)
    return 1 + (earlier.agg(F.max("attempt")).first()[0] or 0)


def _log(
    spark: SparkSession, store: Store, phase: str, ingest_batch: int, attempt: int, status: str,
    counts: DataFrame | None = None, error: str | None = None,
) -> None:
    if counts is None:
        nothing = F.lit(None).cast("bigint")
        counts = spark.range(0, 1, 1, 1).select(nothing.alias("rows_processed"), nothing.alias("rows_rejected"))
    row = counts.select(
        _batch_id(phase, ingest_batch).alias("batch_id"), F.lit(_EVENT_ORDER[status]).alias("event_no"),
        "rows_processed", "rows_rejected", F.current_timestamp().alias("event_time"),
        F.lit(error).cast("string").alias("error_message"), F.lit(phase).alias("phase"),
        F.lit(ingest_batch).cast("bigint").alias("ingest_batch"), F.lit(attempt).alias("attempt"),
        F.lit(status).alias("status"),
    )
    overwrite_partitions(row, store.events_path, [*BATCH_KEY, "attempt", "status"])


def _own_part(spark: SparkSession, path: str, schema: str, phase: str, ingest_batch: int) -> DataFrame:
    """What one micro-batch has written to a table. Only its folder is listed, so the cost of
    a batch does not grow with the number of batches before it."""
    return read_if_any(spark, f"{path}/phase={phase}/ingest_batch={ingest_batch}", schema, base=path)


def _clear(spark: SparkSession, path: str, phase: str, ingest_batch: int) -> None:
    """Removes what an earlier attempt wrote: a replay may have no rows for one of its partitions."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/phase={phase}/ingest_batch={ingest_batch}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def load_batch(rows: DataFrame, ingest_batch: int, store: Store, phase: str) -> None:
    """Load one micro-batch: rows, then their partial statistics, then the event.

    The input is evaluated once: while it is written, it is counted and added up. Partials by file
    come from the columns they need of what was written, and have to agree with those counts, so a
    write that lost or doubled rows fails the batch; a later loss is seen by the verification of
    the store against the partials.
    """
    spark = rows.sparkSession
    key = {"phase": F.lit(phase), "ingest_batch": F.lit(ingest_batch).cast("bigint")}
    attempt = _next_attempt(spark, store, phase, ingest_batch)
    _log(spark, store, phase, ingest_batch, attempt, "processing")
    try:
        outcome = F.when(F.col("reject_reason").isNull(), "kept").otherwise("rejected")
        loaded = to_transactions(rows, _batch_id(phase, ingest_batch)).withColumns({**key, "outcome": outcome})
        seen = Observation()
        price = F.when(F.col("reject_reason").isNull(), F.col("price"))
        observed = loaded.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count("reject_reason").alias("rows_rejected"))
        _clear(spark, store.rows_path, phase, ingest_batch)
        overwrite_partitions(observed, store.rows_path, [*BATCH_KEY, "outcome"])
        stored = _own_part(spark, store.rows_path, schemas.TRANSACTIONS, phase, ingest_batch)
        user = F.when(F.col("reject_reason").isNull(), F.col("user_id"))
        partial = stored.groupBy("source_file", "file_id", "bronze_version").agg(
            F.count(F.lit(1)).alias("rows_in"), F.count("reject_reason").alias("rows_rejected"),
            F.count(price).alias("count"), partial_sum(price, store.scale).alias("sum"),
            F.min(price).alias("min"), F.max(price).alias("max"),
            F.hll_sketch_agg(user, USERS_LOG).alias("users"), F.kll_sketch_agg_double(price, PRICES_K).alias("prices"),
        )
        overwrite_partitions(partial.withColumns(key), store.partials_path, BATCH_KEY)
        mine = _own_part(spark, store.partials_path, schemas.batch_partials(store.scale), phase, ingest_batch)
        sums = mine.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_in", "rows_rejected", "count")]).first()
        came = seen.get
        if (sums["rows_in"], sums["rows_rejected"]) != (came["rows_in"], came["rows_rejected"]):
            raise ValueError(f"{came['rows_in']} rows came in, {sums['rows_in']} were stored")
        counts = literal_rows(spark, "rows_processed bigint, rows_rejected bigint", [(sums["count"], sums["rows_rejected"])])
        _log(spark, store, phase, ingest_batch, attempt, "completed", counts)
    except Exception as problem:
        _log(spark, store, phase, ingest_batch, attempt, "failed", error=str(problem))
        raise


def bronze_stream(
    spark: SparkSession, bronze_path: str, wanted: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int | None = FILES_PER_LOAD,
) -> DataFrame:
    """Bronze files as a stream, a number of files per micro-batch."""
    reader = spark.readStream.schema(schemas.BRONZE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(bronze_path)
    return wanted(rows) if wanted else rows


def ingest_available(
    stream: DataFrame, store: Store, phase: str, after_batch: Callable[[int], None] | None = None
) -> None:
    """Load everything that has arrived since the last run of this phase, then stop.

    Run again after a failure or after new files came in, it goes on where the checkpoint
    left off. Phases have their own checkpoint and share the state. ``after_batch`` is
    called with the number of every loaded batch.
    """

    def load(rows: DataFrame, number: int) -> None:
        load_batch(rows, number, store, phase)
        if after_batch:
            after_batch(number)

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", store.checkpoint(phase))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
