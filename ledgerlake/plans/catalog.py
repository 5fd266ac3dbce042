"""The queries over the given tables. Each one covers whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions import numbers, texts
from ledgerlake.operators import (
    batches, clean, completeness, gold, monitoring, quality, reconcile, silver, stats,
)
from ledgerlake.operators.quantiles import quantiles
from ledgerlake.plans import inputs, report, run
from ledgerlake.plans.inputs import FEED, NARROW_FEED, PRICE_SCALE
from ledgerlake.sinks import retention
from ledgerlake.sinks import tables as sinks
from ledgerlake.sources import csvfiles, listing, parquetfiles
from ledgerlake.sources.tables import query_store, read_state
from ledgerlake.streaming import ingest, live
from ledgerlake.workspace import fresh_path, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FILE_ORDER = ["event_id", "copy"]
SMALL_BATCH = 100


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- Building blocks --------------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty feed as bronze rows, with the columns that give the file order."""
    return clean.to_bronze(inputs.dirty_text(spark, sf_dir), keep=FILE_ORDER)


def _partials(spark: SparkSession, sf_dir: str, size: int = 1000) -> DataFrame:
    rows = _bronze(spark, sf_dir).select("source_file", "price", "bad_price", *FILE_ORDER)
    return batches.batch_partials(batches.number_batches(rows, FILE_ORDER, size), PRICE_SCALE)


def _folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials for a fold, which needs no numbers: one row per source and task, nothing is sorted."""
    rows = _bronze(spark, sf_dir).select("source_file", "price", "bad_price", F.spark_partition_id().alias("part"))
    return batches.batch_partials(rows, PRICE_SCALE, ["source_file", "part"])


def _history(spark: SparkSession, sf_dir: str, size: int = 1000) -> DataFrame:
    return batches.running_history(_partials(spark, sf_dir, size), FEED.expected, PRICE_SCALE)


def _raw_files(spark: SparkSession, sf_dir: str) -> str:
    """The dirty feed as CSV files, one folder per source."""
    path = fresh_path(spark, "raw")
    (
        inputs.dirty_text(spark, sf_dir).write.partitionBy("source_file").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def _raw_and_bronze(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    raw, bronze = _raw_files(spark, sf_dir), fresh_path(spark, "bronze")
    run.convert_to_bronze(spark, raw, bronze)
    return raw, bronze


def _iso(column: str) -> Column:
    return texts.iso_text(F.col(column))


# --- Statistics and batches -------------------------------------------------------


@query
def running_stats_reconcile(spark, sf_dir):
    """Per-batch partials folded into the state, against a direct recomputation."""
    rows = inputs.transactions(spark, sf_dir)
    slim = rows.select("source_file", "price", F.spark_partition_id().alias("part"))
    partials = batches.batch_partials(slim, PRICE_SCALE, ["source_file", "part"])
    return reconcile.reconcile(
        stats.merge_partials(partials, PRICE_SCALE), stats.direct_stats(clean.kept(rows), PRICE_SCALE)
    )


@query
def batch_history(spark, sf_dir):
    return _history(spark, sf_dir).select(
        "source_file", "batch_number", "batch_seq", "batch_id", "rows_in", "rows_rejected", "rows_processed",
        "batch_min", "batch_max", "batch_avg", "running_count_before", "running_count_after",
        "running_sum_after", "running_min_after", "running_max_after", "running_avg_after",
    )


@query
def batch_snapshots(spark, sf_dir):
    return batches.snapshots(_history(spark, sf_dir))


@query
def last_batch(spark, sf_dir):
    return batches.last_batch(_history(spark, sf_dir)).select(
        "batch_seq", "source_file", "batch_number", "rows_processed", "batch_min", "batch_max",
        "running_count_after", "running_avg_after",
    )


@query
def progress_every_5(spark, sf_dir):
    return batches.progress(_history(spark, sf_dir, SMALL_BATCH))


@query
def history_cap(spark, sf_dir):
    kept = batches.recent_history(_history(spark, sf_dir, SMALL_BATCH), 50)
    return kept.select("batch_seq", "source_file", "batch_number", "rows_processed")


@query
def engine_metrics(spark, sf_dir):
    return batches.engine_metrics(_partials(spark, sf_dir))


@query
def file_rollup(spark, sf_dir):
    return batches.source_rollup(_partials(spark, sf_dir))


@query
def stored_batches(spark, sf_dir):
    """Batches numbered by the place of rows in stored files: sizes per source."""
    _, bronze = _raw_and_bronze(spark, sf_dir)
    numbered = batches.number_stored_batches(parquetfiles.stored_rows(spark, bronze))
    per_batch = numbered.groupBy("source_file", "batch_number").agg(F.count("*").alias("rows_in"))
    return per_batch.select("source_file", "batch_number", "rows_in")


@query
def update_per_file(spark, sf_dir):
    """Statistics updated per source instead of per batch."""
    rows = _bronze(spark, sf_dir)
    return batches.batch_partials(rows, PRICE_SCALE, ["source_file"]).withColumn("batch_sum", F.col("batch_sum").cast("double"))


@query
def direct_stats(spark, sf_dir):
    """The verification query as SQL text over the store."""
    return query_store(
        spark,
        "SELECT count(*) AS count, CAST(sum(CAST(price AS decimal(18,2))) AS double) AS sum, "
        "CAST(sum(CAST(price AS decimal(18,2))) AS double) / count(*) AS avg, min(price) AS min, "
        "max(price) AS max FROM {transactions}",
        transactions=clean.kept(_bronze(spark, sf_dir)),
    )


@query
def lineitem_stats(spark, sf_dir):
    """Direct statistics over the largest table, per source."""
    return stats.direct_stats(inputs.lineitems(spark, sf_dir), PRICE_SCALE, ["source_file"])


@query
def lineitem_incremental(spark, sf_dir):
    """State per source, folded from partial statistics per day, on the largest table."""
    rows = inputs.lineitems(spark, sf_dir).withColumn("day", F.to_date("ts"))
    partials = batches.batch_partials(rows, PRICE_SCALE, ["source_file", "day"])
    return stats.merge_partials(partials, PRICE_SCALE, ["source_file"])


@query
def lineitem_history(spark, sf_dir):
    """Running history of the largest table in batches of a thousand rows."""
    order = ["event_id", "line", "item", "seller", "price", "row_file", "row_no"]
    rows = inputs.numbered_lineitems(spark, sf_dir).select("source_file", *order)
    numbered = batches.number_batches(rows, order)
    history = batches.running_history(batches.batch_partials(numbered, PRICE_SCALE), inputs.LINEITEM_SOURCES, PRICE_SCALE)
    return history.select(
        "source_file", "batch_number", "batch_seq", "rows_processed", "running_count_after", "running_sum_after",
        "running_min_after", "running_max_after", "running_avg_after",
    )


@query
def lineitem_describe(spark, sf_dir):
    """Distribution of prices in the largest table, exact quartiles included."""
    return stats.describe_prices(inputs.lineitems(spark, sf_dir))


@query
def report_stats(spark, sf_dir):
    return stats.report_stats(clean.kept(_bronze(spark, sf_dir)), PRICE_SCALE)


@query
def record_count(spark, sf_dir):
    return stats.record_count(clean.kept(_bronze(spark, sf_dir)))


@query
def price_describe(spark, sf_dir):
    return stats.describe_prices(_bronze(spark, sf_dir))


@query
def std_median(spark, sf_dir):
    return stats.std_and_median(_bronze(spark, sf_dir))


@query
def users_per_file(spark, sf_dir):
    return stats.users_per_source(_bronze(spark, sf_dir))


@query
def stats_text(spark, sf_dir):
    """State as a line of text and as a block, per source."""
    partials = written(_partials(spark, sf_dir), "partials")
    made = partials.groupBy("source_file").agg(F.count("*").alias("batches"))
    state = stats.merge_partials(partials, PRICE_SCALE, ["source_file"]).join(made, "source_file")
    c = {n: F.col(n) for n in ("count", "sum", "avg", "min", "max")}
    return state.select(
        "source_file", texts.stats_line(c["count"], c["avg"], c["min"], c["max"]).alias("line"),
        texts.stats_block(c["count"], c["sum"], c["avg"], c["min"], c["max"], F.col("batches")).alias("block"),
    )


# --- Cleaning -----------------------------------------------------------------------


@query
def clean_kept(spark, sf_dir):
    return clean.kept(_bronze(spark, sf_dir)).select("event_id", "copy", "price", "user_id", "source_file")


@query
def clean_rejects(spark, sf_dir):
    return clean.rejected(_bronze(spark, sf_dir)).select(
        "event_id", "copy", "price", "bad_price", "source_file", "reject_reason"
    )


@query
def clean_counts(spark, sf_dir):
    return clean.clean_counts(_bronze(spark, sf_dir))


@query
def customer_balances(spark, sf_dir):
    """Natural non-positive amounts: kept and rejected customers per nation."""
    rows = inputs.table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("price"), F.col("c_nationkey").cast("string").alias("source_file")
    )
    return clean.clean_counts(rows).select("source_file", "rows_in", "rows_kept", "rejected_not_positive")


@query
def null_profile(spark, sf_dir):
    return clean.null_profile(_bronze(spark, sf_dir), ["timestamp", "price", "user_id"], ["source_file"])


@query
def safe_float(spark, sf_dir):
    text = inputs.dirty_text(spark, sf_dir)
    return text.select(
        "event_id", "copy", numbers.safe_float(F.col("price")).alias("price"),
        numbers.flag(numbers.not_a_number(F.col("price"))).alias("not_numeric"),
    )


@query
def transactions_table(spark, sf_dir):
    """Bronze rows in the columns of the transactions table, nulls kept as nulls."""
    out = clean.to_transactions(_bronze(spark, sf_dir), F.md5(F.col("source_file")))
    return out.select("timestamp", "price", "user_id", "source_file", "batch_id", "processing_metadata", "reject_reason")


@query
def format_sizes(spark, sf_dir):
    size = F.col("o_orderkey") * F.col("o_orderkey") * 997
    return inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", texts.size_one_decimal(size).alias("one_decimal"),
        texts.size_two_decimals(size).alias("two_decimals"),
    )


@query
def batch_ids(spark, sf_dir):
    rows = inputs.transactions(spark, sf_dir).select("source_file", "ts", "event_id")
    numbered = batches.number_batches(rows, ["ts", "event_id"], SMALL_BATCH)
    per_batch = numbered.groupBy("source_file", "batch_number").agg(F.min("ts").alias("at"))
    number = F.col("batch_number")
    return per_batch.select(
        "source_file", "batch_number", texts.stem(F.col("source_file")).alias("file_stem"),
        texts.stamped_batch_id(F.col("source_file"), number, F.col("at")).alias("stamped_id"),
        texts.batch_key(F.col("source_file"), number).alias("batch_id"), _iso("at").alias("started_at"),
    )


@query
def state_json(spark, sf_dir):
    """State per source written as a JSON file and loaded again."""
    path = fresh_path(spark, "state")
    sinks.write_state(stats.merge_partials(_folds(spark, sf_dir), PRICE_SCALE, ["source_file"]), path)
    return read_state(spark, path, ["source_file"])


@query
def snapshot_values(spark, sf_dir):
    """Snapshots decoded from their JSON text."""
    text = batches.snapshots(_history(spark, sf_dir))
    state = F.from_json("stats_snapshot", schemas.STATE_JSON)
    return text.select("batch_id", state.alias("s")).select("batch_id", "s.*")


# --- Reconciliation ----------------------------------------------------------------


@query
def compare_sources(spark, sf_dir):
    """Store, folded state and uncleaned rows side by side; the last one must differ."""
    rows = _bronze(spark, sf_dir)
    sides = {
        "store": stats.direct_stats(clean.kept(rows), PRICE_SCALE),
        "incremental": stats.merge_partials(_folds(spark, sf_dir), PRICE_SCALE),
        "uncleaned": stats.direct_stats(rows.where(F.col("price").isNotNull()), PRICE_SCALE),
    }
    return reconcile.compare_sources(sides)


@query
def per_file_reconcile(spark, sf_dir):
    folded = stats.merge_partials(_folds(spark, sf_dir), PRICE_SCALE, ["source_file"])
    direct = stats.direct_stats(clean.kept(_bronze(spark, sf_dir)), PRICE_SCALE, ["source_file"])
    return reconcile.verdict(reconcile.reconcile(folded, direct, ["source_file"]), ["source_file"])


@query
def heldout_drift(spark, sf_dir):
    return reconcile.held_out_drift(_folds(spark, sf_dir), FEED.held_out, PRICE_SCALE)


@query
def audit_record(spark, sf_dir):
    """The audit row of a reconciliation, written and read back."""
    folded = stats.merge_partials(_folds(spark, sf_dir), PRICE_SCALE)
    direct = stats.direct_stats(clean.kept(_bronze(spark, sf_dir)), PRICE_SCALE)
    path = fresh_path(spark, "audit")
    for _ in range(2):  # both verifications stay on record
        sinks.append_audit(reconcile.audit_row(folded, direct, reconcile.reconcile(folded, direct), "run-1", "final"), path)
    return spark.read.schema(schemas.STATS_VERIFICATION).parquet(path).select(
        "run_id", "incremental_stats", "database_stats", "verification_passed", "notes"
    )


# --- Files and layers ---------------------------------------------------------------


@query
def bronze_roundtrip(spark, sf_dir):
    _, bronze = _raw_and_bronze(spark, sf_dir)
    return parquetfiles.read_bronze(spark, bronze).select(
        "timestamp", "price", "user_id", "bad_price", "bronze_created_by", "source_file"
    )


@query
def csv_profile(spark, sf_dir):
    raw = _raw_files(spark, sf_dir)
    files = listing.list_files(spark, raw, "*.csv")
    profile = csvfiles.csv_profile(files, csvfiles.csv_headers(files), csvfiles.line_counts(spark, raw))
    return profile.select(
        "source_file", "row_count", F.concat_ws(",", "columns").alias("columns"), "n_layouts", "valid",
        (F.col("file_size") > 0).alias("has_bytes"),
    )


@query
def csv_samples(spark, sf_dir):
    """First three rows of every source."""
    rows = inputs.dirty_text(spark, sf_dir).select("source_file", *FILE_ORDER, "price")
    return csvfiles.csv_sample(rows, FILE_ORDER, 3)


@query
def parquet_profile(spark, sf_dir):
    _, bronze = _raw_and_bronze(spark, sf_dir)
    files = listing.list_files(spark, bronze, "*.parquet")
    return parquetfiles.parquet_profile(parquetfiles.parquet_footers(files)).select(
        "source_file", "row_count", "column_count", "compression", "corrupt_files"
    )


@query
def conversion_totals(spark, sf_dir):
    raw, bronze = _raw_and_bronze(spark, sf_dir)
    converted = parquetfiles.parquet_profile(parquetfiles.parquet_footers(listing.list_files(spark, bronze, "*.parquet")))
    return completeness.conversion_summary(converted, listing.list_files(spark, raw, "*.csv")).select(
        "total_files", "converted_files", "failed_files", "total_rows", "total_batches", "avg_batch_size", "success"
    )


@query
def size_compare(spark, sf_dir):
    raw, bronze = _raw_and_bronze(spark, sf_dir)
    sizes = completeness.compare_sizes(
        listing.list_files(spark, raw, "*.csv"), listing.list_files(spark, bronze, "*.parquet")
    )
    saved = F.col("csv_size") - F.col("parquet_size")
    return sizes.select(
        "file_stem", "csv_exists", "parquet_exists", "csv_size",
        (F.col("parquet_size") > 0).alias("parquet_has_bytes"),
        ((F.col("space_saved") == saved) & (F.abs(F.col("compression_ratio") - saved * 100 / F.col("csv_size")) < 1e-9)).alias("consistent"),
    )


@query
def missing_files(spark, sf_dir):
    """Expected sources that the bronze layer does not have."""
    _, bronze = _raw_and_bronze(spark, sf_dir)
    expected = completeness.expected_sources(spark, [*FEED.expected, "2024-6.csv", "2024-7.csv"])
    return completeness.missing_sources(listing.list_files(spark, bronze, "*.parquet"), expected)


@query
def layer_totals(spark, sf_dir):
    _, bronze = _raw_and_bronze(spark, sf_dir)
    profile = parquetfiles.parquet_profile(parquetfiles.parquet_footers(listing.list_files(spark, bronze, "*.parquet")))
    checked = completeness.check_layer(profile, completeness.expected_sources(spark, [*FEED.expected, "2024-6.csv"]))
    return completeness.layer_totals(checked).drop("total_size")


@query
def layer_status(spark, sf_dir):
    _, bronze = _raw_and_bronze(spark, sf_dir)
    counts = listing.count_sources(listing.list_files(spark, bronze, "*.parquet"))
    return completeness.layer_status(counts, "bronze").select("component", "status", "sources", "gate_open")


@query
def source_selection(spark, sf_dir):
    """Sources found below the feed folder, in processing order, with and without the held-out one."""
    raw = _raw_files(spark, sf_dir)
    files = listing.list_files(spark, raw, "*.csv")
    chosen = listing.select_sources(files, inputs.MAIN_PATTERN, FEED.held_out)
    main = listing.select_sources(files, inputs.MAIN_PATTERN, FEED.held_out, include_held_out=False)
    place = listing.feed_position(F.col("source_file"), FEED.expected)
    marked = main.select("source_file").distinct().withColumn("in_main", F.lit(True))
    return chosen.select("source_file", place.alias("feed_no")).distinct().join(marked, "source_file", "left").select(
        "feed_no", "source_file", F.coalesce("in_main", F.lit(False)).alias("in_main")
    )


@query
def feed_folder(spark, sf_dir):
    """The folder below the raw folder that holds a whole feed."""
    raw = _raw_files(spark, sf_dir)
    parent = raw.rsplit("/", 1)[0]
    files = listing.list_files(spark, raw, "*.csv")
    found = listing.feed_folders(files, parent)
    return found.select((F.element_at(F.split("feed_folder", "/"), -1) == raw.rsplit("/", 1)[1]).alias("is_the_feed"), "n_sources", "is_root")


@query
def latest_report(spark, sf_dir):
    """Daily report files, the last day written last; the newest one is found by its file time."""
    path = fresh_path(spark, "reports")
    daily = inputs.transactions(spark, sf_dir).groupBy(F.date_format("ts", "yyyyMMdd").alias("day")).agg(
        F.count("*").alias("n")
    )
    named = daily.select(
        F.concat(F.lit("daily_report_"), F.col("day"), F.lit(".txt")).alias("report"),
        F.format_string("Records: %,d", "n").alias("line"),
    )
    newest = daily.agg(F.concat(F.lit("daily_report_"), F.max("day"), F.lit(".txt"))).scalar()
    for part in (F.col("report") != newest, F.col("report") == newest):
        named.where(part).write.mode("append").partitionBy("report").text(path)
    return listing.latest_file(listing.list_files(spark, path, "*.txt"))


@query
def schema_evolution(spark, sf_dir):
    """An older and a newer generation of files under one schema, and what changed."""
    rows = _bronze(spark, sf_dir).select("event_id", "copy", "price", "user_id", "source_file")
    path = fresh_path(spark, "evolving")
    held_out = F.col("source_file") == FEED.held_out
    old = rows.where(~held_out).drop("user_id")
    old.write.parquet(f"{path}/generation=1")
    rows.where(held_out).write.parquet(f"{path}/generation=2")
    merged = parquetfiles.read_evolving(spark, path)
    filled = merged.agg(*[F.count(c).alias(c) for c in rows.columns]).unpivot([], rows.columns, "field", "rows_with_value")
    return parquetfiles.schema_difference(spark, old.schema, rows.schema).join(filled, "field")


# --- Quality and silver ---------------------------------------------------------------


@query
def schema_checks(spark, sf_dir):
    return quality.schema_checks(_bronze(spark, sf_dir))


@query
def silver_clean(spark, sf_dir):
    """The silver table, written by source and read back."""
    path = fresh_path(spark, "silver")
    sinks.write_silver(silver.silver_table(silver.to_silver(_bronze(spark, sf_dir), NARROW_FEED)), path)
    return spark.read.schema(schemas.SILVER).parquet(path).select(
        "transaction_id", _iso("timestamp").alias("timestamp"), "price", "user_id", "source_file", "is_valid", "quality_score"
    )


@query
def invalid_records(spark, sf_dir):
    """Invalid rows written as CSV and counted from the file, per source."""
    path = fresh_path(spark, "invalid")
    bad = silver.invalid_rows(silver.to_silver(_bronze(spark, sf_dir), NARROW_FEED))
    sinks.write_invalid(bad.select("event_id", "copy", "price", "user_id", "source_file"), path)
    back = spark.read.option("header", True).schema(
        "event_id bigint, copy int, price double, user_id string, source_file string"
    ).csv(path)
    return back.select("event_id", "copy", "price", "source_file")


@query
def dedup(spark, sf_dir):
    rows = quality.parsed(_bronze(spark, sf_dir)).select("timestamp", "user_id", "price", "event_id", "copy", "source_file")
    return quality.deduplicate(rows, FILE_ORDER).select("event_id", "copy", "price", "user_id", "source_file", "copies")


@query
def duplicate_report(spark, sf_dir):
    return quality.duplicate_summary(quality.parsed(_bronze(spark, sf_dir)))


def _fill(strategy: str) -> Query:
    def run_fill(spark, sf_dir):
        rows = quality.parsed(_bronze(spark, sf_dir)).select("event_id", "copy", "source_file", "price", "user_id")
        filled = quality.fill_prices(rows, strategy, FILE_ORDER)
        return filled.select(
            "event_id", "copy", "source_file", F.round("filled_price", 6).alias("filled_price"),
            quality.fill_users(F.col("user_id")).alias("user_id"),
        )

    return run_fill


QUERIES["null_fill_median"] = _fill("median")
QUERIES["null_fill_mean"] = _fill("mean")
QUERIES["null_fill_forward"] = _fill("forward_fill")
QUERIES["null_fill_backward"] = _fill("backward_fill")


@query
def null_fill_timestamps(spark, sf_dir):
    rows = quality.parsed(_bronze(spark, sf_dir)).select("event_id", "copy", "source_file", "timestamp")
    filled = quality.fill_timestamps(rows, FILE_ORDER)
    return filled.select("event_id", "copy", "source_file", _iso("filled_timestamp").alias("filled_timestamp"))


@query
def outliers(spark, sf_dir):
    rows = _bronze(spark, sf_dir).select("event_id", "copy", "price")
    return quality.outliers(rows)


@query
def quality_checks(spark, sf_dir):
    return quality.quality_checks(_bronze(spark, sf_dir), NARROW_FEED, tolerances="quality").drop("checked_at")


@query
def quality_checks_silver(spark, sf_dir):
    """The same with the price range and the tolerances of the silver layer."""
    return quality.quality_checks(_bronze(spark, sf_dir), NARROW_FEED, "silver").drop("checked_at")


@query
def quality_gate(spark, sf_dir):
    return quality.quality_gate(quality.quality_checks(_bronze(spark, sf_dir), NARROW_FEED, action="error", tolerances="quality"))


# --- Gold ---------------------------------------------------------------------------


def _gold_columns(df: DataFrame) -> DataFrame:
    return df.select("metric_name", "metric_value", "metric_type", "date_partition", "aggregation_level")


def _gold_query(level: str) -> Query:
    return lambda spark, sf_dir: _gold_columns(gold.price_metrics(inputs.transactions(spark, sf_dir), level, PRICE_SCALE))


for _level in gold.LEVELS:
    QUERIES[f"gold_{_level}"] = _gold_query(_level)


@query
def gold_orders_monthly(spark, sf_dir):
    """All metric types per month over years of orders, written as gold and read back."""
    path = fresh_path(spark, "gold")
    sinks.write_gold(gold.gold_table(inputs.orders(spark, sf_dir), "monthly", PRICE_SCALE), path)
    return _gold_columns(spark.read.schema(schemas.GOLD).parquet(path))


@query
def gold_lineitem_monthly(spark, sf_dir):
    """All metric types per month on the largest table."""
    return _gold_columns(gold.gold_table(inputs.lineitems(spark, sf_dir), "monthly", PRICE_SCALE))


@query
def user_analytics(spark, sf_dir):
    return _gold_columns(gold.user_metrics(inputs.transactions(spark, sf_dir), "daily", PRICE_SCALE))


@query
def temporal_patterns(spark, sf_dir):
    return _gold_columns(gold.temporal_metrics(inputs.transactions(spark, sf_dir), "daily", PRICE_SCALE))


@query
def hourly_prices(spark, sf_dir):
    rows = gold.hourly_prices(inputs.transactions(spark, sf_dir), PRICE_SCALE)
    return rows.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


@query
def gold_refresh(spark, sf_dir):
    """Gold of the main sources, then the periods of the held-out one folded from the totals of both loads."""
    rows = inputs.transactions(spark, sf_dir)
    held_out = F.col("source_file") == FEED.held_out
    path = fresh_path(spark, "gold")
    sinks.fold_gold(rows.where(~held_out), "weekly", path, "main", PRICE_SCALE)
    sinks.fold_gold(rows.where(held_out), "weekly", path, "held-out", PRICE_SCALE)
    return _gold_columns(spark.read.schema(schemas.GOLD).parquet(path))


@query
def hourly_refresh(spark, sf_dir):
    """The hourly level written for the main sources, then refreshed for the days of the held-out one."""
    rows = inputs.transactions(spark, sf_dir)
    held_out = F.col("source_file") == FEED.held_out
    path = fresh_path(spark, "hourly")
    sinks.write_hourly(rows.where(~held_out), path, PRICE_SCALE)
    sinks.refresh_hourly(rows, rows.where(held_out), path, PRICE_SCALE)
    back = spark.read.parquet(path).drop("date_partition")
    return back.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


@query
def gold_rules(spark, sf_dir):
    return quality.gold_rule_checks(gold.gold_table(inputs.orders(spark, sf_dir), "monthly", PRICE_SCALE))


# --- Monitoring ------------------------------------------------------------------------


@query
def price_spikes(spark, sf_dir):
    return monitoring.price_spikes(_history(spark, sf_dir, 20))


@query
def count_anomalies(spark, sf_dir):
    return monitoring.count_anomalies(monitoring.daily_counts(inputs.transactions(spark, sf_dir)))


@query
def retention_split(spark, sf_dir):
    """Orders kept and archived, written by tier and read back."""
    path = fresh_path(spark, "archive")
    rows = inputs.orders(spark, sf_dir).select("event_id", "ts", "price")
    for day in ("2001-08-01", "1999-08-01"):  # the second run leaves the first one's files alone
        as_of = F.lit(day).cast("date")
        sinks.archive(monitoring.with_retention(rows, "silver", F.col("ts"), as_of), path, day)
    return spark.read.schema("event_id bigint, price double, tier string, as_of string").parquet(path)


@query
def retention_move(spark, sf_dir):
    """Expired days moved to the archive by a run that dies after recording the move and is repeated; then a later run."""
    live_path, archive = fresh_path(spark, "live"), fresh_path(spark, "archive")
    rows = inputs.transactions(spark, sf_dir).select("event_id", "price", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    sinks.overwrite_partitions(rows, live_path, ["day"])
    schema = "event_id bigint, price double, day string"

    def move(as_of: str, run: str, **options) -> None:
        retention.move_expired(spark, live_path, archive, schema, "bronze", as_of, run, days=10, **options)

    def dies(step: str) -> None:
        if step == "recorded":
            raise InterruptedError(step)

    try:
        move("2024-01-20", "first", after=dies)
    except InterruptedError:
        pass
    move("2024-01-20", "first")
    move("2024-01-25", "second")
    here = retention.live_rows(spark, live_path, archive, schema, "day").select("event_id", "price", "day", F.lit("live").alias("side"))
    there = retention.archived_rows(spark, archive, schema).select("event_id", "price", "day", F.concat(F.lit("cold "), F.col("run")).alias("side"))
    return here.unionByName(there)


@query
def lineage(spark, sf_dir):
    rows = _bronze(spark, sf_dir)
    raw = rows.groupBy("source_file").agg(F.count("*").alias("rows_in")).withColumn("rows_out", F.col("rows_in"))
    valid = silver.to_silver(rows, NARROW_FEED).groupBy("source_file").agg(
        F.count("*").alias("rows_in"), F.count_if("is_valid").alias("rows_out")
    )
    return monitoring.lineage(raw, "bronze").unionByName(monitoring.lineage(valid, "silver"))


# --- Streams and runs ----------------------------------------------------------------------


def _bronze_part(spark: SparkSession, sf_dir: str, path: str, wanted: Column) -> None:
    rows = inputs.dirty_text(spark, sf_dir).where(wanted)
    sinks.write_bronze(clean.to_bronze(rows), path)


@query
def stream_stats(spark, sf_dir):
    """Bronze streamed into the store, two files per micro-batch; the state is folded from partials."""
    lake = fresh_path(spark, "lake")
    _bronze_part(spark, sf_dir, f"{lake}/bronze", F.lit(True))
    store = ingest.Store(f"{lake}/store", PRICE_SCALE)
    ingest.ingest_available(ingest.bronze_stream(spark, f"{lake}/bronze", max_files=2), store, ingest.MAIN)
    return store.state(spark)


@query
def stream_restart(spark, sf_dir):
    """Half of the sources, a restart with the rest, a restart with nothing new, and a replayed
    batch: every row is counted once."""
    lake = fresh_path(spark, "lake")
    bronze, store = f"{lake}/bronze", ingest.Store(f"{lake}/store", PRICE_SCALE)
    early = F.col("source_file").isin(*FEED.main[:3])
    _bronze_part(spark, sf_dir, bronze, early)
    ingest.ingest_available(ingest.bronze_stream(spark, bronze), store, ingest.MAIN)
    _bronze_part(spark, sf_dir, bronze, ~early)
    for _ in range(2):
        ingest.ingest_available(ingest.bronze_stream(spark, bronze), store, ingest.MAIN)
    ingest.load_batch(parquetfiles.read_bronze(spark, bronze, FEED.main[:3]), 0, store, ingest.MAIN)
    status = ingest.latest_status(store.events(spark))
    done = status.agg(F.bool_and(F.col("status") == "completed").alias("d")).scalar()
    return reconcile.reconcile(store.state(spark), stats.direct_stats(store.transactions(spark), PRICE_SCALE)).withColumn(
        "all_completed", done
    )


@query
def stream_rejects(spark, sf_dir):
    """Rows the store rejected, per source and reason."""
    lake = fresh_path(spark, "lake")
    _bronze_part(spark, sf_dir, f"{lake}/bronze", F.lit(True))
    store = ingest.Store(f"{lake}/store", PRICE_SCALE)
    ingest.ingest_available(ingest.bronze_stream(spark, f"{lake}/bronze"), store, ingest.MAIN)
    return store.rejects(spark).groupBy("source_file", "reject_reason").agg(F.count("*").alias("n_rows"))


@query
def stream_history(spark, sf_dir):
    """Running history and snapshots of a streamed load: one micro-batch of one file each."""
    lake = fresh_path(spark, "lake")
    store = ingest.Store(f"{lake}/store", PRICE_SCALE)
    for source in FEED.expected:  # one load per source, in processing order
        _bronze_part(spark, sf_dir, f"{lake}/bronze", F.col("source_file") == source)
        ingest.ingest_available(ingest.bronze_stream(spark, f"{lake}/bronze"), store, ingest.MAIN)
    history = store.history(spark).select(
        "phase", "ingest_batch", "rows_in", "rows_rejected", "rows_processed", "running_count_before",
        "running_count_after", "running_avg_after",
    )
    status = store.batch_metadata(spark).select("phase", "ingest_batch", "status")
    return history.join(status, ["phase", "ingest_batch"])


@query
def load_speed(spark, sf_dir):
    """Rows per second of a streamed load, and its batch summary; only the counts are repeatable."""
    lake = fresh_path(spark, "lake")
    _bronze_part(spark, sf_dir, f"{lake}/bronze", F.lit(True))
    store = ingest.Store(f"{lake}/store", PRICE_SCALE)
    ingest.ingest_available(ingest.bronze_stream(spark, f"{lake}/bronze"), store, ingest.MAIN)
    speed = ingest.throughput(ingest.latest_status(store.events(spark)))
    return speed.select("rows_processed", (F.col("rows_per_second") > 0).alias("measured"))


@query
def statistics_table(spark, sf_dir):
    """The statistics table after a load."""
    lake = fresh_path(spark, "lake")
    _bronze_part(spark, sf_dir, f"{lake}/bronze", F.lit(True))
    store = ingest.Store(f"{lake}/store", PRICE_SCALE)
    ingest.ingest_available(ingest.bronze_stream(spark, f"{lake}/bronze"), store, ingest.MAIN)
    table = store.statistics(spark)
    return table.select(
        "count", "sum", "min", "max", "avg", (F.col("last_updated") >= F.col("created_at")).alias("dated"), "version"
    )


@query
def two_phase_run(spark, sf_dir):
    """Main sources, then the held-out one on the same state, and what it changed."""
    lake = fresh_path(spark, "lake")
    layout = run.Layout(raw="", lake=lake)
    _bronze_part(spark, sf_dir, layout.bronze, F.lit(True))
    run.load_phase(spark, layout, FEED, ingest.MAIN, PRICE_SCALE)
    store = run.load_phase(spark, layout, FEED, ingest.HELD_OUT_PHASE, PRICE_SCALE)
    return run.phase_drift(spark, store)


@query
def run_steps(spark, sf_dir):
    """A whole run from CSV files to the report, as its step log."""
    layout = run.Layout(raw=_raw_files(spark, sf_dir), lake=fresh_path(spark, "lake"))
    return run.run_all(spark, layout, FEED, PRICE_SCALE).drop("seconds")


@query
def run_report(spark, sf_dir):
    """Text lines of the run report."""
    rows = clean.kept(_bronze(spark, sf_dir))
    files = rows.agg(F.count_distinct("source_file").alias("sources"))
    state = stats.merge_partials(_folds(spark, sf_dir), PRICE_SCALE)
    return report.report_lines(report.report_row(files, stats.report_stats(rows, PRICE_SCALE), state, 1000))


@query
def stream_live_stats(spark, sf_dir):
    """Statistics held in the state store of a streaming aggregate."""
    path = fresh_path(spark, "live")
    _bronze_part(spark, sf_dir, f"{path}/bronze", F.lit(True))
    stream = clean.kept(ingest.bronze_stream(spark, f"{path}/bronze", max_files=2))
    live.run_live(live.live_stats(stream, PRICE_SCALE), f"{path}/state", f"{path}/checkpoint")
    return live.published(spark, f"{path}/state")


def _newest_first(spark: SparkSession, sf_dir: str, path: str, load: Callable[[DataFrame], None]) -> None:
    """The feed with its newest source first, then the others; one file for each micro-batch."""
    reader = live.state_session(spark)
    held_out = F.col("source_file") == FEED.held_out
    for part in (held_out, ~held_out):
        _bronze_part(spark, sf_dir, f"{path}/bronze", part)
        rows = quality.parsed(ingest.bronze_stream(reader, f"{path}/bronze", max_files=1))
        load(rows.withColumnRenamed("timestamp", "ts"))


@query
def stream_daily_prices(spark, sf_dir):
    """Days of event time, folded from micro-batches that arrive newest first."""
    path = fresh_path(spark, "windows")
    _newest_first(spark, sf_dir, path, lambda rows: live.fold_windows(
        clean.kept(rows).where(F.col("ts").isNotNull()), f"{path}/days", f"{path}/checkpoint", PRICE_SCALE))
    return live.daily_windows(spark, f"{path}/days", PRICE_SCALE).select(
        F.date_format("date_partition", "yyyy-MM-dd").alias("day"), "transaction_count", "price_sum", "price_min", "price_max"
    )


@query
def stream_late_rows(spark, sf_dir):
    """Rows per day that arrived more than two days late; they are in the days all the same."""
    path = fresh_path(spark, "late")
    _newest_first(spark, sf_dir, path, lambda rows: live.fold_windows(
        clean.kept(rows).where(F.col("ts").isNotNull()), f"{path}/days", f"{path}/checkpoint", PRICE_SCALE))
    return live.daily_windows(spark, f"{path}/days", PRICE_SCALE).select(
        F.date_format("date_partition", "yyyy-MM-dd").alias("day"), "transaction_count", "late_rows"
    )


@query
def stream_dedup(spark, sf_dir):
    """Copies dropped by the stream, newest source first: rows left per source."""
    path = fresh_path(spark, "unique")
    _newest_first(spark, sf_dir, path, lambda rows: live.fold_unique(
        rows.select("ts", "user_id", "price", "source_file"), f"{path}/rows", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/rows").groupBy("source_file").agg(F.count("*").alias("n_rows"))


@query
def approx_metrics(spark, sf_dir):
    """Stream-friendly median and distinct users, against the exact values."""
    rows = clean.kept(_bronze(spark, sf_dir)).select("price", "user_id")
    near = stats.approximate_metrics(rows)
    users = rows.agg(F.count_distinct("user_id").alias("users")).scalar()
    median = written(quantiles(rows, [], "price", [0.5]), "median").scalar()
    return near.select(
        users.alias("users"), F.round(median, 6).alias("median"),
        (F.abs(F.col("approx_users") - users) <= users * 0.1).alias("users_close"),
        (F.abs(F.col("approx_median") - median) <= median * 0.05).alias("median_close"),
    )


def _store_of_sources(spark: SparkSession, sf_dir: str, after: Callable[[ingest.Store], None] | None = None) -> ingest.Store:
    """A store into which batch n brought source n + 1."""
    store = ingest.Store(fresh_path(spark, "store"), PRICE_SCALE)
    for number, source in enumerate(FEED.expected):
        rows = clean.to_bronze(inputs.dirty_text(spark, sf_dir).where(F.col("source_file") == source))
        ingest.load_batch(rows, number, store, ingest.MAIN)
        if after:
            after(store)
    return store


@query
def compacted_history(spark, sf_dir):
    """History of a store whose partials and events were gathered in segments after each batch."""
    store = _store_of_sources(spark, sf_dir, lambda s: s.compact(spark, fanout=2))
    done = ingest.latest_status(store.events(spark)).select("ingest_batch", "status")
    return store.history(spark).join(done, "ingest_batch").select(
        "ingest_batch", "rows_in", "rows_rejected", "rows_processed", "running_count_after", "running_sum_after", "status"
    )


@query
def batch_sketches(spark, sf_dir):
    """Distinct users and quantiles merged from the sketches of all batches, against the stored rows."""
    store = _store_of_sources(spark, sf_dir)
    sketch = written(store.sketches(spark), "sketches")
    rows = store.transactions(spark).select("price", "user_id")
    names = {"price_5": 0.05, "price_25": 0.25, "price_50": 0.5, "price_75": 0.75, "price_95": 0.95}
    below = {n: F.count_if(F.col("price") <= sketch.select(n).scalar()) / F.count("price") for n in names}
    above = {n: F.count_if(F.col("price") < sketch.select(n).scalar()) / F.count("price") for n in names}
    bound = sketch.select("rank_bound").scalar()
    exact = rows.agg(
        F.count_distinct("user_id").alias("users"), F.count("price").alias("n_prices"),
        *[((above[n] <= q + bound) & (below[n] >= q - bound)).alias(f"{n}_close") for n, q in names.items()],
    )
    near, most = sketch.select("users").scalar(), sketch.select("users_bound").scalar()
    return exact.select(
        "users", "n_prices", (sketch.select("n_prices").scalar() == F.col("n_prices")).alias("all_prices"),
        (F.abs(near - F.col("users")) <= F.col("users") * most).alias("users_close"), *[f"{n}_close" for n in names],
        F.round(most, 6).alias("users_bound"), F.round(bound, 6).alias("rank_bound"),
    )


# --- What goes wrong -----------------------------------------------------------------------


def _wild(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.to_bronze(inputs.wild_text(spark, sf_dir), keep=FILE_ORDER)


@query
def wild_rejects(spark, sf_dir):
    """Infinite and huge prices are rejected with a reason of their own."""
    return clean.rejected(_wild(spark, sf_dir)).select("event_id", "copy", "source_file", "reject_reason")


@query
def wild_counts(spark, sf_dir):
    return clean.clean_counts(_wild(spark, sf_dir))


@query
def wild_stats(spark, sf_dir):
    return stats.direct_stats(clean.kept(_wild(spark, sf_dir)), PRICE_SCALE, ["source_file"])


def _troubled_store(spark: SparkSession, sf_dir: str) -> ingest.Store:
    """A store whose batch 1 failed and was loaded again, whose batch 2 was loaded and failed when
    it was replayed, and whose batch 3 has only failed; batch n is source n + 1."""
    store = ingest.Store(fresh_path(spark, "store"), PRICE_SCALE)

    def load(number: int, broken: bool) -> None:
        rows = clean.to_bronze(inputs.dirty_text(spark, sf_dir).where(F.col("source_file") == FEED.expected[number]))
        if broken:
            rows = rows.withColumn("price", F.when(F.col("price").isNotNull(), F.raise_error(F.lit("broken batch")).cast("double")))
        try:
            ingest.load_batch(rows, number, store, ingest.MAIN)
        except Exception:
            if not broken:
                raise

    for number, broken in ((0, False), (1, True), (1, False), (2, False), (2, True), (3, True), (4, False), (5, False)):
        load(number, broken)
    return store


@query
def batch_status_latest(spark, sf_dir):
    """Batch metadata of a store with failed, recovered and replayed batches."""
    status = ingest.latest_status(_troubled_store(spark, sf_dir).events(spark))
    return status.select(
        "phase", "ingest_batch", "status", "rows_processed", "rows_rejected",
        F.coalesce(F.contains(F.col("error_message"), F.lit("broken batch")), F.lit(False)).alias("says_why"),
    )


@query
def batch_summary(spark, sf_dir):
    return ingest.batch_summary(ingest.latest_status(_troubled_store(spark, sf_dir).events(spark)))


@query
def degradation_flags(spark, sf_dir):
    """Every batch of the troubled store as a run; seconds come from the log and only their sign is compared."""
    store = _troubled_store(spark, sf_dir)
    last = ingest.latest_status(store.events(spark))
    spent = F.timestamp_diff("MICROSECOND", F.col("processing_start"), F.col("processing_end")) / F.lit(1e6)
    runs = last.select(
        F.col("ingest_batch").cast("string").alias("run_id"), F.col("ingest_batch").alias("run_no"),
        (F.coalesce("rows_processed", F.lit(0)) + F.coalesce("rows_rejected", F.lit(0))).alias("rows_in"),
        F.coalesce("rows_rejected", F.lit(0)).alias("rows_rejected"), F.lit(1).alias("batches"),
        (F.col("status") == "failed").cast("int").alias("failed_batches"), spent.alias("seconds"),
    )
    return monitoring.degradation(runs).select(
        "run_id", "failed_share", "reject_share", "processing_failure", "quality_degraded",
        (F.col("rows_per_second") >= 0).alias("timed"),
    )


@query
def reconcile_detects_loss(spark, sf_dir):
    """A stored source that vanishes, and one that is there twice, are seen by the verification."""
    lake = fresh_path(spark, "lake")
    store = ingest.Store(f"{lake}/store", PRICE_SCALE)
    for number, source in enumerate(FEED.expected):
        rows = clean.to_bronze(inputs.dirty_text(spark, sf_dir).where(F.col("source_file") == source))
        ingest.load_batch(rows, number, store, ingest.MAIN)
    whole, state = store.transactions(spark), store.state(spark)
    first = F.col("source_file") == FEED.expected[0]
    sides = {"whole": whole, "lost": whole.where(~first), "doubled": whole.unionByName(whole.where(first))}
    out = None
    for name, rows in sides.items():
        verdict = reconcile.verdict(reconcile.reconcile(state, stats.direct_stats(rows, PRICE_SCALE)))
        verdict = verdict.select(F.lit(name).alias("store"), "overall_match")
        out = verdict if out is None else out.unionByName(verdict)
    return out


def _csv_text(spark: SparkSession, lines: list[str], path: str) -> None:
    """A CSV file with exactly these lines."""
    rows = written(spark.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(x) for x in lines])).alias("value")), "lines")
    rows.coalesce(1).write.mode("overwrite").option("sep", "\x01").option("quote", "").csv(path)


def _raw_bytes(spark: SparkSession, content: bytes, path: str) -> None:
    """A file with exactly these few bytes."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True)
    out.write(bytearray(content))
    out.close()


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_HEADER = "event_id,copy,timestamp,price,user_id"


@query
def header_only_source(spark, sf_dir):
    """A source with a header and no rows is present with none, and the run goes through."""
    raw = _raw_files(spark, sf_dir)
    _csv_text(spark, [_HEADER], f"{raw}/source_file=2024-9.csv")
    feed = replace(FEED, main=(*FEED.main, "2024-9.csv"))
    layout = run.Layout(raw=raw, lake=fresh_path(spark, "lake"))
    steps = written(run.run_all(spark, layout, feed, PRICE_SCALE, publish=False), "steps")
    done = steps.agg(F.bool_and(F.col("status") == "completed")).scalar()
    profile = run.bronze_profile(spark, layout.bronze)
    return profile.select("source_file", "row_count", done.alias("run_completed"))


@query
def source_emptied(spark, sf_dir):
    """A source that is replaced by a file without rows loses its earlier ones, in bronze and in the store."""
    raw = _raw_files(spark, sf_dir)
    layout = run.Layout(raw=raw, lake=fresh_path(spark, "lake"))
    run.run_all(spark, layout, FEED, PRICE_SCALE, publish=False)
    _csv_text(spark, [_HEADER], f"{raw}/source_file={FEED.main[1]}")
    steps = written(run.run_all(spark, layout, FEED, PRICE_SCALE, publish=False), "steps")
    done = steps.agg(F.bool_and(F.col("status") == "completed")).scalar()
    stored = layout.store(PRICE_SCALE).transactions(spark).groupBy("source_file").agg(F.count("*").alias("n_stored"))
    bronze = run.bronze_profile(spark, layout.bronze).select("source_file", F.col("row_count").alias("n_bronze"))
    return bronze.join(stored, "source_file", "left").select(
        "source_file", "n_bronze", F.coalesce("n_stored", F.lit(0)).alias("n_stored"), done.alias("run_completed")
    )


@query
def conversion_results(spark, sf_dir):
    """What became of every source's files, one of which lacks a column."""
    raw = _raw_files(spark, sf_dir)
    _csv_text(spark, ["event_id,copy,timestamp,user_id", "1,0,2024-01-01,user_1"], f"{raw}/source_file=2024-8.csv")
    _raw_bytes(spark, "timestamp,price,user_id,größe\n2024-01-01,1,user_1,2\n".encode("latin-1"), f"{raw}/2024-7.csv")
    _raw_bytes(spark, "timestamp,price,user_id\n2024-01-01,1,Jürgen\n".encode("latin-1"), f"{raw}/2024-6.csv")
    _raw_bytes(spark, b"this is no archive", f"{raw}/2024-5.csv.gz")
    _raw_bytes(spark, b"", f"{raw}/2024-10.csv")
    results = run.convert_to_bronze(spark, raw, fresh_path(spark, "bronze"))
    return results.groupBy("source_file").agg(
        F.bool_and("converted").alias("converted"), F.max(F.regexp_extract("reason", "^[^:]+(: price)?", 0)).alias("reason"),
        F.sum("row_count").alias("row_count"), (F.sum("file_size") >= 0).alias("sized"),
        (F.sum("batches") >= F.ceil(F.sum("row_count") / 1000)).alias("batched"),
    )


@query
def manifest_follows_files(spark, sf_dir):
    """A file that is added to a source, one that is replaced and one that is gone: rows per source
    afterwards, in bronze and in the store, and how many files the second run looked at."""
    raw = _raw_files(spark, sf_dir)
    layout = run.Layout(raw=raw, lake=fresh_path(spark, "lake"))
    run.convert_to_bronze(spark, raw, layout.bronze)
    run.load_phase(spark, layout, FEED, ingest.MAIN, PRICE_SCALE)
    first, second, third = FEED.main[:3]
    _raw_bytes(spark, b"timestamp,price,user_id\n2024-01-01,1.5,user_1\n", f"{raw}/source_file={first}/part-added.csv")
    _csv_text(spark, [_HEADER, "1,0,2024-01-01,2.5,user_1"], f"{raw}/source_file={second}")
    _delete(spark, f"{raw}/source_file={third}")
    looked = written(run.convert_to_bronze(spark, raw, layout.bronze), "looked").agg(F.count("*")).scalar()
    store = run.load_phase(spark, layout, FEED, ingest.MAIN, PRICE_SCALE)
    bronze = parquetfiles.read_bronze(spark, layout.bronze).groupBy("source_file").agg(F.count("*").alias("n_bronze"))
    stored = store.transactions(spark).groupBy("source_file").agg(F.count("*").alias("n_stored"))
    return bronze.join(stored, "source_file", "left").select(
        "source_file", "n_bronze", F.coalesce("n_stored", F.lit(0)).alias("n_stored"), looked.alias("files_looked_at"))


@query
def bronze_layouts(spark, sf_dir):
    """Sources whose files differ in the order of their columns, read in one scan by header name."""
    raw, bronze = fresh_path(spark, "raw"), fresh_path(spark, "bronze")
    columns = ["event_id", "copy", "timestamp", "price", "user_id"]
    layouts = (columns, columns[::-1], ["price", "user_id", "note", "timestamp"])
    rows = inputs.dirty_text(spark, sf_dir).withColumn("note", F.lit("a, b"))
    for k, names in enumerate(layouts):
        mine = F.pmod(listing.feed_position(F.col("source_file"), FEED.expected), F.lit(len(layouts))) == k
        rows.where(mine).select(*names, "source_file").write.mode("append").partitionBy("source_file").option("header", True).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(raw)
    run.convert_to_bronze(spark, raw, bronze)
    return parquetfiles.read_bronze(spark, bronze).select("timestamp", "price", "user_id", "bad_price", "source_file")
