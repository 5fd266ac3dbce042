"""Table schemas of every layer, as the DDL text that readers and tables take."""

from __future__ import annotations

RAW = "timestamp string, price string, user_id string"

# `bad_price` keeps the text of a price that is present but not a number, so that a later
# step can tell it from a missing one.
# `file_id` is the raw file; `bronze_version` grows with every conversion, and the newest one of a
# file counts. Rows that are only ever added share one version. The last two are partition columns.
BRONZE = (
    "timestamp string, price double, user_id string, bronze_created_at string, "
    "bronze_created_by string, bad_price string, file_id bigint, bronze_version bigint, source_file string"
)

# What became of a raw file, a row for each file and version. States: converted, quarantined, withdrawn.
MANIFEST = (
    "path string, file_id bigint, source_file string, file_name string, file_size bigint, modified_at timestamp, "
    "state string, reason string, row_count bigint, batches bigint, version bigint"
)

TRANSACTIONS = (
    "timestamp string, price double, user_id string, source_file string, batch_id string, "
    "bronze_created_at string, db_inserted_at timestamp, processing_metadata string, "
    "bronze_version bigint, file_id bigint, reject_reason string, outcome string, phase string, ingest_batch bigint"
)

BATCH_EVENTS = (
    "batch_id string, event_no int, rows_processed bigint, rows_rejected bigint, "
    "event_time timestamp, error_message string, phase string, ingest_batch bigint, attempt int, status string"
)


def batch_partials(scale: int | None) -> str:
    """Sums are kept so that folding them never rounds."""
    money = "double" if scale is None else f"decimal(38,{scale})"
    return (
        f"source_file string, file_id bigint, bronze_version bigint, rows_in bigint, rows_rejected bigint, count bigint, sum {money}, "
        "min double, max double, users binary, prices binary, phase string, ingest_batch bigint"
    )


STATS_VERIFICATION = (
    "run_id string, verification_timestamp timestamp, incremental_stats string, "
    "database_stats string, comparison_result string, verification_passed int, notes string, verified_at bigint"
)

STATISTICS = (
    "count bigint, sum double, min double, max double, avg double, "
    "created_at timestamp, last_updated timestamp, version string"
)

QUALITY_CHECKS = (
    "batch_id string, check_type string, check_result string, details string, "
    "checked_at timestamp"
)

SILVER = (
    "transaction_id string, timestamp timestamp, price double, user_id string, "
    "source_file string, is_valid boolean, quality_score double, "
    "silver_created_at timestamp, silver_updated_at timestamp"
)

GOLD = (
    "metric_name string, metric_value double, metric_type string, date_partition date, "
    "aggregation_level string, gold_created_at timestamp"
)

STATE_JSON = "count bigint, sum double, min double, max double, avg double"


def create_table_sql(name: str, columns: str, location: str, partitions: tuple[str, ...] = ()) -> str:
    """The statement that registers written Parquet files as a table."""
    parted = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET{parted} LOCATION '{location}'"
