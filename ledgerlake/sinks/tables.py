"""Parquet writers for the layers, the audit table and the files of rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.gold import LEVELS as UNITS
from ledgerlake.operators.gold import gold_of_totals, gold_table, hourly_prices, hourly_totals, period, user_totals
from ledgerlake.workspace import literal_rows, read_if_any, written


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], max_records_per_file: int = 0,
    compression: str = "snappy", row_group_bytes: int = 128 * 1024 * 1024,
) -> None:
    """Write ``df``, replacing exactly the partitions it contains."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.enable.dictionary", True)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def drop_partitions(df_of_names: DataFrame, path: str, column: str) -> None:
    """Removes whole partitions, named by the one column of a small table; reads names only."""
    spark = df_of_names.sparkSession
    for row in df_of_names.toLocalIterator():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={row[0]}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_bronze(bronze: DataFrame, path: str, **options) -> None:
    """One partition per version and source. Tasks write what they read, so nothing is shuffled."""
    overwrite_partitions(bronze, path, ["bronze_version", "source_file"], **options)


def write_silver(silver: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """Partitioned by source. The rebalance hint lets Spark size the files at run time (by
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and split a hot source over tasks."""
    sized = silver.hint("rebalance", "source_file")
    overwrite_partitions(sized, path, ["source_file"], max_records_per_file)


def write_gold(gold: DataFrame, path: str) -> None:
    """Partitioned by metric type and date. Gold is small, so each date becomes one file."""
    overwrite_partitions(
        gold.repartition("metric_type", "date_partition"), path, ["aggregation_level", "metric_type", "date_partition"]
    )


def touched_rows(store: DataFrame, new_rows: DataFrame, level: str) -> DataFrame:
    """The stored rows of the periods that new rows fall into.

    The first and the last touched period bound the scan of the store as a plain range of ``ts``,
    which reaches the Parquet reader; the periods themselves, one row each, decide inside it.
    They are written first, so that the planner sees how few they are.
    """
    touched = written(new_rows.select(period(F.col("ts"), level).alias("_period")).distinct(), "touched")
    unit = UNITS[level]
    ends = touched.agg(F.min("_period").alias("a"), (F.max("_period") + F.expr(f"INTERVAL 1 {unit}")).alias("b")).first()
    if ends["a"] is None:
        return store.limit(0)
    near = store.where((F.col("ts") >= F.lit(ends["a"])) & (F.col("ts") < F.lit(ends["b"])))
    return near.withColumn("_period", period(F.col("ts"), level)).join(touched, "_period", "left_semi").drop("_period")


def refresh_gold(store: DataFrame, new_rows: DataFrame, level: str, path: str, scale: int | None = None) -> None:
    """Rebuild only the periods that new rows touch; all others stay as written."""
    write_gold(gold_table(touched_rows(store, new_rows, level), level, scale), path)


def fold_gold(new_rows: DataFrame, level: str, path: str, load: str, scale: int | None = None) -> None:
    """Gold of the periods that new rows fall into, from totals instead of stored rows.

    Each load leaves its totals per hour and per user beside the table, under its own name: a
    repeated load replaces them. The periods it touches are then folded from the totals of all
    loads, of which only these periods are read. Every row has to come by way of a load.
    """
    spark = new_rows.sparkSession
    totals = {"hours": hourly_totals(new_rows, level, scale), "users": user_totals(new_rows, level, scale)}
    folded = {}
    for name, rows in totals.items():
        table = f"{path.rstrip('/')}_totals/{level}/{name}"
        drop_partitions(literal_rows(spark, "load string", [(load,)]), table, "load")
        dated = rows.withColumn("date_partition", F.coalesce(F.col("date_partition").cast("string"), F.lit("none")))
        overwrite_partitions(dated.withColumn("load", F.lit(load)), table, ["load", "date_partition"])
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "date_partition")
        stored = read_if_any(spark, table, f"{columns}, load string, date_partition string")
        touched = written(stored.where(F.col("load") == load).select("date_partition").distinct(), "touched")
        near = stored.join(touched, "date_partition", "left_semi").drop("load")
        folded[name] = near.withColumn("date_partition", F.when(F.col("date_partition") != "none", F.col("date_partition")).cast("date"))
    write_gold(gold_of_totals(folded["hours"], folded["users"], level, scale), path)


def write_hourly(rows: DataFrame, path: str, scale: int | None = None) -> None:
    """The hourly level of gold, a partition for each day."""
    hourly = hourly_prices(rows, scale).withColumn("date_partition", F.to_date("hour"))
    overwrite_partitions(hourly.repartition("date_partition"), path, ["date_partition"])


def refresh_hourly(store: DataFrame, new_rows: DataFrame, path: str, scale: int | None = None) -> None:
    """Rebuild only the days that new rows touch."""
    write_hourly(touched_rows(store, new_rows, "daily"), path, scale)


def write_invalid(rows: DataFrame, path: str) -> None:
    """Rejected or invalid rows as CSV, for people to look at."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_state(state: DataFrame, path: str) -> None:
    """Statistics as JSON, one row per group or a single one; NULL fields are kept."""
    state.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_audit(audit: DataFrame, path: str) -> None:
    """Audit rows under their run and time; earlier verifications stay."""
    at = F.unix_micros("verification_timestamp")
    overwrite_partitions(audit.withColumn("verified_at", at), path, ["run_id", "verified_at"])


def write_report(report: DataFrame, text: DataFrame, folder: str) -> None:
    """The report as JSON and as text lines, one file each: both are a few rows."""
    report.coalesce(1).write.mode("overwrite").json(f"{folder}/json")
    text.orderBy("line_no").coalesce(1).select("line").write.mode("overwrite").text(f"{folder}/text")


def archive(rows: DataFrame, path: str, as_of: str) -> None:
    """Rows with their ``tier``, a partition for each tier and archive run; earlier runs stay."""
    overwrite_partitions(rows.withColumn("as_of", F.lit(as_of)), path, ["tier", "as_of"])

