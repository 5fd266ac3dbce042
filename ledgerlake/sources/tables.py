"""The relational store: registered views, SQL text and, optionally, a JDBC table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerlake import schemas


def query_store(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run a SQL text over named DataFrames: ``query_store(spark, "... {transactions}", transactions=df)``."""
    return spark.sql(sql, **tables)


def read_state(spark: SparkSession, path: str, group: Sequence[str] = ()) -> DataFrame:
    """Statistics written as JSON, with the text columns that group them."""
    keys = "".join(f"{name} string, " for name in group)
    return spark.read.schema(keys + schemas.STATE_JSON).json(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A table of an external database, read in parallel ranges; the driver jar is the user's."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )
