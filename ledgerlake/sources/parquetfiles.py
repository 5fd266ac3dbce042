"""Parquet reading: bronze scans, footers and evolving schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake import schemas
from ledgerlake.functions.texts import size_one_decimal
from ledgerlake.sources.listing import spread
from ledgerlake.sources.manifest import dead_versions, manifest_path
from ledgerlake.sources.remote import FOOTER_SCHEMA, footer_batches
from ledgerlake.workspace import literal_rows, written


def read_bronze(spark: SparkSession, path: str, sources: Sequence[str] | None = None) -> DataFrame:
    """The rows of bronze that count; naming sources prunes partitions.

    What replaced, quarantined and withdrawn files left behind is few pairs of file and version.
    """
    rows = spark.read.schema(schemas.BRONZE).parquet(path)
    dead = written(dead_versions(spark, manifest_path(path)), "dead-versions")
    if not dead.isEmpty():
        rows = rows.join(dead, ["file_id", "bronze_version"], "left_anti").select(*rows.columns)
    return rows.where(F.col("source_file").isin(*sources)) if sources else rows


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """Bronze rows with the file they are stored in and their place in it."""
    return spark.read.schema(schemas.BRONZE).parquet(path).select(
        "*",
        F.col("_metadata.file_path").alias("stored_file"),
        F.col("_metadata.row_index").alias("stored_row"),
    )


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Files of different ages under one schema; columns a file lacks are NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def parquet_footers(files: DataFrame) -> DataFrame:
    """Footer facts per file, without reading data. A file that cannot be read has an ``error``."""
    known = files.select("path", "source_file", "file_size", "modified_at")
    return spread(known).mapInArrow(footer_batches, FOOTER_SCHEMA)


def parquet_profile(footers: DataFrame) -> DataFrame:
    """Footer facts per source."""
    return footers.groupBy("source_file").agg(
        F.count("*").alias("n_files"),
        F.sum("row_count").alias("row_count"),
        F.max("column_count").alias("column_count"),
        F.sum("row_groups").alias("row_groups"),
        F.max("compression").alias("compression"),
        F.sum("file_size").alias("file_size"),
        size_one_decimal(F.sum("file_size")).alias("file_size_formatted"),
        F.max("modified_at").alias("modified_at"),
        F.count_if(F.col("error").isNotNull()).alias("corrupt_files"),
    )


def schema_difference(spark: SparkSession, old: StructType, new: StructType) -> DataFrame:
    """Fields added, removed or changed between two schemas."""
    def fields(schema: StructType) -> DataFrame:
        rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
        return literal_rows(spark, "field string, type string", rows)

    before = fields(old).withColumnRenamed("type", "old_type")
    after = fields(new).withColumnRenamed("type", "new_type")
    kind = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "changed")
        .otherwise("same")
    )
    return before.join(after, "field", "full_outer").select("field", "old_type", "new_type", kind.alias("change"))
