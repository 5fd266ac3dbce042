"""File listings as DataFrames. Only file-system metadata is read, never file contents."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.texts import date_in_name, source_name, stem
from ledgerlake.sources.remote import LISTING_SCHEMA, READABLE, listing_batches
from ledgerlake.workspace import written

FOLDERS_PER_TASK = 16


def _qualified(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _by_reader(spark: SparkSession, folder: str) -> DataFrame:
    """The listing that Spark's own reader makes on the driver; it leaves out files without a byte."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(
        "path", F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at")
    )


def _by_tasks(spark: SparkSession, root: str) -> DataFrame:
    """The files below a folder: its own entries first, then every subfolder as a whole, dealt out to tasks."""
    top = written(literal_paths(spark, [root]).mapInArrow(listing_batches(False), LISTING_SCHEMA), "top")
    below = spread(top.where("is_folder").select("path"), FOLDERS_PER_TASK).mapInArrow(listing_batches(True), LISTING_SCHEMA)
    return top.where("NOT is_folder").unionByName(below).drop("is_folder")


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """One row per file below ``folder``: path, folder, file_name, source_file, size, time.

    Files are listed through the file system, in tasks, and without opening any. A store that
    only Spark's readers know is listed by them.
    """
    root = _qualified(spark, folder)
    files = _by_tasks(spark, root) if root.partition(":")[0] in READABLE else _by_reader(spark, folder)
    pattern = "^" + re.sub(r"\\\*", "[^/]*", re.sub(r"\\\?", "[^/]", re.escape(glob))) + "$"
    files = files.where(F.regexp_extract("path", r"([^/]+)$", 1).rlike(pattern))
    source = source_name(F.col("path"))
    return files.select(
        "path",
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        source.alias("source_file"),
        stem(source).alias("file_stem"),
        "file_size",
        "modified_at",
    )


def literal_paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A bounded number of paths as a table, made of one literal in the JVM."""
    listed = F.from_json(F.lit(json.dumps(list(paths))), "array<string>")
    return spark.range(0, 1, 1, 1).select(F.explode(listed).alias("path"))


def spread(files: DataFrame, per_task: int = 64) -> DataFrame:
    """A listing dealt out so that a task opens about ``per_task`` files."""
    return files.repartition(max(1, -(-files.count() // per_task)))


def feed_folders(files: DataFrame, raw_folder: str, min_files: int = 5) -> DataFrame:
    """Folders that hold a whole feed: at least ``min_files`` CSV sources.

    Visible subfolders come first, the raw folder itself last; take the first row.
    """
    root = raw_folder.rstrip("/")
    name = F.regexp_extract("feed_folder", r"([^/]+)$", 1)
    is_part = F.col("file_name").rlike("^part-")
    parent = F.when(is_part, F.regexp_extract("folder", r"^(.*)/[^/]+$", 1)).otherwise(F.col("folder"))
    return (
        files.withColumn("feed_folder", parent)
        .groupBy("feed_folder")
        .agg(F.countDistinct("source_file").alias("n_sources"))
        .where((F.col("n_sources") >= min_files) & ~name.startswith("."))
        .withColumn("is_root", F.col("feed_folder").endswith(root.split(":")[-1]))
        .orderBy("is_root", "feed_folder")
    )


def feed_position(source_file: Column, expected: Sequence[str]) -> Column:
    """Place of a source in the fixed processing order; sources not named come after."""
    place = F.array_position(F.array(*[F.lit(s) for s in expected]), source_file)
    return F.when(place > 0, place.cast("int")).otherwise(F.lit(len(expected) + 1))


def select_sources(files: DataFrame, pattern: str, held_out: str, include_held_out: bool = True) -> DataFrame:
    """Files of the sources whose name fits ``pattern`` (a regex), plus the held-out one."""
    is_held_out = F.col("source_file") == held_out
    wanted = F.col("source_file").rlike(pattern) & ~is_held_out
    return files.where((wanted | is_held_out) if include_held_out else wanted)


def count_sources(files: DataFrame) -> DataFrame:
    """How many files and sources a layer holds."""
    return files.agg(
        F.countDistinct("source_file").alias("sources"),
        F.count("*").alias("files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
    )


def latest_file(files: DataFrame, prefix: str = "daily_report_") -> DataFrame:
    """The newest report and the date in its name."""
    newest = F.max_by(F.col("source_file"), F.struct("modified_at", "source_file"))
    return files.where(F.col("source_file").startswith(prefix)).agg(newest.alias("report")).select(
        "report", date_in_name(F.col("report"), prefix).alias("report_date")
    )
