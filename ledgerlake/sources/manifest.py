"""The change record of raw files: what became of each one, a row for each file and version.

Bronze is only ever added to: a conversion writes a version of its own and then commits it here.
A row of bronze counts if its version is the newest one of its file and was converted; rows of a
version that was never committed, of a quarantined file or of a file that is gone do not. So a
conversion that dies in between leaves nothing that anyone reads, and a file is replaced or
withdrawn without touching what was written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.sinks.tables import overwrite_partitions
from ledgerlake.workspace import read_if_any, written

CONVERTED, QUARANTINED, WITHDRAWN = "converted", "quarantined", "withdrawn"


def manifest_path(bronze: str) -> str:
    return f"{bronze.rstrip('/')}_manifest"


def history(spark: SparkSession, path: str) -> DataFrame:
    """Every committed version of every file."""
    return read_if_any(spark, path, schemas.MANIFEST)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of each file."""
    rows = history(spark, path)
    newest = F.max_by(F.struct(*rows.columns), "version")
    return rows.groupBy("file_id").agg(newest.alias("r")).select("r.*")


def dead_versions(spark: SparkSession, path: str) -> DataFrame:
    """Pairs (file_id, bronze_version) whose rows no longer count; few where few files change."""
    newest = current(spark, path).select("file_id", F.col("version").alias("_newest"), F.col("state").alias("_state"))
    replaced = (F.col("version") < F.col("_newest")) | (F.col("_state") != CONVERTED)
    return history(spark, path).join(newest, "file_id").where(replaced).select("file_id", F.col("version").alias("bronze_version"))


def commit(rows: DataFrame, path: str) -> None:
    """Adds the rows of one version; a repeated commit replaces itself."""
    overwrite_partitions(rows, path, ["version"])


def changes(spark: SparkSession, path: str, files: DataFrame, sources: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Of a listing with ``file_id``: the files to convert, and the manifest rows of those that are gone.

    New and changed files are converted, and those that could not be last time are looked at
    again. ``sources`` says which ones the listing covers; others are not taken for gone.
    """
    known = written(current(spark, path), "manifest")
    print_of = ["file_id", "file_size", "modified_at"]
    todo = files.join(known.where(F.col("state") == CONVERTED).select(*print_of), print_of, "left_anti")
    covered = known.where(F.col("source_file").isin(*sources)) if sources else known
    gone = covered.where(F.col("state") != WITHDRAWN).join(files.select("file_id"), "file_id", "left_anti")
    return written(todo, "changed"), written(gone, "gone")
