"""CSV reading by header name, and CSV profiles."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake import schemas
from ledgerlake.functions.texts import size_two_decimals, source_name
from ledgerlake.settings import RAW_COLUMNS
from ledgerlake.sources.listing import spread
from ledgerlake.sources.remote import HEADER_SCHEMA, header_batches
from ledgerlake.workspace import literal_rows, written


FILES_PER_SCAN = 10_000
LAYOUTS_PER_SCAN = 16
_GLOB_SIGNS = re.compile(r"([*?{}\[\]\\])")


def csv_headers(files: DataFrame) -> DataFrame:
    """Header of every file of a listing: (path, source_file, columns, error). Reads first lines only,
    compressed files as a whole. A file that cannot be read has an error and no columns."""
    return spread(files.select("path", "source_file")).mapInArrow(header_batches, HEADER_SCHEMA)


def missing_columns(headers: DataFrame, required: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Adds the required columns that a file does not have; all of them if it cannot be read."""
    wanted = F.array(*[F.lit(c) for c in required])
    return headers.withColumn("missing_columns", F.coalesce(F.array_except(wanted, F.col("columns")), wanted))


def inspected(files: DataFrame, required: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """A listing with ``places``, where each required column stands, or the ``reason`` why a file is not usable."""
    headers = missing_columns(csv_headers(files), required)
    lacking = F.concat(F.lit("missing columns: "), F.array_join("missing_columns", ", "))
    reason = F.when(F.col("error").isNotNull(), F.col("error")).when(F.size("missing_columns") > 0, lacking)
    places = F.array(*[(F.array_position("columns", F.lit(c)) - 1).cast("int") for c in required])
    return files.join(headers.select("path", reason.alias("reason"), F.when(reason.isNull(), places).alias("places")), "path")


def _plain_path(file_path: Column) -> Column:
    """The path as a listing has it; the reader gives it as an encoded URI."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def file_id(path: Column) -> Column:
    """Identifies a file by its path."""
    return F.xxhash64(path)


def read_csv_layout(
    spark: SparkSession, paths: Sequence[str], places: Sequence[int], required: Sequence[str] = RAW_COLUMNS, multi_line: bool = False
) -> DataFrame:
    """Exactly these files, whose required columns all stand at the same places, as text columns.

    No other file is listed or opened, and what a row belongs to comes from its path, so nothing
    is joined. The scan is as wide as the last place that is needed, whatever else files hold.
    """
    cells = [f"c{i}" for i in range(max(places) + 1)]
    rows = (
        spark.read.schema(StructType([StructField(c, StringType()) for c in cells]))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv([_GLOB_SIGNS.sub(r"\\\1", p) for p in paths])
    )
    path = _plain_path(F.col("_metadata.file_path"))
    return rows.select(
        *[F.col(f"c{place}").alias(name) for name, place in zip(required, places)],
        source_name(path).alias("source_file"), file_id(path).alias("file_id"),
    )


def layout_scans(
    spark: SparkSession, usable: DataFrame, required: Sequence[str] = RAW_COLUMNS, multi_line: bool = False,
    files_per_scan: int = FILES_PER_SCAN,
) -> Iterator[tuple[list[str], DataFrame]]:
    """The usable files of `inspected` in portions: their paths, and their rows.

    The driver holds the paths of one portion at a time, at most ``files_per_scan``. Files with
    the same places are one scan; a portion unites a few of them.
    """

    def portion(found: dict[tuple, list[str]]) -> tuple[list[str], DataFrame]:
        scans = [read_csv_layout(spark, paths, places, required, multi_line) for places, paths in found.items()]
        return [p for paths in found.values() for p in paths], reduce(DataFrame.unionByName, scans)

    found: dict[tuple, list[str]] = {}
    for row in usable.select("places", "path").orderBy("places", "path").toLocalIterator():
        places = tuple(row["places"])
        if sum(map(len, found.values())) >= files_per_scan or (places not in found and len(found) >= LAYOUTS_PER_SCAN):
            yield portion(found)
            found = {}
        found.setdefault(places, []).append(row["path"])
    if found:
        yield portion(found)


def read_csv_by_name(
    spark: SparkSession, files: DataFrame, required: Sequence[str] = RAW_COLUMNS, multi_line: bool = False
) -> DataFrame:
    """The usable CSV files of a listing as text columns, mapped by header **name**.

    Files that cannot be read or lack a required column are left out; `inspected` lists them.
    Quoted line breaks need ``multi_line``, which makes a file unsplittable.
    """
    usable = written(inspected(files, required), "headers").where(F.col("reason").isNull())
    scans = [rows for _, rows in layout_scans(spark, usable, required, multi_line)]
    if not scans:
        return literal_rows(spark, ", ".join(f"{c} string" for c in (*required, "source_file")) + ", file_id bigint", [])
    return reduce(DataFrame.unionByName, scans)


def stream_csv(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """CSV files as a stream of text rows. A file with another header order stops the stream."""
    reader = (
        spark.readStream.schema(schemas.RAW)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(folder)
    return rows.select("*", source_name(F.col("_metadata.file_path")).alias("source_file"))


def line_counts(spark: SparkSession, folder: str, glob: str = "*.csv*") -> DataFrame:
    """Lines less the header, per source. Quoted line breaks are counted, as in a plain line count."""
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(folder)
        .select(F.col("_metadata.file_path").alias("path"))
        .groupBy("path")
        .agg(F.count("*").alias("n_lines"))
    )
    return lines.groupBy(source_name(F.col("path")).alias("source_file")).agg(
        F.sum(F.col("n_lines") - 1).alias("line_rows")
    )


def csv_profile(files: DataFrame, headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Existence, size, columns and row count per source."""
    sizes = files.groupBy("source_file").agg(
        F.sum("file_size").alias("file_size"), F.count("*").alias("n_files")
    )
    layout = missing_columns(headers).groupBy("source_file").agg(
        F.first("columns").alias("columns"),
        F.max(F.size("missing_columns")).alias("n_missing"),
        F.countDistinct("columns").alias("n_layouts"),
    )
    return (
        sizes.join(layout, "source_file", "left")
        .join(lines, "source_file", "left")
        .select(
            "source_file", "n_files", "file_size",
            size_two_decimals(F.col("file_size")).alias("file_size_formatted"),
            "columns", "n_layouts", F.coalesce("line_rows", F.lit(0)).alias("row_count"),
            (F.col("n_missing") == 0).alias("valid"),
        )
    )


def csv_sample(rows: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """First ``n`` rows per source.

    Spark limits the groups before the shuffle, so a source of any size sends at most ``n``
    rows per task to the final ranking.
    """
    first = Window.partitionBy("source_file").orderBy(*order)
    return rows.withColumn("sample_no", F.row_number().over(first)).where(F.col("sample_no") <= n)
