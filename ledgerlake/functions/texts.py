"""Text columns: names, identifiers, sizes and formatted statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names and text formats.
_UNITS = ("B", "KB", "MB", "GB", "TB")
BATCH_STAMP = "yyyyMMdd_HHmmss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def source_name(path: Column) -> Column:
    """The source a file belongs to: its own name, or the folder name for a part file.

    ``raw/2012-1.csv`` and ``raw/2012-1.csv/part-00000-x.csv`` are both ``2012-1.csv``; so is what
    lies anywhere below a partition ``source_file=2012-1.csv``.
    """
    partition = F.regexp_extract(path, r"/source_file=([^/]+)/", 1)
    part = path.rlike(r"/part-[^/]+$")
    folder = F.regexp_extract(path, r"([^/=]+)/part-[^/]+$", 1)
    return F.when(partition != "", F.url_decode(partition)).when(part, F.url_decode(folder)).otherwise(F.regexp_extract(path, r"([^/]+)$", 1))


def stem(name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(F.regexp_extract(name, r"([^/]+)$", 1), r"\.[^.]+$", "")


def stamped_batch_id(source_file: Column, batch_number: Column, at: Column) -> Column:
    """``{stem}_batch_{number, at least 4 digits}_{time}``."""
    return F.concat_ws(
        "_", stem(source_file), F.lit("batch"), F.format_string("%04d", batch_number),
        F.date_format(at, BATCH_STAMP),
    )


def batch_key(source_file: Column, batch_number: Column) -> Column:
    """Identifier that is the same every time the batch is loaded."""
    return F.md5(F.concat_ws("/", source_file, batch_number.cast("string")))


def size_one_decimal(size: Column) -> Column:
    """``1.5 KB``: one decimal, bytes to terabytes, ties to the even digit."""
    value = size.cast("double")
    out = F.when(value < 1024.0, F.format_string("%.1f B", value))
    for power, unit in list(enumerate(_UNITS))[1:-1]:
        shown = F.format_string(f"%.1f {unit}", F.bround(value / F.lit(1024.0**power), 1))
        out = out.when(value < F.lit(1024.0 ** (power + 1)), shown)
    return out.otherwise(F.format_string(f"%.1f {_UNITS[-1]}", F.bround(value / F.lit(1024.0**4), 1)))


def size_two_decimals(size: Column) -> Column:
    """``1.46 KB``: up to two decimals, ``0 B`` for zero, largest unit kept for huge sizes."""
    value = size.cast("double")
    out = F.when(value == 0, F.lit("0 B"))
    for power, unit in enumerate(_UNITS):
        shown = F.bround(value / F.lit(1024.0**power), 2).cast("string")
        named = F.concat(shown, F.lit(f" {unit}"))
        if unit == _UNITS[-1]:
            return out.otherwise(named)
        out = out.when(value < F.lit(1024.0 ** (power + 1)), named)
    return out


def iso_text(at: Column) -> Column:
    return F.date_format(at, ISO_MICROS)


def date_in_name(name: Column, prefix: str = "daily_report_") -> Column:
    return F.regexp_extract(stem(name), f"^{prefix}(.*)$", 1)


# Fixed formats: the two texts of the running statistics.


def stats_line(count: Column, avg: Column, low: Column, high: Column, precision: int = 2) -> Column:
    """One-line summary of the running statistics."""
    money = f"$%.{precision}f"
    return F.when(count == 0, F.lit("Count: 0, Stats: N/A")).otherwise(
        F.format_string(f"Count: %,d, Avg: {money}, Min: {money}, Max: {money}", count, avg, low, high)
    )


def stats_block(
    count: Column, total: Column, avg: Column, low: Column, high: Column, batches: Column,
    updated_at: Column | None = None, created_at: Column | None = None,
) -> Column:
    """Several lines for reports; with the times of the state where they are given."""
    lines = F.format_string(
        "Records: %,d\nTotal: $%,.2f\nAverage: $%.2f\nMinimum: $%.2f\nMaximum: $%.2f\nBatches: %d",
        count, total, avg, low, high, batches,
    )
    for name, at in (("Last update", updated_at), ("Created", created_at)):
        if at is not None:
            lines = F.concat(lines, F.lit(f"\n{name}: "), F.coalesce(iso_text(at), F.lit("never")))
    return F.when(count == 0, F.lit("No data processed")).otherwise(lines)


def null_safe_json(struct: Column) -> Column:
    """JSON text that keeps NULL fields."""
    return F.to_json(struct, {"ignoreNullFields": "false"})
