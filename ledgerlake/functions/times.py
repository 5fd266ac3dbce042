"""Timestamp parsing and range tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.settings import TIMESTAMP_FORMATS


_STARTS_WITH_DAY = r"^\d{4}-\d{1,2}-\d{1,2}([ T]|$)"


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """ISO 8601 with ``T`` or a blank, else the first format that fits; NULL when none does.

    ISO text goes through the cast, which reads no pattern and raises nothing for a misfit;
    the test in front keeps out bare years and times, which the cast would complete.
    """
    others = F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])
    return F.when(text.rlike(_STARTS_WITH_DAY), text.try_cast("timestamp")).otherwise(others)


def within_days(at: Column, first_day: str, last_day: str) -> Column:
    """True inside the range, the whole last day included."""
    return (at >= F.lit(first_day).cast("timestamp")) & (
        at < F.date_add(F.lit(last_day).cast("date"), 1).cast("timestamp")
    )
