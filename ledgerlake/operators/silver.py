"""Silver rows: parsed, standardised, scored and identified."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.texts import iso_text
from ledgerlake.operators.quality import deduplicate, full_key, parsed, rules
from ledgerlake.settings import Feed


def to_silver(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Bronze to silver, row by row: no shuffle. Invalid rows stay, marked as such.

    The identifier is a hash of what identifies a transaction, so it is the same in every run.
    Where a part of that is missing or unreadable, the text as it came in counts too.
    """
    raw = [F.coalesce(F.col(c), F.lit("")).alias(f"_raw_{c}") for c in ("timestamp", "user_id", "bad_price") if c in bronze.columns]
    rows = parsed(bronze.select("*", *raw))
    flags = list(rules(feed, "silver").values())
    identity = F.concat_ws(
        "|", F.coalesce(iso_text(F.col("timestamp")), F.lit("")), F.coalesce("user_id", F.lit("")),
        F.coalesce(F.col("price").cast("string"), F.lit("")), "source_file",
    )
    texts = [c for c in rows.columns if c.startswith("_raw_")]
    identity = F.when(full_key(), identity).otherwise(F.concat_ws("|", identity, *texts))
    score = reduce(lambda a, b: a + b, [f.cast("int") for f in flags]) / F.lit(float(len(flags)))
    valid = reduce(lambda a, b: a & b, flags)
    return rows.withColumns(
        {
            "transaction_id": F.md5(identity), "is_valid": valid, "quality_score": score,
            "silver_created_at": F.current_timestamp(), "silver_updated_at": F.current_timestamp(),
        }
    ).drop(*texts)


def silver_table(silver: DataFrame) -> DataFrame:
    """The silver schema, one row per transaction, whatever number of copies came in."""
    columns = (
        "transaction_id", "timestamp", "price", "user_id", "source_file", "is_valid", "quality_score",
        "silver_created_at", "silver_updated_at",
    )
    return deduplicate(silver.select(*columns), ["transaction_id"], ["timestamp", "user_id", "price", "source_file"]).select(
        *columns
    )


def invalid_rows(silver: DataFrame) -> DataFrame:
    """Rows that break a rule, for the file of invalid records."""
    return silver.where(~F.col("is_valid"))
