"""Cleaning: lineage, typed projection, reject reasons and null counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import no_nan, not_a_number, null_tokens, to_number
from ledgerlake.functions.texts import iso_text
from ledgerlake.settings import BRONZE_CREATED_BY, MAX_PRICE, RAW_COLUMNS

# Why a row is not loaded.
UNPARSEABLE = "price_not_numeric"
MISSING = "price_null"
NON_POSITIVE = "price_not_positive"
NOT_FINITE = "price_not_finite"
OUT_OF_RANGE = "price_out_of_range"


def absent_columns(df: DataFrame, required: Sequence[str] = RAW_COLUMNS) -> list[str]:
    """Required columns the DataFrame does not have, known without running a job."""
    return [c for c in required if c not in df.columns]


FIRST_VERSION = 0
NO_FILE = 0  # rows that do not come from a file
REPLACED = "\ufffd"  # what readers put where bytes are not UTF-8


def to_bronze(raw: DataFrame, keep: Sequence[str] = (), version: Column | None = None) -> DataFrame:
    """Text rows to typed bronze rows with lineage. One pass, no shuffle, nothing is dropped.

    Columns named in ``keep`` come along; all others are left out. A ``version`` says that
    these rows replace all earlier ones of their source; without one they are added.
    """
    price = F.col("price").cast("string")
    return raw.select(
        null_tokens(F.col("timestamp").cast("string")).alias("timestamp"),
        to_number(price).alias("price"),
        null_tokens(F.col("user_id").cast("string")).alias("user_id"),
        iso_text(F.current_timestamp()).alias("bronze_created_at"),
        F.lit(BRONZE_CREATED_BY).alias("bronze_created_by"),
        F.when(not_a_number(price), price).alias("bad_price"),
        (F.col("file_id") if "file_id" in raw.columns else F.lit(NO_FILE)).cast("bigint").alias("file_id"),
        (F.lit(FIRST_VERSION) if version is None else version).cast("bigint").alias("bronze_version"),
        "source_file",
        *keep,
    )


def is_garbled() -> Column:
    """Whether a bronze row has characters that were not UTF-8; a price that has is kept as text."""
    texts = F.concat_ws("", "timestamp", "user_id", "bad_price")
    return F.contains(texts, F.lit(REPLACED))


def reject_reason(df: DataFrame) -> Column:
    """Why a row is rejected; NULL for a row that is kept."""
    price = no_nan(F.col("price"))
    reason = (
        F.when(price.isNull(), F.lit(MISSING)).when(F.abs(price) == float("inf"), F.lit(NOT_FINITE))
        .when(price <= 0, F.lit(NON_POSITIVE)).when(price > MAX_PRICE, F.lit(OUT_OF_RANGE))
    )
    if "bad_price" in df.columns:
        return F.when(F.col("bad_price").isNotNull(), F.lit(UNPARSEABLE)).otherwise(reason)
    return reason


def judge(df: DataFrame) -> DataFrame:
    """Adds ``reject_reason``. Kept plus rejected rows are always all rows."""
    return df.withColumn("reject_reason", reject_reason(df))


def kept(df: DataFrame) -> DataFrame:
    """Rows that `judge` gives no reason: no NULL, no NaN, above zero, at most ``MAX_PRICE``.

    NaN and infinity are above the upper bound; unlike tests for them, both bounds reach the
    Parquet scan as pushed filters.
    """
    return df.where((F.col("price") > 0) & (F.col("price") <= MAX_PRICE))


def rejected(df: DataFrame) -> DataFrame:
    return judge(df).where(F.col("reject_reason").isNotNull())


def clean_counts(df: DataFrame) -> DataFrame:
    """Rows in, kept and rejected per source and reason, in one pass."""
    reason = F.col("reject_reason")
    return judge(df).groupBy("source_file").agg(
        F.count("*").alias("rows_in"),
        F.count_if(reason.isNull()).alias("rows_kept"),
        F.count_if(reason == MISSING).alias("rejected_null"),
        F.count_if(reason == NON_POSITIVE).alias("rejected_not_positive"),
        F.count_if(reason == UNPARSEABLE).alias("rejected_not_numeric"),
        F.count_if(reason == NOT_FINITE).alias("rejected_not_finite"),
        F.count_if(reason == OUT_OF_RANGE).alias("rejected_out_of_range"),
    )


def to_transactions(df: DataFrame, batch_id: Column) -> DataFrame:
    """Bronze rows to the columns of the transactions table; NULL stays NULL."""
    return df.select(
        F.col("timestamp").cast("string").alias("timestamp"),
        F.col("price").cast("double").alias("price"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("source_file").cast("string").alias("source_file"),
        batch_id.alias("batch_id"),
        F.col("bronze_created_at").cast("string").alias("bronze_created_at"),
        F.current_timestamp().alias("db_inserted_at"),
        F.lit(None).cast("string").alias("processing_metadata"),
        (F.col("bronze_version") if "bronze_version" in df.columns else F.lit(FIRST_VERSION)).cast("bigint").alias("bronze_version"),
        (F.col("file_id") if "file_id" in df.columns else F.lit(NO_FILE)).cast("bigint").alias("file_id"),
        reject_reason(df).alias("reject_reason"),
    )


def null_profile(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Null count and share per column, all columns in one aggregate."""
    counts = df.groupBy(*group).agg(
        F.count("*").alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    long = counts.unpivot([*group, "total_rows"], list(columns), "column_name", "null_count")
    share = F.try_divide(F.col("null_count") * F.lit(100.0), F.col("total_rows"))
    return long.withColumn("null_percent", F.round(share, 6))
