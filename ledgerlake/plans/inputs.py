"""How the given tables become transactions.

``events`` is the transaction feed: ``value`` is the price and the 30 days of ``ts`` form six
sources of five days, the last of which is held out. Every view covers the whole table.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.settings import Feed

FEED = Feed(
    main=("2024-1.csv", "2024-2.csv", "2024-3.csv", "2024-4.csv", "2024-5.csv"),
    held_out="validation.csv",
    timestamp_min="2024-01-01",
    timestamp_max="2024-01-30",
)
PRICE_SCALE = 2
LINEITEM_SOURCES = ("a.csv", "n.csv", "r.csv")
# The same feed with a narrower expected range, so that the range rule has something to find.
NARROW_FEED = replace(FEED, timestamp_max="2024-01-28")
MAIN_PATTERN = r"^2024-.*\.csv$"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _source_of(ts: Column) -> Column:
    number = F.call_function("div", F.dayofmonth(ts) - 1, F.lit(5)) + 1
    return F.when(number == 6, F.lit(FEED.held_out)).otherwise(F.concat(F.lit("2024-"), number, F.lit(".csv")))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean feed: event_id, ts, price, user_id, source_file."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("value").alias("price"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("user_id"),
        _source_of(F.col("ts")).alias("source_file"),
    )


def _nth(every: int) -> Column:
    return F.pmod(F.col("event_id"), F.lit(every)) == 0


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a careless producer would send it: text columns, all rows kept.

    Some prices are missing, not numeric, negative or 100 times too high; some timestamps
    are no timestamps; some users are written differently or missing; some rows come twice
    (``copy`` 1).
    """
    value = F.col("value")
    price = (
        F.when(_nth(97), F.lit("NA"))
        .when(_nth(193), F.lit("abc"))
        .when(_nth(89), (-value).cast("string"))
        .when(_nth(101), F.round(value * 100, 2).cast("string"))
        .otherwise(value.cast("string"))
    )
    stamp = (
        F.when(_nth(127), F.lit("not a time"))
        .when(_nth(2), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    )
    number = F.col("user_id").cast("string")
    variant = F.pmod(F.call_function("div", F.col("event_id"), F.lit(83)), F.lit(4))
    user = (
        F.when(~_nth(83), F.concat(F.lit("user_"), number))
        .when(variant == 0, F.concat(F.lit("USER_"), number))
        .when(variant == 1, F.concat(F.lit(" user_"), number, F.lit(" ")))
        .when(variant == 2, number)
        .otherwise(F.lit("null"))
    )
    copies = F.when(_nth(50), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return table(spark, sf_dir, "events").select(
        "event_id", F.explode(copies).alias("copy"), stamp.alias("timestamp"), price.alias("price"),
        user.alias("user_id"), _source_of(F.col("ts")).alias("source_file"),
    )


def wild_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The careless feed with infinite and huge prices on top; all rows kept."""
    price = (
        F.when(_nth(307), F.lit("Infinity")).when(_nth(311), F.lit("-Infinity")).when(_nth(313), F.lit("1e17"))
        .otherwise(F.col("price"))
    )
    return dirty_text(spark, sf_dir).withColumn("price", price)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second feed, over years: one transaction per order, one source per year."""
    year = F.year("o_orderdate").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("price"), F.concat(F.lit("user_"), F.col("o_custkey")).alias("user_id"),
        F.concat(year, F.lit(".csv")).alias("source_file"),
    )


def lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third and largest feed: one transaction per order line, one source per return flag."""
    return table(spark, sf_dir, "lineitem").select(*_lineitem_columns())


def numbered_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the place of a line in its file, so that an order by it never ties."""
    return table(spark, sf_dir, "lineitem").select(
        *_lineitem_columns(), F.xxhash64("_metadata.file_path").alias("row_file"),
        F.col("_metadata.row_index").alias("row_no"),
    )


def _lineitem_columns() -> list[Column]:
    return [
        F.col("l_orderkey").alias("event_id"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("seller"),
        F.col("l_shipdate").alias("ts"), F.col("l_extendedprice").alias("price"),
        F.concat(F.lit("user_"), F.col("l_suppkey")).alias("user_id"),
        F.concat(F.lower("l_returnflag"), F.lit(".csv")).alias("source_file"),
    ]
