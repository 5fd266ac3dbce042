import datetime as dt

from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import gold, monitoring
from ledgerlake.operators.quality import gold_rule_checks
from ledgerlake.sinks import tables


def feed(spark, rows):
    return spark.createDataFrame(rows, "t string, price double, user_id string").withColumn("ts", F.col("t").cast("timestamp"))


ROWS = [("2024-01-01 10:00:00", 2.0, "u1"), ("2024-01-01 10:30:00", 4.0, "u2"), ("2024-01-07 23:00:00", 6.0, "u1"),
        ("2024-01-08 00:00:00", 8.0, "u1"), ("2024-02-01 00:00:00", 10.0, None)]


def values(df):
    return {(r["metric_name"], str(r["date_partition"])): r["metric_value"] for r in df.collect()}


def test_periods_start_where_calendars_do(spark):
    weekly = values(gold.price_metrics(feed(spark, ROWS), "weekly", 2))
    assert weekly["transaction_count", "2024-01-01"] == 3.0  # Monday to Sunday
    assert weekly["price_avg", "2024-01-01"] == 4.0
    assert weekly["transaction_count", "2024-01-08"] == 1.0
    monthly = values(gold.price_metrics(feed(spark, ROWS), "monthly", 2))
    assert monthly["price_sum", "2024-01-01"] == 20.0 and monthly["price_max", "2024-02-01"] == 10.0


def test_users_and_patterns(spark):
    users = values(gold.user_metrics(feed(spark, ROWS), "monthly", 2))
    assert users["unique_users", "2024-01-01"] == 2.0 and users["spend_per_user", "2024-01-01"] == 10.0
    assert users["unique_users", "2024-02-01"] == 0.0 and users["spend_per_user", "2024-02-01"] is None
    patterns = values(gold.temporal_metrics(feed(spark, ROWS), "monthly", 2))
    assert patterns["hour_10_count", "2024-01-01"] == 2.0 and patterns["weekday_07_avg_price", "2024-01-01"] == 6.0


def test_refresh_rebuilds_touched_periods_only(spark, tmp_path):
    path = str(tmp_path / "gold")
    rows = feed(spark, ROWS)
    tables.write_gold(gold.gold_table(rows, "daily", 2), path)
    read = lambda: spark.read.schema(schemas.GOLD).parquet(path)
    stamp = read().where("date_partition = '2024-02-01'").agg(F.max("gold_created_at")).first()[0]
    new = feed(spark, [("2024-01-01 11:00:00", 12.0, "u3")])
    tables.refresh_gold(rows.unionByName(new), new, "daily", path, 2)
    got = values(read().where("metric_type = 'price_statistics'"))
    assert got["price_avg", "2024-01-01"] == 6.0 and got["price_avg", "2024-02-01"] == 10.0
    assert read().where("date_partition = '2024-02-01'").agg(F.max("gold_created_at")).first()[0] == stamp
    checks = gold_rule_checks(read())
    assert checks.agg(F.sum("duplicates")).first()[0] == 0


def test_folded_loads_equal_gold_of_all_rows(spark, tmp_path):
    """Late rows, a repeated load that has changed, rows without time: always the gold of what was loaded, without any stored row."""
    path, whole = str(tmp_path / "gold"), str(tmp_path / "whole")
    loads = {"a": ROWS, "b": [("2024-01-02 11:00:00", 1.5, "u9"), ("2024-02-01 05:00:00", 2.25, "u1"), (None, 3.0, "u1")], "c": [("2024-01-07 09:00:00", 4.5, "u2")]}

    def look(at):
        return sorted(map(str, spark.read.schema(schemas.GOLD).parquet(at).drop("gold_created_at").collect()))

    for level in ("daily", "weekly"):
        for name, rows in loads.items():
            tables.fold_gold(feed(spark, rows), level, path, name, 2)
        tables.write_gold(gold.gold_table(feed(spark, sum(loads.values(), [])), level, 2), whole)
    assert look(path) == look(whole)
    again = [*loads["c"], ("2024-01-07 10:00:00", 7.0, None)]
    for level in ("daily", "weekly"):
        tables.fold_gold(feed(spark, again), level, path, "c", 2)
        tables.write_gold(gold.gold_table(feed(spark, ROWS + loads["b"] + again), level, 2), whole)
    assert look(path) == look(whole)


def test_gold_rules_find_problems(spark):
    rows = [("a", 5.0), ("a", 6.0), ("b", 2e6), ("c", None)]
    df = spark.createDataFrame(rows, "metric_name string, metric_value double").withColumns(
        {"metric_type": F.lit("t"), "aggregation_level": F.lit("daily"), "date_partition": F.lit(dt.date(2024, 1, 1))}
    )
    row = gold_rule_checks(df).first()
    assert (row["total_rows"], row["null_values"], row["out_of_range"], row["duplicates"]) == (4, 1, 1, 1)


def test_spikes_and_anomalies(spark):
    history = spark.createDataFrame(
        [("a", 1, 5.0, None), ("a", 2, 10.0, 5.0), ("a", 3, 10.1, 5.0), ("a", 4, None, 6.0)],
        "source_file string, batch_number int, batch_avg double, running_avg_before double",
    )
    flags = [r["is_spike"] for r in monitoring.price_spikes(history).orderBy("batch_number").collect()]
    assert flags == [False, False, True, False]
    days = spark.createDataFrame([(dt.date(2024, 1, i + 1), n) for i, n in enumerate([100, 110, 98, 99])], "day date, transactions bigint")
    got = [r["is_anomaly"] for r in monitoring.count_anomalies(days).orderBy("day").collect()]
    assert got[0] is False and got[2] is True and got[3] is False


def test_degradation(spark):
    runs = spark.createDataFrame(
        [("r1", 1, 100, 1, 10, 0, 10.0), ("r2", 2, 100, 2, 10, 1, 10.5), ("r3", 3, 100, 2, 10, 0, 20.0)],
        "run_id string, run_no int, rows_in bigint, rows_rejected bigint, batches bigint, failed_batches bigint, seconds double",
    )
    got = {r["run_id"]: (r["processing_failure"], r["quality_degraded"], r["performance_degraded"]) for r in monitoring.degradation(runs).collect()}
    assert got == {"r1": (False, False, False), "r2": (True, True, False), "r3": (False, False, True)}


def test_retention(spark, tmp_path):
    rows = feed(spark, ROWS)
    as_of = F.lit("2025-01-05").cast("date")
    tiers = monitoring.with_retention(rows, "bronze", F.col("ts"), as_of)
    assert {r["tier"]: r["count"] for r in tiers.groupBy("tier").count().collect()} == {"cold": 2, "keep": 3}
    assert monitoring.with_retention(rows, "gold", F.col("ts"), as_of).where("tier <> 'keep'").count() == 0
    for day in ("2025-01-05", "2025-01-06", "2025-01-06"):  # a run that is repeated replaces itself only
        tables.archive(tiers, str(tmp_path / "a"), day)
    assert spark.read.parquet(f"{tmp_path}/a/tier=cold").count() == 4
