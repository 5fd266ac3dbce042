"""Moving expired partitions, whatever step the run dies at."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.sinks import retention
from ledgerlake.sinks.tables import overwrite_partitions

SCHEMA = "n bigint, day string"
STEPS = ("finished earlier moves", "copied", "recorded", "deleted")


class Died(Exception):
    pass


def table(spark, path):
    rows = spark.range(60).select("id", F.when(F.col("id") % 7 == 0, F.lit("none")).otherwise(
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 6 * 10).cast("int")), "yyyy-MM-dd")).alias("day")).toDF("n", "day")
    overwrite_partitions(rows, path, ["day"])
    return {(r["n"], r["day"]) for r in rows.collect()}


def sides(spark, live, archive):
    here = [(r["n"], r["day"]) for r in retention.live_rows(spark, live, archive, SCHEMA, "day").collect()]
    there = [(r["n"], r["day"]) for r in retention.archived_rows(spark, archive, SCHEMA).select("n", "day").collect()]
    return here, there


def move(spark, live, archive, run, after=lambda step: None):
    return retention.move_expired(spark, live, archive, SCHEMA, "bronze", "2024-02-20", run, days=25, after=after)


@pytest.mark.parametrize("step", STEPS)
def test_a_crash_loses_and_doubles_nothing(spark, tmp_path, step):
    live, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    rows = table(spark, live)

    def dies(done):
        if done == step:
            raise Died

    with pytest.raises(Died):
        move(spark, live, archive, "one", dies)
    for run in ("one", "one", "two"):
        here, there = sides(spark, live, archive)
        assert len(here) + len(there) == len(rows) and {*here, *there} == rows
        move(spark, live, archive, run)
    here, there = sides(spark, live, archive)
    assert {*here, *there} == rows and len(here) + len(there) == len(rows)
    assert {d for _, d in there} == {"2024-01-01", "2024-01-11", "2024-01-21"}
    assert sorted(os.listdir(live)) == sorted(["day=2024-01-31", "day=2024-02-10", "day=2024-02-20", "day=none"])


def test_late_rows_of_a_moved_day_are_moved_by_the_next_run(spark, tmp_path):
    live, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    rows = table(spark, live)
    assert sum(r["n_rows"] for r in move(spark, live, archive, "one").collect()) == len([r for r in rows if r[1] < "2024-01-26"])
    late = spark.createDataFrame([(1000, "2024-01-11")], SCHEMA)
    overwrite_partitions(late, live, ["day"])
    here, there = sides(spark, live, archive)
    assert (1000, "2024-01-11") in here and len(here) + len(there) == len(rows) + 1
    move(spark, live, archive, "two")
    here, there = sides(spark, live, archive)
    assert (1000, "2024-01-11") in there and {*here, *there} == rows | {(1000, "2024-01-11")}


def test_rows_that_arrive_between_copy_and_record_stop_the_move(spark, tmp_path):
    live, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    rows = table(spark, live)

    def loses(done):
        if done == "copied":
            spark.createDataFrame([(1, "2024-01-11")], SCHEMA).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{archive}/tier=cold/run=one")

    with pytest.raises(ValueError):
        move(spark, live, archive, "one", loses)
    here, there = sides(spark, live, archive)
    assert there == [] and set(here) == rows


def test_layers_that_keep_everything(spark, tmp_path):
    live, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    table(spark, live)
    assert retention.move_expired(spark, live, archive, SCHEMA, "gold", "2034-01-01", "one").collect() == []
    assert retention.move_expired(spark, str(tmp_path / "absent"), archive, SCHEMA, "bronze", "2034-01-01", "one").collect() == []
