"""Streams whose cost does not grow: segments, marks, keyed state, one pass for each batch."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.streaming import ingest, live, segments

SCHEMA = "n bigint, phase string, ingest_batch bigint"


def add(spark, path, phase, batch):
    segments.overwrite_partitions(spark.range(1).select(F.lit(batch).cast("bigint").alias("n"), F.lit(phase).alias("phase"), F.lit(batch).cast("bigint").alias("ingest_batch")), path, ["phase", "ingest_batch"])


def rows(spark, path):
    return sorted(tuple(r) for r in segments.read_all(spark, path, SCHEMA).collect())


def test_levels_are_logarithmic_and_nothing_changes(spark, tmp_path):
    path, want = str(tmp_path / "t"), []
    most = 0
    for batch in range(20):
        for phase in ("main", "held_out") if batch < 3 else ("main",):
            add(spark, path, phase, batch)
            want.append((batch, phase, batch))
        if batch % 2:
            most = max(most, segments.compact(spark, path, SCHEMA, fanout=2))
            assert rows(spark, path) == sorted(want)
    number, found = segments.cover(spark, path)
    assert most <= 12 and max(s[2] for s in found) >= 4
    read = [f for f in segments.read_all(spark, path, SCHEMA).inputFiles()]
    assert len(read) < 15
    segments.compact(spark, path, SCHEMA, fanout=2)  # now what the last cover holds is deleted
    assert rows(spark, path) == sorted(want) and len(os.listdir(f"{path}/phase=main")) <= 3


def test_a_compaction_that_dies_before_its_cover_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for batch in range(9):
        add(spark, path, "main", batch)
    want = rows(spark, path)

    def dies(*_):
        raise RuntimeError

    with monkeypatch.context() as patched:
        patched.setattr(segments, "overwrite_partitions", dies)
        with pytest.raises(RuntimeError):
            segments.compact(spark, path, SCHEMA, fanout=4)
    assert rows(spark, path) == want
    add(spark, path, "main", 8)  # the newest batch is replayed
    segments.compact(spark, path, SCHEMA, fanout=4)
    assert rows(spark, path) == want


def test_state_and_history_before_and_after(spark, tmp_path, bronze_rows):
    store = ingest.Store(str(tmp_path / "store"), 2)
    for number in range(7):
        prices = [str(number + k / 4) for k in range(1, 6)] + ["x", "-1"]
        ingest.load_batch(bronze_rows([("a.csv", "t", p, f"u{k}") for k, p in enumerate(prices)]), number, store, ingest.MAIN)
    ingest.load_batch(bronze_rows([("v.csv", "t", "9", "u")]), 0, store, ingest.HELD_OUT_PHASE)
    look = lambda: [sorted(map(str, df.collect())) for df in (store.state(spark), store.history(spark), ingest.latest_status(store.events(spark)), store.sketches(spark))]
    before = look()
    for _ in range(2):
        assert set(store.compact(spark, fanout=2)) == {"batch_partials", "batch_events"}
        assert look() == before
    ingest.load_batch(bronze_rows([("b.csv", "t", "5", "u")]), 7, store, ingest.MAIN)
    assert store.state(spark).first()["count"] == 7 * 5 + 2


def test_a_write_that_loses_rows_fails_the_batch(spark, tmp_path, bronze_rows, monkeypatch):
    store = ingest.Store(str(tmp_path / "store"), 2)
    write = ingest.overwrite_partitions
    seen = []

    def loses(df, path, by, *rest):
        write(df, path, by, *rest)
        if path == store.rows_path:
            seen.append(df._jdf.queryExecution().toString().count("Scan"))
            part = f"{path}/phase=main/ingest_batch=0/outcome=kept"
            spark.read.parquet(part).limit(2).collect()
            less = spark.createDataFrame(spark.read.parquet(part).limit(2).collect(), spark.read.parquet(part).schema)
            less.write.mode("overwrite").parquet(part)

    monkeypatch.setattr(ingest, "overwrite_partitions", loses)
    with pytest.raises(ValueError, match="5 rows came in, 3 were stored"):
        ingest.load_batch(bronze_rows([("a.csv", "t", p, "u") for p in ("1", "2", "3", "4", "x")]), 0, store, ingest.MAIN)
    monkeypatch.undo()
    assert ingest.latest_status(store.events(spark)).first()["status"] == "failed"
    ingest.load_batch(bronze_rows([("a.csv", "t", p, "u") for p in ("x", "y")]), 0, store, ingest.MAIN)
    assert store.transactions(spark).count() == 0 and store.state(spark).first()["count"] == 0


def test_marks_replace_earlier_partials(spark, tmp_path):
    """Late rows are known although nothing but the last mark is left of earlier micro-batches."""
    folder = tmp_path / "in"
    path, checkpoint = str(tmp_path / "days"), str(tmp_path / "cp")

    def arrive(name, days):
        spark.createDataFrame([(d, 1.0) for d in days], "day string, price double").select(F.to_timestamp("day").alias("ts"), "price").coalesce(1).write.parquet(str(folder / f"{name}"))
        stream = spark.readStream.schema("ts timestamp, price double").option("recursiveFileLookup", True).parquet(str(folder))
        live.fold_windows(stream, path, checkpoint)

    arrive("a", ["2024-01-10"])
    arrive("b", ["2024-01-05"])
    for part in os.listdir(path):  # hidden from readers
        if part.startswith("ingest_batch="):
            os.rename(f"{path}/{part}", f"{path}/.{part}")
    arrive("c", ["2024-01-07", "2024-01-09"])
    got = {str(r["date_partition"]): r["late_rows"] for r in live.daily_windows(spark, path).collect()}
    assert got == {"2024-01-07": 1, "2024-01-09": 0}


def test_keyed_state_reads_no_stored_rows(spark, tmp_path):
    """Copies are found although the rows that were written before are out of sight."""
    session = live.state_session(spark)
    folder, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    key = ("ts", "user_id", "price")

    def arrive(name, rows):
        spark.createDataFrame(rows, "day string, user_id string, price double").select(F.to_timestamp("day").alias("ts"), "user_id", "price").write.parquet(f"{folder}/{name}")
        stream = session.readStream.schema("ts timestamp, user_id string, price double").option("recursiveFileLookup", True).parquet(folder)
        live.fold_unique(stream, path, checkpoint, key)
        return spark.read.option("recursiveFileLookup", True).schema("ts timestamp, user_id string, price double").parquet(path).count()

    assert arrive("a", [("2024-01-05", "u", 1.0), ("2024-01-05", "u", 1.0), (None, "u", 1.0), (None, "u", 1.0)]) == 3
    for part in os.listdir(path):
        if part.startswith("day="):
            os.rename(f"{path}/{part}", f"{path}/.{part}")
    assert arrive("b", [("2024-01-05", "u", 1.0), ("2024-01-04", "u", 1.0), (None, "u", 1.0)]) == 2
