import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import reconcile, stats
from ledgerlake.plans import run
from ledgerlake.settings import Feed
from ledgerlake.sinks.tables import write_bronze
from ledgerlake.sources.parquetfiles import read_bronze
from ledgerlake.streaming import ingest, live

FEED = Feed(main=("a.csv", "b.csv"), held_out="validation.csv")
ROWS = [("a.csv", f"2012-01-0{i % 9 + 1}", str(i), f"user_{i % 4}") for i in range(-2, 30)] + [
    ("b.csv", "2012-02-01", p, "user_9") for p in ("5", "NA", "x", "7.5")
]
HELD = [("validation.csv", "2012-03-01", p, "user_1") for p in ("100", "0.5", "-3")]
KEPT_MAIN = [float(i) for i in range(1, 30)] + [5.0, 7.5]


@pytest.fixture()
def layout(spark, tmp_path, bronze_rows):
    made = run.Layout(raw=str(tmp_path / "raw"), lake=str(tmp_path / "lake"))
    write_bronze(bronze_rows(ROWS + HELD), made.bronze)
    return made


def state_of(store, spark, phase=None):
    row = store.state(spark, phase).first()
    return row["count"], row["sum"], row["min"], row["max"]


def test_two_phases_share_the_state(spark, layout):
    store = run.load_phase(spark, layout, FEED, ingest.MAIN, 2)
    assert state_of(store, spark) == (31, sum(KEPT_MAIN), 1.0, 29.0)
    run.load_phase(spark, layout, FEED, ingest.HELD_OUT_PHASE, 2)
    assert state_of(store, spark) == (33, sum(KEPT_MAIN) + 100.5, 0.5, 100.0)
    drift = run.phase_drift(spark, store).first()
    assert (drift["count_added"], drift["new_min"], drift["new_max"]) == (2, True, True)
    assert store.rejects(spark).count() == 6 and store.transactions(spark).count() == 33
    snapshot = store.batch_metadata(spark).where("status = 'completed' and phase = 'held_out'").first()["stats_snapshot"]
    assert snapshot.startswith('{"count":31,"sum":447.5')
    history = store.history(spark).orderBy("batch_seq").collect()
    assert [(r["phase"], r["running_count_after"]) for r in history] == [("main", 31), ("held_out", 33)]


def test_restart_and_replay_do_not_double(spark, layout):
    store = run.load_phase(spark, layout, FEED, ingest.MAIN, 2)
    once = state_of(store, spark)
    run.load_phase(spark, layout, FEED, ingest.MAIN, 2)
    assert state_of(store, spark) == once
    ingest.load_batch(read_bronze(spark, layout.bronze, FEED.main), 0, store, ingest.MAIN)
    assert state_of(store, spark) == once
    direct = stats.direct_stats(store.transactions(spark), 2)
    assert reconcile.verdict(reconcile.reconcile(store.state(spark), direct)).first()["overall_match"]


def test_new_files_are_added(spark, layout, bronze_rows):
    store = run.load_phase(spark, layout, FEED, ingest.MAIN, 2)
    write_bronze(bronze_rows([(s, "2012-04-01", "2.25", "user_1") for s in ("c.csv", "d.csv")]), layout.bronze)
    run.load_phase(spark, layout, Feed(main=("a.csv", "b.csv", "c.csv")), ingest.MAIN, 2)
    assert state_of(store, spark)[:2] == (32, sum(KEPT_MAIN) + 2.25)  # d.csv is not part of the feed


def test_failed_batch_is_logged_and_recovers(spark, tmp_path, bronze_rows):
    store = ingest.Store(str(tmp_path / "store"), 2)
    good = bronze_rows(ROWS)
    broken = good.withColumn("price", F.raise_error(F.lit("broken input")).cast("double"))
    with pytest.raises(Exception):
        ingest.load_batch(broken, 0, store, ingest.MAIN)
    log = ingest.latest_status(store.events(spark)).first()
    assert log["status"] == "failed" and "broken input" in log["error_message"]
    ingest.load_batch(good, 0, store, ingest.MAIN)
    ingest.load_batch(good.limit(0), 1, store, ingest.MAIN)
    batches = ingest.latest_status(store.events(spark))
    assert {r["status"] for r in batches.collect()} == {"completed"}
    summary = ingest.batch_summary(batches).first()
    assert (summary["total_batches"], summary["total_rows"], summary["success_rate"]) == (2, 31, 100.0)


def test_summary_of_nothing(spark):
    none = spark.createDataFrame([], "status string, rows_processed bigint")
    row = ingest.batch_summary(none).first()
    assert (row["total_batches"], row["total_rows"], row["avg_batch_size"], row["success_rate"]) == (0, 0, 0.0, 0.0)


def test_live_statistics_equal_batch(spark, layout, tmp_path):
    stream = ingest.bronze_stream(spark, layout.bronze, lambda r: r.where("price > 0"), max_files=1)
    live.run_live(live.live_stats(stream, 2), f"{tmp_path}/s", f"{tmp_path}/cp")
    row = live.published(spark, f"{tmp_path}/s").first()
    assert (row["count"], row["sum"], row["min"], row["max"]) == (33, sum(KEPT_MAIN) + 100.5, 0.5, 100.0)


def test_windows_and_copies(spark, layout, tmp_path):
    rows = lambda r: r.withColumn("ts", F.to_timestamp("timestamp"))
    live.fold_windows(ingest.bronze_stream(spark, layout.bronze, rows, max_files=1), f"{tmp_path}/d", f"{tmp_path}/cpd", 2)
    per_day = {str(r["date_partition"]): r["transaction_count"] for r in live.daily_windows(spark, f"{tmp_path}/d", 2).collect()}
    assert per_day["2012-02-01"] == 4 and per_day["2012-03-01"] == 3 and sum(per_day.values()) == len(ROWS + HELD)

    twice = lambda r: rows(r).union(rows(r))
    stream = ingest.bronze_stream(spark, layout.bronze, twice, max_files=1)
    key = ("ts", "user_id", "price")
    live.fold_unique(stream.select(*key, "source_file"), f"{tmp_path}/u", f"{tmp_path}/cpu", key)
    got = spark.read.parquet(f"{tmp_path}/u")
    full = [r for r in ROWS + HELD if r[2] not in ("NA", "x") and r[1] and r[3]]
    assert got.where("price is not null and ts is not null and user_id is not null").count() == len({(r[1], r[2], r[3]) for r in full})
    assert got.where("price is null or ts is null or user_id is null").count() == 2 * (len(ROWS + HELD) - len(full))


def test_a_failed_replay_is_a_failure(spark, tmp_path, bronze_rows):
    store = ingest.Store(str(tmp_path / "store"), 2)
    good = bronze_rows(ROWS)
    bad = good.withColumn("price", F.raise_error(F.lit("no " + "x" * 3000)).cast("double"))
    ingest.load_batch(good, 0, store, ingest.MAIN)
    with pytest.raises(Exception):
        ingest.load_batch(bad, 0, store, ingest.MAIN)
    row = ingest.latest_status(store.events(spark)).first()
    assert row["status"] == "failed" and "x" * 3000 in row["error_message"]
    ingest.load_batch(good, 0, store, ingest.MAIN)
    assert ingest.latest_status(store.events(spark)).first()["status"] == "completed"


@pytest.fixture()
def raw_layout(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name in FEED.expected:
        lines = [",".join((r[1], r[2], r[3])) for r in ROWS + HELD if r[0] == name]
        (folder / name).write_text("\n".join(["timestamp,price,user_id", *lines]) + "\n")
    return run.Layout(raw=str(folder), lake=str(tmp_path / "lake"))


def test_whole_run(spark, raw_layout):
    steps = run.run_all(spark, raw_layout, FEED, 2, run_id="run")
    got = [(r["step"], r["status"], r["rows"]) for r in steps.orderBy("step_no").collect()]
    assert got == [("raw_data", "completed", 3), ("bronze", "completed", 39), ("ingestion", "completed", 31),
                   ("validation", "completed", 2), ("report", "completed", 33)]
    assert run.run_succeeded(steps).first()["overall_success"] is True
    audit = spark.read.parquet(raw_layout.audit)
    assert {(r["run_id"], r["verification_passed"]) for r in audit.collect()} == {("run-main", 1), ("run-held-out", 1)}
    text = [r["value"] for r in spark.read.text(f"{raw_layout.reports}/text").collect()]
    assert text[0] == "TRANSACTION LOAD REPORT" and "Records in store: 33" in text
    assert spark.read.json(f"{raw_layout.reports}/json").first()["total_records"] == 33
    run.run_all(spark, raw_layout, FEED, 2)  # a second run finds nothing new to load
    assert raw_layout.store(2).state(spark).first()["count"] == 33


def test_sources_outside_the_feed_are_left_alone(spark, raw_layout):
    from pathlib import Path

    (Path(raw_layout.raw) / "other.csv").write_text("timestamp,price,user_id\n2012-01-01,99,user_1\n")
    steps = run.run_all(spark, raw_layout, FEED, 2)
    assert [r["rows"] for r in steps.orderBy("step_no").collect()] == [4, 39, 31, 2, 33]
    assert read_bronze(spark, raw_layout.bronze).where("source_file = 'other.csv'").count() == 0


def test_changed_source_replaces_its_rows(spark, raw_layout):
    from pathlib import Path

    run.run_all(spark, raw_layout, FEED, 2)
    (Path(raw_layout.raw) / "b.csv").write_text("price,timestamp,user_id\n1000,2012-02-01,user_9\nNA,2012-02-01,user_9\n")
    steps = run.run_all(spark, raw_layout, FEED, 2)
    assert run.run_succeeded(steps).first()["overall_success"] is True
    store = raw_layout.store(2)
    assert state_of(store, spark) == (29 + 1 + 2, sum(range(1, 30)) + 1000.0 + 100.5, 0.5, 1000.0)
    assert store.transactions(spark).where("source_file = 'b.csv'").count() == 1
    assert store.rejects(spark).where("source_file = 'b.csv'").count() == 1


def test_files_of_the_other_phase_make_empty_batches(spark, tmp_path, bronze_rows):
    layout = run.Layout(raw="", lake=str(tmp_path / "lake"))
    write_bronze(bronze_rows(HELD), layout.bronze)
    store = run.load_phase(spark, layout, FEED, ingest.MAIN, 2)
    assert [(r["status"], r["rows_processed"]) for r in ingest.latest_status(store.events(spark)).collect()] == [("completed", 0)]


def test_reset_starts_over(spark, layout):
    store = run.load_phase(spark, layout, FEED, ingest.MAIN, 2)
    new = store.reset()
    assert new.rows_path != store.rows_path
    ingest.ingest_available(ingest.bronze_stream(spark, layout.bronze), new, ingest.MAIN)
    assert state_of(new, spark)[0] == 33 and state_of(store, spark)[0] == 31


def test_periodic_verification(spark, layout):
    run.load_phase(spark, layout, FEED, ingest.MAIN, 2, max_files=2, verify_every=2)
    audit = spark.read.parquet(layout.audit).collect()
    assert audit and all(r["verification_passed"] == 1 for r in audit)
    assert all(int(r["run_id"].split("-")[1]) % 2 == 1 for r in audit)


def test_state_file(spark, tmp_path):
    from ledgerlake.sinks.tables import write_state
    from ledgerlake.sources.tables import read_state

    empty = stats.direct_stats(spark.range(0).select(F.lit(1.0).alias("price")))
    write_state(empty, f"{tmp_path}/state")
    assert tuple(read_state(spark, f"{tmp_path}/state").first()) == (0, None, None, None, None)


def test_small_micro_batches_give_the_same_state(spark, layout):
    store = run.load_phase(spark, layout, FEED, ingest.MAIN, 2, max_files=1)
    assert state_of(store, spark) == (31, sum(KEPT_MAIN), 1.0, 29.0)
    assert store.events(spark).select("ingest_batch").distinct().count() > 1


def test_missing_source_stops_the_run(spark, raw_layout):
    bigger = Feed(main=("a.csv", "b.csv", "c.csv"), held_out="validation.csv")
    steps = run.run_all(spark, raw_layout, bigger, 2)
    got = [(r["step"], r["status"]) for r in steps.collect()]
    assert got == [("raw_data", "failed")]
    assert run.run_succeeded(steps).first()["overall_success"] is False


def test_unpublished_run(spark, raw_layout):
    import os

    steps = run.run_all(spark, raw_layout, FEED, 2, publish=False)
    assert run.run_succeeded(steps).first()["overall_success"] is True
    assert not os.path.exists(raw_layout.audit) and not os.path.exists(raw_layout.reports)
