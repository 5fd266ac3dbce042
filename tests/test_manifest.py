"""Conversion file by file: findings, changes, withdrawals, and what a run opens."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import run
from ledgerlake.sources import csvfiles, listing, manifest, parquetfiles
from ledgerlake.streaming.ingest import MAIN, bronze_stream, ingest_available

HEAD = "timestamp,price,user_id\n"


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    (folder / "a.csv").mkdir(parents=True)
    (folder / "a.csv" / "part-0.csv").write_text(HEAD + "2012-01-01,1,user_1\n2012-01-02,2,user_2\n")
    (folder / "a.csv" / "part-1 [x] 50%+.csv").write_text("user_id,extra,price,timestamp\nuser_3,,3,2012-01-03\n")
    (folder / "b.csv").write_text(HEAD + "2012-02-01,4,user_4\n")
    return folder


def convert(spark, raw, bronze, **options):
    return {r["file_name"]: (r["converted"], r["reason"], r["row_count"], r["batches"]) for r in run.convert_to_bronze(spark, str(raw), bronze, **options).collect()}


def prices(spark, bronze):
    return sorted(r["price"] for r in parquetfiles.read_bronze(spark, bronze).collect())


def test_one_bad_file_does_not_stop_the_others(spark, raw, tmp_path):
    (raw / "latin.csv").write_bytes("timestamp,price,user_id,größe\n2012-01-01,9,u,1\n".encode("latin-1"))
    (raw / "body.csv").write_bytes((HEAD + "2012-01-01,8,J\xfcrgen\n2012-01-01,8,ok\n").encode("latin-1"))
    (raw / "torn.csv.gz").write_bytes(gzip.compress((HEAD + "2012-01-01,7,u\n" * 5000).encode())[:-40])
    (raw / "none.csv.gz").write_bytes(b"no archive")
    (raw / "whole.csv.gz").write_bytes(gzip.compress((HEAD + "2012-01-01,6,u\n").encode()))
    (raw / "long.csv").write_bytes(b"x" * (2 << 20))
    (raw / "wide.csv").write_text(HEAD[:-1] + ",x" * 30_000 + "\n")
    (raw / "empty.csv").write_text("")
    bronze = str(tmp_path / "bronze")
    got = convert(spark, raw, bronze, batch_size=2)
    assert got["part-0.csv"] == (True, None, 2, 1) and got["part-1 [x] 50%+.csv"] == (True, None, 1, 1)
    assert got["b.csv"] == got["whole.csv.gz"] == (True, None, 1, 1)
    assert got["latin.csv"] == (False, "header is not UTF-8", 0, 0) and got["body.csv"] == (False, "not UTF-8 in rows: 1", 0, 0)
    assert got["wide.csv"][1] == "more than 20000 columns" and "no line break" in got["long.csv"][1]
    assert all(not got[n][0] and got[n][1].startswith("unreadable") for n in ("torn.csv.gz", "none.csv.gz", "long.csv"))
    assert got["empty.csv"][1] == "missing columns: timestamp, price, user_id"
    assert prices(spark, bronze) == [1, 2, 3, 4, 6]
    states = {r["state"]: r["n"] for r in manifest.current(spark, manifest.manifest_path(bronze)).groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert states == {"converted": 4, "quarantined": 7}
    (raw / "latin.csv").write_text(HEAD + "2012-01-01,9,u\n")  # mended: converted; the others are looked at again
    again = convert(spark, raw, bronze)
    assert again["latin.csv"][0] and set(again) == set(got) - {"part-0.csv", "part-1 [x] 50%+.csv", "b.csv", "whole.csv.gz"}


def test_only_what_changed_is_converted(spark, raw, tmp_path):
    bronze = str(tmp_path / "bronze")
    convert(spark, raw, bronze)
    assert convert(spark, raw, bronze) == {}
    (raw / "a.csv" / "part-2.csv").write_text(HEAD + "2012-01-04,5,user_5\n")
    assert set(convert(spark, raw, bronze)) == {"part-2.csv"} and prices(spark, bronze) == [1, 2, 3, 4, 5]
    (raw / "b.csv").write_text(HEAD + "2012-02-01,40,user_4\n2012-02-01,41,user_4\n")
    assert set(convert(spark, raw, bronze)) == {"b.csv"} and prices(spark, bronze) == [1, 2, 3, 5, 40, 41]
    os.remove(raw / "a.csv" / "part-0.csv")
    assert convert(spark, raw, bronze, sources=["b.csv"]) == {}  # its source was not looked at
    assert prices(spark, bronze) == [1, 2, 3, 5, 40, 41]
    assert convert(spark, raw, bronze) == {} and prices(spark, bronze) == [3, 5, 40, 41]
    profile = {r["source_file"]: (r["n_files"], r["row_count"]) for r in run.bronze_profile(spark, bronze).collect()}
    assert profile == {"a.csv": (2, 2), "b.csv": (1, 2)}
    (raw / "a.csv" / "part-0.csv").write_text(HEAD + "2012-01-01,1,user_1\n")  # it comes back
    assert set(convert(spark, raw, bronze)) == {"part-0.csv"} and prices(spark, bronze) == [1, 3, 5, 40, 41]


def test_the_store_follows_the_files(spark, raw, tmp_path):
    layout = run.Layout(str(raw), str(tmp_path / "lake"))
    store = layout.store(2)

    def load():
        convert(spark, raw, layout.bronze)
        ingest_available(bronze_stream(spark, layout.bronze), store, MAIN)
        assert float(store.state(spark).first()["sum"]) == sum(r["price"] for r in store.transactions(spark).collect())
        return sorted(r["price"] for r in store.transactions(spark).collect())

    assert load() == [1, 2, 3, 4]
    (raw / "a.csv" / "part-0.csv").write_text(HEAD + "2012-01-01,10,user_1\n")
    assert load() == [3, 4, 10]
    os.remove(raw / "b.csv")
    assert load() == [3, 10]
    (raw / "a.csv" / "part-0.csv").write_bytes((HEAD + "2012-01-01,10,\xfc\n").encode("latin-1"))  # its rows are loaded, then do not count
    assert load() == [3]


def test_portions_are_committed_one_by_one(spark, raw, tmp_path):
    bronze = str(tmp_path / "bronze")
    for n in range(7):
        (raw / f"c{n}.csv").write_text(HEAD + f"2012-03-01,{100 + n},u\n")
    assert len(convert(spark, raw, bronze, files_per_scan=3)) == 10
    assert prices(spark, bronze) == [1, 2, 3, 4, *range(100, 107)]
    versions = manifest.history(spark, manifest.manifest_path(bronze)).select("version").distinct().count()
    assert versions == 4


def test_a_conversion_that_died_leaves_nothing(spark, raw, tmp_path, monkeypatch):
    bronze = str(tmp_path / "bronze")
    commit = run.commit

    def dies(rows, path):
        raise RuntimeError("lost")

    monkeypatch.setattr(run, "commit", dies)
    with pytest.raises(RuntimeError):
        convert(spark, raw, bronze)
    assert prices(spark, bronze) == [1, 2, 3, 4]  # without any commit there is no manifest to go by
    monkeypatch.setattr(run, "commit", commit)
    convert(spark, raw, bronze)
    assert prices(spark, bronze) == [1, 2, 3, 4]
    assert [r["version"] for r in manifest.history(spark, manifest.manifest_path(bronze)).select("version").distinct().collect()] == [2]


def test_vacuum_deletes_dead_versions_only(spark, raw, tmp_path):
    bronze = str(tmp_path / "bronze")
    convert(spark, raw, bronze)
    os.utime(raw / "b.csv", (1, 1))
    convert(spark, raw, bronze)
    assert run.vacuum_bronze(spark, bronze).count() == 0  # version 1 still has the files of a.csv
    for name in ("part-0.csv", "part-1 [x] 50%+.csv"):
        os.utime(raw / "a.csv" / name, (2, 2))
    convert(spark, raw, bronze)
    assert [r[0] for r in run.vacuum_bronze(spark, bronze).collect()] == [1]
    assert prices(spark, bronze) == [1, 2, 3, 4] and not os.path.exists(f"{bronze}/bronze_version=1")


def test_unchanged_files_are_not_opened_and_nothing_is_shuffled(spark, raw, tmp_path):
    """The scan of a conversion lists exactly the changed files, and its rows meet no join."""
    bronze = str(tmp_path / "bronze")
    convert(spark, raw, bronze)
    (raw / "a.csv" / "part-2.csv").write_text(HEAD + "2012-01-04,5,user_5\n")
    files = listing.list_files(spark, str(raw), "*.csv*").withColumn("file_id", csvfiles.file_id(F.col("path")))
    changed, _ = manifest.changes(spark, manifest.manifest_path(bronze), files)
    (paths, rows), = csvfiles.layout_scans(spark, csvfiles.inspected(changed))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["part-2.csv"]
    assert [f.rsplit("/", 1)[1] for f in rows.inputFiles()] == ["part-2.csv"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_missing_source_may_be_a_warning(spark, raw, tmp_path):
    from ledgerlake.settings import Feed

    feed = Feed(main=("a.csv", "absent.csv"), held_out="b.csv")
    strict = run.run_all(spark, run.Layout(str(raw), str(tmp_path / "one")), feed, 2).collect()
    assert [(r["step"], r["status"]) for r in strict] == [("raw_data", "failed")]
    steps = run.run_all(spark, run.Layout(str(raw), str(tmp_path / "two")), feed, 2, strict=False).collect()
    assert [(r["step"], r["status"], r["rows"]) for r in steps] == [
        ("raw_data", "completed", 2), ("bronze", "completed", 4), ("ingestion", "completed", 3), ("validation", "completed", 1), ("report", "completed", 4)]
    assert steps[0]["message"].startswith("warning: 1 expected") and steps[1]["message"].startswith("warning")
