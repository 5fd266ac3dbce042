import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import completeness
from ledgerlake.operators.clean import clean_counts, to_bronze
from ledgerlake.plans.run import convert_to_bronze
from ledgerlake.sources import csvfiles, listing, parquetfiles


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "2012-1.csv").write_text("timestamp,price,user_id\n2012-01-01,1.5,user_1\n2012-01-02,NA,user_2\n")
    (folder / "2012-2.csv").write_text("user_id,price,timestamp,extra\nuser_3,2.5,2012-02-01,x\n")
    (folder / "2012-3.csv").write_text("timestamp,price,user_id\n")
    (folder / "2012-4.csv").write_text("timestamp,user_id\n2012-04-01,user_4\n")
    (folder / "2012-5.csv").write_text('timestamp,price,user_id\n2012-05-01,abc,"us""er, 5"\n2012-05-02,3,user_6\n')
    (folder / "notes.txt").write_text("not a source\n")
    return str(folder)


def files_of(spark, raw):
    return listing.list_files(spark, raw, "*.csv")


def test_columns_are_mapped_by_name(spark, raw):
    rows = csvfiles.read_csv_by_name(spark, files_of(spark, raw))
    got = {r["user_id"]: (r["timestamp"], r["price"], r["source_file"]) for r in rows.collect()}
    assert got == {
        "user_1": ("2012-01-01", "1.5", "2012-1.csv"), "user_2": ("2012-01-02", "NA", "2012-1.csv"),
        "user_3": ("2012-02-01", "2.5", "2012-2.csv"), 'us"er, 5': ("2012-05-01", "abc", "2012-5.csv"),
        "user_6": ("2012-05-02", "3", "2012-5.csv"),
    }


def test_missing_column_rejects_the_file_only(spark, raw):
    headers = csvfiles.missing_columns(csvfiles.csv_headers(files_of(spark, raw)))
    bad = {r["source_file"]: r["missing_columns"] for r in headers.where(F.size("missing_columns") > 0).collect()}
    assert bad == {"2012-4.csv": ["price"]}


def test_profile_and_line_counts(spark, raw):
    files = files_of(spark, raw)
    profile = csvfiles.csv_profile(files, csvfiles.csv_headers(files), csvfiles.line_counts(spark, raw, "*.csv"))
    got = {r["source_file"]: (r["row_count"], r["valid"]) for r in profile.collect()}
    assert got == {"2012-1.csv": (2, True), "2012-2.csv": (1, True), "2012-3.csv": (0, True),
                   "2012-4.csv": (1, False), "2012-5.csv": (2, True)}


def test_bad_values_do_not_lose_a_file(spark, raw, tmp_path):
    bronze = str(tmp_path / "bronze")
    convert_to_bronze(spark, raw, bronze)
    table = parquetfiles.read_bronze(spark, bronze)
    got = {r["source_file"]: (r["rows_in"], r["rows_kept"], r["rejected_not_numeric"]) for r in clean_counts(table).collect()}
    assert got == {"2012-1.csv": (2, 1, 0), "2012-2.csv": (1, 1, 0), "2012-5.csv": (2, 1, 1)}
    convert_to_bronze(spark, raw, bronze)  # once more: replaced, not doubled
    assert parquetfiles.read_bronze(spark, bronze).count() == 5
    assert parquetfiles.read_bronze(spark, bronze, ["2012-5.csv"]).count() == 2


def test_quoted_line_breaks(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text('timestamp,price,user_id\n2012-01-01,1,"two\nlines"\n')
    files = listing.list_files(spark, str(folder), "*.csv")
    rows = csvfiles.read_csv_by_name(spark, files, multi_line=True)
    assert [r["user_id"] for r in rows.collect()] == ["two\nlines"]
    counted = csvfiles.line_counts(spark, str(folder)).first()
    assert counted["line_rows"] == 2  # a plain line count sees the break


def test_no_usable_file(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    rows = csvfiles.read_csv_by_name(spark, listing.list_files(spark, str(folder), "*.csv"))
    assert rows.count() == 0 and rows.columns == ["timestamp", "price", "user_id", "source_file", "file_id"]


def test_footers_and_corrupt_files(spark, raw, tmp_path):
    bronze = tmp_path / "bronze"
    convert_to_bronze(spark, raw, str(bronze))
    broken = bronze / "source_file=2012-3.csv"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("this is no parquet")
    profile = parquetfiles.parquet_profile(parquetfiles.parquet_footers(listing.list_files(spark, str(bronze), "*.parquet")))
    expected = completeness.expected_sources(spark, ["2012-1.csv", "2012-3.csv", "2012-4.csv"])
    checked = completeness.check_layer(profile, expected)
    assert {r["source_file"]: r["state"] for r in checked.collect()} == {
        "2012-1.csv": "found", "2012-3.csv": "corrupt", "2012-4.csv": "missing"
    }
    totals = completeness.layer_totals(checked).first()
    assert (totals["files_found"], totals["missing"], totals["corrupt"], totals["total_rows"], totals["valid"]) == (2, 1, 1, 2, False)
    row = profile.where("source_file = '2012-1.csv'").first()
    assert (row["row_count"], row["compression"]) == (2, "SNAPPY")


def test_feed_folder_prefers_a_subfolder(spark, tmp_path):
    for folder in (tmp_path, tmp_path / "feed", tmp_path / ".hidden", tmp_path / "few"):
        folder.mkdir(exist_ok=True)
        for i in range(2 if folder.name == "few" else 5):
            (folder / f"2012-{i}.csv").write_text("timestamp,price,user_id\n")
    files = listing.list_files(spark, str(tmp_path), "*.csv")
    found = [r["feed_folder"].rsplit("/", 1)[1] for r in listing.feed_folders(files, str(tmp_path)).collect()]
    assert found == ["feed", tmp_path.name]


def test_source_selection_and_order(spark, tmp_path):
    for name in ("2012-2.csv", "validation.csv", "2012-1.csv", "other.csv"):
        (tmp_path / name).write_text("timestamp,price,user_id\n")
    files = listing.list_files(spark, str(tmp_path), "*.csv")
    chosen = listing.select_sources(files, r"^2012-", "validation.csv")
    place = listing.feed_position(F.col("source_file"), ["2012-1.csv", "2012-2.csv", "validation.csv"])
    assert [r["source_file"] for r in chosen.orderBy(place).collect()] == ["2012-1.csv", "2012-2.csv", "validation.csv"]
    assert listing.select_sources(files, r"^2012-", "validation.csv", include_held_out=False).count() == 2


@pytest.mark.parametrize("count,status,gate", [(6, "success", True), (5, "success", False), (4, "warning", False), (0, "error", False)])
def test_layer_status(spark, count, status, gate):
    counts = spark.createDataFrame([(count, 3 * 1024 * 1024)], "sources bigint, bytes bigint")
    row = completeness.layer_status(counts, "bronze").first()
    assert (row["status"], row["gate_open"], row["size_mb"]) == (status, gate, 3.0)


def test_size_comparison(spark):
    before = spark.createDataFrame([("a", 100), ("b", 50)], "file_stem string, file_size bigint")
    after = spark.createDataFrame([("a", 25), ("c", 5)], "file_stem string, file_size bigint")
    got = {r["file_stem"]: r for r in completeness.compare_sizes(before, after).collect()}
    assert (got["a"]["compression_ratio"], got["a"]["space_saved"]) == (75.0, 75)
    assert (got["b"]["parquet_exists"], got["b"]["compression_ratio"]) == (False, 0.0)
    assert got["c"]["csv_exists"] is False


def test_failed_conversions_are_counted(spark):
    csv = spark.createDataFrame([("a.csv", 100), ("b.csv", 50)], "source_file string, file_size bigint")
    done = spark.createDataFrame([("a.csv", 2500, 40)], "source_file string, row_count bigint, file_size bigint")
    row = completeness.conversion_summary(done, csv).first()
    assert (row["converted_files"], row["failed_files"], row["total_batches"], row["success"]) == (1, 1, 3, True)
    assert row["compression_ratio"] == pytest.approx(60.0)
    none = completeness.conversion_summary(done.limit(0), csv).first()
    assert none["success"] is False


def test_csv_stream_refuses_another_header(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    for folder, header in ((good, "timestamp,price,user_id"), (bad, "user_id,price,timestamp")):
        folder.mkdir()
        (folder / "2012-1.csv").write_text(f"{header}\n2012-01-01,4,user_1\n")
    for folder in (good, bad):
        stream = to_bronze(csvfiles.stream_csv(spark, str(folder), max_files=1))
        run = lambda: stream.writeStream.option("checkpointLocation", f"{folder}-cp").trigger(availableNow=True).start(f"{folder}-out", format="parquet").awaitTermination()
        if folder is good:
            run()
            row = spark.read.parquet(f"{folder}-out").first()
            assert (row["price"], row["source_file"]) == (4.0, "2012-1.csv")
        else:
            with pytest.raises(Exception):
                run()


def test_schema_change_and_evolving_files(spark, tmp_path):
    old = spark.range(3).withColumn("price", F.lit(1.0))
    new = old.withColumn("user_id", F.lit("u"))
    old.write.parquet(f"{tmp_path}/t/generation=1")
    new.write.parquet(f"{tmp_path}/t/generation=2")
    merged = parquetfiles.read_evolving(spark, f"{tmp_path}/t")
    assert merged.where("user_id is null").count() == 3
    other = old.withColumn("price", F.lit("x"))
    changes = {r["field"]: r["change"] for r in parquetfiles.schema_difference(spark, new.schema, other.schema).collect()}
    assert changes == {"id": "same", "price": "changed", "user_id": "removed"}


def test_registered_table(spark, tmp_path):
    from ledgerlake.sources.tables import query_store

    spark.sql(schemas.create_table_sql("statistics_t", schemas.STATISTICS, f"{tmp_path}/stats"))
    assert [f.name for f in spark.table("statistics_t").schema][:2] == ["count", "sum"]
    spark.sql("DROP TABLE statistics_t")
    rows = spark.range(5).select(F.col("id").cast("double").alias("price"))
    assert query_store(spark, "SELECT sum(price) AS s FROM {t}", t=rows).first()["s"] == 10.0


def test_file_helpers_need_no_installed_package():
    """Executors get the helpers with the task: unpickled where this package is not importable."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from ledgerlake.sources.remote import footer_batches, header_batches

    payload = cloudpickle.dumps((header_batches, footer_batches))
    code = "import pickle, sys; print([f.__name__ for f in pickle.load(sys.stdin.buffer)])"
    done = subprocess.run([sys.executable, "-c", code], input=payload, capture_output=True, cwd="/", timeout=60)
    assert b"header_batches" in done.stdout, done.stderr
