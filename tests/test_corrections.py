"""Cases that the given tables do not contain."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import clean, quality, reconcile, stats
from ledgerlake.sinks import tables
from ledgerlake.streaming import ingest


def test_folds_above_a_double_are_exact(spark):
    sums = [Decimal("123456789012345678901.23"), Decimal("0.01"), Decimal("-123456789012345678901.00")]
    rows = [("a.csv", 1, s, 1.0, 2.0) for s in sums]
    partials = spark.createDataFrame(rows, "source_file string, rows_processed long, batch_sum decimal(38,2), batch_min double, batch_max double")
    assert stats.merge_partials(partials, 2).first()["sum"] == 0.24
    large = partials.withColumn("batch_sum", F.lit(Decimal("60000000000000000.11")).cast("decimal(38,2)"))
    assert stats.merge_partials(large, 2).first()["sum"] == float(Decimal("180000000000000000.33"))


@pytest.mark.parametrize("text, reason", [
    ("Infinity", clean.NOT_FINITE), ("-Infinity", clean.NOT_FINITE), ("1e17", clean.OUT_OF_RANGE), ("1e13", None),
    ("0", clean.NON_POSITIVE), ("NaN", clean.MISSING), ("abc", clean.UNPARSEABLE), ("5", None),
])
def test_one_definition_of_a_kept_price(bronze_rows, text, reason):
    rows = bronze_rows([("a.csv", "t", text, "u")])
    assert clean.judge(rows).first()["reject_reason"] == reason
    assert clean.kept(rows).count() == (reason is None)
    counts = clean.clean_counts(rows).first()
    assert counts["rows_kept"] == (reason is None) and sum(counts[c] for c in counts.asDict() if c.startswith("reject")) == (reason is not None)


COPIES = [
    ("a", "2012-01-01 00:00:00", 5.0, "u", 1), ("a", "2012-01-01 00:00:00", 5.0, "u", 2), ("b", "2012-01-01 00:00:00", 5.0, "u", 3),
    ("a", None, 5.0, "u", 4), ("a", None, 5.0, "u", 5), ("a", "2012-01-01 00:00:00", None, "u", 6),
]


@pytest.fixture()
def copies(spark):
    return spark.createDataFrame(COPIES, "source_file string, timestamp string, price double, user_id string, n int").withColumn(
        "timestamp", F.to_timestamp("timestamp"))


def test_report_and_removal_agree(copies):
    left = quality.deduplicate(copies, ["n"])
    assert sorted(r["n"] for r in left.collect()) == [1, 3, 4, 5, 6]
    report = {r["source_file"]: r["duplicate_rows"] for r in quality.duplicate_summary(copies).collect()}
    assert report == {"a": 1, "b": 0} and copies.count() - left.count() == sum(report.values())


def test_action_on_duplicates(copies):
    assert quality.handle_duplicates(copies, ["n"]).count() == 6
    removed = quality.handle_duplicates(copies, ["n"], "remove")
    assert removed.count() == 5 and removed.columns == copies.columns
    with pytest.raises(RuntimeError):
        quality.handle_duplicates(copies, ["n"], "error")
    assert quality.handle_duplicates(copies, ["n"], "error", tolerance=0.5).count() == 6
    with pytest.raises(ValueError):
        quality.handle_duplicates(copies, ["n"], "other")


def test_audit_keeps_every_verification(spark, tmp_path):
    one = spark.createDataFrame([(2, 3.0, 1.5, 1.0, 2.0)], "count long, sum double, avg double, min double, max double")
    for _ in range(2):
        tables.append_audit(reconcile.audit_row(one, one, reconcile.reconcile(one, one), "same"), str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 2


def test_verification_sees_a_lost_and_a_doubled_partition(spark, tmp_path, bronze_rows):
    store = ingest.Store(str(tmp_path / "store"), 2)
    for number, source in enumerate(("a.csv", "b.csv")):
        ingest.load_batch(bronze_rows([(source, "t", str(k + 1 + number), "u") for k in range(5)]), number, store, ingest.MAIN)

    def match():
        comparison = reconcile.reconcile(store.state(spark), stats.direct_stats(store.transactions(spark), 2))
        return reconcile.verdict(comparison).first()["overall_match"]

    assert match()
    part = f"{store.rows_path}/phase=main/ingest_batch=1/outcome=kept"
    rows = spark.read.parquet(part).collect()
    again = spark.createDataFrame(rows + rows, spark.read.parquet(part).schema)
    again.write.mode("append").parquet(part)
    assert not match()
    again.limit(2).coalesce(1).write.mode("overwrite").parquet(part)
    assert not match()


def test_refresh_reads_only_the_touched_range(spark, tmp_path):
    rows = spark.range(400).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias("ts"), F.lit(1.0).alias("price"), F.lit("u").alias("user_id"))
    rows.write.parquet(str(tmp_path / "store"))
    store = spark.read.parquet(str(tmp_path / "store"))
    new = store.where("ts >= timestamp'2024-03-05' and ts < timestamp'2024-03-07'")
    again = tables.touched_rows(store, new, "weekly")
    assert again.count() == 7
    plan = again._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert tables.touched_rows(store, store.where("false"), "daily").count() == 0
