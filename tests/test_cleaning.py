import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import clean, reconcile, stats
from ledgerlake.operators.quality import (
    deduplicate, duplicate_summary, fill_prices, fill_timestamps, outliers, parsed, quality_checks, quality_gate,
    schema_checks, standard_user, stop_on_failed_checks,
)
from ledgerlake.operators.silver import silver_table, to_silver
from ledgerlake.settings import Feed


def reasons(df):
    return [(r["price"], r["reject_reason"]) for r in clean.judge(df).collect()]


def test_missing_prices_are_rejected(bronze_rows):
    df = bronze_rows([("a.csv", "t", p, "u") for p in ["", "NaN", "NA", None]])
    assert reasons(df) == [(None, "price_null")] * 4


def test_unparseable_price_has_its_own_reason(bronze_rows):
    df = bronze_rows([("a.csv", "t", "abc", "u"), ("a.csv", "t", "3", "u")])
    assert reasons(df) == [(None, "price_not_numeric"), (3.0, None)]
    assert [r["bad_price"] for r in df.collect()] == ["abc", None]


def test_non_positive_prices_in_a_mixed_batch(bronze_rows):
    df = bronze_rows([("a.csv", "t", p, "u") for p in ["-5", "0", "3"]])
    assert [r["price"] for r in clean.kept(df).collect()] == [3.0]
    assert clean.rejected(df).count() == 2


def test_all_non_positive(bronze_rows):
    df = bronze_rows([("a.csv", "t", p, "u") for p in ["-1", "-2"]])
    assert clean.kept(df).count() == 0 and clean.rejected(df).count() == 2


def test_kept_and_rejected_make_all_rows(bronze_rows):
    df = bronze_rows([("a.csv", "t", p, "u") for p in ["1", "-1", "x", "NA", "0", "2"]])
    counts = clean.clean_counts(df).first()
    assert counts["rows_in"] == 6 == counts["rows_kept"] + sum(
        counts[c] for c in ("rejected_null", "rejected_not_positive", "rejected_not_numeric")
    )


def test_nan_never_passes(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (2.0, "a")], "price double, source_file string")
    assert clean.kept(df).count() == 1
    assert clean.judge(df).where("reject_reason = 'price_null'").count() == 1


def test_other_nulls_only_count(bronze_rows):
    df = bronze_rows([("a.csv", None, "1", None), ("a.csv", "t", "2", "u")])
    assert clean.kept(df).count() == 2
    nulls = {r["column_name"]: r["null_count"] for r in clean.null_profile(df, ["timestamp", "price", "user_id"]).collect()}
    assert nulls == {"timestamp": 1, "price": 0, "user_id": 1}


def test_nulls_stay_null_in_the_table(bronze_rows):
    row = clean.to_transactions(bronze_rows([("a.csv", None, "1", None)]), F.lit("b")).first()
    assert row["timestamp"] is None and row["user_id"] is None and row["processing_metadata"] is None


def test_absent_columns(spark):
    assert clean.absent_columns(spark.range(1).withColumn("price", F.lit(1))) == ["timestamp", "user_id"]


def test_empty_input_reconciles(spark, bronze_rows):
    df = bronze_rows([("a.csv", "t", "-1", "u")])
    state = stats.direct_stats(clean.kept(df))
    assert state.first()["count"] == 0 and state.first()["avg"] is None
    assert reconcile.verdict(reconcile.reconcile(state, state)).first()["overall_match"] is True


def state_row(spark, **values):
    base = {"count": 2.0, "sum": 3.0, "avg": 1.5, "min": 1.0, "max": 2.0, **values}
    return spark.createDataFrame([tuple(base[m] for m in reconcile.ALL_METRICS)], ", ".join(f"{m} double" for m in reconcile.ALL_METRICS))


def test_sum_is_reported_but_does_not_decide(spark):
    result = reconcile.reconcile(state_row(spark), state_row(spark, sum=4.0))
    assert reconcile.verdict(result).first()["overall_match"] is True
    assert result.where("metric = 'sum'").first()["difference"] == 1.0


def test_a_difference_fails_and_zero_is_a_number(spark):
    result = reconcile.reconcile(state_row(spark, min=0.0), state_row(spark))
    row = result.where("metric = 'min'").first()
    assert row["matches"] is False and row["difference"] == 1.0
    assert reconcile.verdict(result).first()["overall_match"] is False


def test_two_sources_are_needed(spark):
    one = state_row(spark)
    with pytest.raises(ValueError):
        reconcile.compare_sources({"a": one})
    result = reconcile.compare_sources({"a": one, "b": one, "c": state_row(spark, max=9.0)}).collect()
    assert {(r["source"], r["metric"]) for r in result if not r["matches"]} == {("c", "max")} and len(result) == 8


def test_drift_from_an_empty_state(spark):
    partials = spark.createDataFrame(
        [("validation.csv", 2, 3.0, 1.0, 2.0)],
        "source_file string, rows_processed bigint, batch_sum double, batch_min double, batch_max double",
    )
    row = reconcile.held_out_drift(partials, "validation.csv").first()
    assert (row["count_before"], row["count_added"], row["avg_change"]) == (0, 2, 1.5)
    assert row["new_min"] is True and row["new_max"] is True


def test_equal_extremes_are_not_new(spark):
    partials = spark.createDataFrame(
        [("a.csv", 1, 1.0, 1.0, 1.0), ("validation.csv", 1, 1.0, 1.0, 1.0)],
        "source_file string, rows_processed bigint, batch_sum double, batch_min double, batch_max double",
    )
    row = reconcile.held_out_drift(partials, "validation.csv").first()
    assert row["new_min"] is False and row["new_max"] is False


def test_standard_user(spark):
    df = spark.createDataFrame([(" USER_7 ",), ("7",), ("guest",), (None,)], "u string")
    assert [r[0] for r in df.select(standard_user(F.col("u"))).collect()] == ["user_7", "user_7", "guest", None]


FEED = Feed()


def test_silver_scores_and_identifiers(bronze_rows):
    df = bronze_rows([
        ("a.csv", "2012-05-01T00:00:00", "5", "User_1"), ("a.csv", "2013-05-01T00:00:00", "5", "user_1"),
        ("a.csv", "never", "20000", "guest"), ("a.csv", "2012-05-01T00:00:00", "5", "user_1"),
    ])
    got = to_silver(df, FEED).collect()
    assert [(r["is_valid"], r["quality_score"]) for r in got] == [(True, 1.0), (False, 0.75), (False, 0.0), (True, 1.0)]
    assert got[0]["transaction_id"] == got[3]["transaction_id"] != got[1]["transaction_id"]
    assert silver_table(to_silver(df, FEED)).count() == 3


def test_deduplicate_keeps_the_first(spark):
    rows = [(i, "k" if i % 3 else "z", i * 1.0) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "n int, k string, v double").repartition(4)
    got = {r["k"]: (r["n"], r["v"], r["copies"]) for r in deduplicate(df, ["n"], ["k"]).collect()}
    assert got == {"k": (1, 1.0, 266), "z": (3, 3.0, 133)}


def test_duplicate_tolerance(bronze_rows):
    df = parsed(bronze_rows([("a.csv", "2012-01-01", "1", "u")] * 3 + [("a.csv", "2012-01-01", "2", "u")]))
    row = duplicate_summary(df).first()
    assert (row["duplicate_rows"], row["repeated_keys"], row["tolerated"]) == (2, 1, False)
    assert duplicate_summary(df, tolerance=0.5).first()["tolerated"] is True


def test_outliers(spark):
    df = spark.createDataFrame([(10.0,)] * 50 + [(11.0,)] * 50 + [(500.0,), (None,)], "price double")
    assert [r["price"] for r in outliers(df).where("is_outlier").collect()] == [500.0]


def test_fill_strategies(spark):
    rows = [("a", 1, None), ("a", 2, 4.0), ("a", 3, None), ("a", 4, 8.0), ("a", 5, 9.0), ("a", 6, None), ("b", 1, None)]
    df = spark.createDataFrame(rows, "source_file string, n int, price double")

    def filled(strategy):
        got = fill_prices(df, strategy, ["n"]).orderBy("source_file", "n").collect()
        return [r["filled_price"] for r in got]

    assert filled("median") == [8.0, 4.0, 8.0, 8.0, 9.0, 8.0, None]
    assert filled("mean") == [7.0, 4.0, 7.0, 8.0, 9.0, 7.0, None]
    assert filled("forward_fill") == [None, 4.0, 4.0, 8.0, 9.0, 9.0, None]
    assert filled("backward_fill") == [4.0, 4.0, 8.0, 8.0, 9.0, None, None]
    with pytest.raises(ValueError):
        fill_prices(df, "guess", ["n"])


def test_fill_timestamps(spark):
    rows = [("a", 1, None), ("a", 2, "2012-01-01 00:00:00"), ("a", 3, None), ("a", 4, None), ("a", 5, "2012-01-01 00:03:00"), ("a", 6, None)]
    df = spark.createDataFrame(rows, "source_file string, n int, t string").withColumn("timestamp", F.col("t").cast("timestamp"))
    got = fill_timestamps(df, ["n"]).orderBy("n").select(F.date_format("filled_timestamp", "mm:ss")).collect()
    assert [r[0] for r in got] == ["00:00", "00:00", "01:00", "02:00", "03:00", "03:00"]


def test_quality_report_and_gate(bronze_rows):
    good = bronze_rows([("a.csv", "2012-01-01", "1", "user_1"), ("a.csv", "2012-01-02", "2", "user_2")])
    assert {r["check_result"] for r in quality_checks(good, FEED).collect()} == {"passed"}
    bad = bronze_rows([("a.csv", "2012-01-01", "1", "user_1"), ("a.csv", "2014-01-02", "NA", "guest")])
    got = {r["check_type"]: (r["check_result"], r["details"]) for r in quality_checks(bad, FEED).collect()}
    assert got["null_price"] == ("warning", "1 of 2 rows") and got["duplicates"][0] == "passed"
    assert got["timestamp_range"][0] == "warning" and got["user_id_pattern"][0] == "warning"
    strict = quality_checks(bad, FEED, action="error")
    assert quality_gate(strict).first()["failed"] == 3
    with pytest.raises(RuntimeError):
        stop_on_failed_checks(strict)
    stop_on_failed_checks(quality_checks(good, FEED, action="error"))


def test_schema_checks_cover_all_rows_and_missing_columns(spark, bronze_rows):
    rows = [("a.csv", "t", "1", "u")] * 50 + [("a.csv", "t", "oops", None)]
    got = {r["check_type"]: r["affected_rows"] for r in schema_checks(bronze_rows(rows)).collect()}
    assert got == {"missing_columns": 0, "non_numeric_price": 1, "null_timestamp": 0, "null_price": 0, "null_user_id": 1}
    bare = spark.createDataFrame([("a.csv", "u")], "source_file string, user_id string")
    got = {r["check_type"]: r["check_result"] for r in schema_checks(bare).collect()}
    assert got["missing_columns"] == "failed"
