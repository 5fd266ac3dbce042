import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import batches, clean, reconcile, stats
from ledgerlake.operators.ordering import slice_in_order, with_neighbours, with_position, with_running
from ledgerlake.operators.quantiles import quantiles

GOLDEN = [
    # The worked example.
    [10.5, 20.3, 15.7, 8.9, 25.1],
    [12.4, 18.6, 22.1, 9.3, 30.0],
    [5.5, 35.2, 28.4, 14.7, 19.8],
]


def priced(spark, rows):
    return spark.createDataFrame(rows, "source_file string, n int, price double")


def test_golden_batches(spark):
    """Three batches of five prices: the worked example with known results."""
    rows = [(f"demo_{i}.csv", j, p) for i, prices in enumerate(GOLDEN, 1) for j, p in enumerate(prices)]
    partials = batches.batch_partials(batches.number_batches(priced(spark, rows), ["n"], 5), 2)
    names = [f"demo_{i}.csv" for i in (1, 2, 3)]
    got = batches.running_history(partials, names, 2).orderBy("batch_seq").collect()
    assert [r["batch_sum"] for r in got] == [80.5, 92.4, 103.6]
    assert [r["running_count_before"] for r in got] == [0, 5, 10]
    assert [r["running_count_after"] for r in got] == [5, 10, 15]
    assert [r["running_avg_after"] for r in got] == pytest.approx([16.1, 17.29, 18.43333333333333])
    assert [r["running_min_after"] for r in got] == [8.9, 8.9, 5.5]
    assert [r["running_max_after"] for r in got] == [25.1, 30.0, 35.2]
    state = stats.merge_partials(partials, 2).first()
    assert (state["count"], state["sum"], state["min"], state["max"]) == (15, 276.5, 5.5, 35.2)


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_any_split_gives_the_same_state(spark, size):
    """Folding partials of any batch size equals one aggregate over all rows."""
    random.seed(size)
    rows = [(random.choice(["a.csv", "b.csv"]), i, round(random.uniform(-5, 50), 2)) for i in range(120)]
    df = priced(spark, rows)
    partials = batches.batch_partials(batches.number_batches(df, ["n"], size), 2)
    both = reconcile.reconcile(stats.merge_partials(partials, 2), stats.direct_stats(clean.kept(df), 2))
    assert all(r["matches"] and r["difference"] == 0.0 for r in both.collect())


def test_numbering_with_one_large_source(spark):
    """One source with most rows is spread over slices and still numbered without gaps."""
    rows = [("big.csv", i, 1.0) for i in range(5000)] + [(f"s{i}.csv", 0, 1.0) for i in range(5)]
    random.seed(1)
    random.shuffle(rows)
    sliced = slice_in_order(priced(spark, rows), ["source_file"], ["n"])
    assert sliced.where("source_file = 'big.csv'").select("_slice").distinct().count() > 1
    placed = with_position(sliced, ["source_file"]).collect()
    assert all(r["position"] == r["n"] + 1 for r in placed) and len(placed) == len(rows)


def test_hot_source_is_cut_into_even_slices(spark):
    """A source with a third of all rows, and one range per task all the same."""
    n = 60000
    source = F.when(F.col("id") % 3 == 0, "hot.csv").otherwise(F.concat((F.col("id") % 50).cast("string"), F.lit(".csv")))
    df = spark.range(n).select(source.alias("source_file"), "id")
    sizes = [r["count"] for r in slice_in_order(df, ["source_file"], ["id"]).groupBy("_slice").count().collect()]
    assert sum(sizes) == n and len(sizes) == 4 and max(sizes) < 1.6 * n / 4


def test_history_blocks_do_not_change_results(spark):
    random.seed(3)
    rows = [(random.choice(["a.csv", "b.csv", "c.csv"]), i, round(random.uniform(1, 9), 2)) for i in range(400)]
    partials = batches.batch_partials(batches.number_batches(priced(spark, rows), ["n"], 5), 2)
    names = ["b.csv", "a.csv", "c.csv"]
    one = batches.running_history(partials, names, 2).orderBy("batch_seq").collect()
    many = batches.running_history(partials, names, 2, block=3).orderBy("batch_seq").collect()
    assert one == many
    assert [r["batch_seq"] for r in one] == list(range(1, len(one) + 1))
    ordered = [(r["source_file"], r["batch_number"]) for r in one]
    assert ordered == sorted(ordered, key=lambda k: (names.index(k[0]), k[1]))


def test_batch_without_kept_rows_changes_nothing(spark):
    rows = [("a.csv", i, p) for i, p in enumerate([1.0, 2.0, -1.0, -2.0, 3.0, 4.0])]
    partials = batches.batch_partials(batches.number_batches(priced(spark, rows), ["n"], 2))
    got = batches.running_history(partials, ["a.csv"]).orderBy("batch_number").collect()
    assert [(r["rows_processed"], r["rows_rejected"], r["running_count_after"]) for r in got] == [(2, 0, 2), (0, 2, 2), (2, 0, 4)]
    assert got[1]["batch_avg"] is None and got[1]["running_max_after"] == 2.0
    metrics = batches.engine_metrics(partials).first()
    assert (metrics["total_batches_processed"], metrics["avg_batch_size"]) == (2, 2.0)


def test_snapshot_comes_before_its_batch(spark):
    rows = [("a.csv", i, float(i + 1)) for i in range(4)]
    partials = batches.batch_partials(batches.number_batches(priced(spark, rows), ["n"], 2))
    got = batches.snapshots(batches.running_history(partials, ["a.csv"])).orderBy("batch_number").collect()
    assert got[0]["stats_snapshot"] == '{"count":0,"sum":null,"min":null,"max":null,"avg":null}'
    assert got[1]["stats_snapshot"] == '{"count":2,"sum":3.0,"min":1.0,"max":2.0,"avg":1.5}'


def test_stored_rows_are_numbered_without_gaps(spark, tmp_path, bronze_rows):
    from ledgerlake.sinks.tables import write_bronze
    from ledgerlake.sources.parquetfiles import stored_rows

    rows = [("a.csv" if i % 3 else "b.csv", None, str(i + 1), "u") for i in range(230)]
    path = str(tmp_path / "bronze")
    write_bronze(bronze_rows(rows).repartition(4), path)
    stored = stored_rows(spark, path)
    sizes = batches.number_stored_batches(stored, 10).groupBy("source_file", "batch_number").count().collect()
    for source, total in (("a.csv", 153), ("b.csv", 77)):
        by_number = {r["batch_number"]: r["count"] for r in sizes if r["source_file"] == source}
        full, rest = divmod(total, 10)
        assert by_number == {**{n: 10 for n in range(1, full + 1)}, full + 1: rest}
    slices = batches.stored_slice_partials(stored, 2, 10)
    for source, total in (("a.csv", 153), ("b.csv", 77)):
        mine = slices.where(F.col("source_file") == source).collect()
        assert sum(r["rows_in"] for r in mine) == total
        assert sorted(r["batch_number"] for r in mine) == list(range(1, len(mine) + 1))
        assert max(r["rows_in"] for r in mine) <= 10
    assert stats.merge_partials(slices, 2).first()["sum"] == sum(range(1, 231))


def brute(rows):
    groups = {}
    for g, n, v in sorted(rows, key=lambda r: (r[0], r[1])):
        groups.setdefault(g, []).append((n, v))
    return groups


def test_running_and_neighbours_against_brute_force(spark):
    random.seed(5)
    rows = [(random.choice("aab"), i, None if random.random() < 0.6 else float(random.randint(1, 9))) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, n int, v double")
    sliced = slice_in_order(df, ["g"], ["n"])
    near = {(r["g"], r["n"]): r for r in with_neighbours(sliced, ["g"], F.col("v"), "x").collect()}
    ran = {(r["g"], r["n"]): r["running"] for r in with_running(sliced.fillna(0.0, ["v"]), ["g"], "v").collect()}
    for g, items in brute(rows).items():
        total = 0.0
        for i, (n, v) in enumerate(items):
            total += v or 0.0
            assert ran[g, n] == total
            before = [x for _, x in items[: i + 1] if x is not None]
            after = [x for _, x in items[i:] if x is not None]
            assert near[g, n]["x_before"] == (before[-1] if before else None)
            assert near[g, n]["x_after"] == (after[0] if after else None)


def test_quantiles_against_numpy(spark):
    import numpy as np

    random.seed(6)
    rows = [(random.choice("aaab"), float(random.choice([1, 1, 1, 2, 3.5, 9]) if random.random() < 0.5 else random.random()))
            for _ in range(501)] + [("one", 4.0), ("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    assert "none" not in got
    for g in ("a", "b", "one"):
        values = [v for k, v in rows if k == g and v is not None]
        for point in (0.0, 0.25, 0.5, 0.9, 1.0):
            assert got[g][f"q_{point:g}".replace(".", "_")] == pytest.approx(np.quantile(values, point))
    whole = quantiles(df, [], "v", [0.5]).first()["q_0_5"]
    assert whole == pytest.approx(np.median([v for _, v in rows if v is not None]))


def test_history_cap_and_last_batch(spark):
    rows = [("a.csv", i, float(i + 1)) for i in range(10)]
    partials = batches.batch_partials(batches.number_batches(priced(spark, rows), ["n"], 1))
    history = batches.running_history(partials, ["a.csv"])
    assert sorted(r["batch_seq"] for r in batches.recent_history(history, 3).collect()) == [8, 9, 10]
    assert batches.last_batch(history).first()["batch_number"] == 10
    assert [r["batch_number"] for r in batches.progress(history).orderBy("batch_number").collect()] == [5, 10]


def test_quantiles_of_many_values_are_narrowed(spark):
    """Brackets that hold more values than one task should rank are cut in bins, several times."""
    import numpy as np

    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("g"), (F.xxhash64("id") % 1_000_003 / F.lit(7.0)).alias("v"))
    values = {"hot": [], "cold": []}
    for g, v in df.collect():
        values[g].append(v)
    got = {r["g"]: r for r in quantiles(df, ["g"], "v", [0.01, 0.5, 0.999], few=5).collect()}
    for g, own in values.items():
        for point in (0.01, 0.5, 0.999):
            assert got[g][f"q_{point:g}".replace(".", "_")] == pytest.approx(np.quantile(own, point))


def test_quantiles_whose_bracket_missed_are_still_exact(spark, monkeypatch):
    import numpy as np

    from ledgerlake.operators import quantiles as module

    monkeypatch.setattr(module, "ACCURACY", 3)
    df = spark.range(999).select(F.col("id").cast("double").alias("v"))
    assert module.quantiles(df, [], "v", [0.37], few=7).first()["q_0_37"] == pytest.approx(np.quantile(np.arange(999), 0.37))


def test_quantiles_do_not_sort_rows(spark):
    df = spark.range(1000).select((F.col("id") % 5).cast("string").alias("source_file"), F.col("id").cast("double").alias("price"))
    plan = quantiles(df, ["source_file"], "price", [0.25, 0.5])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
