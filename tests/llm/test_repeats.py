"""Operators that remove what occurred before, or what many documents share, against brute force."""

import brute
import pytest
from odd_rows import ODD_ROWS, lines_rows, prose, sorted_rows
from pyspark.sql import functions as F

from ledgerlake.llm import blocks, line_dedup, queries, substring_dedup, suffix_dedup

SF = "/root/testdata/sf0.001"


def sha(text):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


@pytest.fixture(scope="module")
def small(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_words_on_the_given_table(spark, small):
    got = sorted_rows(queries.op2_substring_dedup(spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.repeated_words(small), key=str)


def test_bytes_on_the_given_table(spark, small):
    got = sorted_rows(queries.op4_suffix_dedup(spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.repeated_bytes(small), key=str)


def distinct_ids(rows):
    """One row for each identifier and one without: the order of equal ones is that of storage."""
    seen = {}
    for i, t in rows:
        seen.setdefault(i, (i, t))
    return list(seen.values())


@pytest.mark.parametrize("window, phrase", [(20, 8), (5, 5), (3, 1)])
def test_odd_words(docs_of, window, phrase):
    rows = distinct_ids(ODD_ROWS)
    got = substring_dedup.remove_repeats(docs_of(rows), window, phrase).withColumn("sha", sha("text"))
    assert sorted_rows(got, "doc_id", "n_words", "n_removed", "sha") == sorted(brute.repeated_words(rows, window), key=str)


@pytest.mark.parametrize("length, trigger, crowded", [(100, 32, 1000), (100, 32, 1), (12, 4, 1000), (12, 4, 2), (1, 1, 1000)])
def test_odd_bytes(docs_of, monkeypatch, length, trigger, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    rows = distinct_ids(ODD_ROWS)
    got = suffix_dedup.remove_repeats(docs_of(rows), length, trigger).withColumn("sha", F.sha2("kept", 256))
    want = brute.repeated_bytes(rows, length)
    assert sorted_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == sorted(want, key=str)


def test_zero_bytes_in_texts(docs_of):
    rows = [(1, "a" + "\0" * 40 + "bc" * 9), (2, "\0" * 30 + "a" + "\0" * 40 + "bd" * 9), (3, "a" + "\0" * 7)]
    got = suffix_dedup.remove_repeats(docs_of(rows), 12, 4).withColumn("sha", F.sha2("kept", 256))
    assert sorted_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == sorted(brute.repeated_bytes(rows, 12), key=str)


def test_many_small_blocks_give_the_same(docs_of, monkeypatch):
    rows = [(i, prose(i % 7, 40) + " " + prose(100 + i, 10) + " " + prose(i % 3, 25)) for i in range(60)]
    pack = blocks.packed
    monkeypatch.setattr(blocks, "packed", lambda docs, i, t: pack(docs, i, t, 600))
    got = substring_dedup.remove_repeats(docs_of(rows)).withColumn("sha", sha("text"))
    assert sorted_rows(got, "doc_id", "n_words", "n_removed", "sha") == sorted(brute.repeated_words(rows), key=str)
    got = suffix_dedup.remove_repeats(docs_of(rows)).withColumn("sha", F.sha2("kept", 256))
    assert sorted_rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == sorted(brute.repeated_bytes(rows), key=str)


def test_equal_rows_lose_all_but_one(docs_of):
    rows = [(4, prose(1, 30))] * 3 + [(None, prose(1, 30))]
    got = substring_dedup.remove_repeats(docs_of(rows))
    assert sorted(r["n_removed"] for r in got.collect()) == [0, 30, 30, 30]
    assert sum(r["n_removed"] == 0 for r in suffix_dedup.remove_repeats(docs_of(rows)).collect()) == 1


def test_lines(docs_of):
    rows = lines_rows()
    got = line_dedup.drop_common_lines(docs_of(rows)).withColumn("sha", sha("text"))
    assert sorted_rows(got, "doc_id", "n_lines", "n_dropped", "sha") == sorted(brute.common_lines(rows), key=str)
    got = line_dedup.drop_common_lines(docs_of(rows), min_docs=2, min_chars=5).withColumn("sha", sha("text"))
    assert sorted_rows(got, "doc_id", "n_lines", "n_dropped", "sha") == sorted(brute.common_lines(rows, 2, 5), key=str)


def test_empty_tables(docs_of):
    none = docs_of([(1, "x")]).where("false")
    for out in (substring_dedup.remove_repeats(none), suffix_dedup.remove_repeats(none), line_dedup.drop_common_lines(none)):
        assert out.collect() == []


def test_parameters_are_checked(docs_of):
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(docs_of([]), 5, 6)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs_of([]), 300, 4)
