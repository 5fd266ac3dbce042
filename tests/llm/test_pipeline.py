"""The registered queries against SQL, and the pipeline against its stages done plainly."""

import os

import brute
import duckdb
import pytest
from odd_rows import ODD_ROWS, sorted_rows
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ledgerlake.llm import mixing
from ledgerlake.llm.oracle import ORACLE
from ledgerlake.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert [next(q for q in QUERIES if q.startswith(f"op{n}_")) for n in range(1, 14)] == list(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries()[name](spark, SF)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted_rows(df, *names) == sorted(result.fetchall(), key=str)


def test_stages(spark):
    """Exact and near copies and likelier toxic documents are found by brute force; leaks only may go besides."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    kept = dict(rows)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.blocks.stored(stage(spark, docs, SF), name)
        got = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "exact_copies":
            last = {}
            for i, t in kept.items():
                last[t] = max(i, last.get(t, i))
            kept = {i: t for i, t in kept.items() if last[t] == i}
        elif name == "near_copies":
            groups = brute.similar_groups(list(kept.items()))
            kept = {i: kept[i] for i, n, c in groups if i == c}
        elif name == "benchmark":
            kept = {i: t for i, t in kept.items() if i in got}
        elif name == "mixed":
            labels = [tuple(r) for r in mixing.domain_labels(spark.read.parquet(f"{SF}/labels.parquet")).collect()]
            words = before.select(F.explode(mixing.words_of(F.col("text"))).alias("w")).distinct()
            bucket_of = {r["w"]: r["b"] for r in words.select("w", F.pmod(F.hash("w"), F.lit(mixing.BUCKETS)).alias("b")).collect()}
            toxic = brute.likelier_toxic(list(kept.items()), labels, bucket_of)
            assert toxic
            kept = {i: t for i, t in kept.items() if i not in toxic}
        assert got == set(kept), name
        assert docs.columns[: len(before.columns)] == before.columns
    assert sorted_rows(corpus_pipeline.run(spark, SF), "doc_id", "rate") == sorted_rows(docs, "doc_id", "rate")


def test_odd_rows_pass_all_stages(spark, docs_of):
    docs = docs_of(ODD_ROWS)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.blocks.stored(stage(spark, docs, SF), name)
    assert docs.where("rate <= 0").count() == 0
    none = docs_of([(1, "x")]).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []
