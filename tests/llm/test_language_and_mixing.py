"""Classifiers and mixing: held-out accuracy, and the solution against a dense solver."""

import base64

import numpy as np
import pytest
from odd_rows import CLASHING, ODD_ROWS, sorted_rows
from pyspark.sql import functions as F

from ledgerlake.llm import language_id, mixing, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op1_language_id(spark, SF).withColumnRenamed("held_out", "_held_out")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["_held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "fr", "es"} for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.002 * len(rows)


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = docs.where(~queries.held_out())
    spoiled = docs.withColumn("lang", F.when(queries.held_out(), "zz").otherwise(F.col("lang"))).where(~queries.held_out())
    a, b = language_id.train(learned), language_id.train(spoiled)
    assert a.languages == b.languages and np.array_equal(a.centroids, b.centroids)


@pytest.fixture(scope="module")
def model(spark):
    return language_id.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_texts_without_letters_and_odd_columns(docs_of, model):
    rows = [(1, None), (2, ""), (3, "12 34 -- ##"), (4, "of the and that"), (None, "of the and that"), (4, "of the and that")]
    got = language_id.classify(docs_of(rows), model)
    assert set(got.columns) == {"doc_id", "text", "lang", "source", *CLASHING, "lang_pred", "rejected"}
    assert sorted_rows(got.where("rejected"), "doc_id", "lang_pred", "score") == [(i, "und", 0.0) for i in (1, 2, 3)]
    assert got.where("lang_pred = 'en'").count() == 3
    kept = language_id.accepted(docs_of(rows), model)
    assert kept.columns == docs_of(rows).columns and kept.count() == 3
    assert language_id.classify(docs_of(ODD_ROWS), model).count() == len(ODD_ROWS)


def test_far_texts_are_rejected(docs_of, model):
    far = ["qzx qwk jjx vvq zzk wqx xkq", "Это русский текст", "日本語の文章です"]
    got = language_id.classify(docs_of([(i, t) for i, t in enumerate(far)]), model)
    assert got.where("rejected").count() == len(far)


def test_nothing_to_learn(docs_of):
    docs = docs_of([(1, "some text"), (2, None)])
    empty = language_id.train(docs.where("false"))
    assert sorted_rows(language_id.classify(docs, empty), "doc_id", "lang_pred", "score") == [(1, "und", 0.0), (2, "und", 0.0)]
    assert language_id.classify(docs.where("false"), empty).collect() == []


def test_expected_words_meet_the_targets(spark):
    got = queries.op7_mixing(spark, SF).toPandas()
    total = got["n_words"].sum()
    assert (got["rate"] >= 0).all()
    for domain, share in mixing.TARGETS.items():
        assert abs((got["rate"] * got["n_words"] * got[f"p_{domain}"]).sum() / total - share) < 1e-3
    assert np.allclose(got[[f"p_{d}" for d in mixing.TARGETS]].sum(axis=1), 1)


def test_classifier_on_labelled_rows(spark):
    got = queries.op7_mixing(spark, SF)
    labels = mixing.domain_labels(spark.read.parquet(f"{SF}/labels.parquet"))
    best = F.greatest("p_good", "p_low", "p_toxic")
    guess = F.when(F.col("p_toxic") == best, "toxic").when(F.col("p_low") == best, "low").otherwise("good")
    right = got.join(labels, "doc_id").agg(F.avg((guess == F.col("domain")).cast("double"))).first()[0]
    assert right > 0.85


def solved(n, p, targets, rounds=20000):
    """Plain projected gradient."""
    n, p, r = np.array(n, float), np.array(p, float), np.ones(len(n))
    step = 1 / np.linalg.norm((p * n[:, None]).T @ p, 2)
    for _ in range(rounds):
        r = np.maximum(0, r - step * (p @ ((r * n) @ p - targets)))
    return r


@pytest.mark.parametrize("shares, slack", [((0.5, 0.5), 1e-3), ((0.9, 0.1), 1e-3), ((0.02, 0.98), 5e-3), ((1.0, 0.0), 2e-2)])
def test_solver_against_plain_gradient(spark, shares, slack):
    """The last targets cannot be reached by any rates."""
    rng = np.random.default_rng(5)
    a = rng.random(40)
    n = rng.integers(0, 50, 40)
    rows = [(i, int(x), float(y), float(1 - y)) for i, (x, y) in enumerate(zip(n, a))]
    weighted = spark.createDataFrame(rows, "doc_id long, n_words long, p_x double, p_y double")
    targets = np.array(shares) * n.sum()
    history = mixing.solve(weighted, dict(zip("xy", targets)))
    got = [r["rate"] for r in weighted.withColumn("rate", mixing._rate(["x", "y"], history)).orderBy("doc_id").collect()]
    p = np.stack([a, 1 - a], axis=1)
    want = solved(n, p, targets)
    off = lambda r: (((np.array(r) * n) @ p - targets) ** 2).sum() ** 0.5 / n.sum()
    assert min(got) >= 0 and off(got) <= off(want) + slack


def test_mixing_odd_rows(docs_of, spark):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 0), (9, 0, 1), (9, 0, 1), (None, 1, 0), (77, None, None)], "doc_id long, quality int, toxic int")
    got = mixing.with_rates(docs_of(ODD_ROWS), mixing.domain_labels(labels))
    assert got.count() == len(ODD_ROWS) and got.where("rate < 0 or rate is null or n_words is null").count() == 0
    assert [r["n_words"] for r in got.where("doc_id in (1, 2, 3)").collect()] == [0, 0, 0]
    unlabelled = mixing.rates(docs_of(ODD_ROWS), mixing.domain_labels(labels).where("false"))
    assert unlabelled.select("p_good").distinct().count() == 1
    assert mixing.rates(docs_of([(1, "x")]).where("false"), mixing.domain_labels(labels)).collect() == []


def test_mixing_runs_no_python(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    plan = mixing.with_rates(docs, mixing.domain_labels(labels))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_a_filter_on_rates_does_not_repeat_the_scoring(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rated = mixing.with_rates(docs, mixing.domain_labels(labels)).where("rate > 0")
    plan = rated._jdf.queryExecution().executedPlan().toString()
    assert plan.count("aggregate(") == len(mixing.TARGETS)


def test_long_far_texts_are_rejected_and_clean_ones_stay(spark, docs_of, model):
    """Many trigrams share the buckets, so long texts of any kind are nearer than short ones."""
    rng = np.random.default_rng(3)
    words = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(2000))
    turkish = "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. "
    with open(language_id.__file__) as f:
        code = f.read()
    far = [words, rng.bytes(5000).hex(), base64.b64encode(rng.bytes(6000)).decode(), code, turkish * 40, words[:1500]]
    assert language_id.classify(docs_of(list(enumerate(far))), model).where("not rejected").count() == 0
    clean = spark.read.parquet(f"{SF}/documents.parquet")
    assert language_id.accepted(clean, model).count() >= 0.999 * clean.count()
    short = [(i, t) for i, t in enumerate(["Of the.", "Die tz.", "Avec une.", "En los."])]
    assert language_id.accepted(docs_of(short), model).count() == len(short)


def test_planted_toxic_documents_go_and_clean_ones_stay(spark, docs_of):
    """Toxic text is 1 % of the words; some clean documents hold a toxic word."""
    words = {"good": "calm river stone garden", "low": "click offer cheap winner", "toxic": "awful nasty vile hateful"}
    kinds = ["toxic"] * 3 + ["low"] * 57 + ["good"] * 240
    rows = [(i, f"{words[k]} " * 5 + ("vile" if i >= 290 else "")) for i, k in enumerate(kinds)]
    labels = spark.createDataFrame([(i, int(k == "good"), int(k == "toxic")) for i, k in enumerate(kinds)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["rate"] for r in mixing.with_rates(docs_of(rows), mixing.domain_labels(labels)).collect()}
    assert [i for i, rate in sorted(got.items()) if rate <= 0] == [0, 1, 2]


def test_digits_and_fractions_are_no_letters(spark, docs_of):
    model = language_id.train(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.classify(docs_of([(1, "10²"), (2, "½ ① 7"), (3, "_ —"), (4, None)]), model).collect()}
    assert got == {n: ("und", 0.0) for n in (1, 2, 3, 4)}
