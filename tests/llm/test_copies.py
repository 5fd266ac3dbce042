"""Exact copies, similar documents and connected components."""

import random

import brute
import numpy as np
import pytest
from odd_rows import ODD_ROWS, prose, sorted_rows

from ledgerlake.llm import exact_dedup, jaccard_join, mph, queries
from ledgerlake.llm.components import roots

SF = "/root/testdata/sf0.001"


def test_perfect_hash():
    a = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    b = a[::-1] + np.uint64(1)
    sizes, bits = mph.build(a, b)
    assert sorted(mph.slots(sizes, bits, a, b)) == list(range(5000))
    assert mph.slots(*mph.build(a[:0], b[:0]), a[:3], b[:3]).tolist() == [-1, -1, -1]


def want_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, brute.sha(t or "")))
    return out


@pytest.mark.parametrize("per_shard", [4096, 2])
def test_exact_copies_against_history(docs_of, per_shard, monkeypatch):
    monkeypatch.setattr(exact_dedup.build_index, "__defaults__", (per_shard,))
    rows = [(100 + i, f"text {i % 5}") for i in range(40)] + ODD_ROWS
    for cut in (0, 20, len(rows)):
        got = exact_dedup.exact_dedup(docs_of(rows[:cut]), docs_of(rows[cut:]))
        assert sorted_rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want_exact(rows), key=str)


def test_one_row_of_each_text_stays(docs_of):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "b"), (None, "b")]
    docs = docs_of(rows)
    kept = exact_dedup.keep_one_row(docs, exact_dedup.exact_dedup(docs.limit(0), docs))
    assert kept.columns == docs.columns
    assert sorted_rows(kept, "doc_id", "text") == sorted([(2, "a"), (4, ""), (None, "b")], key=str)


def test_similar_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op10_jaccard_join(spark, SF)
    assert sorted_rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.similar_groups(rows), key=str)


def family(seed, n, edits):
    """A text and variants of it, each with some words replaced."""
    base, r = prose(seed, 120).split(), random.Random(seed)
    for k in range(n):
        words = list(base)
        for _ in range(r.randint(0, edits)):
            words[r.randrange(len(words))] = f"w{seed}x{k}x{r.randrange(1000)}"
        yield " ".join(words)


@pytest.mark.parametrize("region, pivots", [(512, 16), (8, 4), (4, 1)])
def test_similar_families(docs_of, monkeypatch, region, pivots):
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    texts = [t for seed in range(4) for t in family(seed, 30, 9)] + [prose(50, 12) + " " + prose(60 + i, 3) for i in range(30)]
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + ODD_ROWS[:18] + ODD_ROWS[19:]
    got = jaccard_join.similar_groups(docs_of(rows), region_size=region)
    want = brute.similar_groups(rows)
    assert sorted_rows(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=str)
    kept = got.where("kept and n_shingles > 0")
    assert kept.count() == kept.select("component_id").distinct().count() == len({w[2] for w in want if w[1]})


def loose_family(seed, n, least, edits):
    """Variants of one text that are all about as far from each other: words replaced, left out or added, and some cut short."""
    base, r = prose(seed, 120).split(), random.Random(seed)
    for k in range(n):
        words = list(base)
        for _ in range(r.randint(least, edits)):
            at, new = r.randrange(len(words)), f"w{r.choice([k, r.randrange(3)])}x{r.randrange(1000)}"
            words[at : at + 1] = r.choice([[new], [new], [], [words[at], new]])
        yield " ".join(words[: r.choice([120] * 9 + [100])])


@pytest.mark.parametrize("region, least", [(40, 1), (40, 4), (10, 1)])
def test_similar_loose_family(docs_of, monkeypatch, region, least):
    counts, squares, cuts = [], [], []
    for name, calls in (("_in_squares", squares), ("_by_new_shingles", cuts)):
        plain = getattr(jaccard_join, name)
        monkeypatch.setattr(jaccard_join, name, lambda *a, f=plain, c=calls: c.append(1) or f(*a))
    plain_roots = jaccard_join.roots
    monkeypatch.setattr(jaccard_join, "roots", lambda edges: counts.append(edges.count()) or plain_roots(edges))
    rows = [(500 - i, t) for i, t in enumerate(loose_family(7 + least, 120, least, 8))]
    got = jaccard_join.similar_groups(docs_of(rows), region_size=region)
    assert sorted_rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.similar_groups(rows), key=str)
    if region == 40:
        assert max(counts) <= 5 * len(rows)  # not one for each pair of members, or of members and pivots
    if region == 40 and least == 1:
        assert cuts and not squares


def test_similarity_at_the_threshold(docs_of):
    word = [f"w{i}" for i in range(60)]
    full = " ".join(word[:16])  # 12 shingles
    exact, below = " ".join(word[:13]), " ".join(word[:12])  # 9 and 8 of them
    rows = [(1, full), (2, exact), (3, below)]
    for pair, linked in (((0, 1), True), ((0, 2), False), ((1, 2), True)):
        got = jaccard_join.similar_groups(docs_of([rows[i] for i in pair])).collect()
        assert (len({r["component_id"] for r in got}) == 1) is linked


def test_no_documents(docs_of):
    none = docs_of([(1, "x")]).where("false")
    assert jaccard_join.similar_groups(none).collect() == []
    assert exact_dedup.exact_dedup(none, none).collect() == []


def test_components(spark):
    r = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x["u"]: x["v"] for x in roots(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
