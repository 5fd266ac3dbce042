"""Merkle manifest and prefix trie against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from odd_rows import ODD_ROWS, sorted_rows
from pyspark.sql import functions as F

from ledgerlake.llm import merkle, prefix_trie
from ledgerlake.llm.queries import op12_merkle, op13_prefix_trie


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """The root, and for each node its siblings level by level."""
    proofs, own, places = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(own) > 1:
        for i, p in enumerate(places):
            run = own[p // 8 * 8 :][:8]
            proofs[i].append((p % 8, run[: p % 8] + run[p % 8 + 1 :]))
        own, places = [h(*own[i : i + 8]) for i in range(0, len(own), 8)], [p // 8 for p in places]
    return own[0] if own else None, proofs


def plain_manifest(rows):
    leaf = lambda r: h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])
    langs = defaultdict(list)
    for r in rows:
        langs[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: plain_tree([x[2] for x in sorted(langs[k])]) for k in order}
    root, ups = plain_tree([trees[k][0] for k in order])
    out = []
    for k, up in zip(order, ups):
        for (_, _, digest, r), way in zip(sorted(langs[k]), trees[k][1]):
            found, way = digest, way + up
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                found = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for p, others in way:
                found = h(*others[:p], found, *others[p:])
            out.append((r[0], digest, trees[k][0], root, h(*[x for _, o in way for x in o]), found, found == root))
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def docs_table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, key string, root string").repartition(3)


@pytest.mark.parametrize("block_levels", [1, 3])
def test_manifest(spark, tmp_path, monkeypatch, block_levels):
    """With blocks of 8 leaves the roots of blocks are appended in several rounds."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(merkle, "BLOCK", 8**block_levels)
    rows = [(i, "src", ("en" if n % 3 else [None, "", "dé", "-", "zz"][n % 5]), None if n % 4 == 0 else n, t) for n, (i, t) in enumerate(ODD_ROWS)]
    rows += [(n, None, "hot", n, f"Text {n}") for n in range(100, 100 + 600)] + [(n, None, "full", n, "A") for n in range(64)]
    docs_table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted_rows(op12_merkle(spark, str(tmp_path)), *COLUMNS) == sorted(plain_manifest(rows), key=str)


def test_manifest_of_few_and_no_rows(spark):
    one = docs_table(spark, [(5, "s", None, 1, "t")])
    assert sorted_rows(merkle.manifest(one), *COLUMNS) == plain_manifest([(5, "s", None, 1, "t")])
    none = merkle.manifest(one.where("false"))
    assert none.collect() == [] and tuple(none.columns) == COLUMNS


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512])
def test_open_tree(n):
    tree, nodes = merkle.OpenTree(), [h(str(i)) for i in range(n)]
    for d in nodes:
        tree.append(d)
    tree.close(None)
    root, proofs = plain_tree(nodes)
    assert tree.root == root and [tree.witness(i) for i in range(n)] == proofs
    assert all(merkle.fold(nodes[i], merkle.unpack_steps(merkle.pack_steps(tree.witness(i)))) == root for i in range(n))


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", h(text or ""), text or ""))
    turns = {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in convs.items()}
    members, last = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        n = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        full = tuple(turns.get(base, [])[:n] + own[n:])
        for d in range(len(full) + 1):
            members[full[:d]].append(c)
        last[full].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = sum(saved[x] for x in children[k]) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)
    return [(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], h(",".join(map(str, sorted(last[k]))))) for k, m in members.items()]


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turns_table(spark, rows):
    return spark.createDataFrame([(*r, "a", 1) for r in rows], "conv_id long, turn long, role string, text string, a string, depth int").repartition(3)


def trie_of(turns, band=prefix_trie.BAND):
    return prefix_trie.trie(prefix_trie.prefixes(prefix_trie.rebuilt(prefix_trie.turns_in_order(turns))), band)


ODD_TURNS = [
    (None, 1, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 3, "user", "é😀"),
    (-7, 0, "user", "minus"), (-7, 1, "assistant", "minus"), (-100, 0, "user", "minus"), (-150, 0, "", "x"), (-150, 1, "", "x"),
    (5000, 0, "r", "alone"), (5001, 0, "r", "alone"), (5002, 0, "r", "alone"), (7, 1, "user", "y" * 50_000),
]


@pytest.mark.parametrize("band", [2, 3, 8])
def test_trie(spark, band):
    """Long conversations, so that several rounds of bands are needed; one holds a third of all rows."""
    rows = ODD_TURNS + [(c, t, "user" if t % 2 else "assistant", f"{t if c % 4 else c}") for c in range(200, 330) for t in range(c % 9)]
    rows += [(400, t, "user", str(t)) for t in range(600)] + [(401, t, "user", str(t)) for t in range(450)] + [(402, t, "user", str(t)) for t in range(5, 90)]
    assert sorted_rows(trie_of(turns_table(spark, rows), band), *TRIE) == sorted(plain_trie(rows), key=str)


def test_trie_of_many_equal_conversations(spark):
    """Their identifiers span several pieces, some of them negative."""
    rows = [(c, t, "user", "hi") for c in range(-9000, 9000, 3) for t in range(7)]
    assert sorted_rows(trie_of(turns_table(spark, rows)), *TRIE) == sorted(plain_trie(rows), key=str)


def test_trie_of_no_rows(spark):
    none = trie_of(turns_table(spark, ODD_TURNS).where("false"))
    assert none.collect() == [] and tuple(none.columns) == TRIE
    assert trie_of(turns_table(spark, [(None, 1, "a", "b")] * 2)).where(F.lit(True)).collect() == []


def test_native_nodes(spark, tmp_path):
    turns_table(spark, ODD_TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    assert op13_prefix_trie(spark, str(tmp_path)).columns == list(TRIE)
