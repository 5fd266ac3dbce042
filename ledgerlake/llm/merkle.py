"""Merkle manifest of a dataset: leaves, a subtree for each language, one root, and proofs.

H is SHA-256 in lowercase hex of its inputs concatenated, digests as hex text. A leaf is H of the
row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value. In each language
leaves ascend by ``doc_id``; every 8 consecutive nodes become their H as long as there is more
than one. What remains is the subroot; subroots, ordered by language, give the root likewise.

Leaves get their place from range-partitioned slices, never from a window over a language. Then a
task appends 512 aligned leaves one by one to an ``OpenTree``: an open subtree keeps the witnesses
of its members so far, and each sibling that completes extends them. The roots of these blocks are
further appends: they form blocks of 512 again, until one is left, so the number of rounds is the
logarithm of the rows to the base 512. Witnesses are kept once for each subtree and not for each
leaf; the way up from a block's root is joined to the block, not to its leaves, and the whole
witness of a leaf exists only in the task that folds it.

Rows without a language come first and are a language of their own, other than the empty one. In a
language rows without ``doc_id`` come first; rows with the same ``doc_id`` follow each other by
their leaf, and equal rows are leaves each. An empty table has no rows and no root. Columns other
than the fields are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import blocks
from ledgerlake.operators.ordering import slice_in_order, with_position

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
BLOCK_LEVELS = 3
BLOCK = ARITY**BLOCK_LEVELS
_BLOCKS = "key string, block long, digests array<string>, payload binary, root string"
_WAYS = "key string, block long, steps binary, top string"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_PROOFS = pa.schema([(name, kind) for name, kind in zip(
    ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"),
    (pa.int64(), *[pa.string()] * 5, pa.bool_()))])


def leaf(columns: dict[str, Column]) -> Column:
    """The digest of a row whose fields have these values."""

    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(columns[name]) for name in FIELDS]), 256)


def h(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class OpenTree:
    """A tree that grows by appends; levels hold the nodes that are complete so far.

    The members of a complete run share one witness, the run itself: a node's siblings are the
    others in it. A leaf's witness is the list of the runs above it, shared by all leaves below.
    """

    def __init__(self) -> None:
        self.levels: list[list[str]] = [[]]

    def append(self, digest: str, level: int = 0) -> None:
        while True:
            nodes = self.levels[level]
            nodes.append(digest)
            if len(nodes) % ARITY:
                return
            digest, level = h(nodes[-ARITY:]), level + 1
            if level == len(self.levels):
                self.levels.append([])

    def close(self, height: int | None) -> None:
        """No more appends: completes the last run of each level; without ``height`` up to a single node."""
        level = 0
        while level < height if height is not None else len(self.levels[level]) > 1:
            nodes = self.levels[level]
            if level + 1 == len(self.levels):
                self.levels.append([])
            if len(nodes) % ARITY:
                self.append(h(nodes[len(nodes) // ARITY * ARITY :]), level + 1)
            level += 1
        del self.levels[level + 1 :]

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def witness(self, place: int) -> list[tuple[int, list[str]]]:
        """For each level below the root: the place in its run, and the run's other nodes."""
        out = []
        for nodes in self.levels[:-1]:
            run = nodes[place // ARITY * ARITY :][:ARITY]
            out.append((place % ARITY, run[: place % ARITY] + run[place % ARITY + 1 :]))
            place //= ARITY
        return out


def pack_steps(steps: list[tuple[int, list[str]]]) -> bytes:
    return b"".join(bytes([place, len(others)]) + bytes.fromhex("".join(others)) for place, others in steps)


def unpack_steps(data: bytes) -> list[tuple[int, list[str]]]:
    out, at = [], 0
    while at < len(data):
        place, n = data[at], data[at + 1]
        raw = data[at + 2 : at + 2 + 32 * n].hex()
        out.append((place, [raw[i : i + 64] for i in range(0, len(raw), 64)]))
        at += 2 + 32 * n
    return out


def fold(digest: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its witness lead to."""
    for place, others in steps:
        digest = h([*others[:place], digest, *others[place:]])
    return digest


def _tree(digests: list[str], block: int) -> OpenTree:
    """The tree of a block; the first block of a key may be its only one, others never are."""
    tree = OpenTree()
    for d in digests:
        tree.append(d)
    tree.close(BLOCK_LEVELS if block else None)
    return tree


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by("place")
    digests, block = table["digest"].to_pylist(), table["block"][0].as_py()
    payload = pa.BufferOutputStream()
    own = table.drop_columns(["key", "block", "place", "digest"])
    with pa.ipc.new_stream(payload, own.schema) as writer:
        writer.write_table(own)
    row = [[table["key"][0].as_py()], [block], [digests], [payload.getvalue().to_pybytes()], [_tree(digests, block).root]]
    return pa.table([pa.array(v, t) for v, t in zip(row, (pa.string(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.string()))], names=["key", "block", "digests", "payload", "root"])


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each child block the way from its root to the top: the parent's witness, then the parent's own way."""
    for batch in batches:
        rows = []
        for key, block, digests, steps, top in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "digests", "steps", "top"))):
            tree = _tree(digests, block)
            rows += [(key, block * BLOCK + i, pack_steps(tree.witness(i)) + steps, top) for i in range(len(digests))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary(), pa.string()))], names=["key", "block", "steps", "top"])


def appended(nodes: DataFrame) -> DataFrame:
    """Blocks of ``nodes`` (key, place counted from 0, digest, more), each with its way to the top of its key.

    Columns: key, block, digests, payload (the other columns as an Arrow stream), root, steps, top.
    """
    placed = nodes.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))
    built = blocks.stored(placed.groupBy("key", "block").applyInArrow(_build, _BLOCKS), "merkle-blocks")
    if not built.agg(F.max("block")).first()[0]:
        return built.withColumn("steps", F.unhex(F.lit(""))).withColumn("top", F.col("root"))
    parents = appended(built.select("key", F.col("block").alias("place"), F.col("root").alias("digest")))
    ways = blocks.stored(parents.select("key", "block", "digests", "steps", "top").mapInArrow(_ways, _WAYS), "merkle-ways")
    return built.join(ways, ["key", "block"])


def _places(nodes: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    return with_position(slice_in_order(nodes, group, order), group).withColumn("place", F.col("position") - 1).drop("position", "_slice", "_row")


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ("block", "digests", "payload", "steps", "top", "key_steps", "root")
        for block, digests, payload, steps, subroot, key_steps, root in zip(*(batch.column(c).to_pylist() for c in names)):
            own = pa.ipc.open_stream(payload).read_all()
            tree, above, rows = _tree(digests, block), unpack_steps(steps + key_steps), []
            for i, (doc_id, digest, found) in enumerate(zip(own["doc_id"].to_pylist(), digests, own["found"].to_pylist())):
                way = tree.witness(i) + above
                folded = fold(found or digest, way)
                rows.append((doc_id, digest, subroot, root, h([x for _, others in way for x in others]), folded, folded == root))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), _PROOFS.types)], schema=_PROOFS)


def manifest(docs: DataFrame, found: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of ``docs``: its leaf, the roots, its proof, and whether the row as found verifies.

    ``found`` gives fields whose value is now another one; the proof is that of the original leaf.
    """
    fields = {name: F.col(name) for name in FIELDS}
    now = F.nullif(leaf({**fields, **found}), leaf(fields)) if found else F.lit(None).cast("string")
    # null before the empty language, both before others, in the order of UTF-8 bytes
    key = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), leaf(fields).alias("digest"), now.alias("found"))
    trees = blocks.stored(appended(_places(blocks.stored(rows, "leaves"), ["key"], ["doc_id", "digest"])), "merkle-trees")
    subroots = trees.where("block = 0").select(F.col("key").alias("of"), F.col("top").alias("digest"))
    top = appended(_places(subroots, [], ["of"]).withColumn("key", F.lit("")))
    ways = blocks.stored(top.mapInArrow(_key_ways, "key string, key_steps binary, root string"), "merkle-keys")
    joined = trees.drop("root").join(ways, "key")
    return joined.select("block", "digests", "payload", "steps", "top", "key_steps", "root").mapInArrow(_prove, PROOFS)


def _key_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, digests, payload, steps, root in zip(*(batch.column(c).to_pylist() for c in ("block", "digests", "payload", "steps", "top"))):
            tree, keys = _tree(digests, block), pa.ipc.open_stream(payload).read_all()["of"].to_pylist()
            rows = [(k, pack_steps(tree.witness(i)) + steps, root) for i, k in enumerate(keys)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.string()))], names=["key", "key_steps", "root"])
