"""Trie of conversation prefixes, with what each shared prefix would save.

A conversation is the sequence of its turns (role, text). Each distinct sequence of its first d
turns is a node of depth d; the conversations that start with it are its members. ``rebuilt``
gives a conversation the head of another one first; ``trie`` makes the nodes.

Prefixes are named without following a conversation turn by turn: a turn and its place give two
64-bit hashes (of the SHA-256 of role and text), and a prefix is the exclusive or of those of its
turns. That is a running value, so a conversation that holds a third of all rows is cut into the
slices of a range-partitioned order, each slice adds up its own turns, and what came before it is
one small row for each slice.

Sums over subtrees go by bands of ``band`` levels. Inside a band the nodes of one smallest member
are added up from below and handed to the ancestors in the same band only, at most ``band`` rows.
The tops of the bands form a tree whose depth is smaller by the factor ``band``, which is solved
in the same way; the completed totals of tops are then handed to the ancestors in the band above.
So neither the rows nor the rounds grow with depth but by its logarithm, and partial aggregation
adds up what a hot prefix receives before anything moves.

Turns are in the order of ``turn``, null first; turns with the same number in that of role and
SHA-256 of the text. Null roles and texts are empty. Rows without ``conv_id`` belong to no
conversation and are left out; repeated rows are turns each. An empty table has no nodes, not even
a root. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.blocks import stored
from ledgerlake.operators.ordering import slice_in_order, with_position

BAND = 8
_ENDS = "depth long, a long, b long, ends_sha256 string"
_PIECE_BITS = 12  # conversations whose identifiers differ in so many bits are named together


def head_length() -> Column:
    """How many turns a conversation takes from another one."""
    return F.crc32(F.col("conv_id").cast("string")) % 6


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), two hashes of role and text, the text's code points, and the slice of the row."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.length(text).cast("long").alias("chars"), digest.alias("digest"), F.sha2(text, 256).alias("of_text"),
    )
    sliced = slice_in_order(stored(rows, "turns"), ["conv_id"], ["turn", "role", "of_text"])
    return with_position(sliced, ["conv_id"]).select(
        "conv_id", F.col("position").alias("place"), half(1).alias("x"), half(16).alias("y"), "chars", F.col("_slice").alias("slice")
    )


def rebuilt(turns: DataFrame, every: int = 100, longest: int = 5) -> DataFrame:
    """Each conversation with its first ``head_length`` turns replaced by those of the one at the hundred below it."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", head_length())
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("place") <= longest)).select(
        F.col("conv_id").alias("base"), F.col("place").alias("depth"), "x", "y", "chars"
    )
    sizes = heads.groupBy("base").agg(F.count(F.lit(1)).alias("size"))
    known = stored(convs.withColumn("base", base).join(sizes, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("size", F.lit(0))).alias("taken")
    ), "heads-taken")
    taken = known.join(heads, "base").where("depth <= h").select("conv_id", F.lit(-1).alias("slice"), "depth", "x", "y", "chars")
    own = turns.join(known, "conv_id").where("place > h").select(
        "conv_id", "slice", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "x", "y", "chars"
    )
    start = known.select("conv_id", F.lit(-2).alias("slice"), F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in "xy"], F.lit(0).cast("long").alias("chars"))
    return start.unionByName(taken).unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """Every (conv_id, depth) with the name (a, b) of its prefix and that of the prefix before it."""
    here = F.col("depth") > 0
    named = turns.select("conv_id", "slice", "depth", "chars", F.when(here, F.xxhash64("depth", "x", "y")).otherwise(0).alias("p"), F.when(here, F.xxhash64("y", "depth", "x", F.lit(7))).otherwise(0).alias("q"))
    inside = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda c, w: F.bit_xor(c).over(w)
    totals = named.groupBy("conv_id", "slice").agg(F.bit_xor("p").alias("p"), F.bit_xor("q").alias("q"))
    carried = totals.select("conv_id", "slice", *[F.coalesce(xor(c, before), F.lit(0)).alias(f"from_{c}") for c in "pq"])
    rows = named.withColumn("_p", xor("p", inside)).withColumn("_q", xor("q", inside)).join(carried, ["conv_id", "slice"])
    a, b = F.col("_p").bitwiseXOR(F.col("from_p")), F.col("_q").bitwiseXOR(F.col("from_q"))
    return rows.select("conv_id", "depth", "chars", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("p")).alias("up_a"), b.bitwiseXOR(F.col("q")).alias("up_b"))


KEY = ["depth", "a", "b"]


def _paths(members: DataFrame, band: int) -> DataFrame:
    """For each conversation and band the names of its prefixes there, at most ``band`` of them."""
    return members.groupBy("conv_id", F.expr(f"depth div {band}").alias("band")).agg(F.array_sort(F.collect_list(F.struct(*KEY))).alias("path"))


def subtree_sums(nodes: DataFrame, members: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """``values`` of each node added up over its subtree.

    ``nodes`` has depth, a, b, the values, and conv_id, the node's smallest member; ``members`` has
    conv_id and the names of all its prefixes.
    """
    paths = stored(_paths(members, band), "band-paths")
    of_band = nodes.groupBy("conv_id", F.expr(f"depth div {band}").alias("band")).agg(F.collect_list(F.struct("depth", *values)).alias("below"))
    total = lambda v: F.aggregate(F.filter("below", lambda x: x["depth"] >= F.col("at.depth")), F.lit(0).cast("long"), lambda s, x: s + x[v])
    inner = of_band.join(paths, ["conv_id", "band"]).select(F.explode("path").alias("at"), "below").select("at.*", *[total(v).alias(v) for v in values])
    sums = lambda df: df.groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values])
    if (members.agg(F.max("depth")).first()[0] or 0) < band:
        return sums(inner)
    part = stored(sums(inner), "band-sums")
    tops = nodes.where(F.col("depth") % band == 0).select(*KEY, "conv_id").join(part, KEY)
    shrunk = lambda df: df.where(F.col("depth") % band == 0).withColumn("depth", F.expr(f"depth div {band}"))
    whole = subtree_sums(stored(shrunk(tops), "band-tops"), stored(shrunk(members.select("conv_id", *KEY)), "band-members"), values, band)
    done = whole.withColumn("depth", F.col("depth") * band).where("depth > 0").join(nodes.select(*KEY, "conv_id"), KEY)
    handed = done.withColumn("band", F.expr(f"depth div {band} - 1")).drop(*KEY).join(paths, ["conv_id", "band"])
    outer = handed.select(F.explode("path").alias("at"), *values).select("at.*", *values)
    return sums(part.unionByName(outer))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by node and place: one digest for each node, read piece by piece."""
    node, digest = None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*node, digest.hexdigest()), (*[pa.int64()] * 3, pa.string()))], names=["depth", "a", "b", "ends_sha256"])
    for batch in batches:
        done = []
        for *key, piece in zip(*(batch.column(c).to_pylist() for c in (*KEY, "piece"))):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append(row())
                node, digest = key, hashlib.sha256()
            digest.update(piece.encode())
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
    if node is not None:
        yield row()


def ends(members: DataFrame) -> DataFrame:
    """For each node at which conversations end the digest of their identifiers, ascending, comma-joined.

    The identifiers are first joined in pieces of bounded size, then a node's pieces are hashed as
    they arrive, so that a node at which most conversations end takes no memory.
    """
    last = members.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("at")).select("conv_id", "at.*")
    pieces = last.groupBy(*KEY, F.shiftright("conv_id", _PIECE_BITS).alias("nr")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("piece")
    )
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "nr").mapInArrow(_digests, _ENDS)


def trie(members: DataFrame, band: int = BAND) -> DataFrame:
    """Nodes of ``prefixes``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    members = stored(members, "prefixes")
    nodes = stored(members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in ("chars", "up_a", "up_b")]
    ), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    full = stored(nodes.join(children, KEY, "left").select(
        *KEY, "up_a", "up_b", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    ), "nodes")
    sums = subtree_sums(full.select(*KEY, "conv_id", "n_leaves", "saved_tokens"), members, ["n_leaves", "saved_tokens"], band)
    parents = full.select(F.col("depth") + 1, F.col("a"), F.col("b"), F.col("conv_id")).toDF("depth", "up_a", "up_b", "parent_conv_id")
    out = full.drop("n_leaves", "saved_tokens").join(sums, KEY).join(parents, ["depth", "up_a", "up_b"], "left").join(ends(members), KEY, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
