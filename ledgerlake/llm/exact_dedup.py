"""Exact deduplication against history, by a minimal perfect hash over its distinct digests.

``build_index`` turns the digests of everything seen so far into shards: a minimal perfect hash
whose slots hold the whole SHA-256 digest, the locator of the winner and the group's size.
``look_up`` sends the distinct digests of new rows to the shards. The hash gives any digest some
slot, so the digest there is compared byte by byte: members update the winner and the size of
their slot, nonmembers are groups of their own. ``exact_dedup`` then tells every row its group.

Texts are equal when they are identical; null counts as empty. The row with the largest
``doc_id`` stays. Rows without ``doc_id`` stay only if no equal row has one. Rows that agree in
``doc_id`` and text are one document written twice: all are marked as kept, and
``keep_one_row`` leaves one of them. Other columns are not read. Empty tables give empty results.

A digest that a third of all rows share is one row after the first, partial aggregation. The
last join is a join of (doc_id, digest) with the groups, whose skewed keys adaptive execution
splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import blocks, mph

DIGESTS_PER_SHARD = 4096
_GROUPS = "digest binary, keep_id long, group_size long"
_INDEX = "shard int, n_slots long, arrays binary"


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digests as rows of four numbers, winners, missing winners, sizes."""
    raw = b"".join(table["digest"].to_pylist())
    keep = table["keep_id"].combine_chunks()
    return (
        np.frombuffer(raw, dtype=np.uint64).reshape(-1, 4), keep.fill_null(0).to_numpy(zero_copy_only=False),
        keep.is_null().to_numpy(zero_copy_only=False), table["group_size"].to_numpy(),
    )


def _table(key: np.ndarray, keep: np.ndarray, none: np.ndarray, size: np.ndarray) -> pa.Table:
    raw = np.ascontiguousarray(key).tobytes()
    binary = pa.array([raw[i : i + 32] for i in range(0, len(raw), 32)], pa.binary())
    return pa.table({"digest": binary, "keep_id": pa.array(keep, pa.int64(), mask=none), "group_size": pa.array(size, pa.int64())})


def _build(table: pa.Table) -> pa.Table:
    key, keep, none, size = _columns(table)
    sizes, bits = mph.build(key[:, 0], key[:, 1])
    order = np.argsort(mph.slots(sizes, bits, key[:, 0], key[:, 1]))
    arrays = blocks.zip_arrays(sizes, bits, key[order].reshape(-1), keep[order], none[order].astype(np.uint8), size[order])
    return pa.table({"shard": table["shard"][:1], "n_slots": pa.array([len(key)], pa.int64()), "arrays": pa.array([arrays], pa.binary())})


def _merge(index: pa.Table, new: pa.Table) -> pa.Table:
    if not index.num_rows:
        return new.select(["digest", "keep_id", "group_size"])
    sizes, bits, slot_key, slot_keep, slot_none, slot_size = blocks.unzip_arrays(index["arrays"][0].as_py())
    slot_key = slot_key.reshape(-1, 4)
    if not new.num_rows:
        return _table(slot_key, slot_keep, slot_none == 1, slot_size)
    key, keep, none, size = _columns(new)
    slot = mph.slots(sizes, bits, key[:, 0], key[:, 1])
    member = (slot >= 0) & (slot_key[slot] == key).all(axis=1)
    at = slot[member]  # each slot at most once: the new digests are distinct
    least = np.iinfo(np.int64).min
    slot_keep, slot_size = np.where(slot_none == 1, least, slot_keep), slot_size.copy()
    slot_keep[at] = np.maximum(slot_keep[at], np.where(none, least, keep)[member])
    slot_none = (slot_none == 1)
    slot_none[at] &= none[member]
    slot_size[at] += size[member]
    rest = ~member
    return pa.concat_tables([_table(slot_key, slot_keep, slot_none, slot_size), _table(key[rest], keep[rest], none[rest], size[rest])])


def build_index(history: DataFrame, per_shard: int = DIGESTS_PER_SHARD) -> DataFrame:
    """``history`` is what ``digests`` returns. The index is written; its shards fit in memory each."""
    groups = blocks.stored(_groups(history), "digest-groups")
    shards = 1 + groups.count() // per_shard
    return blocks.stored(_sharded(groups, shards).groupBy("shard").applyInArrow(_build, _INDEX).withColumn("shards", F.lit(shards)), "digest-index")


def look_up(index: DataFrame, incoming: DataFrame, per_shard: int = DIGESTS_PER_SHARD) -> DataFrame:
    """All groups after ``incoming``: members merged into their slots, nonmembers apart."""
    first = index.select("shards").first()
    if first is None:  # nothing seen before
        return _groups(incoming)
    new = _sharded(_groups(incoming), first[0])
    return index.groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(_merge, _GROUPS)


def exact_dedup(history: DataFrame, incoming: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of both tables: doc_id, keep_id, group_size, kept, text_sha256."""
    old = blocks.stored(digests(history, id_column, text_column), "digests")
    new = blocks.stored(digests(incoming, id_column, text_column), "digests")
    groups = look_up(build_index(old), new)
    return old.unionByName(new).join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one_row(docs: DataFrame, decisions: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and one row for each document."""
    kept = decisions.where("kept").select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha")).distinct()
    rows = docs.withColumn("__sha", F.sha2(F.coalesce(F.col(text_column).cast("string"), F.lit("")), 256))
    same = F.col("__sha").eqNullSafe(F.col("__kept_sha")) & rows[id_column].cast("long").eqNullSafe(F.col("__kept_id"))
    return rows.join(kept, same, "left_semi").dropDuplicates([id_column, "__sha"]).select(*docs.columns)
