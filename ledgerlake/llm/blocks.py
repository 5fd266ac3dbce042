"""Blocks of documents, and questions that blocks ask each other.

Operators that compare every passage with every other one work in rounds. Documents are packed
once, without a shuffle, into compressed rows of a few megabytes (``packed``), which lie in the
shared folder. In a round each block sends what it wants to know, one row for each shard that
has to answer (``Mail``); a shard sees the question of all blocks about its keys and answers
each of them; the answers meet the block again by a cogroup on its number.

A block asks about each distinct key once, so a key that a third of all rows hold reaches its
shard once for each block and not once for each row. Shards are ranges of a hash, so distinct
keys spread evenly; their number follows the size of the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20
MOST_DOCS = 1 << 15  # so that 16 bits number the documents of a block
BYTES_PER_SHARD = 16 << 20
PACKED = "block long, n_docs int, n_bytes long, raw_bytes long, payload binary"
LETTER = "block long, shard int, data binary"
_PACKED = pa.schema([("block", pa.int64()), ("n_docs", pa.int32()), ("n_bytes", pa.int64()), ("raw_bytes", pa.int64()), ("payload", pa.binary())])
_LETTER = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("data", pa.binary())])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder, in small row groups, so that large rows spread over tasks."""
    from ledgerlake.workspace import fresh_path  # only the driver needs it

    path = fresh_path(df.sparkSession, name)
    df.write.option("parquet.block.size", 8 << 20).option("parquet.page.size.row.check.min", 4).option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` wrote, once nothing will read them again."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def zip_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value."""
    head = np.array([x for a in arrays for x in (ord(a.dtype.char), len(a))], dtype=np.int64)
    raw = b"".join([np.int64(len(arrays)).tobytes(), head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(raw, asbytes=True)


def unzip_arrays(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd")
    raw = np.frombuffer(raw, dtype=np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    head, at, out = raw[8 : 8 + 16 * n].view(np.int64), 8 + 16 * n, []
    for kind, size in head.reshape(-1, 2):
        dtype = np.dtype(chr(kind))
        out.append(np.frombuffer(raw[at : at + size * dtype.itemsize].tobytes(), dtype=dtype))
        at += size * dtype.itemsize
    return out


class Block:
    """Documents in storage order: ``ids``, their bytes in ``data`` at [starts, ends).

    A line break stands behind each document, so that words never run from one into the next.
    """

    def __init__(self, ids, no_id, no_text, ends, data):
        self.ids, self.no_id, self.no_text, self.ends, self.data = ids, no_id, no_text, ends, data
        self.starts = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64) if len(ends) else ends

    def __len__(self) -> int:
        return len(self.ids)

    @classmethod
    def of(cls, raw_bytes: int, payload: bytes) -> Block:
        ids, no_id, no_text, ends, data = unzip_arrays(payload)
        return cls(ids, no_id.view(bool), no_text.view(bool), ends, data)

    def pack(self) -> bytes:
        return zip_arrays(self.ids, self.no_id.view(np.uint8), self.no_text.view(np.uint8), self.ends, self.data)

    @property
    def keys(self) -> np.ndarray:
        """What orders documents: the identifier, without one last."""
        return np.where(self.no_id, np.iinfo(np.int64).max, self.ids)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def id_list(self) -> pa.Array:
        return pa.array(self.ids, mask=self.no_id)


def texts_of(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, bytes and null flags of a string column."""
    strings = batch.column(column).cast(pa.large_string())
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets, data, strings.is_null().to_numpy(zero_copy_only=False)


def _block(ids, no_id, no_text, parts) -> Block:
    order = np.lexsort((np.array(ids), np.array(no_id)))  # so that the first copy in a block is the earliest one
    sizes = np.array([len(parts[i]) for i in order], dtype=np.int64)
    line = np.array([10], dtype=np.uint8)
    data = np.concatenate([x for i in order for x in (parts[i], line)])
    pick = lambda x, kind: np.array(x, dtype=kind)[order]
    return Block(pick(ids, np.int64), pick(no_id, bool), pick(no_text, bool), np.cumsum(sizes + 1) - 1, data)


def _pack(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    ids, no_id, no_text, parts, size = [], [], [], [], 0

    def flush():
        nonlocal number, ids, no_id, no_text, parts, size
        block = _block(ids, no_id, no_text, parts)
        payload = block.pack()
        row = [[number], [len(block)], [size], [len(block.data)], [payload]]
        number, ids, no_id, no_text, parts, size = number + 1, [], [], [], [], 0
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _PACKED.types)], schema=_PACKED)

    for batch in batches:
        offsets, data, null = texts_of(batch, 1)
        own = batch.column(0)
        here, missing = own.fill_null(0).to_numpy(zero_copy_only=False), own.is_null().to_numpy(zero_copy_only=False)
        for i in range(batch.num_rows):
            ids.append(here[i])
            no_id.append(missing[i])
            no_text.append(null[i])
            parts.append(data[offsets[i] : offsets[i + 1]].copy())
            size += int(offsets[i + 1] - offsets[i])
            if size >= limit or len(ids) >= MOST_DOCS:
                yield flush()
    if ids:
        yield flush()


def packed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of whole documents, written once; a document longer than a block is a block of its own."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return stored(rows.mapInArrow(lambda batches: _pack(block_bytes, batches), PACKED), "blocks")


def shards_for(blocks: DataFrame, bytes_per_shard: int = BYTES_PER_SHARD) -> int:
    """How many shards answer; follows the size of the input."""
    size = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return 16 + size // bytes_per_shard


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def letters(block: int, shard: np.ndarray, columns: list[np.ndarray]) -> list[tuple[int, int, bytes]]:
    """One letter for each shard, with the rows of ``columns`` (sorted by shard) that go there."""
    cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True]))) if len(shard) else np.empty(0, int)
    return [(block, int(shard[a]), b"".join([int(b - a).to_bytes(4, "little"), *(c[a:b].tobytes() for c in columns)])) for a, b in zip(cuts, cuts[1:])]


def open_letter(data: bytes, types: list) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:4], "little"), 4, []
    for t in map(np.dtype, types):
        out.append(np.frombuffer(data, dtype=t, count=n, offset=at))
        at += n * t.itemsize
    return out


def letter_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.table([pa.array(v, t) for v, t in zip(columns, _LETTER.types)], schema=_LETTER)


def asked(blocks: DataFrame, ask: Callable[[int, Block], list[tuple[int, int, bytes]]]) -> DataFrame:
    """The letters of all blocks; ``ask(number, block)`` makes those of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw, payload in zip(*(batch.column(i) for i in range(3))):
                yield from letter_table(ask(number.as_py(), Block.of(raw.as_py(), payload.as_py()))).to_batches()

    return blocks.select("block", "raw_bytes", "payload").mapInArrow(run, LETTER)


class Inbox:
    """All letters that one shard got, joined column by column."""

    def __init__(self, table: pa.Table, types: list):
        # in the order of the blocks, whatever order the shuffle brought them in
        order = np.argsort(table["block"].to_numpy(), kind="stable")
        self.blocks = table["block"].to_numpy()[order]
        self.shard = table["shard"][0].as_py()
        opened = [open_letter(table["data"][int(i)].as_py(), types) for i in order]
        self.sizes = np.array([len(x[0]) for x in opened], dtype=np.int64)
        self.columns = [np.concatenate([x[k] for x in opened]) for k in range(len(types))]
        self.sender = np.repeat(np.arange(len(opened)), self.sizes)

    def answers(self, *columns: np.ndarray) -> pa.Table:
        """The same number of rows back to each sender."""
        cuts = np.concatenate(([0], np.cumsum(self.sizes)))
        rows = [(int(block), self.shard, b"".join([int(b - a).to_bytes(4, "little"), *(c[a:b].tobytes() for c in columns)])) for block, a, b in zip(self.blocks, cuts, cuts[1:])]
        return letter_table(rows)


def answered(mail: DataFrame, types: list, answer: Callable[[Inbox], pa.Table]) -> DataFrame:
    """Each shard reads its letters together."""
    return mail.groupBy("shard").applyInArrow(lambda table: answer(Inbox(table, types)), LETTER)


def replies(table: pa.Table, types: list) -> list[np.ndarray]:
    """A block's answers, in the order in which it asked: by shard."""
    if not table.num_rows:
        return [np.empty(0, t) for t in types]
    order = np.argsort(table["shard"].to_numpy(), kind="stable")
    opened = [open_letter(table["data"][int(i)].as_py(), types) for i in order]
    return [np.concatenate([x[k] for x in opened]) for k in range(len(types))]


def with_answers(blocks: DataFrame, mail: DataFrame, work: Callable[[int, Block, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Blocks with what they were told; ``work(number, block, letters)`` makes the rows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        number, block = left["block"][0].as_py(), Block.of(left["raw_bytes"][0].as_py(), left["payload"][0].as_py())
        return work(number, block, right)

    pair = blocks.select("block", "raw_bytes", "payload").groupBy("block").cogroup(mail.groupBy("block"))
    return pair.applyInArrow(run, schema)


def state_row(block: int, *arrays: np.ndarray) -> tuple[int, int, bytes]:
    """What a block keeps for its next round, among its letters."""
    return block, -1, zip_arrays(*arrays)


def split_state(table: pa.Table) -> tuple[list[np.ndarray], pa.Table]:
    """The kept arrays and the other letters."""
    own = table["shard"].to_numpy() < 0
    return unzip_arrays(table["data"][int(np.flatnonzero(own)[0])].as_py()), table.filter(pa.array(~own))


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    turns = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return turns[::2], turns[1::2]


def covered(size: int, starts: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Which of ``size`` places some run [start, start + length) covers."""
    depth = np.bincount(starts, minlength=size + 1) - np.bincount(starts + length, minlength=size + 1)
    return np.cumsum(depth[:size]) > 0
