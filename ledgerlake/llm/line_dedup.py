"""Removal of lines that many documents share, by a minimal perfect hash over line hashes.

1. Each block of documents tells, for every distinct line key in it, how many of its documents
   hold the key (128-bit hashes, summed before anything moves).
2. A shard sums what the blocks told it and builds a minimal perfect hash over its distinct
   line hashes, with an array of 16-bit fingerprints and one of document counts (``line_index``).
3. Blocks probe those arrays with their distinct hashes (``probe``) and drop lines whose count
   reaches the threshold.

A line is what stands between ``\\n``; its key is the line without white space at both ends, with
A-Z lower-cased. Null and empty texts are one empty line, which is never dropped (a key needs
``min_chars`` code points, one by default). A key that occurs several times in a document counts
once. Rows with the same ``doc_id`` count as documents of their own; a null ``doc_id`` is passed
through. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ledgerlake.llm import blocks, mph
from ledgerlake.llm.hashing import LOWER, mix

MIN_DOCS = 10
WHITE = b" \t\n\v\f\r"
KEPT = "doc_id long, text string, n_lines long, n_dropped long"
_LOWER = LOWER.tobytes()
_MAIL = [np.uint64, np.uint64, np.uint32]


class _Lines:
    """The lines of a block, their documents, and the distinct keys in the order of shards."""

    def __init__(self, block: blocks.Block, min_chars: int, shards: int):
        self.lines, doc, digests, self.countable = [], [], [], []
        for i in range(len(block)):
            for line in block.text(i).split(b"\n"):
                key = line.strip(WHITE).translate(_LOWER)
                long_enough = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
                self.lines.append(line)
                doc.append(i)
                self.countable.append(long_enough)
                digests.append(xxhash.xxh3_128_digest(key))
        self.doc = np.array(doc, dtype=np.int64)
        self.countable = np.array(self.countable, dtype=bool)
        a, b = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2).T if digests else (np.empty(0, np.uint64),) * 2
        at = np.flatnonzero(self.countable)
        a, b, doc, shard = a[at], b[at], self.doc[at], blocks.shard_of(mix(b[at]), shards)
        order = np.lexsort((doc, b, a, shard))
        a, b, doc, shard = a[order], b[order], doc[order], shard[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.empty(0, bool)
        new_doc = new.copy()
        new_doc[1:] |= doc[1:] != doc[:-1]
        entry = np.cumsum(new) - 1
        self.a, self.b, self.shard = a[new], b[new], shard[new]
        self.docs = np.bincount(entry[new_doc], minlength=len(self.a)).astype(np.uint32)
        self.entry = np.full(len(self.lines), -1, dtype=np.int64)
        self.entry[at[order]] = entry


def _index(inbox: blocks.Inbox) -> pa.Table:
    a, b, docs = inbox.columns
    order = np.lexsort((b, a))
    a, b, docs = a[order], b[order], docs[order].astype(np.int64)
    head = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    a, b, docs = a[head], b[head], np.add.reduceat(docs, head)
    sizes, bits = mph.build(a, b)
    slot = mph.slots(sizes, bits, a, b)
    prints, counts = np.empty(len(a), np.uint16), np.empty(len(a), np.int64)
    prints[slot], counts[slot] = _print(a, b), docs
    arrays = blocks.zip_arrays(sizes, bits, prints, counts)
    return pa.table({"shard": pa.array([inbox.shard], pa.int32()), "n_keys": pa.array([len(a)], pa.int64()), "arrays": pa.array([arrays], pa.binary())})


def _print(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix(a ^ (b << np.uint64(1))) >> np.uint64(48)).astype(np.uint16)


def line_index(mail: DataFrame) -> DataFrame:
    """One row for each shard: the perfect hash with fingerprints and document counts."""
    build = lambda table: _index(blocks.Inbox(table, _MAIL))
    return blocks.stored(mail.groupBy("shard").applyInArrow(build, "shard int, n_keys long, arrays binary"), "line-index")


def probe(mail: DataFrame, index: DataFrame, min_docs: int) -> DataFrame:
    """For each key that a block asked about: is it in ``min_docs`` documents or more?"""

    def run(letters: pa.Table, arrays: pa.Table) -> pa.Table:
        inbox = blocks.Inbox(letters, _MAIL)
        a, b, _ = inbox.columns
        sizes, bits, prints, counts = blocks.unzip_arrays(arrays["arrays"][0].as_py())
        slot = mph.slots(sizes, bits, a, b)
        known = (slot >= 0) & (prints[slot] == _print(a, b))
        return inbox.answers((known & (counts[slot] >= min_docs)).astype(np.uint8))

    return mail.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(run, blocks.LETTER)


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document without the lines whose key occurs in ``min_docs`` documents or more."""
    parts = blocks.packed(docs, id_column, text_column)
    shards = blocks.shards_for(parts)

    def ask(number, block):
        lines = _Lines(block, min_chars, shards)
        return blocks.letters(number, lines.shard, [lines.a, lines.b, lines.docs])

    def clean(number, block, mail):
        lines = _Lines(block, min_chars, shards)
        (common,) = blocks.replies(mail, [np.uint8])
        dropped = np.zeros(len(lines.lines), dtype=bool)
        asked = lines.entry >= 0
        dropped[asked] = common[lines.entry[asked]] == 1
        cuts = np.searchsorted(lines.doc, np.arange(len(block) + 1))
        texts = [b"\n".join([lines.lines[k] for k in range(a, b) if not dropped[k]]) for a, b in zip(cuts, cuts[1:])]
        lost = np.concatenate(([0], np.cumsum(dropped)))
        text = pa.array([None if gone else t.decode() for t, gone in zip(texts, block.no_text)], pa.string())
        return pa.table({"doc_id": block.id_list(), "text": text, "n_lines": pa.array(np.diff(cuts), pa.int64()), "n_dropped": pa.array(lost[cuts[1:]] - lost[cuts[:-1]], pa.int64())})

    mail = blocks.stored(blocks.asked(parts, ask), "line-keys")
    return blocks.with_answers(parts, probe(mail, line_index(mail), min_docs), clean, KEPT)
