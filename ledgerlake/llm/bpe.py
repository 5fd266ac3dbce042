"""Byte-level BPE over a corpus whose chunks are encoded once, and decoding.

Texts are cut where a rolling hash says so, hence equal passages are cut alike wherever they
stand. A block of documents asks each shard about its distinct chunks; a shard encodes every
distinct chunk once, whatever number of blocks asks, and answers with its ids. A chunk knows
nothing of its neighbours, so the ids near its ends may be wrong. Every join is therefore encoded
again, from the last sure word start before it up to the first word start behind it at which the
new encoding and the chunk's own agree; where they do not, the window grows, over further chunks
if need be, up to the end of the text.

Why agreement at a word start is exact: the tokenizer splits a text into words from left to right
without looking back, and encodes each word alone. From a word start that is true for the whole
text, all further words depend on what follows only, so two encodings that share a true word
start are equal from there on, except within ``reach`` bytes of the end of the shorter one: that
is how far the splitting may look ahead (the longest special token, or a run of white space).

What crosses the network: each distinct chunk of a block once as compressed text, its ids once on
the way back, and the numbers of a block's chunks. Texts are not sent again; windows are spelled
from ids. A shard reads its letters one batch after the other and keeps the ids of its distinct
chunks only, so a chunk that all blocks hold costs no memory. A document is the unit of work.

Null texts count as empty and have no ids. Every row gives a row; other columns are not read.
Strings of special tokens inside a text become special tokens, as the library does by default.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.llm import blocks, hashing

DECODED_BYTES = 1 << 21  # of ids
IDS = "doc_id long, n_tokens long, ids binary"
_IDS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


@dataclass(frozen=True)
class Settings:
    """``path`` names a tokenizer file that every executor can read at the same place."""

    path: str
    block_bytes: int = 8 << 20
    least: int = 512  # bytes of a chunk, but for the last one of a text
    mask: int = (1 << 11) - 1  # a hash with these bits unset ends a chunk
    width: int = 24  # bytes under the rolling hash
    window: int = 144  # bytes behind a join that are encoded at first
    reach: int = 64  # more bytes than splitting looks ahead, a special token or a few characters


#: Fixed value: how byte-level vocabularies of this kind split a text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space, ASCII, Latin letters and signs, and common punctuation: their classes are the same in all libraries.
_PLAIN = re.compile("[\t-\r -~\u00a1-\u017f\u2010-\u2027\u20ac]*")
_loaded = hashing._Cache()


class Coder:
    """A tokenizer file with the bytes that each id stands for."""

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.spelled = [b""] * (max(vocabulary.values(), default=-1) + 1)
        byte_of = _byte_of_letter()
        for token, i in vocabulary.items():
            self.spelled[i] = special[i] if i in special else bytes(byte_of[c] for c in token)
        self.size = np.array([len(x) for x in self.spelled], dtype=np.int64)
        self._ranks = {x: i for i, x in enumerate(self.spelled) if i not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ranked = all(vocabulary.get(a + b) == 256 + n for n, (a, b) in enumerate(merges))
        splits = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.ranked = ranked and splits and spec["normalizer"] is None and len(self._ranks) == 256 + len(merges)
        self._special = [t["content"] for t in spec["added_tokens"]]
        space = frozenset(b" \t\n\v\f\r")
        self._opens = np.array([x[:1] != b"" and x[0] in space for x in self.spelled])
        self._closes = np.array([x[-1:] != b"" and x[-1] not in space for x in self.spelled])
        if self.ranked:
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=self._ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> Coder:
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def plain_starts(self, ids: np.ndarray) -> np.ndarray:
        """Which ids surely start a word where characters are plain: the first one, and white space behind something else."""
        starts = self._opens[ids]
        starts[1:] &= self._closes[ids[:-1]]
        starts[:1] = True
        return starts

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """For each text its ids and which of them start a word, none where ``plain_starts`` tells.

        Where the vocabulary is ranked by its merges and a text has plain European characters only,
        the same merges are made by a faster library.
        """
        out: list = [None] * len(texts)
        slow = []
        for i, raw in enumerate(texts):
            text = raw.decode()
            if self.ranked and _PLAIN.fullmatch(text) and not any(s in text for s in self._special):
                out[i] = self.fast.encode_to_numpy(text, disallowed_special=()), None
            else:
                slow.append((i, text))
        for (i, _), e in zip(slow, self.tokenizer.encode_batch([t for _, t in slow], add_special_tokens=False)):
            word = np.array(e.word_ids, dtype=np.int64)
            out[i] = np.array(e.ids, dtype=np.uint32), np.concatenate(([True], word[1:] != word[:-1])) if len(word) else np.empty(0, bool)
        return out

    def spell(self, ids: np.ndarray) -> bytes:
        return b"".join([self.spelled[i] for i in ids.tolist()])


def _byte_of_letter() -> dict[str, int]:
    """The public rule of byte-level vocabularies: printable bytes are themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


def cuts(data: np.ndarray, settings: Settings) -> np.ndarray:
    """Where the chunks of one text end, in bytes; never inside a character."""
    n = len(data)
    if n <= settings.least + settings.width:
        return np.array([n] if n else [], dtype=np.int64)
    rolling = hashing.Spans(hashing.byte_values(data)).windows(settings.width)
    ends = np.flatnonzero((rolling & np.uint64(settings.mask)) == 0) + settings.width
    ends = ends[ends < n]
    ends = ends[(data[ends] & 0xC0) != 0x80]
    out, last = [], 0
    for end in ends.tolist():
        if end - last >= settings.least:
            out.append(end)
            last = end
    return np.array([*out, n], dtype=np.int64)


def _documents(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list]]:
    """Identifiers and texts of about ``limit`` bytes at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        offsets, data, _ = blocks.texts_of(batch, 1)
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            ids.append(doc_id)
            texts.append(data[offsets[i] : offsets[i + 1]].copy())
            size += len(texts[-1])
            if size >= limit or len(ids) >= blocks.MOST_DOCS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _ask(settings: Settings, shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    for ids, texts in _documents(batches, settings.block_bytes):
        place, wanted, chunks, counts = {}, [], [], []
        for text in texts:
            start, ends = 0, cuts(text, settings)
            for end in ends.tolist():
                chunk = text[start:end].tobytes()
                key = hashlib.blake2b(chunk, digest_size=16).digest()
                if key not in place:
                    place[key] = len(wanted)
                    wanted.append((int.from_bytes(key[:4], "little") % shards, key, chunk))
                chunks.append(place[key])
                start = end
            counts.append(len(ends))
        order = sorted(range(len(wanted)), key=lambda i: wanted[i][0])
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        own = [np.array([0 if i is None else i for i in ids], dtype=np.int64), np.array([i is None for i in ids], dtype=np.uint8), np.array(counts, dtype=np.int64), rank[np.array(chunks, dtype=np.int64)]]
        rows, at = [(number, -1 - number % shards, blocks.zip_arrays(*own))], 0
        while at < len(order):
            shard, upto = wanted[order[at]][0], at
            while upto < len(order) and wanted[order[upto]][0] == shard:
                upto += 1
            some = [wanted[i] for i in order[at:upto]]
            raw = [np.frombuffer(b"".join(x[k] for x in some), dtype=np.uint8) for k in (1, 2)]
            rows.append((number, shard, blocks.zip_arrays(raw[0], np.array([len(x[2]) for x in some], dtype=np.int64), raw[1])))
            at = upto
        yield from blocks.letter_table(rows).to_batches()
        number += 1


def _answer(settings: Settings, letters: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder, known = Coder.of(settings.path), {}
    kind = np.uint16 if len(coder.spelled) <= 1 << 16 else np.uint32
    for batch in letters:
        for block, shard, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if shard < 0:  # what a block keeps for itself
                yield from blocks.letter_table([(block, shard, data)]).to_batches()
                continue
            keys, sizes, text = blocks.unzip_arrays(data)
            keys, text, ends = keys.tobytes(), text.tobytes(), np.cumsum(sizes).tolist()
            keys = [keys[i : i + 16] for i in range(0, len(keys), 16)]
            new = [i for i, key in enumerate(keys) if key not in known]
            if new:
                for i, (ids, starts) in zip(new, coder.encode([text[ends[i] - int(sizes[i]) : ends[i]] for i in new])):
                    known[keys[i]] = ids.astype(kind), np.empty(0, np.uint8) if starts is None else np.packbits(starts)
            found = [known[key] for key in keys]
            lengths = [np.array([len(x[k]) for x in found], dtype=np.int64) for k in (0, 1)]
            reply = blocks.zip_arrays(*lengths, *(np.concatenate([x[k] for x in found]) for k in (0, 1)))
            yield from blocks.letter_table([(block, shard, reply)]).to_batches()


class _Chunk:
    """The ids of a chunk, where each of them starts, and which of them start a word."""

    def __init__(self, coder: Coder, settings: Settings, ids: np.ndarray, starts: np.ndarray | None):
        self.ids = ids
        starts = coder.plain_starts(ids) if starts is None else starts
        at = np.concatenate(([0], np.cumsum(coder.size[ids])))
        self.at, self.size = at[:-1], int(at[-1])
        self.words = np.flatnonzero(starts)
        sure = self.words[self.at[self.words] <= self.size - settings.reach]
        self.sure = int(sure[-1]) if len(sure) else 0  # the last word start that the end cannot have changed
        head = int(np.searchsorted(self.at, settings.window + 4))
        self.head, self.tail = coder.spell(ids[:head]), coder.spell(ids[self.sure :])


def _whole(text: bytes, at: int) -> int:
    """The nearest end of a character from ``at`` on."""
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at += 1
    return min(at, len(text))


def _join(coder: Coder, settings: Settings, chunks: list[_Chunk], windows: dict) -> np.ndarray:
    """The ids of a text out of its chunks. ``windows`` holds encodings that were made together."""
    out: list[np.ndarray] = []
    held, first, left = chunks[0], 0, b""  # from ``first`` on, the ids of ``held`` are right up to its ``sure``
    k = 1
    while k < len(chunks):
        # everything before this place is settled; ``left`` is the text from it up to chunk k
        stop = max(first, held.sure)
        out.append(held.ids[first:stop])
        left = held.tail if stop == held.sure else coder.spell(held.ids[stop:])
        nearest = len(left)  # where chunk k starts
        width, found = settings.window, None
        while found is None:
            text, reached = left, k
            while reached < len(chunks) and len(text) - nearest < width:
                more, room = chunks[reached], width - (len(text) - nearest)
                if more.size > room:
                    text += more.head if len(more.head) >= room + 4 else coder.spell(more.ids)
                    break
                text, reached = text + coder.spell(more.ids), reached + 1
            rest = reached == len(chunks)  # the window goes to the end of the text
            if not rest:
                text = text[: _whole(text, nearest + width)]
            ids, starts = windows.get(text) or coder.encode([text])[0]
            at = np.concatenate(([0], np.cumsum(coder.size[ids])))[:-1]
            words = at[coder.plain_starts(ids) if starts is None else starts]
            sure = words if rest else words[words <= len(text) - settings.reach]
            base = nearest
            for j in range(k, len(chunks)):
                own = chunks[j].at[chunks[j].words] + base
                same = own[np.isin(own, sure, assume_unique=True)]
                if len(same):
                    where = int(same[0])
                    found = int(np.searchsorted(chunks[j].at, where - base)), j, int(np.searchsorted(at, where))
                    break
                base += chunks[j].size
                if base > len(text):
                    break
            if found is None and rest:
                return np.concatenate([*out, ids])
            width *= 4
        first, k, upto = found
        out.append(ids[:upto])
        held, k = chunks[k], k + 1
    out.append(held.ids[first:])
    return np.concatenate(out)


def _assemble(settings: Settings, letters: pa.Table) -> pa.Table:
    coder = Coder.of(settings.path)
    (doc_ids, missing, counts, order), letters = blocks.split_state(letters)
    chunks: list[_Chunk] = []
    for i in np.argsort(letters["shard"].to_numpy(), kind="stable"):
        sizes, flagged, ids, bits = blocks.unzip_arrays(letters["data"][int(i)].as_py())
        at = at_bits = 0
        for n, m in zip(sizes.tolist(), flagged.tolist()):
            starts = np.unpackbits(bits[at_bits : at_bits + m], count=n).astype(bool) if m else None
            chunks.append(_Chunk(coder, settings, ids[at : at + n].astype(np.uint32), starts))
            at, at_bits = at + n, at_bits + m
    ends = np.cumsum(counts)
    pairs = {}
    for start, end in zip((ends - counts).tolist(), ends.tolist()):  # every join as a rule needs its first window only
        for a, b in zip(order[start : end - 1].tolist(), order[start + 1 : end].tolist()):
            if chunks[b].size > settings.window and (a, b) not in pairs:
                text = chunks[a].tail + chunks[b].head
                pairs[a, b] = text[: _whole(text, len(chunks[a].tail) + settings.window)]
    texts = list(dict.fromkeys(pairs.values()))
    windows = dict(zip(texts, coder.encode(texts)))
    rows = []
    for doc_id, none, start, end in zip(doc_ids.tolist(), missing.tolist(), (ends - counts).tolist(), ends.tolist()):
        own = [chunks[i] for i in order[start:end].tolist()]
        ids = _join(coder, settings, own, windows) if own else np.empty(0, np.uint32)
        rows.append((None if none else doc_id, len(ids), ids.astype("<u4").tobytes()))
    return pa.table([pa.array(v, t) for v, t in zip(zip(*rows), _IDS.types)], schema=_IDS)


def encode(docs: DataFrame, settings: Settings, id_column: str = "doc_id", text_column: str = "text", shards: int | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (unsigned 32-bit numbers, little-endian) of every row."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    mail = rows.mapInArrow(lambda batches: _ask(settings, shards, batches), blocks.LETTER)

    def answer(letters: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _answer(settings, letters)

    # the annotations choose the form that reads a group batch by batch
    answer.__annotations__ = {"letters": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    answers = mail.groupBy("shard").applyInArrow(answer, blocks.LETTER)
    return answers.groupBy("block").applyInArrow(lambda letters: _assemble(settings, letters), IDS)


def decode(encoded: DataFrame, settings: Settings) -> DataFrame:
    """``encoded`` with the texts that its ids stand for, special tokens included, as ``decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Coder.of(settings.path).tokenizer
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False)
            group, first = np.cumsum(size) // DECODED_BYTES, 0
            while first < len(size):  # lists of numbers are large, so a few texts at a time
                upto = int(np.searchsorted(group, group[first], side="right"))
                part = batch.slice(first, upto - first)
                ids = [np.frombuffer(x or b"", dtype="<u4").tolist() for x in part.column("ids").to_pylist()]
                texts = tokenizer.decode_batch(ids, skip_special_tokens=False)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])
                first = upto

    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    return encoded.mapInArrow(run, schema)
