"""Benchmark decontamination by spaced seeds.

A mask keeps some positions of a run of words and ignores the others, so a replaced word at an
ignored position leaves the hash unchanged. Hashes of all masks over the benchmark are matched
with those over every document; each hit names a diagonal (document position minus item
position), along which the words of the item are compared one by one. The best-scoring stretch
(match +1, mismatch -2, so more than two thirds of its words are equal) is the overlap; it counts
from ``min_matches`` equal words on, or from ``min_share`` of the item's words if the item is
shorter than that.

Words are lower-cased runs of ASCII letters and digits and of all non-ASCII characters, so
punctuation and line breaks do not matter. Null and empty texts, and items with fewer words
than the shortest mask, match nothing. Documents that occur twice are judged twice; an item that
occurs twice counts under each of its numbers. Other columns are passed through or not read.

The benchmark is cut into slices of bounded size; each slice's index travels to the tasks, and
documents never move. Documents pass all slices one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlake.llm.hashing import Spans, byte_values, mix
from ledgerlake.llm.language_id import portions

MASKS = ("111111", "110101101", "1010110011", "11001001011")
MIN_MATCHES = 12
MIN_SHARE = 0.8
SLICE_BYTES = 8 << 20
LEAKS = "doc_id long, item_id long, matched_words int, overlap_words int, doc_word int, item_word int"
_WORD = np.array([i >= 128 or chr(i).isalnum() for i in range(256)])
_FILTER_BITS = 22


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, one behind the other, and where each text begins (one more at the end)."""
    raw = [t.lower().encode() + b"\n" for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    solid = np.concatenate(([False], _WORD[data], [False]))
    turns = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = turns[::2], turns[1::2]
    first = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    return Spans(byte_values(data)).of(starts, ends), np.searchsorted(starts, first)


def _seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every run of words under the mask."""
    n = len(words) - len(mask) + 1
    total = np.full(max(n, 0), np.uint64(len(mask)))
    for k, keep in enumerate(mask):
        if keep == "1" and n > 0:
            total += words[k : k + n] * np.uint64(2 * k + 1 | 0x5851F42D4C957F00)
    return mix(total)


@dataclass(frozen=True)
class Index:
    """Seeds and words of one slice of the benchmark; about a hundred bytes for each word."""

    items: list[int]
    words: np.ndarray
    first: np.ndarray
    seeds: list[tuple[np.ndarray, np.ndarray]]  # for each mask the hashes, ascending, and their word positions

    @classmethod
    def of(cls, items: list[int], texts: list[str]) -> Index:
        words, first = _words(texts)
        owner = np.searchsorted(first, np.arange(len(words)), side="right")
        seeds = []
        for mask in MASKS:
            value = _seeds(words, mask)
            whole = np.flatnonzero(owner[: len(value)] == owner[len(mask) - 1 :][: len(value)])
            order = whole[np.argsort(value[whole], kind="stable")]
            seeds.append((value[order], order))
        return cls(items, words, first, seeds)

    def hits(self, words: np.ndarray) -> np.ndarray:
        """Distinct (item, diagonal) pairs packed as rows; the diagonal is relative to all words given."""
        found = []
        for mask, (known, place) in zip(MASKS, self.seeds):
            if not len(known):
                continue
            seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
            seen[known >> np.uint64(64 - _FILTER_BITS)] = True
            value = _seeds(words, mask)
            at = np.flatnonzero(seen[value >> np.uint64(64 - _FILTER_BITS)])
            low, high = np.searchsorted(known, value[at], "left"), np.searchsorted(known, value[at], "right")
            at, low, times = at[high > low], low[high > low], (high - low)[high > low]
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            item_word = place[np.repeat(low, times) + step]
            found.append(np.stack([np.searchsorted(self.first, item_word, side="right") - 1, np.repeat(at, times) - item_word], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)

    def leaks(self, texts: list[str], min_matches: int, min_share: float) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item number, matched, length, word in the text, word in the item), best for each pair."""
        words, first = _words(texts)
        best: dict[tuple[int, int], tuple] = {}
        for item, diagonal in self.hits(words):
            a, b = self.first[item], self.first[item + 1]
            # the item may overlap several texts on this diagonal: look at each of them
            low, high = max(0, a + diagonal), min(len(words), b + diagonal)
            for text in range(np.searchsorted(first, low, "right") - 1, np.searchsorted(first, high, "left")):
                start, end = max(low, first[text]), min(high, first[text + 1])
                if end - start < min(min_matches, int(np.ceil(min_share * (b - a)))):
                    continue
                equal = words[start:end] == self.words[start - diagonal : end - diagonal]
                score = np.cumsum(np.where(equal, 1, -2))
                floor = np.minimum.accumulate(np.concatenate(([0], score[:-1])))
                stop = int(np.argmax(score - floor))
                begin = int(np.argmin(np.concatenate(([0], score[:stop]))))
                matched = int(equal[begin : stop + 1].sum())
                if matched >= min(min_matches, np.ceil(min_share * (b - a))):
                    row = (matched, stop + 1 - begin, int(start - first[text] + begin), int(start - diagonal - a + begin))
                    key = (text, int(item))
                    best[key] = max(best.get(key, row), row)
        return [(text, item, *row) for (text, item), row in sorted(best.items())]


def slices(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text", slice_bytes: int = SLICE_BYTES) -> Iterator[Index]:
    """The benchmark, a bounded part at a time."""
    rows = benchmark.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // slice_bytes
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        part.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        if part:
            yield Index.of([r["item_id"] for r in part], [r["text"] for r in part])


def _judged(index: Index, texts: list[str | None], min_matches: int, min_share: float) -> list[tuple]:
    known = [t or "" for t in texts]
    return [(a + text, *rest) for a, b in portions(known) for text, *rest in index.leaks(known[a:b], min_matches, min_share)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_matches: int = MIN_MATCHES, min_share: float = MIN_SHARE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document and benchmark item that overlap."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def finder(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _judged(index, batch.column(1).to_pylist(), min_matches, min_share)
                text, item, *numbers = zip(*found) if found else ((),) * 6
                ids = batch.column(0).take(pa.array(text, pa.int64()))
                columns = [ids, pa.array([index.items[i] for i in item], pa.int64()), *(pa.array(x, pa.int32()) for x in numbers)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "matched_words", "overlap_words", "doc_word", "item_word"])

        return rows.mapInArrow(run, LEAKS)

    out = None
    for index in slices(benchmark):
        out = finder(index) if out is None else out.unionByName(finder(index))
    return docs.sparkSession.createDataFrame([], LEAKS) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, min_matches: int = MIN_MATCHES, min_share: float = MIN_SHARE, text_column: str = "text") -> DataFrame:
    """The documents that overlap no item, with all their columns; no shuffle."""
    at, schema = docs.columns.index(text_column), docs.schema
    names = to_arrow_schema(schema).names

    def filtered(rows: DataFrame, index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[x[0] for x in _judged(index, batch.column(at).to_pylist(), min_matches, min_share)]] = False
                yield pa.RecordBatch.from_arrays(batch.filter(pa.array(keep)).columns, names=names)

        return rows.mapInArrow(run, schema)

    for index in slices(benchmark):
        docs = filtered(docs, index)
    return docs
