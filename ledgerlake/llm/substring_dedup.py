"""Removal of passages that occurred before, with automata of the phrases that recur.

Every run of ``window`` words holds an anchor: the phrase of ``phrase`` words whose hash is the
smallest in it. Equal runs have equal anchors.

1. Blocks report the hashes of their anchors; shards tell which of them occur twice or more.
2. A block confirms which of its phrases recur, compiles them to an Aho-Corasick automaton
   (each block of documents has the shard of the automaton that can match there) and streams its
   documents through it. Runs whose anchor is among the occurrences are the only ones that can
   recur; their 96-bit keys go to the shards with the earliest document of the block that has them.
3. The shards answer which of them are not the first; the words these cover are removed.

Words are runs of anything but space and ``\\t\\n\\v\\f\\r``, unchanged. A run is removed if the same
words start earlier: in a smaller ``doc_id``, or earlier in the same document, always judged on
the input. A null ``doc_id`` comes last; of rows with equal ``doc_id`` the one stored first comes
first. Null and empty texts have no words. Other columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import blocks
from ledgerlake.llm.hashing import Spans, leftmost_min, mix, word_hashes, words

WINDOW = 20
PHRASE = 8
KEPT = "doc_id long, text string, n_words long, n_removed long"
_ANCHORS = [np.uint64, np.uint8]
_RUNS = [np.uint64, np.uint32, np.int64]


class _Words:
    """The words of a block, documents one behind the other, single spaces between words."""

    def __init__(self, block: blocks.Block, window: int, phrase: int):
        texts = [b" " + b" ".join(block.text(i).split()) + b" \n" for i in range(len(block))]
        self.line = b"".join(texts)
        data = np.frombuffer(self.line, dtype=np.uint8)
        self.starts, self.ends = words(data)
        first = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        self.first_word = np.searchsorted(self.starts, first)  # one more than documents
        self.hashes = word_hashes(data, self.starts, self.ends)
        n = max(0, len(self.starts) - window + 1)
        self.doc = np.repeat(np.arange(len(block)), np.diff(self.first_word))
        self.whole = self.doc[:n] == self.doc[window - 1 :][:n]  # runs inside one document
        self.phrases = Spans(self.hashes).windows(phrase)
        self.anchor_of = leftmost_min(self.phrases, window - phrase + 1)  # of each run
        self.anchors = np.unique(self.anchor_of[np.flatnonzero(self.whole)])

    def distinct_anchors(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes by shard, whether the block has them twice, shards, and the entry of each anchor."""
        value, entry, times = np.unique(self.phrases[self.anchors], return_inverse=True, return_counts=True)
        shard = blocks.shard_of(mix(value), shards)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return value[order], (times[order] > 1).astype(np.uint8), shard[order], place[entry]


def _recurring(inbox: blocks.Inbox) -> pa.Table:
    value, twice = inbox.columns
    _, entry, times = np.unique(value, return_inverse=True, return_counts=True)
    often = (times > 1) | (np.bincount(entry, weights=twice, minlength=len(times)) > 0)
    return inbox.answers(often[entry].astype(np.uint8))


def _not_first(inbox: blocks.Inbox) -> pa.Table:
    a, b, key = inbox.columns
    order = np.lexsort((inbox.sender, key, b, a))
    later = np.zeros(len(a), dtype=bool)
    later[1:] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    out = np.empty(len(a), dtype=np.uint8)
    out[order] = later
    return inbox.answers(out)


def _matches(text: _Words, anchors: np.ndarray, phrase: int) -> np.ndarray:
    """First words of all occurrences of the anchors' phrases."""
    line = text.line.decode("latin-1")  # one character for each byte
    automaton = ahocorasick.Automaton()
    for at in anchors.tolist():
        pattern = line[text.starts[at] - 1 : text.ends[at + phrase - 1] + 1]
        automaton.add_word(pattern, len(pattern))
    if not len(automaton):
        return np.empty(0, np.int64)
    automaton.make_automaton()
    found = np.fromiter((end - size + 2 for end, size in automaton.iter(line)), dtype=np.int64)
    return np.searchsorted(text.starts, found)


def remove_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document with its remaining words, joined by single spaces."""
    if not 0 < phrase <= window:
        raise ValueError("a phrase has between one word and a window's words")
    parts = blocks.packed(docs, id_column, text_column)
    shards = blocks.shards_for(parts)

    def anchors(number, block):
        value, twice, shard, _ = _Words(block, window, phrase).distinct_anchors(shards)
        return blocks.letters(number, shard, [value, twice])

    def recurring(block, mail):
        """The runs whose anchor recurs: 96-bit keys, each run's entry among the distinct ones, first words."""
        text = _Words(block, window, phrase)
        *_, entry = text.distinct_anchors(shards)
        (often,) = blocks.replies(mail, [np.uint8])
        located = np.zeros(len(text.doc) + 1, dtype=bool)
        located[_matches(text, text.anchors[often[entry] == 1], phrase)] = True
        at = np.flatnonzero(text.whole & located[text.anchor_of])
        a, b = Spans(text.hashes).of(at, at + window), (Spans(text.hashes, 1).of(at, at + window) >> np.uint64(32)).astype(np.uint32)
        shard = blocks.shard_of(mix(a), shards)
        order = np.lexsort((at, b, a, shard))
        a, b, shard, at = a[order], b[order], shard[order], at[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return text, shard, a, b, at, new

    def runs(number, block, mail):
        text, shard, a, b, at, new = recurring(block, mail)
        return blocks.letter_table(blocks.letters(number, shard[new], [a[new], b[new], block.keys[text.doc[at[new]]]]))

    def clean(number, block, mail):
        # the runs are found again: that costs less than keeping them
        of_phrases = pa.compute.less(mail["shard"], shards)
        *_, at, new = recurring(block, mail.filter(of_phrases))
        (later,) = blocks.replies(mail.filter(pa.compute.invert(of_phrases)), [np.uint8])
        first = np.ones(len(at), dtype=bool)
        first[new] = later == 0
        removed_runs = at[~(new & first)]
        texts, n_words, n_removed = [], [], []
        rows = [block.text(i).split() for i in range(len(block))]
        cuts = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
        gone = blocks.covered(int(cuts[-1]), removed_runs, window)
        for row, a, b, none in zip(rows, cuts, cuts[1:], block.no_text):
            own = gone[a:b]
            lost = int(own.sum())
            left = row if not lost else [w for w, g in zip(row, own) if not g]
            texts.append(None if none else b" ".join(left).decode())
            n_words.append(len(row))
            n_removed.append(lost)
        return pa.table({"doc_id": block.id_list(), "text": pa.array(texts, pa.string()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())})

    known = blocks.stored(blocks.answered(blocks.asked(parts, anchors), _ANCHORS, _recurring), "recurring-phrases")
    later = blocks.answered(blocks.with_answers(parts, known, runs, blocks.LETTER), _RUNS, _not_first)
    both = known.unionByName(later.withColumn("shard", F.col("shard") + F.lit(shards)))
    return blocks.with_answers(parts, both, clean, KEPT)
