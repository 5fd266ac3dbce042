"""Removal of byte strings that occurred before, by prefix-free parsing and suffix order.

A rolling hash over ``TRIGGER`` bytes sets triggers so that every string of ``length`` bytes holds
one, at a place that depends on the string alone. Triggers cut a document into phrases. The
strings that share a trigger form a unit: the phrase's bytes before the trigger, the trigger,
and the bytes of the parse that follow, as far as these strings reach.

1. Blocks report their distinct units as (trigger, content) hashes with the earliest document.
   In highly repetitive text almost every unit is a copy: a shard answers which are, and copies
   are removed without a look inside.
2. What is left to compare are first units whose trigger has other contents too. Their bytes meet
   in the trigger's shard. It sorts what stands before the trigger, read backwards (the suffixes
   of the dictionary's phrases), and what follows (the suffixes of the parse), each with the
   lengths of common prefixes. A string of the corpus is a place in both orders at once; equal
   strings are neighbours in both, found for all places together by combining the two orders.
3. Blocks remove the bytes that later strings cover.

A trigger with more than ``CROWDED`` contents, such as the end of a passage that a third of all
documents share, would bring an unbounded group to one shard. Its strings are spread by 96-bit
hashes of their own instead, again once for each block; both ways give the same answer.

A byte is removed if a string of ``length`` bytes that covers it also starts earlier: in a smaller
``doc_id``, or earlier in the same document, always judged on the input. Strings never cross
documents. A null ``doc_id`` comes last; of rows with equal ``doc_id`` the one stored first comes
first. Null and empty texts have no bytes. Other columns are not read. An empty table gives an
empty result. ``kept`` is binary, as a cut may fall inside a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import blocks
from ledgerlake.llm.hashing import Spans, byte_values, leftmost_min, mix

LENGTH = 100
TRIGGER = 24
CROWDED = 1000
KEPT = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"
_UNITS = [np.uint64, np.uint64, np.int64]
_STRINGS = [np.uint64, np.uint32, np.int64]
_COPY, _COMPARE, _CROWDED = 1, 2, 4


class _Units:
    """The units of a block: strings [low, high] hold the trigger at ``at``; distinct ones by shard."""

    def __init__(self, block: blocks.Block, length: int, trigger: int, shards: int):
        self.sums = Spans(byte_values(block.data))
        grams = self.sums.windows(trigger)
        at = leftmost_min(grams, length - trigger + 1)
        whole = np.zeros(len(block.data) + 1, dtype=np.int8)
        room = np.flatnonzero(block.ends - block.starts >= length)
        whole[block.starts[room]] += 1
        whole[block.ends[room] - length + 1] -= 1
        whole = np.cumsum(whole[: len(at)]) > 0
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | ~whole[:-1]
        self.low = np.flatnonzero(new & whole)
        last = np.ones(len(at), dtype=bool)
        last[:-1] = (at[1:] != at[:-1]) | ~whole[1:]
        self.high = np.flatnonzero(last & whole)
        self.at = at[self.low]
        self.trigger = grams[self.at] if len(self.at) else np.empty(0, np.uint64)
        content = self.sums.of(self.low, self.high + length)
        content = mix(content + (self.at - self.low).astype(np.uint64))
        shard = blocks.shard_of(self.trigger, shards)
        self.order = np.lexsort((self.low, content, self.trigger, shard))
        t, c = self.trigger[self.order], content[self.order]
        self.first = np.ones(len(t), dtype=bool)
        self.first[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
        self.columns = shard[self.order][self.first], t[self.first], c[self.first]


def _judge_units(inbox: blocks.Inbox) -> pa.Table:
    trigger, content, key = inbox.columns
    order = np.lexsort((inbox.sender, key, content, trigger))
    t, c = trigger[order], content[order]
    new_trigger, new_unit = np.ones(len(t), dtype=bool), np.ones(len(t), dtype=bool)
    new_trigger[1:] = t[1:] != t[:-1]
    new_unit[1:] = new_trigger[1:] | (c[1:] != c[:-1])
    contents = np.bincount(np.cumsum(new_trigger) - 1, weights=new_unit)[np.cumsum(new_trigger) - 1]
    flags = np.where(new_unit, np.where(contents > CROWDED, _CROWDED, np.where(contents > 1, _COMPARE, 0)), _COPY)
    out = np.empty(len(t), dtype=np.uint8)
    out[order] = flags
    return inbox.answers(out)


def _ranked(group: np.ndarray, rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings by group and content, and the common prefix with the one before (-1: other group)."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : rows.shape[1]] = rows
    parts = wide.view(">u8").astype(np.uint64)
    order = np.lexsort((size, *parts.T[::-1], group))
    common = np.full(len(rows), -1, dtype=np.int64)
    a, b = order[:-1], order[1:]
    differ = rows[a] != rows[b]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    common[1:] = np.where(group[a] == group[b], np.minimum(shared, np.minimum(size[a], size[b])), -1)
    return order, common


def later_places(group: np.ndarray, rank: np.ndarray, left: list | np.ndarray, before: np.ndarray, right: np.ndarray, after: np.ndarray, length: int) -> np.ndarray:
    """For each unit and each number k of bytes before the trigger: does the string that starts
    there equal one of a unit with a smaller rank? ``left`` is read backwards."""
    reach = left.shape[1] + 1
    out = np.zeros((len(group), reach), dtype=bool)
    by_left, common_left = _ranked(group, left, before)
    by_right, common_right = _ranked(group, right, after)
    for k in range(reach):
        has = np.flatnonzero((before >= k) & (after >= length - k))
        if len(has) < 2:
            continue
        left_class, right_class = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
        left_class[by_left] = np.cumsum(common_left < k)
        right_class[by_right] = np.cumsum(common_right < length - k)
        a, b = left_class[has], right_class[has]
        order = np.lexsort((rank[has], b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        out[has[order[1:][same]], k] = True
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's bytes without those that a string of ``length`` bytes covers that occurred before."""
    if not 0 < trigger <= length <= 255:
        raise ValueError("0 < trigger <= length <= 255")
    reach = length - trigger  # most bytes before the trigger
    width = reach + length
    bits = -(-(reach + 1) // 8)
    unit_types = [np.uint64, np.int64, np.uint32, np.uint8, np.uint8, f"V{width}"]
    parts = blocks.packed(docs, id_column, text_column)
    shards = blocks.shards_for(parts)

    def ask_units(number, block):
        units = _Units(block, length, trigger, shards)
        shard, t, c = units.columns
        return blocks.letters(number, shard, [t, c, block.keys[block.doc_of(units.low[units.order][units.first])]])

    def ask_strings(number, block, mail):
        units = _Units(block, length, trigger, shards)
        (flags,) = blocks.replies(mail, [np.uint8])
        entry = np.cumsum(units.first) - 1
        copies = units.order[~units.first | (flags[entry] == _COPY)] if len(entry) else units.order
        first = units.order[units.first]
        letters = []
        # units to compare, byte by byte, in the trigger's shard
        own = first[flags == _COMPARE]
        low, high, at = units.low[own], units.high[own], units.at[own]
        size = high + length - low
        padded = np.concatenate([block.data, np.zeros(width, np.uint8)])
        content = padded[low[:, None] + np.arange(width)]
        content[np.arange(width) >= size[:, None]] = 0
        rows = np.ascontiguousarray(content).view(f"V{width}").reshape(-1)
        shard = blocks.shard_of(units.trigger[own], shards)
        letters += blocks.letters(number, shard, [
            units.trigger[own], block.keys[block.doc_of(low)], low.astype(np.uint32), (at - low).astype(np.uint8), size.astype(np.uint8), rows])
        # strings of crowded triggers, in shards of their own
        many = first[flags == _CROWDED]
        counts = units.high[many] - units.low[many] + 1
        place = np.repeat(units.low[many] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        second = Spans(byte_values(block.data), 1)
        a, b = units.sums.of(place, place + length), (second.of(place, place + length) >> np.uint64(32)).astype(np.uint32)
        far = blocks.shard_of(mix(a), shards) + shards
        order = np.lexsort((place, b, a, far))
        a, b, far, place = a[order], b[order], far[order], place[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        letters += blocks.letters(number, far[new], [a[new], b[new], block.keys[block.doc_of(place[new])]])
        number32 = [x.astype(np.uint32) for x in (units.low[copies], units.high[copies], place[~new], at, place[new])]
        return blocks.letter_table([*letters, blocks.state_row(number, *number32)])

    def compare(table: pa.Table) -> pa.Table:
        if table["shard"][0].as_py() >= shards:
            inbox = blocks.Inbox(table, _STRINGS)
            a, b, key = inbox.columns
            order = np.lexsort((inbox.sender, key, b, a))
            later = np.zeros(len(a), dtype=np.uint8)
            later[order[1:]] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
            return inbox.answers(later)
        inbox = blocks.Inbox(table, unit_types)
        t, key, low, before, size, rows = inbox.columns
        rows = rows.view(np.uint8).reshape(len(t), width)
        before, size = before.astype(np.int64), size.astype(np.int64)
        rank = np.empty(len(t), dtype=np.int64)
        rank[np.lexsort((low, inbox.sender, key))] = np.arange(len(t))
        column = np.arange(reach)
        left = np.where(column < before[:, None], np.take_along_axis(rows, np.maximum(before[:, None] - 1 - column, 0), axis=1), 0)
        column = np.arange(length)
        right = np.where(column < (size - before)[:, None], np.take_along_axis(rows, np.minimum(before[:, None] + column, width - 1), axis=1), 0)
        later = later_places(t, rank, left.astype(np.uint8), before, right.astype(np.uint8), np.minimum(size - before, length), length)
        return inbox.answers(np.ascontiguousarray(np.packbits(later, axis=1)).view(f"V{bits}").reshape(-1))

    def clean(number, block, mail):
        (copy_low, copy_high, repeats, at, place), mail = blocks.split_state(mail)
        far = pa.compute.greater_equal(mail["shard"], shards)
        (later_string,) = blocks.replies(mail.filter(far), [np.uint8])
        (later_unit,) = blocks.replies(mail.filter(pa.compute.invert(far)), [f"V{bits}"])
        flags = np.unpackbits(later_unit.view(np.uint8).reshape(-1, bits), axis=1)[:, : reach + 1] if len(later_unit) else np.zeros((0, reach + 1), np.uint8)
        unit, back = np.nonzero(flags)
        starts = np.concatenate([repeats, place[later_string == 1], at[unit].astype(np.int64) - back]).astype(np.int64)
        copy_low, copy_high = copy_low.astype(np.int64), copy_high.astype(np.int64)
        depth = np.zeros(len(block.data) + 1, dtype=np.int64)
        for a, b in ((starts, starts + length), (copy_low, copy_high + length)):
            depth += np.bincount(a, minlength=len(depth)) - np.bincount(b, minlength=len(depth))
        gone = np.cumsum(depth[:-1]) > 0
        lost = np.concatenate(([0], np.cumsum(gone)))
        run_starts, _ = blocks.runs_of(gone)
        kept = [block.data[a:b][~gone[a:b]].tobytes() if lost[b] > lost[a] else block.data[a:b].tobytes() for a, b in zip(block.starts, block.ends)]
        spans = np.searchsorted(run_starts, block.ends) - np.searchsorted(run_starts, block.starts)
        return pa.table({
            "doc_id": block.id_list(), "kept": pa.array(kept, pa.binary()), "n_bytes": pa.array(block.ends - block.starts, pa.int64()),
            "n_removed": pa.array(lost[block.ends] - lost[block.starts], pa.int64()), "n_spans": pa.array(spans, pa.int64()),
        })

    known = blocks.answered(blocks.asked(parts, ask_units), _UNITS, _judge_units)
    asked = blocks.stored(blocks.with_answers(parts, known, ask_strings, blocks.LETTER), "units")
    later = asked.where(F.col("shard") >= 0).groupBy("shard").applyInArrow(compare, blocks.LETTER)
    return blocks.with_answers(parts, later.unionByName(asked.where(F.col("shard") < 0)), clean, KEPT)
