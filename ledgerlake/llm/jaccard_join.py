"""Exact Jaccard join of word shingles, as a join in the metric space of Jaccard distance.

1. Documents with equal shingle sets are one class; its first document stands for it.
2. Links of similarity t share some of the smallest-hashed shingles of both sides (prefix
   filter). Shards count in how many classes such a key occurs; a class that shares fewer keys
   than a link implies is alone. The others leave their most frequent keys aside, as many as
   leave at least one common key to any link, and meet in the regions that their remaining keys
   name. A region is named by the first class that has the key, so the many keys of a family of
   near copies name few regions.
3. A region of up to ``REGION`` members is joined in one task. A larger one gets pivots. Members
   within the radius of a pivot are linked with it, and members that such links connect need not
   be compared with each other any more; if no more than ``REGION`` members are left over, they
   are compared with all others, a part at a time. If more are, the region is cut: first by the
   prefix filter once more, now with the shingles that are rare in the region first; then each
   member goes to the Voronoi region of its nearest pivot, and to those whose distance exceeds that
   by no more than twice the radius (triangle inequality: a link cannot leave these windows), and
   members farther than 1 - 2 radii from all pivots also meet in a region of their own. Where all
   members are about as far from all pivots, as the looser members of a family of near copies are,
   windows hold everything; there members meet by the shingles that most of the region lack
   (``_by_new_shingles``). This is repeated until regions are small. One that does not shrink by
   any of these is joined in squares of parts.
4. Links, as spanning trees of each region, give the connected components.

Words are runs of anything but space and ``\\t\\n\\v\\f\\r``, A-Z lower-cased; a set has the distinct
runs of ``size`` words, or the whole sequence if there are fewer. Sets without words are linked
with nothing. ``component_id`` is the smallest ``doc_id`` of a component (null only where no
member has one); of rows with equal ``doc_id`` each is a document of its own. ``kept`` marks one row
of each component, the one with the smallest ``doc_id`` and, among those, stored first. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import blocks
from ledgerlake.llm.components import roots
from ledgerlake.llm.hashing import LOWER, Spans, mix, word_hashes, words

SIZE = 5
PERCENT = 75
REGION = 512
PIVOTS = 16
MEMBERS_PER_TASK = 2048
_MAX = np.iinfo(np.int64).max
_SETS = "block long, rank int, doc_id long, n_shingles long, set_a long, set_b long, text_sha256 string"
_KEYS = [np.uint64, np.uint16, np.uint16]
_CANDIDATES = "node long, n long, shingles binary, regions array<long>"
_PLACES = "region long, node long, part long"
_NEW = "region long, node long, near boolean, size long, both long, center long, n long, shingles array<long>"
_EDGES = "u long, v long"


class _Sets:
    """Shingle hashes of a block, by document and ascending; each once."""

    def __init__(self, block: blocks.Block, size: int):
        data = LOWER[block.data]
        starts, ends = words(data)
        hashes = word_hashes(data, starts, ends)
        first = np.searchsorted(starts, np.concatenate((block.starts, [len(data)])))
        n_words = np.diff(first)
        doc = np.repeat(np.arange(len(block)), n_words)
        sums = Spans(hashes)
        runs = sums.windows(size)
        whole = np.flatnonzero(doc[: len(runs)] == doc[size - 1 :][: len(runs)])
        short = np.flatnonzero((n_words > 0) & (n_words < size))
        doc = np.concatenate([doc[whole], short])
        value = np.concatenate([runs[whole], sums.of(first[short], first[short + 1])])
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        self.doc, self.value = doc[new], value[new]
        self.cuts = np.searchsorted(self.doc, np.arange(len(block) + 1))
        self.n = np.diff(self.cuts)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set, whatever the order of its members."""
        out = []
        for salt in (0, 0x5851F42D4C957F2D):
            sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(self.value ^ np.uint64(salt)), dtype=np.uint64)))
            out.append(mix(sums[self.cuts[1:]] - sums[self.cuts[:-1]]).view(np.int64))
        return out[0], out[1]


class _Threshold:
    """What a similarity of ``percent`` implies for a set of n shingles and any partner of it."""

    def __init__(self, percent: int):
        self.percent = percent
        self.radius = 1 - percent / 100

    def least_overlap(self, n: np.ndarray) -> np.ndarray:
        return -(-self.percent * n // 100)

    def _common(self, n: np.ndarray) -> np.ndarray:
        """More common keys ask for a longer prefix, but sets that share a passage only fall out."""
        return 1 + n // 8

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """Two linked sets share at least ``common_keys`` of so many smallest members."""
        return n - self.least_overlap(n) + np.minimum(self._common(n), self.least_overlap(n))

    def common_keys(self, n: np.ndarray) -> np.ndarray:
        low = self.least_overlap(n)  # a partner has at least so many members
        return np.minimum(self._common(low), self.least_overlap(low))

    def linked(self, both: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 100 * both >= self.percent * (n + m - both)


def _rows_of_sets(parts: DataFrame, size: int) -> DataFrame:
    schema = pa.schema([("block", pa.int64()), ("rank", pa.int32()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("text_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                block = blocks.Block.of(raw, payload)
                sets = _Sets(block, size)
                a, b = sets.digests()
                sha = [hashlib.sha256(block.text(i)).hexdigest() for i in range(len(block))]
                columns = [np.full(len(block), number), np.arange(len(block), dtype=np.int32), block.id_list(), sets.n, a, b, sha]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return blocks.stored(parts.select("block", "raw_bytes", "payload").mapInArrow(run, _SETS), "sets")


def _classes(sets: DataFrame) -> DataFrame:
    """One row for each distinct set: its key, the row that stands for it, and a number (node)."""
    key = F.coalesce("doc_id", F.lit(_MAX))
    first = F.min(F.struct(key.alias("key"), F.col("block"), F.col("rank"))).alias("first")
    rows = sets.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(first)
    return blocks.stored(rows.select("set_a", "set_b", "n_shingles", "first.*", F.monotonically_increasing_id().alias("node")), "classes")


def _representatives(table: pa.Table) -> pa.Table:
    order = np.argsort(table["rank"].to_numpy())
    return blocks.letter_table([blocks.state_row(table["block"][0].as_py(), table["rank"].to_numpy()[order], table["node"].to_numpy()[order])])


def _count_keys(inbox: blocks.Inbox) -> pa.Table:
    """For keys of several classes: in how many, and the first of these."""
    key, classes, rank = inbox.columns
    holder = mix(inbox.blocks.astype(np.uint64)[inbox.sender] * np.uint64(1 << 16) + rank).view(np.int64)
    order = np.argsort(key, kind="stable")  # letters lie in the order of blocks
    head = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
    entry = np.empty(len(key), dtype=np.int64)
    entry[order] = np.repeat(np.arange(len(head)), np.diff(np.concatenate((head, [len(key)]))))
    times, least = np.add.reduceat(classes[order].astype(np.int64), head)[entry], holder[order][head][entry]
    cuts = np.concatenate(([0], np.cumsum(inbox.sizes)))
    rows = []
    for number, a, b in zip(inbox.blocks, cuts, cuts[1:]):
        shared = times[a:b] > 1
        data = blocks.zip_arrays(np.packbits(shared), np.array([b - a], dtype=np.int64), times[a:b][shared], least[a:b][shared])
        rows.append((int(number), inbox.shard, data))
    return blocks.letter_table(rows)


class _Keys:
    """The prefix keys of a block's representatives, each once, by shard."""

    def __init__(self, sets: _Sets, rank: np.ndarray, threshold: _Threshold, shards: int):
        place = np.arange(len(sets.doc)) - sets.cuts[sets.doc]
        is_rep = np.full(len(sets.n), -1, dtype=np.int64)
        is_rep[rank] = np.arange(len(rank))
        at = np.flatnonzero((place < threshold.prefix(sets.n)[sets.doc]) & (is_rep[sets.doc] >= 0))
        self.rep = is_rep[sets.doc[at]]
        value = sets.value[at]
        shard = blocks.shard_of(mix(value), shards)
        order = np.lexsort((self.rep, value, shard))
        self.rep, value, shard = self.rep[order], value[order], shard[order]
        head = np.ones(len(value), dtype=bool)
        head[1:] = value[1:] != value[:-1]
        self.entry = np.cumsum(head) - 1
        count = np.bincount(self.entry, minlength=int(head.sum()))
        self.columns = shard[head], value[head], count.astype(np.uint16), rank[self.rep][head].astype(np.uint16)
        self.value = value


def _candidates(parts: DataFrame, classes: DataFrame, size: int, threshold: _Threshold) -> DataFrame:
    """Classes that may have links, with the regions in which they meet their partners."""
    shards = blocks.shards_for(parts)
    reps = blocks.stored(classes.select("block", "rank", "node").groupBy("block").applyInArrow(_representatives, blocks.LETTER), "representatives")

    def ask(number, block, mail):
        if not mail.num_rows:
            return blocks.letter_table([])
        (rank, _), _ = blocks.split_state(mail)
        shard, value, count, first = _Keys(_Sets(block, size), rank, threshold, shards).columns
        return blocks.letter_table(blocks.letters(number, shard, [value, count, first]))

    def choose(number, block, mail):
        out = {"node": [], "n": [], "shingles": [], "regions": []}
        if mail.num_rows:
            (rank, node), mail = blocks.split_state(mail)
            sets = _Sets(block, size)
            keys = _Keys(sets, rank, threshold, shards)
            order = np.argsort(mail["shard"].to_numpy(), kind="stable")
            times, least = [], []
            for i in order:
                bits, n, t, least_node = blocks.unzip_arrays(mail["data"][int(i)].as_py())
                shared = np.unpackbits(bits)[: int(n[0])] == 1
                for values, found in ((times, t), (least, least_node)):
                    full = np.zeros(int(n[0]), dtype=np.int64)
                    full[shared] = found
                    values.append(full)
            times = np.concatenate(times)[keys.entry] if times else np.empty(0, np.int64)
            least = np.concatenate(least)[keys.entry] if least else np.empty(0, np.int64)
            at = np.flatnonzero(times > 1)
            at = at[np.lexsort((keys.value[at], times[at], keys.rep[at]))]  # rare keys first
            cuts = np.searchsorted(keys.rep[at], np.arange(len(rank) + 1))
            need = threshold.common_keys(sets.n[rank])
            for r in np.flatnonzero(np.diff(cuts) >= need):
                doc = rank[r]
                own = at[cuts[r] : cuts[r + 1] - (need[r] - 1)]
                out["node"].append(node[r])
                out["n"].append(sets.n[doc])
                out["shingles"].append(sets.value[sets.cuts[doc] : sets.cuts[doc + 1]].tobytes())
                out["regions"].append(np.unique(least[own]).tolist())
        types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types)})

    counted = blocks.answered(blocks.with_answers(parts, reps, ask, blocks.LETTER), _KEYS, _count_keys)
    return blocks.stored(blocks.with_answers(parts, counted.unionByName(reps), choose, _CANDIDATES), "candidates")


def _sets_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes in ascending order, their set sizes, all members' shingles and where each set begins."""
    node = table["node"].to_numpy()
    order = np.argsort(node, kind="stable")
    n = table["n"].to_numpy()[order]
    column = table["shingles"]
    value = np.frombuffer(b"".join(column[int(i)].as_py() for i in order), dtype=np.uint64)
    return node[order], n, value, np.concatenate(([0], np.cumsum(n)))


def _overlaps(n: np.ndarray, value: np.ndarray, columns_at_once: int = 4096) -> np.ndarray:
    """Sizes of all intersections of a bounded number of sets."""
    owner = np.repeat(np.arange(len(n)), n)
    _, column, times = np.unique(value, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    out = np.zeros((len(n), len(n)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(shared.sum()), columns_at_once):
        a, b = np.searchsorted(column, [low, low + columns_at_once])
        part = np.zeros((len(n), min(columns_at_once, int(shared.sum()) - low)), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _spanning(node: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """For each component of a small matrix of links, edges from all its nodes to the first one."""
    left, edges = np.ones(len(node), dtype=bool), []
    for i in range(len(node)):
        if not left[i]:
            continue
        left[i], front = False, [i]
        while front:
            k = front.pop()
            found = np.flatnonzero(linked[k] & left)
            left[found] = False
            edges += [(int(node[j]), int(node[i])) for j in found]
            front += found.tolist()
    return edges


def _between(root: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """The same between groups of members that are connected already: at most one edge fewer than groups."""
    names, group = np.unique(root, return_inverse=True)
    i, j = np.nonzero(linked)
    near = np.zeros((len(names), len(names)), dtype=bool)
    near[group[i], group[j]] = True
    return _spanning(names, near)


def _join_regions(threshold: _Threshold):
    """Edges that connect each region; where members have a ``root`` already, edges between roots only."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("region")
        region = table["region"].to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], region[1:] != region[:-1], [True])))
        edges = []
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                node, n, value, _ = _sets_of(table.slice(int(a), int(b - a)))
                linked = threshold.linked(_overlaps(n, value), n[:, None], n[None, :])
                if "root" in table.column_names:
                    order = np.argsort(table["node"].slice(int(a), int(b - a)).to_numpy(), kind="stable")
                    edges += _between(table["root"].slice(int(a), int(b - a)).to_numpy()[order], linked)
                else:
                    edges += _spanning(node, linked)
        u, v = zip(*edges) if edges else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _distances(members: pa.Table, pivots: pa.Table) -> tuple:
    """Members of one part of a region, the region's pivots, overlaps and distances."""
    node, n, value, cuts = _sets_of(members)
    p_node, p_n, p_value, p_cuts = _sets_of(pivots) if pivots.num_rows else (np.empty(0, np.int64),) * 4
    both = np.zeros((len(node), len(p_node)), dtype=np.int64)
    for j in range(len(p_node)):
        own = p_value[p_cuts[j] : p_cuts[j + 1]]
        hit = own[np.minimum(np.searchsorted(own, value), len(own) - 1)] == value
        both[:, j] = np.add.reduceat(hit.astype(np.int64), cuts[:-1])
    kept = [value[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    return node, n, kept, p_node, p_n, both, 1 - both / (n[:, None] + p_n[None, :] - both)


def _link_to_pivots(threshold: _Threshold):
    """Edges that connect what links with pivots connect."""

    def run(members: pa.Table, pivots: pa.Table) -> pa.Table:
        edges = []
        if members.num_rows and pivots.num_rows:
            node, n, _, p_node, p_n, both, _ = _distances(members, pivots)
            linked = threshold.linked(both, n[:, None], p_n[None, :])
            some = np.flatnonzero(linked.any(axis=1))
            first = p_node[np.argmax(linked[some], axis=1)]
            edges = [(u, v) for u, v in zip(node[some].tolist(), first.tolist()) if u != v]
            edges += _spanning(p_node, linked.T.astype(np.float32) @ linked.astype(np.float32) > 0)  # pivots with a common member
        u, v = zip(*edges) if edges else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _to_windows(threshold: _Threshold):
    """Each member in the Voronoi regions whose windows it lies in."""
    radius, slack = threshold.radius, 1e-9

    def run(members: pa.Table, pivots: pa.Table) -> pa.Table:
        places = []
        if members.num_rows:
            node, _, _, p_node, _, _, distance = _distances(members, pivots)
            parent = members["region"][0].as_py()
            home = distance.min(axis=1) if len(p_node) else np.ones(len(node))
            for i in range(len(node)):
                at = np.flatnonzero((distance[i] < 1) & (distance[i] <= home[i] + 2 * radius + slack))
                names = [_name(parent, int(p_node[j])) for j in at] + ([_name(parent, -1)] if home[i] >= 1 - 2 * radius - slack else [])
                places += [(parent, int(node[i]), name) for name in names]
        columns = zip(*places) if places else ((), (), ())
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("region", "node", "part"), columns)})

    return run


def _new_shingles(members: pa.Table, center: pa.Table) -> pa.Table:
    """The shingles of each member that the region's center lacks; without a center, all."""
    node, size, value, cuts = _sets_of(members) if members.num_rows else (np.empty(0, np.int64),) * 3 + (np.zeros(1, np.int64),)
    order = np.argsort(members["node"].to_numpy(), kind="stable")
    near = ~members["is_open"].to_numpy(zero_copy_only=False)[order]
    own = center["center"][0].values.to_numpy().view(np.uint64) if center.num_rows else np.empty(0, np.uint64)
    sets = [np.setdiff1d(value[a:b], own, assume_unique=True).view(np.int64) for a, b in zip(cuts, cuts[1:])]
    n = np.array([len(x) for x in sets], dtype=np.int64)
    columns = {"region": members["region"].to_numpy(), "node": node, "near": near, "size": size, "both": size - n, "center": np.full(len(n), len(own)), "n": n}
    return pa.table({k: pa.array(v) for k, v in columns.items()} | {"shingles": pa.array(sets, pa.list_(pa.int64()))})


def _name(parent: int, pivot: int) -> int:
    raw = hashlib.blake2b(f"{parent} {pivot}".encode(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def _small_joined(members: DataFrame, n_members: int, threshold: _Threshold) -> DataFrame:
    """Links in regions that fit in a task; many regions share one call."""
    bucket = F.pmod(F.xxhash64("region"), F.lit(1 + n_members // MEMBERS_PER_TASK))
    columns = [c for c in ("region", "node", "n", "shingles", "root") if c in members.columns]
    return members.select(*columns, bucket.alias("bucket")).groupBy("bucket").applyInArrow(_join_regions(threshold), _EDGES)


def _open_joined(marked: DataFrame, state: DataFrame, large: DataFrame, region_size: int, threshold: _Threshold) -> DataFrame:
    """Links of the open members of a region: they join every part of its connected members."""
    parts = F.ceil(F.col("size") / region_size)
    own = F.array(F.pmod(F.xxhash64("node"), parts))
    rows = marked.withColumn("part", F.explode(F.when(F.col("is_open"), F.sequence(F.lit(0).cast("bigint"), parts - 1)).otherwise(own)))
    sizes = large.select("region", "size").distinct().join(state, "region")
    n = sizes.agg(F.sum(F.col("size") + F.col("open") * parts)).first()[0] or 0
    return _small_joined(rows.withColumn("region", F.xxhash64("region", "part")), n, threshold)


def _square_parts(region_size: int):
    return F.ceil(F.col("size") * 2 / region_size)


def _in_squares(members: DataFrame, sizes: DataFrame, region_size: int, threshold: _Threshold, kept) -> list[DataFrame]:
    """Links in large regions that no pivot divides: each part by itself, then every pair of parts.

    What a part connects by itself counts as one in the pairs, so a family of near copies is
    linked once in each part and then between parts, and not by a tree of its own in every pair.
    """
    parts = _square_parts(region_size)
    own = F.pmod(F.xxhash64("node"), F.col("parts"))
    rows = members.join(sizes, "region").withColumn("parts", parts).withColumn("own", own)
    n = sizes.agg(F.sum("size"), F.sum(F.col("size") * parts)).first()
    inside = kept(_small_joined(rows.withColumn("region", F.xxhash64("region", "own")), n[0] or 0, threshold), "square-parts")
    tree = inside.groupBy("u").agg(F.min("v").alias("v"))  # a part is one task, which knows its components
    rows = rows.join(tree, rows["node"] == tree["u"], "left").withColumn("root", F.coalesce("v", "node")).drop("u", "v")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("own <> other")
    square = F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other"))
    return [inside, _small_joined(rows.withColumn("region", square), n[1] or 0, threshold)]


def _unpacked(members: DataFrame) -> DataFrame:
    """One row for each shingle of each member."""
    schema = "region long, node long, n long, shingles array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x, dtype=np.int64) for x in batch.column(3).to_pylist()]
            cuts = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            value = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], value], names=["region", "node", "n", "shingles"])

    return members.select("region", "node", "n", "shingles").mapInArrow(run, schema).select("region", "node", "n", F.explode("shingles").alias("shingle"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Shingles that several members of a region have, by their place among all n of the member, rare ones first."""
    shared = rows.groupBy("region", "shingle").agg(F.count(F.lit(1)).alias("times"), F.min("node").alias("least")).where("times > 1")
    found = rows.join(shared, ["region", "shingle"])
    own = Window.partitionBy("region", "node")
    alone = F.col("n") - F.count(F.lit(1)).over(own)  # shingles of this member only come first
    return found.withColumn("place", alone + F.row_number().over(own.orderBy("times", "shingle")))


def _by_rare_keys(large: DataFrame, threshold: _Threshold) -> DataFrame:
    """Large regions cut by the prefix filter once more, now with the shingles that are rare in the
    region first: members that have only a passage in common share none of those."""
    prefix = F.col("n") - F.ceil(F.col("n") * threshold.percent / 100) + 1
    keys = _ranked(_unpacked(large)).where(F.col("place") <= prefix)
    return keys.select("region", "node", F.xxhash64("region", "least").alias("part")).distinct()


def _by_new_shingles(dealt: DataFrame, all_salts, threshold: _Threshold, kept) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Large regions cut by shingles that the region's center, what most members have, lacks.

    Members that are not open (near) are connected with each other. Linked sets of n and m
    shingles have percent * (n + m) / (100 + percent) in common. If an open (far) member has fewer
    in common with the center than a link with any set of at least ``low`` shingles asks for,
    some of those must be new, and the prefix filter on new shingles finds these links. Returns
    these parts, the members that this does not cover (smaller sets, and far members that
    need not share a new shingle), and their number in each region. ``low`` leaves the fewest.
    """
    most = _unpacked(dealt).groupBy("region", "shingle").agg(F.count(F.lit(1)).alias("times"))
    most = most.join(dealt.select("region", "size").distinct(), "region").where(2 * F.col("times") > F.col("size"))
    center = kept(most.groupBy("region").agg(F.collect_list("shingle").alias("center"), F.max("size").alias("size")), "centers")
    center = center.withColumn("salt", all_salts)
    rows = dealt.groupBy("region", "salt").cogroup(center.groupBy("region", "salt"))
    rows = kept(rows.applyInArrow(_new_shingles, _NEW), "new-shingles")

    def implied(size):
        return F.ceil(threshold.percent * size / (100 + threshold.percent))

    def common(low):
        return implied(F.col("size") + low) - F.col("both")

    def uncovered(low):
        return (F.col("size") < low) | (~F.col("near") & (common(low) < 1))

    lows = [F.col("center") - F.floor(F.col("center") / k) for k in (1 << 30, 64, 32, 16, 8, 4)]
    counts = [F.struct(F.sum(uncovered(low).cast("long")).alias("open"), F.max(low).alias("low")) for low in lows]
    best = kept(rows.groupBy("region").agg(F.array_min(F.array(*counts)).alias("best")).select("region", "best.*"), "uncovered")
    rows = rows.join(best, "region").withColumn("is_open", uncovered(F.col("low")))
    least = F.greatest(F.lit(1), common(F.col("low")))
    keys = rows.where("not is_open").select("region", "node", "near", "n", (F.col("n") - least + 1).alias("prefix"), F.explode("shingles").alias("shingle"))
    keys = _ranked(keys).where("place <= prefix").select("region", "node", "near", F.xxhash64("region", "shingle").alias("part"))
    useful = keys.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.min("near").alias("all_near")).where("size > 1 and not all_near")
    return keys.join(useful.select("part"), "part").select("region", "node", "part"), rows.where("is_open").select("region", "node"), best.select("region", "open")


def _total(sizes: DataFrame, wanted) -> int:
    return sizes.where(wanted).agg(F.sum("size")).first()[0] or 0


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("region").agg(F.count(F.lit(1)).alias("size"))


def _links(candidates: DataFrame, region_size: int, threshold: _Threshold, scratch: list[DataFrame]) -> DataFrame:
    """Edges that connect what is linked; ``scratch`` gets the tables that they are read from."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(blocks.stored(df, name))
        return scratch[-1]

    small, big = F.col("size") <= region_size, F.col("size") > region_size
    sizes = kept(_sizes(candidates.select(F.explode("regions").alias("region"))), "sizes")
    crowded = kept(sizes.where(big), "crowded")
    places = candidates.select("node", "n", "shingles", F.explode("regions").alias("region"))
    edges = [_small_joined(places.join(crowded, "region", "left_anti"), _total(sizes, small), threshold)]
    large = kept(places.join(crowded, "region"), "large-regions")
    tree = None
    level = 0
    while large.head(1):
        # 1. what is linked with the same pivots, or with others that are, is connected already
        chance = F.pmod(F.xxhash64("node", "region", F.lit(level)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        salts = F.ceil(F.col("size") / MEMBERS_PER_TASK)
        salt, all_salts = F.pmod(F.xxhash64("node"), salts), F.explode(F.sequence(F.lit(0), salts - 1))
        chosen = kept(large.where(chance < F.lit(float(PIVOTS)) / F.col("size")), "pivots")
        pivots, dealt = chosen.withColumn("salt", all_salts), large.withColumn("salt", salt)
        to_pivots = dealt.groupBy("region", "salt").cogroup(pivots.groupBy("region", "salt"))
        to_pivots = kept(to_pivots.applyInArrow(_link_to_pivots(threshold), _EDGES), "pivot-links")
        tree = roots(to_pivots if tree is None else to_pivots.unionByName(tree))
        scratch.append(tree)
        part = large.join(tree, large["node"] == tree["u"], "left").withColumn("part", F.coalesce("v", "node"))
        counts = part.groupBy("region", "part").agg(F.count(F.lit(1)).alias("c"), F.max("size").alias("size"))
        state = counts.groupBy("region").agg(F.max_by("part", F.struct("c", "part")).alias("main"), (F.max("size") - F.max("c")).alias("open"))
        state = kept(state.where("open > 0"), "open-regions")
        marked = part.join(state, "region").withColumn("is_open", F.col("part") != F.col("main"))
        marked = marked.select("region", "node", "n", "shingles", "size", "open", "is_open", F.col("part").alias("root"))
        # 2. a few members that are not connected yet meet all others, a part of them at a time
        few = F.col("open") <= region_size
        edges.append(_open_joined(marked.where(few), state.where(few), large, region_size, threshold))
        # 3. regions in which too little holds together are cut
        rest = kept(marked.where(~few).drop("open"), "large-regions")
        if not rest.head(1):
            break
        dealt = rest.withColumn("salt", salt)

        squares = rest.select("region", "size").distinct()
        most = squares.agg(F.sum(F.col("size") ** 2), F.sum(F.col("size") * _square_parts(region_size))).first()

        def cut(places):
            """Parts, their sizes, and whether they are worth it: fewer pairs in large ones, no more rows than in squares."""
            places = kept(places, "cut-regions")
            now = kept(_sizes(places.select(F.col("part").alias("region"))).where("size > 1"), "sizes")
            pairs, n = now.agg(F.sum(F.when(big, F.col("size") ** 2)), F.sum("size")).first()
            return places, now, 2 * (pairs or 0) <= most[0] and (n or 0) <= most[1]

        if level == 0:
            places, now, _ = cut(_by_rare_keys(rest, threshold))
        else:
            again = pivots.join(rest.select("region").distinct(), "region", "left_semi")
            windows = dealt.groupBy("region", "salt").cogroup(again.groupBy("region", "salt"))
            places, now, divided = cut(windows.applyInArrow(_to_windows(threshold), _PLACES))
            if not divided:
                places, uncovered, state = _by_new_shingles(dealt, all_salts, threshold, kept)
                places, now, divided = cut(places)
                if not divided or state.where(F.col("open") > region_size).head(1):
                    edges += _in_squares(rest.drop("size", "is_open", "root"), squares, region_size, threshold, kept)
                    break
                uncovered = uncovered.withColumn("uncovered", F.lit(True))
                marked = rest.drop("is_open").join(uncovered, ["region", "node"], "left").withColumn("is_open", F.coalesce("uncovered", F.lit(False))).drop("uncovered")
                edges.append(_open_joined(marked, state, rest, region_size, threshold))
        members = places.join(rest.drop("size", "is_open"), ["region", "node"]).drop("region").withColumnRenamed("part", "region").join(now, "region")
        edges.append(_small_joined(members.where(small), _total(now, small), threshold))
        large = kept(members.where(big).drop("root"), "large-regions")
        level += 1
    return reduce(DataFrame.unionByName, edges if tree is None else [*edges, tree])


def similar_groups(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, region_size: int = REGION, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, kept, text_sha256."""
    threshold = _Threshold(percent)
    parts = blocks.packed(docs, id_column, text_column)
    sets = _rows_of_sets(parts, size)
    classes = _classes(sets)
    candidates = _candidates(parts, classes, size, threshold)
    blocks.release(parts)
    scratch = [candidates]
    tree = roots(_links(candidates, region_size, threshold, scratch))
    blocks.release(*scratch)
    rooted = classes.join(tree, classes["node"] == tree["u"], "left").select("set_a", "set_b", "n_shingles", "key", "block", "rank", F.coalesce("v", "node").alias("root"))
    first = rooted.groupBy("root").agg(F.min(F.struct("key", "block", "rank")).alias("first"))
    of_class = rooted.select("set_a", "set_b", "n_shingles", "root").join(first, "root").select("set_a", "set_b", "n_shingles", "first")
    rows = sets.where("n_shingles > 0").join(of_class, ["set_a", "set_b", "n_shingles"])
    component = F.when(F.col("first.key") < _MAX, F.col("first.key"))
    kept = (F.col("block") == F.col("first.block")) & (F.col("rank") == F.col("first.rank"))
    grouped = rows.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "text_sha256")
    empty = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "text_sha256")
    return grouped.unionByName(empty)
