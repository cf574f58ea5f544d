"""Components of documents whose sets of word n-grams are alike, by an exact Jaccard self-join.

Candidates come from prefixes: in an order with rare shingles first, two sets
that are alike share one of the first few of each. Groups of sets that
candidates connect are joined in tasks of bounded size. There, lists of the
index are blocks by position, of which those too far back are skipped, and a
set's overlaps with all others are derived from those of a highly similar set:
only the shingles in which the two differ are looked up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import hash_pair, values_of, width
from sluice.llm.components import connected
from sluice.llm.shingles import set_digest, shingle_set
from sluice.session import written

# Of a shingle's hash, so many leading bits name it where frequencies are counted.
KEY_BITS = 40
# Cells of the table that tells how many sets a shingle may be in: 2**27 cells of two bits are 32 MB on every worker.
CELL_BITS = 27
# A cell's class is that of its most frequent shingle: below 2 sets, below 8, below 64, or more.
CLASSES = (2, 8, 64)
# At most 2**19 shingles are frequent: those in at least 1 / 2**19 of all (set, shingle) pairs.
FREQUENT_BITS, FREQUENT_LEAST = 19, 32
# Shingles that a task gathers before it writes counts, and that one group of sets may have in a task.
FLUSH, GROUP = 2_000_000, 4_000_000
# What names a row whose text has a set: its id and the hash of the text.
HOLDER = ["doc_id", "t1", "t2"]


@dataclass(frozen=True)
class Alike:
    """Sets x and y are alike if 100 * overlap >= percent * union."""

    size: int = 4
    percent: int = 85

    def least(self, n):
        """The smallest overlap of a set of ``n`` with any set that is like it."""
        return (self.percent * n + 99) // 100

    def holds(self, overlap, a, b):
        return 100 * overlap >= self.percent * (a + b - overlap)


def _members(docs: DataFrame, rule: Alike) -> DataFrame:
    """(doc_id, t1, t2, n, s1, s2): the size and the digest of every row's set; ``docs`` has doc_id, text, and the text's hash t1, t2."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in values_of(batch.column(1)):
                s = shingle_set(text, rule.size)
                found.append((len(s), *set_digest(s)))
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 3
            row = [batch.column(0), batch.column(2), batch.column(3)]
            yield pa.RecordBatch.from_arrays([*row, *columns], ["doc_id", "t1", "t2", "n", "s1", "s2"])

    return docs.mapInArrow(sized, "doc_id bigint, t1 bigint, t2 bigint, n bigint, s1 bigint, s2 bigint")


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising keys as differences, byte by byte, and their counts, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T
    body = np.ascontiguousarray(steps).tobytes() + np.minimum(counts, 2**32 - 1).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(keys).to_bytes(8, "little") + zstandard.compress(body, 1)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, body = int.from_bytes(blob[:8], "little"), np.frombuffer(zstandard.decompress(blob[8:]), dtype=np.uint8)
    steps = np.zeros((n, 8), dtype=np.uint8)
    steps[:, :6] = body[: 6 * n].reshape(6, n).T
    counts = np.ascontiguousarray(body[6 * n :].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), counts.astype(np.int64)


@dataclass(frozen=True)
class Frequencies:
    """In how many sets, by class, a shingle may be, and how often the frequent ones are."""

    cells: np.ndarray
    keys: np.ndarray
    counts: np.ndarray

    def classes(self, shingles: np.ndarray) -> np.ndarray:
        """0: in one set only; 1 to 3: may be in more; from 4 on: frequent, the more the higher. A function of the shingle."""
        cell = shingles >> np.uint64(64 - CELL_BITS)
        shift = (np.uint64(6) - np.uint64(2) * (cell & np.uint64(3))).astype(np.uint8)
        out = (self.cells[cell >> np.uint64(2)] >> shift & 3).astype(np.int64)
        if len(self.keys):
            key = shingles >> np.uint64(64 - KEY_BITS)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out = np.where(self.keys[at] == key, 4 + self.counts[at], out)
        return out


def _frequencies(docs: DataFrame, rule: Alike, pairs: int) -> Frequencies:
    """Count shingles over all sets; equal sets count once in a task.

    Counts of a range of hashes meet in one place, as sorted runs of bounded
    size; what comes back are the range's bits and its frequent shingles.
    """
    range_bits = max(1, min(16, math.ceil(math.log2(16 * width(docs.sparkSession)))))
    least = max(FREQUENT_LEAST, pairs >> FREQUENT_BITS)
    shift, ranges = np.uint64(KEY_BITS - range_bits), 1 << range_bits

    def flushed(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        at = np.searchsorted(keys, np.arange(ranges + 1, dtype=np.uint64) << shift)
        full = np.flatnonzero(at[1:] > at[:-1]).tolist()
        blobs = [_packed(keys[at[r] : at[r + 1]] - (np.uint64(r) << shift), counts[at[r] : at[r + 1]]) for r in full]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], ["range", "blob"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in batches:
            for text in values_of(batch.column(0)):
                s = shingle_set(text, rule.size)
                digest = set_digest(s)
                if not len(s) or digest in seen:
                    continue
                seen.add(digest)
                held.append(np.unique(s >> np.uint64(64 - KEY_BITS)))
                size += len(s)
                if size >= FLUSH:
                    yield flushed(held)
                    held, size = [], 0
        if held:
            yield flushed(held)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, runs = None, []
        for batch in batches:
            for r, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if r != now:
                    if runs:
                        yield result(now, runs)
                    now, runs = r, []
                runs.append(_unpacked(blob))
        if runs:
            yield result(now, runs)

    def result(r: int, runs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, place = np.unique(np.concatenate([k for k, _ in runs]), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([c for _, c in runs])).astype(np.int64)
        kinds = np.zeros(1 << (CELL_BITS - range_bits), dtype=np.uint8)
        more = counts > 1
        found = np.searchsorted(CLASSES, counts[more], "right").astype(np.uint8)
        np.maximum.at(kinds, (keys[more] >> np.uint64(KEY_BITS - CELL_BITS)).astype(np.int64), found)
        four = kinds.reshape(-1, 4)
        bits = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
        many = counts >= least
        columns = [
            pa.array([r], pa.int32()), pa.array([bits.tobytes()], pa.binary()),
            pa.array([(keys[many] + (np.uint64(r) << shift)).tobytes()], pa.binary()), pa.array([counts[many].tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["range", "bits", "keys", "counts"])

    runs = docs.select("text").mapInArrow(counted, "range int, blob binary")
    dealt = runs.repartition(width(docs.sparkSession), "range").sortWithinPartitions("range")
    found = written(dealt.mapInArrow(summed, "range int, bits binary, keys binary, counts binary"), "frequencies")
    cells = np.zeros((ranges, 1 << (CELL_BITS - range_bits - 2)), dtype=np.uint8)
    keys, counts = [], []
    for row in found.sort("range").toLocalIterator():  # 2**CELL_BITS cells and 2**FREQUENT_BITS shingles in all
        cells[row["range"]] = np.frombuffer(row["bits"], dtype=np.uint8)
        keys.append(np.frombuffer(row["keys"], dtype=np.uint64))
        counts.append(np.frombuffer(row["counts"], dtype=np.int64))
    none = [np.empty(0)]
    return Frequencies(cells.ravel(), np.concatenate(keys or none).astype(np.uint64), np.concatenate(counts or none).astype(np.int64))


def _prefixes(docs: DataFrame, rule: Alike, frequencies) -> DataFrame:
    """(shingle, s1, s2, n): of every set the first shingles, without those in one set only."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = frequencies.value, set()
        for batch in batches:
            out = []
            for text in values_of(batch.column(0)):
                s = shingle_set(text, rule.size)
                digest, n = set_digest(s), len(s)
                if not n or digest in seen:
                    continue
                seen.add(digest)
                kinds = known.classes(s)
                shared, length = np.flatnonzero(kinds), n - rule.least(n) + 1
                wanted = length - (n - len(shared))
                if wanted < 1:
                    continue
                first = shared[np.lexsort((s[shared], kinds[shared]))[:wanted]]
                out.append((s[first].view(np.int64), *digest, n))
            if out:
                lengths = [len(o[0]) for o in out]
                columns = [pa.array(np.concatenate([o[0] for o in out]))]
                columns += [pa.array(np.repeat(np.array([o[i] for o in out], dtype=np.int64), lengths)) for i in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "s1", "s2", "n"])

    return docs.select("text").mapInArrow(cut, "shingle bigint, s1 bigint, s2 bigint, n bigint")


def _candidate_links(prefixes: DataFrame, sets: DataFrame, rule: Alike) -> DataFrame:
    """(a, b): links that connect all sets that share a prefix shingle and whose sizes are near.

    Sets of one shingle and of neighbouring size classes are linked to the
    smallest of them only, so links grow with the prefixes and not with pairs.
    """
    # Sizes of sets that are alike are in the same or in neighbouring classes.
    step = math.log(100 / rule.percent) * (1 + 1e-9)
    kind = F.floor(F.log(F.col("n").cast("double")) / step)
    rows = prefixes.join(sets.select("s1", "s2", "node"), ["s1", "s2"]).select("shingle", "node", kind.alias("kind")).distinct()
    rows = written(rows.select("shingle", "node", F.explode(F.array("kind", F.col("kind") + 1)).alias("kind")), "prefixes")
    roots = rows.groupBy("shingle", "kind").agg(F.min("node").alias("root"), F.count("*").alias("c")).where("c > 1")
    # Any share of the rows may have one shingle: they are streamed past its root, and Spark splits large ones.
    linked = rows.join(written(roots, "roots").hint("merge"), ["shingle", "kind"]).where(F.col("node") != F.col("root"))
    return linked.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()


class _Groups:
    """Union-find over the sets of one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


class _Index:
    """Lists of the sets that have each shingle, over sets that are sorted by size.

    ``first`` are lists of prefix places only, each sorted by how much of the
    set is left from there, largest first: places with too little left to reach
    a wanted overlap are one block at the list's end, which is skipped.
    """

    def __init__(self, sets: list[np.ndarray], rule: Alike):
        self.rule, self.sizes = rule, np.array([len(s) for s in sets], dtype=np.int64)
        which = np.repeat(np.arange(len(sets)), self.sizes)
        tokens, local, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # Shingles of one set only are left out, but keep their place in front of all others.
        by_rarity = np.argsort(counts, kind="stable")
        rank = np.empty(len(tokens), dtype=np.int64)
        rank[by_rarity] = np.arange(len(tokens))
        ones = int((counts == 1).sum())
        shared = counts[local] > 1
        order = np.lexsort((rank[local[shared]], which[shared]))
        self.token, self.set = rank[local[shared]][order] - ones, which[shared][order]
        self.begin = np.searchsorted(self.set, np.arange(len(sets) + 1))
        alone = self.sizes - np.diff(self.begin)
        place = np.arange(len(self.set)) - self.begin[self.set] + alone[self.set]
        by_token = np.argsort(self.token, kind="stable")
        self.lists, self.list_at = self.set[by_token], np.searchsorted(self.token[by_token], np.arange(len(tokens) - ones + 1))
        self.prefix = self.sizes - rule.least(self.sizes) + 1
        left = self.sizes[self.set] - place
        inside = place < self.prefix[self.set]
        self.span = int(self.sizes.max()) + 1
        keys = self.token[inside] * self.span + (self.span - left[inside])
        order = np.argsort(keys, kind="stable")
        self.first_key, self.first_set = keys[order], self.set[inside][order]
        self.alone = alone

    def tokens(self, x: int) -> np.ndarray:
        return self.token[self.begin[x] : self.begin[x + 1]]

    @staticmethod
    def _gather(flat: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        lengths = high - low
        return flat[np.repeat(low - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))]

    def may_match(self, x: int) -> bool:
        """Whether a set of near size shares a prefix shingle, with enough left behind it."""
        tokens = self.tokens(x)[: max(0, self.prefix[x] - self.alone[x])]
        need = self.rule.least(int(self.sizes[x]))
        low = np.searchsorted(self.first_key, tokens * self.span)
        # Any set like this one shares at least so many, all behind the first common place.
        high = np.searchsorted(self.first_key, tokens * self.span + (self.span - need), "right")
        found = self._gather(self.first_set, low, high)
        near = (100 * self.sizes[found] >= self.rule.percent * self.sizes[x]) & (self.rule.percent * self.sizes[found] <= 100 * self.sizes[x])
        return bool((near & (found != x)).any())

    def added(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the shingles each set has."""
        return np.bincount(self._gather(self.lists, self.list_at[tokens], self.list_at[tokens + 1]), minlength=len(self.sizes))


def alike_groups(sets: list[np.ndarray], rule: Alike) -> list[int]:
    """For each set the number of the first set it is connected with; sets are different and not empty.

    Exact: every pair whose sets are alike is found.
    """
    n = len(sets)
    if n == 1:
        return [0]
    order = sorted(range(n), key=lambda i: (len(sets[i]), i))
    index, groups = _Index([sets[i] for i in order], rule), _Groups(n)
    before, known = None, None
    for x in range(n):
        if not index.may_match(x):
            continue
        own = index.tokens(x)
        if before is not None:
            gone, new = np.setdiff1d(before, own, assume_unique=True), np.setdiff1d(own, before, assume_unique=True)
        if before is not None and len(gone) + len(new) < len(own) // 2:
            known = known - index.added(gone) + index.added(new)
        else:
            known = index.added(own)
        before = own
        for y in np.flatnonzero(rule.holds(known, index.sizes, index.sizes[x])).tolist():
            if y != x:
                groups.join(order[x], order[y])
    return [groups.find(i) for i in range(n)]


def _links(docs: DataFrame, sets: DataFrame, labels: DataFrame, rule: Alike) -> DataFrame:
    """(a, b, whole): links that connect exactly the sets that are connected by being alike.

    Each candidate group goes to a task with the texts of its sets: its links are ``whole``, from every connected
    set, itself included, to the first one. A group too large for one is dealt into blocks, and every two blocks meet in a task.
    """
    placed = labels.join(sets, "node")
    total = placed.groupBy("label").agg(F.sum("n").alias("total")).where(F.col("total") > GROUP)
    # Those in blocks are few: each has more shingles than fit in a task.
    large = total.select("label", (F.ceil(2 * F.col("total") / F.lit(GROUP)) - 1).cast("int").alias("blocks"))
    placed = placed.join(F.broadcast(large), "label", "left").fillna(1, ["blocks"])
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = placed.select("node", "label", "s1", "s2", "blocks", block.alias("block"), *[F.col("holder")[c].alias(f"of_{c}") for c in HOLDER])
    # Rows without an id, or that repeat one, are told apart by the hash of their text.
    mine = [docs[c].eqNullSafe(placed[f"of_{c}"]) for c in HOLDER]
    texts = docs.join(placed, mine[0] & mine[1] & mine[2]).select("node", "label", "s1", "s2", "blocks", "block", "text")
    met = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "blocks", "node", "s1", "s2", "text"
    )
    dealt = met.repartition(width(docs.sparkSession), "label", "i", "j").sortWithinPartitions("label", "i", "j", "node")

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets_here = (None, None, None, 0), [], []
        for batch in batches:
            label, i, j, blocks, node, s1, s2, text = (c.to_pylist() for c in batch.columns)
            out = []
            for r in range(batch.num_rows):
                key = label[r], i[r], j[r], blocks[r]
                if key != now:
                    out += linked(nodes, sets_here, now[3] == 1)
                    now, nodes, sets_here = key, [], []
                s = shingle_set(text[r], rule.size)
                # Rows that repeat an id may have other texts, or the same one again.
                if set_digest(s) == (s1[r], s2[r]) and (not nodes or nodes[-1] != node[r]):
                    nodes.append(node[r])
                    sets_here.append(s)
            if out:
                yield batch_of(out)
        out = linked(nodes, sets_here, now[3] == 1)
        if out:
            yield batch_of(out)

    def linked(nodes: list[int], sets_here: list[np.ndarray], whole: bool) -> list[tuple[int, int, bool]]:
        if len(nodes) < 2:
            return []
        groups = alike_groups(sets_here, rule)
        more = {y for x, y in enumerate(groups) if x != y}
        return [(nodes[x], nodes[y], whole) for x, y in enumerate(groups) if y in more]

    def batch_of(out: list[tuple[int, int, bool]]) -> pa.RecordBatch:
        a, b, whole = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(whole, pa.bool_())], ["a", "b", "whole"])

    return dealt.mapInArrow(solved, "a bigint, b bigint, whole boolean")


def _labels(links: DataFrame) -> DataFrame:
    """(node, label) from ``_links``: whole ones are labels already, and only those of groups in blocks are connected."""
    links = written(links, "alike")
    labels, parted = links.where("whole").select(F.col("a").alias("node"), F.col("b").alias("label")), links.where("NOT whole").select("a", "b")
    return labels if parted.isEmpty() else labels.unionByName(connected(parted))


def join_ngrams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Alike | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    ``component_id`` is the smallest id that can be reached over links between
    documents whose sets are alike, the document's own included; equal sets are
    alike, empty ones are like nothing. A NULL text is empty. Rows without an
    id take part; their component's id is NULL if no row in it has one. Rows
    may repeat.
    """
    rule = rule or Alike()
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *hash_pair(F.col(text_col), "t1", "t2"))
    members = written(_members(slim, rule), "members")
    full = members.where("n > 0")
    sets = full.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("low"), F.min(F.struct(*HOLDER)).alias("holder"))
    sets = written(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    pairs = sets.agg(F.sum("n")).first()[0] or 0
    frequencies = spark.sparkContext.broadcast(_frequencies(slim, rule, pairs))  # 2**CELL_BITS cells and a list of bounded length
    links = _candidate_links(_prefixes(slim, rule, frequencies), sets, rule)
    frequencies.destroy()  # prefixes are written
    labels = _labels(_links(slim, sets, connected(links), rule))
    lows = labels.join(sets.select("node", "low").hint("merge"), "node")
    lowest = written(lows.groupBy("label").agg(F.min("low").alias("lowest")), "lowest")
    # Sets of one label, and rows of one set, may be many: they are streamed past what they look up, and Spark splits large ones.
    of_node = labels.join(lowest.hint("merge"), "label").select("node", "lowest")
    of_set = sets.join(of_node.hint("merge"), "node", "left").select("s1", "s2", F.coalesce("lowest", "low").alias("lowest"))
    joined = full.join(of_set.hint("merge"), ["s1", "s2"])
    alone = members.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("lowest"))
    every = joined.select("doc_id", "n", "lowest").unionByName(alone)
    return every.select("doc_id", F.col("n").alias("n_shingles"), F.col("lowest").alias("component_id"))
