"""Prefix trie of conversations, built as z-fast tries.

A z-fast trie keeps compacted nodes in a hash table under their handle: the
hash of the prefix whose length is the two-fattest number of the node's edge.
Where a conversation leaves the trie (its exit node) is found by a fat binary
search over prefix lengths, in a number of look-ups that is the logarithm of its turns.

Conversations are dealt out in ranges of their first turns, each task inserts
them in batches into a trie of bounded size, and edges are expanded to one row for each
prefix. Tries of different tasks meet only where prefixes lie in both; there the
rows are united by the 128-bit hash of the prefix. Results do not depend on how conversations were dealt out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import width
from sluice.session import written

ROOT = bytes(16)
# Turns and ids that one trie holds before its edges are expanded and it starts anew.
TRIE_TURNS = 1 << 17
# So many first turns order the conversations that tasks get; it only decides which of them share a trie.
ORDER_TURNS = 16


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def prefix_hashes(turns: Iterable[bytes]) -> list[bytes]:
    """The hash of each prefix, from the one without turns on."""
    out = [ROOT]
    for turn in turns:
        out.append(blake2b(out[-1] + turn, digest_size=16).digest())
    return out


class ZFastTrie:
    """A compacted trie over prefix hashes; node 0 is the root.

    A node's edge covers the depths (``top``, ``depth``]; ``path`` is a list of
    prefix hashes of which the first ``depth`` + 1 are the node's, ``sizes`` the bytes of its turns.
    """

    def __init__(self) -> None:
        self.top, self.depth, self.parent = [0], [0], [-1]
        self.path: list[list[bytes]] = [[ROOT]]
        self.sizes: list[list[int]] = [[]]
        self.ends: list[list[int]] = [[]]
        self.handles: dict[bytes, int] = {}
        # The node below an edge, by the first hash on the edge.
        self.below: dict[bytes, int] = {}
        self.held = 0

    def _handle(self, node: int) -> bytes:
        return self.path[node][two_fattest(self.top[node], self.depth[node])]

    def exit_node(self, path: list[bytes], start: int = 0) -> int:
        """The node on whose edge, or at whose end, ``path`` leaves the trie; ``start`` is a node that it passes.

        Fat binary search: a handle that is there leads to its node's end or, where the path
        leaves before that, is the exit; one that is not there rules out all longer prefixes.
        """
        node, low, high = start, self.depth[start], len(path) - 1
        while low < high:
            at = two_fattest(low, high)
            hit = self.handles.get(path[at])
            if hit is None:
                high = at - 1
                continue
            end = self.depth[hit]
            if end >= len(path) or self.path[hit][end] != path[end]:
                return hit
            node, low = hit, end
        # The path may leave on the next edge before that edge's handle.
        return self.below.get(path[low + 1], node) if low + 1 < len(path) else node

    def _add(self, parent: int, top: int, depth: int, path: list[bytes], sizes: list[int]) -> int:
        node = len(self.top)
        for column, value in zip(
            (self.top, self.depth, self.parent, self.path, self.sizes, self.ends), (top, depth, parent, path, sizes, []), strict=True
        ):
            column.append(value)
        self.below[path[top + 1]] = node
        self.handles[self._handle(node)] = node
        return node

    def _split(self, node: int, at: int) -> int:
        """Cut a node's edge at a depth; the upper part becomes a node of its own."""
        del self.handles[self._handle(node)]
        upper = self._add(self.parent[node], self.top[node], at, self.path[node], self.sizes[node])
        self.top[node], self.parent[node] = at, upper
        self.below[self.path[node][at + 1]] = node
        self.handles[self._handle(node)] = node
        return upper

    def _insert(self, path: list[bytes], sizes: list[int], start: int) -> int:
        """The node at which ``path`` ends, made where it is not there."""
        node, length = self.exit_node(path, start), len(path) - 1
        end = self.depth[node]
        if end > length or self.path[node][end] != path[end]:
            # Prefix hashes agree up to where the paths part.
            own, low, high = self.path[node], self.top[node] + 1, min(end, length)
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if own[mid] == path[mid] else (low, mid - 1)
            node, end = self._split(node, low), low
        if end == length:
            return node
        self.held += length - end
        return self._add(node, end, length, path, sizes)

    def insert(self, batch: list[tuple[int, list[bytes], list[int]]]) -> None:
        """Add conversations (id, prefix hashes, bytes of turns).

        Exits of the different paths are located first, in the trie as it is; then each
        path goes in below the node that its exit hangs from, which stays whatever is added.
        """
        different: dict[bytes, list] = {}
        for conv, path, sizes in batch:
            different.setdefault(path[-1], [path, sizes, []])[2].append(conv)
        exits = [self.exit_node(path) for path, _, _ in different.values()]
        starts = [max(self.parent[e], 0) for e in exits]
        for (path, sizes, convs), start in zip(different.values(), starts, strict=True):
            self.ends[self._insert(path, sizes, start)] += convs
            self.held += len(convs)

    def expanded(self) -> Iterator[tuple]:
        """(depth, hash, parent hash, members, smallest member, bytes of the last turn, ids that end) of every prefix."""
        count = [len(e) for e in self.ends]
        least = [min(e, default=None) for e in self.ends]
        for node in sorted(range(1, len(self.top)), key=lambda n: -self.depth[n]):
            up = self.parent[node]
            count[up] += count[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
        yield 0, ROOT, None, count[0], least[0], 0, sorted(self.ends[0]) or None
        for node in range(1, len(self.top)):
            path, sizes, last = self.path[node], self.sizes[node], self.depth[node]
            for d in range(self.top[node] + 1, last + 1):
                ids = sorted(self.ends[node]) if d == last and self.ends[node] else None
                yield d, path[d], path[d - 1], count[node], least[node], sizes[d - 1], ids


_NODES = "part long, depth int, hash binary, parent binary, n_convs long, conv_id long, bytes long, ids array<long>"
_NODE_TYPES = pa.schema([
    ("part", pa.int64()), ("depth", pa.int32()), ("hash", pa.binary()), ("parent", pa.binary()), ("n_convs", pa.int64()),
    ("conv_id", pa.int64()), ("bytes", pa.int64()), ("ids", pa.list_(pa.int64())),
])


def _batched(rows: Iterable[tuple], types: pa.Schema, most: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types.types)], schema=types)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types.types)], schema=types)


def _tries(trie_turns: int):
    """Batches of (conv_id, turns, sizes) to the expanded rows of tries that hold about ``trie_turns``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, trie = TaskContext.get().partitionId() << 32, ZFastTrie()
        for batch in batches:
            # Few conversations at a time: a long one has many turns.
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                paths = [prefix_hashes(turns) for turns in some.column(1).to_pylist()]
                trie.insert(list(zip(some.column(0).to_pylist(), paths, some.column(2).to_pylist(), strict=True)))
                if trie.held >= trie_turns:
                    yield from ((part, *row) for row in trie.expanded())
                    part, trie = part + 1, ZFastTrie()
        if trie.ends[0] or len(trie.top) > 1:
            yield from ((part, *row) for row in trie.expanded())

    return lambda batches: _batched(rows(batches), _NODE_TYPES)


def _by_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows as one table for each value of the first column."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if held and keys[low] != key:
                yield pa.Table.from_batches(held)
                held = []
            key = keys[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


_SUMS = "hash binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_SUM_TYPES = pa.schema([
    ("hash", pa.binary()), ("depth", pa.int32()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
])


def _subtree_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each trie, sums over subtrees of what its own nodes have.

    A node counts in the trie that owns it and in no other, so that sums of all tries add up.
    """
    for table in _by_run(batches):
        part, depth, hashes, parents, n_convs, conv_id, size, n_children, owner = (c.to_pylist() for c in table.columns)
        place = {h: i for i, h in enumerate(hashes)}
        owns = [o == p for o, p in zip(owner, part, strict=True)]
        leaves = [int(own and not kids) for own, kids in zip(owns, n_children, strict=True)]
        saved = [(n - 1) * b if own else 0 for own, n, b in zip(owns, n_convs, size, strict=True)]
        above = [None] * len(hashes)
        for i in sorted(range(len(hashes)), key=lambda i: -depth[i]):
            if parents[i] is not None:
                up = place[parents[i]]
                leaves[up] += leaves[i]
                saved[up] += saved[i]
                above[i] = conv_id[up]
        yield from _batched(zip(hashes, depth, conv_id, above, n_convs, n_children, leaves, saved, strict=True), _SUM_TYPES)


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (hash, first, ids) to (hash, SHA-256 of all ids of the hash, rising and joined by commas), read as a stream."""

    def rows() -> Iterator[tuple]:
        key, state, empty, waiting = None, None, True, []

        def feed(ids: list[int]) -> None:
            nonlocal empty
            if ids:
                state.update(("" if empty else ",").encode() + ",".join(map(str, ids)).encode())
                empty = False

        for batch in batches:
            for at in range(batch.num_rows):
                found, first, ids = (batch.column(i)[at].as_py() for i in range(3))
                if found != key:
                    if key is not None:
                        feed(waiting)
                        yield key, state.hexdigest()
                    key, state, empty, waiting = found, sha256(), True, []
                # Lists of one prefix overlap only where conversations were not dealt out in order of their ids.
                done = np.searchsorted(np.array(waiting, dtype=np.int64), first) if waiting else 0
                feed(waiting[:done])
                waiting = sorted(waiting[done:] + ids) if waiting[done:] else ids
        if key is not None:
            feed(waiting)
            yield key, state.hexdigest()

    yield from _batched(rows(), pa.schema([("hash", pa.binary()), ("ends_sha256", pa.string())]))


def rebuilt_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns, sizes`` of every conversation c: the first h turns of c - c % 5, then its own after its first h.

    h is the CRC-32 of the decimal c, modulo 9. ``turns`` are 128-bit digests of role and text, ``sizes`` the bytes of
    the texts. Only digests are moved; conversations that share turns come to one task by c - c % 5.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turn = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    conv = F.col("conv_id").cast("long")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        conv.alias("conv_id"), (conv - conv % 5).alias("base"),
        F.struct(F.col("turn").alias("at"), turn.alias("turn"), F.octet_length(text).cast("long").alias("bytes")).alias("t"),
    )
    own = rows.repartition(width(conversations.sparkSession), "base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    none = F.lit(None).cast(own.schema["own"].dataType)
    head = F.expr("max(head) OVER (PARTITION BY base)")
    own = own.withColumn("head", F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, 8)).otherwise(none)).withColumn("head", head)
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    first = F.slice(F.coalesce("head", F.slice("own", 1, 0)), F.lit(1), h)
    path = F.concat(first, F.slice("own", h + 1, F.size("own")))
    return own.select("conv_id", path.alias("path")).select("conv_id", F.col("path.turn").alias("turns"), F.col("path.bytes").alias("sizes"))


def prefix_trie(rebuilt: DataFrame, trie_turns: int = TRIE_TURNS) -> DataFrame:
    """Every different prefix of ``rebuilt`` (``conv_id`` unique, ``turns``, ``sizes``) as a node.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256`` and ``hash``, the prefix's. Without conversations there is no node.
    """
    tasks = width(rebuilt.sparkSession)
    stored = written(rebuilt, "trie-conversations")
    order = [F.transform(F.slice("turns", 1, ORDER_TURNS), lambda t: F.xxhash64(t)).alias("o1"), F.xxhash64("turns").alias("o2")]
    keys = ["o1", "o2", "conv_id"]
    dealt = stored.select("*", *order).repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    nodes = written(dealt.select("conv_id", "turns", "sizes").mapInArrow(_tries(trie_turns), _NODES), "trie-nodes")

    united = nodes.groupBy("hash").agg(
        F.max("parent").alias("parent"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.max("bytes").alias("bytes"), F.min("part").alias("owner"),
    )
    united = written(united, "trie-united")
    children = united.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "hash")
    values = united.drop("parent").join(children.hint("merge"), "hash", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    placed = nodes.select("part", "depth", "hash", "parent").join(values.hint("merge"), "hash")
    columns = ["part", "depth", "hash", "parent", "n_convs", "conv_id", "bytes", "n_children", "owner"]
    by_trie = placed.select(*columns).repartition(tasks, "part").sortWithinPartitions("part")
    summed = by_trie.mapInArrow(_subtree_sums, _SUMS).groupBy("hash").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children")],
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
    )
    lists = nodes.where("ids IS NOT NULL").select("hash", F.element_at("ids", 1).alias("first"), "ids")
    ends = lists.repartition(tasks, "hash").sortWithinPartitions("hash", "first").mapInArrow(_end_digests, "hash binary, ends_sha256 string")
    joined = summed.join(ends.hint("merge"), "hash", "left")
    return joined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(sha256().hexdigest())))


def conversation_trie(conversations: DataFrame, trie_turns: int = TRIE_TURNS) -> DataFrame:
    """The prefix trie of all rebuilt conversations of a table ``conv_id, turn, role, text``.

    A NULL role or text is empty, a NULL ``turn`` comes first, rows of one
    ``turn`` are in order of the digest of role and text, so equal rows may stand for each other.
    Rows without ``conv_id`` belong to no conversation. Further columns have no
    effect. An empty table has no nodes. One conversation's digests, some 40 bytes a turn, are sorted in one task.
    """
    return prefix_trie(rebuilt_conversations(conversations), trie_turns)
