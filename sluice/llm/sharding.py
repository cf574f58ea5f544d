"""Minimax contiguous sharding of atomic groups.

Groups of equal texts, in the order of their hash, are cut into contiguous
shards so that the largest shard is as small as possible: a binary search over
the capacity, each tried greedily. The search runs on the driver over known
group boundaries, a bounded number; where a cut may fall between two known
ones, Spark is asked for finer boundaries there, until the answer is exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut_number, hash_pair, rows_frame, width
from sluice.session import written

KEYS = ["h1", "h2"]
# Boundaries that one look at the groups brings to the driver.
LOOK = 20_000
UNSIGNED = 2**64


class Boundaries:
    """Known ends of groups on the line from 0 to ``total``, and between which no other end lies."""

    def __init__(self, total: int):
        self.ends = np.array([0, total], dtype=np.int64)
        self.whole = np.array([True, False])  # whole[i]: no unknown end between ends[i - 1] and ends[i]

    def refine(self, found: list[tuple[int, int, int]], asked: list[tuple[int, int]]) -> None:
        """Take in (smallest end, largest end, count) of cells, which hold all ends within the windows ``asked``."""
        known = dict(zip(self.ends.tolist(), self.whole.tolist(), strict=True))
        for low, high, count in found:
            known[high] = known.get(high, False) or count <= 2
            known[low] = True  # no end lies between the cell before and the smallest end of this one
        for _, right in asked:
            known[right] = True
        self.ends = np.array(sorted(known), dtype=np.int64)
        self.whole = np.array([known[e] for e in self.ends.tolist()])

    def cut(self, at: int, hopeful: bool) -> int:
        """The last end up to ``at``; with ``hopeful``, as far as an unknown end could lie."""
        i = int(np.searchsorted(self.ends, at, "right"))
        if i == len(self.ends):
            return int(self.ends[-1])
        known = int(self.ends[i - 1])
        return known if self.whole[i] or not hopeful else max(known, at)

    def walk(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """Where greedy shards of a capacity end."""
        out, at = [], 0
        for _ in range(shards):
            at = self.cut(at + capacity, hopeful)
            out.append(at)
        return out

    def smallest(self, low: int, shards: int, hopeful: bool) -> int:
        """The smallest capacity from ``low`` whose walk reaches the end."""
        total = int(self.ends[-1])
        high = max(low, total)
        while low < high:
            mid = (low + high) // 2
            if self.walk(mid, shards, hopeful)[-1] >= total:
                high = mid
            else:
                low = mid + 1
        return low


def minimax_cuts(groups: DataFrame, total: int, largest: int, shards: int) -> list[int]:
    """Ends of the ``shards`` contiguous shards of smallest possible capacity.

    ``groups`` has ``end``, the running sum of sizes up to and with each group;
    sizes are positive. All shards but the last end where the next group would not fit.
    """
    if not total:
        return [0] * shards
    line, low = Boundaries(total), max(-(-total // shards), largest)
    asked = [(0, total)]
    while True:
        line.refine(_look(groups, asked), asked)
        sure, hope = line.smallest(low, shards, False), line.smallest(low, shards, True)
        near, far = line.walk(hope, shards, False), line.walk(sure, shards, True)
        if sure == hope and near == far:
            return near
        low, asked = hope, []
        # Cuts of all capacities still possible lie between the two walks; ask for what is not known there.
        for a, b in zip(near, far, strict=True):
            first, last = int(np.searchsorted(line.ends, a, "right")), int(np.searchsorted(line.ends, b, "right"))
            unknown = [i for i in range(first, min(last, len(line.ends) - 1) + 1) if not line.whole[i]]
            if unknown:
                left, right = int(line.ends[unknown[0] - 1]), int(line.ends[unknown[-1]])
                if asked and left < asked[-1][1]:
                    left, right = asked[-1][0], max(right, asked.pop()[1])
                asked.append((left, right))


def _look(groups: DataFrame, windows: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Ends strictly within rising windows, one for each shard at most, by cells: about ``LOOK`` rows for however many groups."""
    cells = max(2, LOOK // len(windows))
    number, end = cut_number([right for _, right in windows], F.col("end")), F.col("end")
    placed = groups.where((end > windows[0][0]) & (end < windows[-1][1])).select("end", number.alias("window"))
    left, right = (F.element_at(F.array(*[F.lit(w[i]).cast("long") for w in windows]), F.col("window") + 1) for i in (0, 1))
    inside = placed.withColumns({"left": left, "right": right}).where((end > F.col("left")) & (end < F.col("right")))
    cell = F.floor((end - F.col("left")) * F.lit(float(cells)) / (F.col("right") - F.col("left")))
    found = inside.groupBy("window", cell.alias("cell")).agg(F.min("end").alias("low"), F.max("end").alias("high"), F.count("*").alias("n"))
    return [(r["low"], r["high"], r["n"]) for r in found.collect()]


def own_shards(sizes: list[int], total: int, shards: int) -> int:
    """How many of the largest groups (sizes descending) fill a shard of their own: each has at least its fair share."""
    own = 0
    while own < len(sizes) and own < shards - 1 and sizes[own] * (shards - own) >= total:
        total -= sizes[own]
        own += 1
    return own


def _bucket(buckets: int) -> Column:
    """The place of a hash among ``buckets`` equal ranges; rises with the hash."""
    share = (F.col("h1").cast("double") + 2.0**63) / float(UNSIGNED)
    return F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("long")


def _running(groups: DataFrame) -> DataFrame:
    """Running sums ``end`` (bytes) and ``rows_end`` over all groups in hash order, without one task for all.

    Sums run within equal ranges of the hash; what lies before a range, one row each, is added from the driver.
    """
    spark, buckets = groups.sparkSession, width(groups.sparkSession)
    placed = groups.withColumn("bucket", _bucket(buckets))
    sums = placed.groupBy("bucket").agg(F.sum("bytes").alias("b"), F.sum("n_rows").alias("r")).orderBy("bucket").collect()
    before, done, rows = [], 0, 0
    for s in sums:
        before.append((s["bucket"], done, rows))
        done, rows = done + s["b"], rows + s["r"]
    offsets = rows_frame(spark, before, "bucket long, bytes_before long, rows_before long")
    within = "OVER (PARTITION BY bucket ORDER BY h1, h2 ROWS UNBOUNDED PRECEDING)"
    summed = placed.select(
        *KEYS, "bytes", "n_rows", "bucket",
        F.expr(f"sum(bytes) {within}").alias("end"), F.expr(f"sum(n_rows) {within}").alias("rows_end"),
    )
    # One row for each range: as many as the session has shuffle partitions.
    return summed.join(F.broadcast(offsets), "bucket").select(
        *KEYS, "bytes", "n_rows",
        (F.col("end") + F.col("bytes_before")).alias("end"), (F.col("rows_end") + F.col("rows_before")).alias("rows_end"),
    )


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Put every document into one of ``shards`` shards of near equal bytes; equal texts stay together.

    A document's size is its text's UTF-8 bytes plus ``overhead``; a NULL text
    has none and is one group with the empty text. Groups with more than their
    fair share of what is left get a shard of their own, the first shards; all
    others are cut by ``minimax_cuts``. Returns ``doc_id, size, text_crc32,
    shard, slot``; slots number a shard's rows from 0 on. Ids may be NULL or
    repeat; with fewer groups than shards some shards are empty.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark, pieces = docs.sparkSession, width(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *hash_pair(text),
    )
    # A group of many copies is dealt out by id, so that no task holds it whole.
    rows = written(rows.withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.lit(pieces))), "shard-rows")
    parts = rows.groupBy(*KEYS, "piece").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    groups = parts.groupBy(*KEYS).agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") * F.col("size")).alias("bytes"))
    groups = written(groups, "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    top = [tuple(r) for r in groups.orderBy(F.desc("bytes"), *KEYS).limit(shards).select(*KEYS, "bytes").collect()]
    own = own_shards([t[2] for t in top], total, shards)
    alone = rows_frame(spark, [(*t[:2], i) for i, t in enumerate(top[:own])], "h1 long, h2 long, shard int")
    rest_total = total - sum(t[2] for t in top[:own])
    line = written(_running(groups.join(F.broadcast(alone), KEYS, "left_anti")), "shard-line")
    cuts = minimax_cuts(line, rest_total, top[own][2] if own < len(top) else 0, shards - own)
    cut_list = F.array(*[F.lit(c).cast("long") for c in cuts])
    shard = F.size(F.filter(cut_list, lambda c: c < F.col("end"))) + own
    line = line.select(*KEYS, shard.cast("int").alias("shard"), (F.col("rows_end") - F.col("n_rows")).alias("start"))
    firsts = line.groupBy("shard").agg(F.min("start").alias("first"))  # at most one row a shard
    line = line.join(F.broadcast(firsts), "shard").select(*KEYS, "shard", (F.col("start") - F.col("first")).alias("start"))
    line = line.unionByName(alone.withColumn("start", F.lit(0).cast("long")))
    before = F.expr("sum(n) OVER (PARTITION BY h1, h2 ORDER BY piece ROWS UNBOUNDED PRECEDING) - n")
    placed = parts.select(*KEYS, "piece", before.alias("before")).join(line, KEYS)
    placed = placed.select(*KEYS, "piece", "shard", (F.col("start") + F.col("before")).alias("start"))
    number = F.expr("row_number() OVER (PARTITION BY h1, h2, piece ORDER BY doc_id)")
    return rows.join(placed, [*KEYS, "piece"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + number - 1).cast("long").alias("slot")
    )
