"""Digests of a text's most improbable byte windows in chained Bloom filters.

Windows of 32 bytes are ranked by how much information they carry under the
byte-pair statistics of all documents. In every run of neighbouring windows the
rarest one is picked; windows picked often enough are the text's features. They
go in order into Bloom filters of 2,048 bits, 160 to a filter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut_number, id_cuts, rows_frame, width

WINDOW, NEIGHBOURS, POPULAR = 32, 32, 8
BITS, HASHES, PER_FILTER = 2048, 5, 160
# Windows that are ranked together; a longer text is ranked in parts, with the same result.
PART = 1 << 22
LOWEST = -(2**63)


def byte_pairs(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each byte follows each other one in the texts of all documents: 256 x 256 counts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(65536, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                data = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
                for a in range(0, max(0, len(data) - 1), PART):
                    part = data[a : a + PART + 1].astype(np.uint16)
                    total += np.bincount(part[:-1] << 8 | part[1:], minlength=65536)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["pair", "n"])

    pairs = docs.select(text_col).mapInArrow(counted, "pair int, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(65536, dtype=np.int64)
    for r in pairs.collect():  # at most 65,536 rows
        out[r["pair"]] = r["n"]
    return out.reshape(256, 256)


def information(pairs: np.ndarray) -> np.ndarray:
    """The information of each byte after each other one, in 1/256 bits, as a flat table; unseen pairs count once."""
    share = (pairs + 1) / (pairs.sum(axis=1, keepdims=True) + 256)
    return np.rint(-256 * np.log2(share)).astype(np.int64).ravel()


def _sliding_max(keys: np.ndarray, span: int) -> np.ndarray:
    """The maximum of each run of ``span`` values: block-wise maxima from both sides."""
    count = len(keys) - span + 1
    rows = -(-len(keys) // span)
    padded = np.full(rows * span, LOWEST, dtype=np.int64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(rows, span)
    ahead = np.maximum.accumulate(blocks, axis=1).ravel()
    behind = np.maximum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.maximum(behind[:count], ahead[span - 1 : span - 1 + count])


def picked(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of the popular windows, rising: those that are the rarest, leftmost of equals, in enough runs."""
    windows = len(data) - WINDOW + 1
    if windows < 1:
        return np.zeros(min(1, len(data)), dtype=np.int64)  # a short text is one feature
    span = min(NEIGHBOURS, windows)
    places, counts = [], []
    for a in range(0, windows - span + 1, PART):
        part = data[a : a + PART + span - 1 + WINDOW - 1].astype(np.uint16)
        sums = np.concatenate([[0], np.cumsum(table[part[:-1] << 8 | part[1:]])])
        rarity = sums[WINDOW - 1 :] - sums[: len(sums) - WINDOW + 1]
        at = np.arange(len(rarity), dtype=np.int64)
        best = _sliding_max((rarity << 32) - at, span)
        change = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
        places.append(-(best[change] & 0xFFFFFFFF) % (1 << 32) + a)
        counts.append(np.diff(np.concatenate([change, [len(best)]])))
    place, count = np.concatenate(places), np.concatenate(counts)
    if len(places) > 1:  # a window picked on both sides of a border counts once
        place, first = np.unique(place, return_inverse=True)
        count = np.bincount(first, weights=count).astype(np.int64)
    enough = count >= min(POPULAR, windows - span + 1)
    return place[enough] if enough.any() else place[:1]


def _hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each picked window."""
    if len(data) < WINDOW:
        data = np.concatenate([data, np.full(WINDOW - len(data), len(data), dtype=np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places].view("<u8")
    out = np.full(len(places), WINDOW, dtype=np.uint64)
    for i in range(words.shape[1]):
        out = (out ^ words[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


class Digest:
    """Chained Bloom filters: ``bits`` as rows of 64-bit words, and how many features each filter has."""

    def __init__(self, bits: np.ndarray, counts: np.ndarray):
        self.bits, self.counts = bits, counts

    @classmethod
    def of(cls, text: str, table: np.ndarray) -> Digest:
        data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        if not len(data):
            return cls(np.empty((0, BITS // 64), dtype=np.uint64), np.empty(0, dtype=np.int64))
        found = _hashes(data, picked(data, table))
        different, first = np.unique(found, return_index=True)
        if len(different) != len(found):
            found = found[np.sort(first)]
        filters = -(-len(found) // PER_FILTER)
        at = (found[:, None] >> (11 * np.arange(HASHES, dtype=np.uint64))) & np.uint64(BITS - 1)
        at += (np.arange(len(found), dtype=np.uint64) // np.uint64(PER_FILTER) * np.uint64(BITS))[:, None]
        flags = np.zeros(filters * BITS, dtype=np.uint8)
        flags[at.ravel()] = 1
        counts = np.full(filters, PER_FILTER, dtype=np.int64)
        counts[-1] = len(found) - PER_FILTER * (filters - 1)
        return cls(np.packbits(flags).view(np.uint64).reshape(filters, -1), counts)

    def text(self) -> str:
        """The number of features and the filters' bits, in base 64."""
        return f"{int(self.counts.sum())}:{base64.b64encode(self.bits.tobytes()).decode('ascii')}"

    @classmethod
    def parse(cls, text: str) -> Digest:
        total, _, body = text.partition(":")
        bits = np.frombuffer(base64.b64decode(body), dtype=np.uint64).reshape(-1, BITS // 64)
        counts = np.full(len(bits), PER_FILTER, dtype=np.int64)
        if len(bits):
            counts[-1] = int(total) - PER_FILTER * (len(bits) - 1)
        return cls(bits, counts)

    def likeness(self, other: Digest) -> float:
        """From 0 to 1: each filter of the smaller digest against its best match, weighted by its features.

        The overlap of two filters counts from what chance would give, two
        standard deviations included, to what the emptier one has. Two empty
        digests are alike, an empty one is like no other.
        """
        small, large = sorted((self, other), key=lambda d: (int(d.counts.sum()), d.bits.tobytes()))
        if not len(small.bits):
            return float(not len(large.bits))
        own, theirs = np.bitwise_count(small.bits).sum(axis=1, dtype=np.int64), np.bitwise_count(large.bits).sum(axis=1, dtype=np.int64)
        score = 0.0
        for row, ones, count in zip(small.bits, own, small.counts, strict=True):
            shared = np.bitwise_count(large.bits & row).sum(axis=1, dtype=np.int64)
            most = np.minimum(ones, theirs).astype(np.float64)
            chance = ones * theirs / BITS
            floor = chance + 2 * np.sqrt(chance * (1 - np.maximum(ones, theirs) / BITS))
            room = most - floor
            value = np.where(room > 0, (shared - floor) / np.where(room > 0, room, 1.0), shared >= most)
            score += float(np.clip(value, 0.0, 1.0).max()) * int(count)
        return score / int(small.counts.sum())


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by the first as many code points of another, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) dealt out by ranges of ids, descending within a task, each range followed by the next one's first row.

    ``tail`` marks the row that follows. Its range's ends are the only rows
    sent twice; which they are, one id for each range, is known from the ids.
    """
    spark, ranges = docs.sparkSession, width(docs.sparkSession)
    keyed = docs.withColumn("key", F.coalesce("doc_id", F.lit(LOWEST)))
    part = cut_number(id_cuts(docs, "doc_id", ranges), F.col("key"))
    placed = keyed.withColumn("part", part)
    heads = sorted((r["part"], r["head"]) for r in placed.groupBy("part").agg(F.max("key").alias("head")).collect())
    # The row after a range is the head of the range below; below the last comes the first.
    after = [(heads[i - 1][1], heads[i][0]) for i in range(len(heads))]
    tails = placed.drop("part").join(F.broadcast(rows_frame(spark, after, "key long, part int")), "key")  # one row a range
    both = placed.withColumn("tail", F.lit(False)).unionByName(tails.withColumn("tail", F.lit(True)))
    dealt = both.repartitionById(ranges, F.col("part"))
    return dealt.sortWithinPartitions("part", "tail", F.desc("key"), "text").select("part", "tail", "doc_id", "text")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The next document is the one before in id; the smallest id is followed by
    the largest. A NULL text is empty. Rows without an id come last, rows that
    repeat an id in the order of their texts; a single row follows itself.
    Returns ``doc_id, n_chars, edited_text, fingerprint, edited_fingerprint,
    near_edited, near_next``.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    table = information(byte_pairs(slim))
    names = ["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows, size = None, [], 0
        for batch in batches:
            parts, tails, ids, texts = batch.columns
            for i in range(batch.num_rows):
                part, text = parts[i].as_py(), texts[i].as_py()
                if last is None and tails[i].as_py():
                    continue  # a second row with the id of the next head
                digest = Digest.of(text, table)
                if last is not None:
                    of_id, of_text, of_digest = last
                    changed = edited(of_text, text)
                    other = Digest.of(changed, table)
                    rows.append((
                        of_id, len(of_text), changed, of_digest.text(), other.text(),
                        of_digest.likeness(other), of_digest.likeness(digest),
                    ))
                    size += len(changed)
                    if size > PART:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)
                        rows, size = [], 0
                last = None if tails[i].as_py() else (ids[i].as_py(), text, digest)
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    return in_order(slim).mapInArrow(
        compared,
        "doc_id bigint, n_chars bigint, edited_text string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
