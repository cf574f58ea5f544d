"""Token ids in ORC files, and what is read back from them.

Files hold documents in ascending id order, each with its place in the file's
token stream. Ids are run-length encoded integers in stripes; row indexes and
Bloom filters on the document id let a reader skip stripes and row groups.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import pretokens as P
from sluice.llm.common import rows_frame, width
from sluice.session import work_folder

FILE_SCHEMA = "doc_id bigint, part_start bigint, n_tokens bigint, ids array<int>"
# Stripes of 64 MB are the unit of parallel reads; row indexes and Bloom filters cover 1,000 rows each.
ORC_OPTIONS = {
    "compression": "zstd", "orc.stripe.size": str(64 << 20), "orc.row.index.stride": "1000", "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
}


@cache
def encoder(path: str) -> P.TextEncoder:
    """The library's BPE model over pre-tokens; each different one is encoded once."""
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    rule = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if spec["normalizer"] is not None or spec["pre_tokenizer"] != rule:
        raise ValueError("a byte-level vocabulary without a normalizer is needed")
    shown, model = dict(enumerate(P.byte_symbols())), tokenizer.model

    def ids(word: str) -> np.ndarray:
        found = model.tokenize(word.encode("utf-8", "surrogatepass").decode("latin-1").translate(shown))
        return np.array([t.id for t in found], dtype=np.uint32)

    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return P.TextEncoder(specials, lambda text: text, P.spaced_spans, lambda strings: map(ids, strings))


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write ids in ascending order of document ids.

    A NULL or empty text has the end id only. Rows without an id come first;
    rows that repeat an id are ordered by text. Each file is a range of ids.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = slim.repartitionByRange(width(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, start = encoder(path), 0
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            for at, texts in P.column_parts(batch.column(1), 4 * P.CHUNK):
                found = [x for ids in work.encode(texts) for x in (ids, end)]
                sizes = np.array([len(x) for x in found], dtype=np.int64).reshape(-1, 2).sum(axis=1)
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(np.concatenate(found).astype(np.int32))
                )
                columns = [batch.column(0).slice(at, len(texts)), pa.array(start + ends - sizes), pa.array(sizes), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part_start", "n_tokens", "ids"])
                start += int(ends[-1])

    ordered.mapInArrow(encoded, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files; ``start`` counts the ids of all documents before.

    What lies before a file, one row each, is summed on the driver from the
    files' own counts; the id columns are not read for it.
    """
    stored = spark.read.schema(FILE_SCHEMA).orc(folder)
    file = F.col("_metadata.file_path").alias("file")
    sums = stored.select(file, "doc_id", "n_tokens").groupBy("file").agg(F.min("doc_id").alias("first"), F.sum("n_tokens").alias("n"))
    before, done = [], 0
    for r in sorted(sums.collect(), key=lambda r: (r["first"] is not None, r["first"] or 0)):
        before.append((r["file"], done))
        done += r["n"]
    offsets = F.broadcast(rows_frame(spark, before, "file string, file_start bigint"))  # one row a file
    placed = stored.select(file, "*").join(offsets, "file")
    return placed.select("doc_id", (F.col("file_start") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def token_digests(tokens: DataFrame) -> DataFrame:
    """``read_tokens`` with the CRC-32 of the ids, as little-endian unsigned 32-bit integers, in place of the ids."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")
            at = lists.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(summed, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_in_files(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write the documents' ids below the shared folder and read them back."""
    folder = work_folder(docs.sparkSession, "token-files")
    write_tokens(docs, path, folder, end_id)
    return read_tokens(docs.sparkSession, folder)
