"""WARC archives as Zstandard files with a dictionary: writing and reading.

An archive starts with a skippable frame that holds its dictionary; every
record is a frame of its own. Spark writes the archives and reads them back, so
any file system that Spark reaches will do; a task builds or parses one archive
of bounded size at a time.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import width
from sluice.session import work_folder

# Fixed values of the Zstandard and WARC formats.
FRAME, SKIPPABLE, DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
# An empty skippable frame, as text: what Spark's text writer puts behind a file's only row.
EMPTY_FRAME = struct.pack("<II", SKIPPABLE, 0).decode("ascii")
PAGE = "urn:x-page:"

RECORDS = (
    "path string, offset bigint, record_type string, record_id string, target string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary, error string"
)


def digest32(payload: bytes) -> str:
    """The bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _id(value: int | None) -> str:
    return f"<{PAGE}{'none' if value is None else value}>"


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, is_revisit: bool, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    fields = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", _id(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest32(payload)}"))
    if is_revisit:
        fields += [("WARC-Refers-To", _id(first)), ("WARC-Profile", REVISIT_PROFILE)]
    else:
        block += payload
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields)])
    return head.encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes], size: int) -> bytes:
    """A dictionary from records spread over the whole archive, about 20 times its size; raw content if too few."""
    step = max(1, sum(map(len, records)) // (20 * size))
    sample = [r[: 4 * size] for r in records[::step]]
    if len(sample) >= 8 and sum(map(len, sample)) > 8 * size:
        try:
            return zstandard.train_dictionary(size, sample, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(sample)[:size]


def archive(records: list[bytes], dictionary_size: int = 32 << 10, level: int = 3) -> bytes:
    """Records as one archive: the dictionary in a skippable frame, then a frame for each record."""
    content = _dictionary(records, dictionary_size)
    trained = zstandard.ZstdCompressionDict(content)
    packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
    packed = zstandard.ZstdCompressor(level=level).compress(content)
    return b"".join([struct.pack("<II", DICTIONARY, len(packed)), packed, *map(packer.compress, records)])


def frame_end(data: bytes, at: int) -> int:
    """Where the Zstandard frame that starts at ``at`` ends, from its header and block headers."""
    kind = data[at + 4]
    single, dictionary, length = kind >> 5 & 1, (0, 1, 2, 4)[kind & 3], kind >> 6
    sizes = (1 if single else 0, 2, 4, 8)
    here = at + 5 + (0 if single else 1) + dictionary + sizes[length]
    while True:
        head = int.from_bytes(data[here : here + 3], "little")
        here += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if here > len(data) or not head and here == len(data):
            raise ValueError("a frame is cut off")
        if head & 1:
            return here + (4 if kind >> 2 & 1 else 0)


def _fields(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8").split("\r\n")
    out = {}
    for line in lines[1:]:
        name, mark, value = line.partition(":")
        if not mark or not name:
            raise ValueError("a header line has no name")
        out[name.strip()] = value.strip()
    return {"": lines[0], **out}


def parse_record(data: bytes) -> dict:
    """Fields of a record; ValueError says what is wrong with its headers, lengths or digest."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    if not mark or fields[""] != VERSION:
        raise ValueError("no WARC header")
    missing = [n for n in NEEDED if n not in fields]
    if missing:
        raise ValueError(f"no {missing[0]}")
    length = fields["Content-Length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("Content-Length is not the block's length")
    http, mark, payload = rest[:-4].partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no end of the HTTP header")
    declared = _fields(http).get("Content-Length", "")
    if not declared.isdigit():
        raise ValueError("no HTTP Content-Length")
    kind, digest = fields["WARC-Type"], fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != int(declared):
            raise ValueError("the payload's length is not the HTTP Content-Length")
        if digest32(payload) != digest:
            raise ValueError("the payload's digest is another")
    elif kind == "revisit":
        if payload or "WARC-Refers-To" not in fields:
            raise ValueError("a revisit has a payload or refers to nothing")
    else:
        raise ValueError("an unknown record type")
    return {
        "record_type": kind, "record_id": fields["WARC-Record-ID"], "target": fields.get("WARC-Target-URI"),
        "refers_to": fields.get("WARC-Refers-To"), "payload_digest": digest, "payload_bytes": int(declared),
        "payload": payload if kind == "response" else None,
    }


def read_archive(data: bytes) -> Iterator[dict]:
    """The records of an archive, one for each frame; what cannot be read is a row with ``error``."""
    reader, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        try:
            if len(data) - at < 8:
                raise ValueError("a frame is cut off")
            magic, size = struct.unpack_from("<II", data, at)
            if magic & ~0xF == SKIPPABLE:
                if at + 8 + size > len(data):
                    raise ValueError("a skippable frame is cut off")
                if at == 0 and magic == DICTIONARY:
                    content = data[8 : 8 + size]
                    if content[:4] == struct.pack("<I", FRAME):
                        content = zstandard.ZstdDecompressor().decompress(content)
                    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
                at += 8 + size
                continue
            if magic != FRAME:
                raise ValueError("no Zstandard frame")
            end = frame_end(data, at)
        except (ValueError, IndexError, zstandard.ZstdError) as e:
            yield {"offset": at, "error": str(e) or "a frame is cut off"}
            return  # where the next frame starts is not known
        try:
            yield {"offset": at, "error": None, **parse_record(reader.decompress(data[at:end]))}
        except (ValueError, zstandard.ZstdError) as e:
            yield {"offset": at, "error": str(e)}
        at = end


def _with_first(pages: DataFrame, least: int) -> DataFrame:
    """``first``: the smallest page_id with the same payload, NULL where the payload is too short or no id is known.

    Copies of one payload are dealt out by id; their minima, one for each
    piece, meet before they are joined back.
    """
    pieces = F.pmod(F.xxhash64("page_id"), F.lit(width(pages.sparkSession)))
    keyed = pages.withColumn("digest", F.sha1(F.col("payload"))).withColumn("piece", pieces)
    smallest = keyed.where(F.octet_length("payload") >= least).groupBy("digest", "piece").agg(F.min("page_id").alias("low"))
    first = smallest.select("digest", "piece", F.expr("min(low) OVER (PARTITION BY digest)").alias("first"))
    return keyed.join(first, ["digest", "piece"], "left").drop("digest", "piece")


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_revisit_bytes: int = 0, archive_bytes: int = 16 << 20, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record for every row; archives hold about ``archive_bytes`` of records, or one larger record.

    Of rows with equal payloads of at least ``least_revisit_bytes`` the one with
    the smallest id is a response and others are revisits of it; rows that
    repeat that id are responses as well. A NULL payload is empty. Rows without
    an id are revisits if an equal payload has one, else responses.
    """
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = _with_first(slim, least_revisit_bytes).select("page_id", "url", "payload", "first")

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = batch.columns
            for i in range(batch.num_rows):
                page_id, url, data, first = (c[i].as_py() for c in columns)
                held.append(record(page_id, url, data, first, first is not None and page_id != first, date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([archive(held)], pa.binary())], ["archive"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([archive(held)], pa.binary())], ["archive"])

    # One row is one file; the bytes of a string are written as they are.
    built_rows = rows.mapInArrow(built, "archive binary").select(F.col("archive").cast("string"))
    built_rows.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(folder)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row for every record of every archive in a folder; damaged ones have ``error`` and nothing else."""
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, held, size = batch.column(0)[i].as_py(), [], 0
                for found in read_archive(batch.column(1)[i].as_py()):
                    held.append(found)
                    size += len(found.get("payload") or b"")
                    if size > 8 << 20:
                        yield _batch(path, held, names, kinds)
                        held, size = [], 0
                if held:
                    yield _batch(path, held, names, kinds)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(parsed, RECORDS)


def _batch(path: str, found: list[dict], names: list[str], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path if n == "path" else r.get(n) for r in found], kinds.get(n, pa.string())) for n in names], names
    )


def page_of(record_id: Column) -> Column:
    """The id in a record's name; NULL where there is none."""
    found = F.regexp_extract(record_id, "^<" + PAGE + "(-?[0-9]+)>$", 1)
    return F.when(found != "", found.cast("long"))


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write all pages below the shared folder and read the archives back; a damaged record is an error."""
    folder = work_folder(pages.sparkSession, "archives")
    write_archives(pages, folder)
    found = read_archives(pages.sparkSession, folder)
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.concat("path", F.lit(": "), "error")).cast("string"))
    return found.withColumn("record_type", F.coalesce(checked, "record_type"))
