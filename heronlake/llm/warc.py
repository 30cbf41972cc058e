"""WARC archives: a writer of one gzip member a record, and a splittable reader.

The reader's tasks own byte ranges. A task looks for gzip magic in its range, takes a place as a member only if it
decompresses to a WARC version line, and owns the records that start inside its range, however far the last one goes on.
After a record the next one is expected at the member's end; where none starts there, the search goes on.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronlake.llm import common

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
SPLIT_BYTES = 8 << 20
#: Most tasks of one read; from so many ranges on a task takes several.
READ_TASKS = 20_000
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: dict[str, str], block: bytes) -> bytes:
    """A WARC record as one gzip member; the member carries no time, so equal records are equal bytes."""
    lines = ["WARC/1.1", *(f"{k}: {' '.join(v.split())}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    start: int
    end: int


def parse(data: bytes, start: int, end: int) -> Record:
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        headers[k.strip().lower()] = v.strip()
    return Record(headers, rest[: int(headers.get("content-length", len(rest)))], start, end)


class Window:
    """A buffered view of an input file: bytes by place, read in blocks."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        if at < self.at or at + n > self.at + len(self.held):
            want = min(max(n, READ_BYTES), max(0, self.size - at))
            self.file.seek(at)
            self.at, self.held = at, self.file.read(want)
        return self.held[at - self.at : at - self.at + n]


def member(view: Window, at: int) -> Record | None:
    """The record whose gzip member starts at a place, or None if no WARC record does."""
    d = zlib.decompressobj(31)
    out, place = [], at
    try:
        while not d.eof and place < view.size:
            block = view.get(place, min(1 << 16, view.size - place))
            out.append(d.decompress(block))
            place += len(block)
            if len(out) == 1 and not out[0].startswith(VERSION[: len(out[0])]):
                return None
    except zlib.error:
        return None
    data = b"".join(out)
    if not d.eof or not data.startswith(VERSION):
        return None
    return parse(data, at, place - len(d.unused_data))


def records(view: Window, start: int, end: int) -> Iterator[Record]:
    """The records that start in [start, end)."""
    at = start
    while at < min(end, view.size):
        block = view.get(at, min(READ_BYTES, view.size - at))
        found = block.find(MAGIC)
        if found < 0:
            at += max(1, len(block) - len(MAGIC) + 1)
            continue
        at += found
        if at >= end:
            return
        got = member(view, at)
        if got is None:
            at += 1
            continue
        yield got
        at = got.end


def write_pages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write one record a row under folder and return the archives written: (path, bytes, records).

    Of rows with equal payloads the one with the largest id is the response and the others are revisits that refer to it; of
    repeated rows with that id one is the response (rows of one id and payload always share a task). A null payload is empty, a null url is left out, a null id is smaller
    than any other. Only digests are shuffled by payload; the rows themselves travel by id, so that neither a common payload
    nor a common host makes a hot task. A task writes under a name of its own attempt and reports it, so a repeated task
    leaves only an unreported file behind.
    """
    body = F.encode(F.coalesce(F.col(f"`{payload_col}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").alias("url"), body.alias("body")).withColumn("sha1", F.unhex(F.sha1("body")))
    rows = rows.withColumn("k", F.concat("sha1", F.coalesce(F.encode(F.col("id").cast("string"), "UTF-8"), F.lit(b""))))
    small = common.materialise(rows.select("id", "sha1", "k"), "warc-digests")
    copied = small.groupBy("sha1").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    repeats = small.join(copied, "sha1").select("k", "first", F.lit(True).alias("shared")).distinct()
    ready = rows.repartition("k").join(repeats, "k", "left").select("id", "url", "body", "sha1", F.coalesce("shared", F.lit(False)).alias("shared"), "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, path, n, size, answered = None, "", 0, 0, set()
        for b in common.parts(batches):
            for i, url, body, sha, shared, first in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    path = f"{root}/part-{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(path, compression=None)
                again = shared and (i != first or (i, sha) in answered)
                if shared and not again:
                    answered.add((i, sha))
                name = f"<urn:heronlake:page:{'null' if i is None else i}>"
                headers = {"WARC-Type": "revisit" if again else "response", "WARC-Record-ID": name, "WARC-Date": DATE, "Content-Type": "text/html; charset=utf-8", "WARC-Payload-Digest": "sha1:" + base64.b32encode(sha).decode(), "X-Payload-Length": str(len(body))}
                if url:
                    headers["WARC-Target-URI"] = url
                if again:
                    headers |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:heronlake:page:{'null' if first is None else first}>"}
                data = record(headers, b"" if again else body)
                out.write(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([n])], ["path", "bytes", "records"])

    return ready.mapInArrow(run, "path string, bytes long, records long")


def read_archives(spark: SparkSession, folder: str, archives: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = False) -> DataFrame:
    """All records of archives (path, bytes): (record_id, record_type, url, payload_bytes, payload_digest, refers_to, payload).

    payload_bytes and payload_digest are those of the full payload: measured on the block of a response, from the headers of
    a revisit. payload is null unless asked for (and for revisits). No archives: no rows. Each task takes whole ranges, one
    up to READ_TASKS of them; a lost task reads its ranges again.
    """
    ranges = archives.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / split_bytes))).alias("k")).select("path", "bytes", (F.col("k") * split_bytes).alias("start"))
    schema = "record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["record_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to", "payload"])

        for b in common.parts(batches):
            for path, size, start in zip(*(c.to_pylist() for c in b.columns)):
                rows, held = [], 0
                with fs.open_input_file(path) as f:
                    for r in records(Window(f, size), start, start + split_bytes):
                        h = r.headers
                        again = h.get("warc-type") == "revisit"
                        n, sha = (int(h.get("x-payload-length", 0)), h.get("warc-payload-digest", "").removeprefix("sha1:")) if again else (len(r.block), digest(r.block))
                        rows.append((h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"), n, sha, h.get("warc-refers-to"), r.block if payload and not again else None))
                        held += len(r.block)
                        if len(rows) >= 4096 or payload and held > 16 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    # a stated number of partitions: ranges are tiny rows, which adaptive execution would merge into one task
    tasks = archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    return ranges.repartition(int(min(tasks, READ_TASKS))).mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder, read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    One row for each input row, whatever repeats; a null page_id comes back null; an empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = common.scratch_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"
    archives = common.materialise(write_pages(pages, folder), "warc-archives")
    page = lambda c: F.regexp_extract(c, r"page:(-?\d+)>", 1).try_cast("long")
    return read_archives(spark, folder, archives).select(page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page(F.col("refers_to")).alias("refers_to"))


ROUND_TRIP_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, row_number() OVER () AS k FROM pages),
h AS (SELECT *, sha1(body) AS s, row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST, k) AS place, max(page_id) OVER (PARTITION BY body) AS first FROM p),
v AS (SELECT *, list_transform(range(8), lambda g: CAST('0x' || substr(s, CAST(5 * g + 1 AS BIGINT), 5) AS BIGINT)) AS fives FROM h)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((fives[(i // 4) + 1] >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN first END AS refers_to
FROM v
"""
