"""WARC archives in seekable Zstandard bundles.

Every page becomes one WARC record. Pages with equal payloads are stored once: the one with
the largest page_id is the response, the others are revisit records that name it. Records are
grouped into independent Zstandard frames of about ``FRAME_BYTES``; frames are appended to a
bundle, and the bundle ends with the seek table of the Zstandard seekable format in a
skippable frame. The index maps every record to (bundle, frame, offset in the frame), so one
record is read by one seek and one frame.

Which page is the response is a grouped maximum over (digest, page_id) only; payloads move at
most once, to meet their reference by page_id. Bundles are written by tasks, streamed frame by
frame, under a name of their own; the index holds the names of committed attempts only, so a
lost executor leaves at most an unreferenced file. Files go to the shared folder through the
file system that its URI names.

Cases: a null html is the empty payload; a null url leaves the target header out; a page
without id is a response of its own kind and never referred to; rows equal in id and payload
are records of the same type; pages below ``min_bytes`` are all responses; an empty table
writes no bundle. Other columns are not read. CR and LF in a url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import table, written
from ledgerline.session import arrow_file_system, work_path

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
PAGES_PER_BATCH = 256
READ_BYTES = 16 << 20  # record bytes that one task reads back
MAX_READ_TASKS = 50_000
# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, record_type string, bundle string, frame int, offset long, length long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the response's HTTP header but no payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    body = http if refers_to is not None else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Header fields, ``http`` header fields and ``payload`` of the record at the start of ``data``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    fields["http"] = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    fields["payload"] = payload
    return fields


class BundleWriter:
    """Appends frames to one bundle file and closes it with its seek table."""

    def __init__(self, folder: str):
        fs, path = arrow_file_system(folder)
        fs.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.size, self.frames = 0, []

    def append(self, data: bytes) -> None:
        packed = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress(data)
        self.out.write(packed)
        self.size += len(packed)
        self.frames.append((len(packed), len(data)))

    def close(self) -> None:
        table_ = b"".join(struct.pack("<II", *x) for x in self.frames)
        table_ += struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table_)) + table_)
        self.out.close()


class BundleReader:
    """Random access to a bundle by the seek table at its end."""

    def __init__(self, folder: str, name: str):
        fs, path = arrow_file_system(folder)
        self.file = fs.open_input_file(f"{path}/{name}")
        end = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC or flags:
            raise ValueError(f"{name} has no seek table")
        at, self.frames = 0, []
        for packed, size in struct.iter_unpack("<II", self.file.read_at(8 * n, end - 9 - 8 * n)):
            self.frames.append((at, packed, size))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, size = self.frames[i]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=size)

    def close(self) -> None:
        self.file.close()


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to) for every page."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    p = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    ids = p.where((F.octet_length("payload") >= min_bytes) & F.col("page_id").isNotNull()).select("page_id", "sha1")
    last = (ids.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select(F.col("sha1").alias("__sha1"), "refers_to"))
    refs = (ids.join(last, (F.col("sha1") == F.col("__sha1")) & (F.col("page_id") < F.col("refers_to")))
            .select(F.col("page_id").alias("__id"), "__sha1", "refers_to").distinct())
    return (p.join(refs, (F.col("page_id") == F.col("__id")) & (F.col("sha1") == F.col("__sha1")), "left")
            .select("page_id", "url", "payload", "sha1", "refers_to"))


def _writer(folder: str, frame_bytes: int, bundle_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, frame, size, rows = None, [], 0, []

        def flush():
            nonlocal bundle, frame, size
            bundle.append(b"".join(frame))
            frame, size = [], 0
            if bundle.size >= bundle_bytes:
                bundle.close()
                bundle = None

        def index() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pandas(
                pd.DataFrame(rows, columns=["page_id", "record_type", "bundle", "frame", "offset", "length"]),
                schema=pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("bundle", pa.string()),
                                  ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
            rows.clear()
            return out

        for batch in batches:
            for r in range(batch.num_rows):
                page_id, url, payload, sha1, refers_to = (batch.column(c)[r].as_py() for c in range(5))
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = record(page_id, url, payload, digest, refers_to)
                if bundle is None:
                    bundle = BundleWriter(folder)
                rows.append((page_id, "response" if refers_to is None else "revisit", bundle.name,
                             len(bundle.frames), size, len(data)))
                frame.append(data)
                size += len(data)
                if size >= frame_bytes:
                    flush()
            if rows:
                yield index()
        if frame:
            flush()
        if bundle is not None:
            bundle.close()
    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES,
                   bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write the bundles to ``folder``; returns the written index of their records."""
    rows = with_references(pages, min_bytes)
    conf, key = pages.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(PAGES_PER_BATCH))  # pages are large rows: few travel to Python at once
    try:
        return written(rows.mapInArrow(_writer(folder, frame_bytes, bundle_bytes), INDEX), "warc-index")
    finally:
        conf.set(key, before)


HEADERS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "bundle string, frame int, offset long")


def _reader(folder: str, contents: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bundle = BundleReader(folder, pdf["bundle"].iloc[0])
        data = bundle.frame(int(pdf["frame"].iloc[0]))
        bundle.close()
        out = []
        for offset, length in zip(pdf["offset"], pdf["length"]):
            r = parse_record(data[offset:offset + length])
            kind, digest = r["WARC-Type"], r["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response" and base32_sha1(r["payload"]) != digest:
                raise ValueError(f"payload of {r['WARC-Record-ID']} does not match its digest")
            number = lambda x: int(x[len("<urn:page:"):-1]) if x and x != "<urn:page:>" else None
            out.append((number(r["WARC-Record-ID"]), r.get("WARC-Target-URI"), int(r["http"]["Content-Length"]), digest,
                        kind, number(r.get("WARC-Refers-To")), r["payload"] if kind == "response" else None,
                        pdf["bundle"].iloc[0], int(pdf["frame"].iloc[0]), offset))
        out = pd.DataFrame(out, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type",
                                         "refers_to", "payload", "bundle", "frame", "offset"])
        out = out.astype({"page_id": "Int64", "refers_to": "Int64"})
        return out if contents else out.drop(columns=["url", "payload"])
    return run


def read_archives(index: DataFrame, folder: str, contents: bool = True) -> DataFrame:
    """All records named by ``index``, read one frame at a time, payloads held against their
    digests: headers, place and, with ``contents``, the url and (responses) the payload."""
    columns = HEADERS + ", url string, payload binary" if contents else HEADERS
    # the index is narrow, what it names is not: frames are dealt out by the bytes behind them
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = min(MAX_READ_TASKS, total // READ_BYTES + 1)
    return index.repartition(tasks, "bundle", "frame").groupBy("bundle", "frame").applyInPandas(_reader(folder, contents), columns)


def op2_warc(spark, sf_dir) -> DataFrame:
    folder = work_path(spark, "llm", "warc")
    index = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(index, folder, contents=False)
