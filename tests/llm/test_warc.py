from __future__ import annotations

import tempfile
from collections import defaultdict

import pyarrow.fs
import pytest
import zstandard

from ledgerline.llm import warc

PAGES = "page_id long, url string, html string, digest int, bundle int"


def pages():
    rows = [(1, "http://a/", "same", 0, 0), (5, "http://b/\r\nX: y", "same", 0, 0), (3, None, "same", 0, 0),
            (2, "u", None, 0, 0), (9, "u", "", 0, 0), (None, "u", "same", 0, 0), (None, "u", None, 0, 0),
            (7, "u", "üñí " * 30_000, 0, 0), (8, "u", "tail", 0, 0), (8, "u", "tail", 0, 0), (8, "u", "other", 0, 0)]
    return rows + [(100 + i, "u", f"page {i % 40} " * (i % 7), 0, 0) for i in range(300)]


def expected(rows, min_bytes=0):
    last = {}
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= min_bytes:
            last[data] = max(last.get(data, i), i)
    out = []
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        refers = last.get(data) if i is not None and last.get(data, i) != i and len(data) >= min_bytes else None
        out.append((i, len(data), warc.base32_sha1(data), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, min_bytes):
    folder = tempfile.mkdtemp(prefix="warc-")
    df = spark.createDataFrame(pages(), PAGES).repartition(3)
    index = warc.write_archives(df, folder, min_bytes=min_bytes, frame_bytes=4000, bundle_bytes=6000)
    back = warc.read_archives(index, folder).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back]
    assert sorted(got, key=repr) == expected(pages(), min_bytes)
    texts = defaultdict(set)
    for i, _, html, *_ in pages():
        texts[i].add((html or "").encode())
    assert all(bytes(r["payload"]) in texts[r["page_id"]] for r in back if r["record_type"] == "response")
    assert len({r["bundle"] for r in back}) > 1


def test_bundle_is_plain_zstandard_with_records(spark):
    folder = tempfile.mkdtemp(prefix="warc-")
    w = warc.BundleWriter(folder)
    one = warc.record(1, "http://x/", b"payload", warc.base32_sha1(b"payload"), None)
    w.append(one + one)
    w.append(one)
    w.close()
    data = open(f"{folder}/{w.name}", "rb").read()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole == one * 3
    r = warc.BundleReader(folder, w.name)
    assert r.frame(1) == one and r.frame(0)[len(one):] == one
    fields = warc.parse_record(r.frame(1))
    assert fields["payload"] == b"payload" and fields["WARC-Type"] == "response"
    r.close()


def test_empty_table_writes_nothing(spark):
    folder = tempfile.mkdtemp(prefix="warc-")
    index = warc.write_archives(spark.createDataFrame([], PAGES), folder)
    assert warc.read_archives(index, folder).count() == 0
    assert not pyarrow.fs.LocalFileSystem().get_file_info(pyarrow.fs.FileSelector(folder))


def test_frames_are_dealt_out_to_readers(spark, monkeypatch):
    from pyspark.sql import functions as F

    folder = tempfile.mkdtemp(prefix="warc-")
    index = warc.write_archives(spark.createDataFrame(pages(), PAGES), folder, frame_bytes=2000)
    monkeypatch.setattr(warc, "READ_BYTES", 20_000)
    parts = warc.read_archives(index, folder).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 3 and sum(r["count"] for r in parts) == len(pages())
