"""Excel workbooks (``.xlsx``): first sheet, first row is the header.

A workbook is a zip container and cannot be split, so each file is one
unit of work: Spark lists and reads the files (``binaryFile``), a
``mapInArrow`` task unpacks each with the stdlib (``zipfile`` + XML; no
Excel library is needed) and streams its rows out as arrays of strings; the
per-file header check, typing and reject sets are those of ``sources.files``.
A workbook that cannot be read is a rejected file, not the end of the job. Date-formatted numeric cells are turned
into ``yyyy-MM-dd HH:mm:ss`` text. Legacy binary ``.xls`` is not read.

Sheets are large for their files, so their cells are cut out of the text: whole blocks of rows by the places of their
tags where all cells are inline texts without a place of their own, other rows by one regular expression each; a row
with anything else in it (rich text, unusual attributes) goes through a tree of its own, and a sheet that is not laid
out plainly (prefixes, comments, another encoding) through a tree as a whole.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice
from typing import BinaryIO
from xml.etree import ElementTree as ET
from xml.parsers import expat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import trim_ws
from ledgerline.operators.joins import small
from ledgerline.schemas import REQUIRED_FILE_COLUMNS
from ledgerline.session import work_path
from ledgerline.sources import files

COLUMNS = ["file_path", "row_no", "cells", "error"]
CELLS = pa.list_(pa.string())
ROWS_PER_BATCH = 5000
CHUNK = 1 << 18   # bytes of a sheet parsed at a time
MOST = 1 << 24    # bytes of one row, or before the first one, that are searched for its end

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
_ROW, _CELL, _VALUE, _TEXT = (f"{{{_NS['m']}}}{x}" for x in ("row", "c", "v", "t"))
# Built-in number formats that are dates/times.
_DATE_FMT_IDS = set(range(14, 23)) | {45, 46, 47}
_EXCEL_EPOCH = dt.datetime(1899, 12, 30)


@lru_cache(maxsize=20_000)
def _col_index(letters: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", letters).group(0):
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _first_sheet_path(z: zipfile.ZipFile) -> str:
    try:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        sheet = wb.find("m:sheets/m:sheet", _NS)
        rid = sheet.get(f"{{{_NS['r']}}}id")
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        for rel in rels.findall("pr:Relationship", _NS):
            if rel.get("Id") == rid:
                target = rel.get("Target").lstrip("/")
                return target if target.startswith("xl/") else "xl/" + target
    except KeyError:
        pass
    return "xl/worksheets/sheet1.xml"


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    try:
        st = ET.fromstring(z.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {}
    for f in st.findall("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")).lower()
        custom[int(f.get("numFmtId"))] = bool(re.search(r"[dmyhs]", code))
    out = set()
    for i, xf in enumerate(st.findall("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_FMT_IDS or custom.get(fid):
            out.add(i)
    return out


def workbook_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet, one after the other, as lists of strings (None: empty cell)."""
    for block in workbook_blocks(content):
        yield from block.to_pylist()


def workbook_blocks(content: bytes) -> Iterator[pa.ListArray]:
    """Rows of the first sheet in blocks."""
    z = zipfile.ZipFile(io.BytesIO(content))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
        for si in sst.findall("m:si", _NS):
            shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
    dates, name, n = _date_styles(z), _first_sheet_path(z), 0
    try:
        with z.open(name) as sheet:
            for block in _plain_blocks(sheet, shared, dates):
                n += len(block)
                yield block
        return
    except _NotPlain:
        pass
    with z.open(name) as sheet:
        rest = islice(_sheet_rows(sheet, shared, dates), n, None)
        while rows := list(islice(rest, ROWS_PER_BATCH)):
            yield pa.array(rows, CELLS)


class _NotPlain(Exception):
    """The sheet's text cannot be cut into rows; its tree can."""


_ATTRIBUTES = r'(?:\s+[\w:.-]+="[^"<]*")*\s*'
_ROOT = re.compile(rf"<worksheet({_ATTRIBUTES})>")
_ROW_START = re.compile(rf"\s*<row{_ATTRIBUTES}(/?)>")
# column letters, other attributes, inline text, value
_PLAIN_CELL = re.compile(r'<c(?: r="([A-Z]+)[0-9]+")?((?: [a-z]+="\w*")*)(?:/>|>(?:<is><t(?: xml:space="preserve")?>([^<]*)</t></is>'
                         r'|(?:<f>[^<&]*</f>)?<v>([^<]*)</v>)?</c>)')
_REFERENCE = re.compile(r"&(amp|lt|gt|quot|apos);")
_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
# what has another meaning than text; what has none in XML
_NOT_TEXT = ("<!", "<?", "xmlns", "]]>")
_NO_SIGNS = (b"\xef\xbf\xbe", b"\xef\xbf\xbf")
_CONTROL = bytes(i for i in range(32) if i not in b"\t\n\r")
_OPEN, _CLOSE, _ROW_END = b"<sheetData>", b"</sheetData>", b"</row>"


def _parsed(parser, text: bytes, last: bool = False) -> None:
    try:
        parser.Parse(text, last)
    except expat.ExpatError as e:
        raise ET.ParseError(str(e)) from e


def _plain_blocks(sheet: BinaryIO, shared: list[str], dates: set[int]) -> Iterator[pa.ListArray]:
    """The rows of a sheet cut out of its text. What is cut out is well formed; expat reads the rest of
    the sheet."""
    parser, held, root, ended = expat.ParserCreate(namespace_separator="}"), b"", "", False
    while chunk := sheet.read(CHUNK):
        held += chunk
        if not root:
            start = held.find(_OPEN)
            if start < 0 and len(held) < MOST:
                continue
            root = _plain_root(held[:max(start, 0)])
            start += len(_OPEN)
            _parsed(parser, held[:start])
            held = held[start:]
        if not ended:
            end = held.find(_CLOSE)
            ended = end >= 0
            cut = end if ended else held.rfind(_ROW_END) + len(_ROW_END)
            if not ended and cut < len(_ROW_END):
                if len(held) > MOST:
                    raise _NotPlain
                continue
            done, held = held[:cut], held[cut:]
            if any(x in done for x in _NO_SIGNS) or len(done.translate(None, _CONTROL)) < len(done):
                raise _NotPlain
            try:
                text = done.decode()
            except UnicodeDecodeError:
                raise _NotPlain from None
            block = _inline_block(done)
            if block is not None:
                yield block
            else:
                yield from _cut_rows(text, root, parser, shared, dates)
        if ended:
            if b"<!" in held or held.count(b"sheetData") > held.startswith(_CLOSE):
                raise _NotPlain
            # a few bytes stay, as a name may be cut in two
            _parsed(parser, held[:-16])
            held = held[-16:]
    if not ended:
        raise _NotPlain
    _parsed(parser, held, True)


def _cut_rows(text: str, root: str, parser, shared: list[str], dates: set[int]) -> Iterator[pa.ListArray]:
    """The rows of ``text`` as a block, also if one of them has a fault."""
    if any(x in text for x in _NOT_TEXT):
        raise _NotPlain
    if "\r" in text:   # as XML reads ends of lines
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    *pieces, rest = text.split("</row>")
    rows, fault = [], None
    try:
        for piece in pieces:
            rows += _rows_of(piece, "</row>", root, parser, shared, dates)
        if rest.strip():
            rows += _rows_of(rest, "", root, parser, shared, dates)
    except Exception as e:
        fault = e
    if rows:
        yield pa.array(rows, CELLS)
    if fault:
        raise fault


def _inline_block(done: bytes) -> pa.ListArray | None:
    """The rows of ``done`` if there is nothing in it but bare rows of inline texts and empty cells: the texts
    lie between the places of known tags, and are never made strings of Python."""
    if b"\r" in done or not done.endswith(_ROW_END):
        return None
    a = np.frombuffer(done, np.uint8)
    lt, gt = np.flatnonzero(a == ord("<")), np.flatnonzero(a == ord(">"))
    if len(lt) != len(gt) or (gt < lt).any() or (gt[:-1] > lt[1:]).any() or lt[0] != 0:
        return None

    def bytes_at(places: np.ndarray, expected: bytes) -> np.ndarray:
        same = np.ones(len(places), bool)
        for i, x in enumerate(expected):
            same &= a[places + i] == x
        return same

    first = np.ndarray(len(done) - 3, "<u4", done, strides=(1,))[lt]
    size = gt - lt + 1

    def tags(tag: bytes) -> np.ndarray:
        """Which tags are ``tag``."""
        known = int.from_bytes(tag[:4], "little")
        found = np.flatnonzero((first & (1 << 8 * min(4, len(tag))) - 1) == known)
        found = found[size[found] == len(tag)]
        return found[bytes_at(lt[found] + 4, tag[4:])] if len(tag) > 4 else found

    cells, empty, opened, closed = tags(b'<c t="inlineStr">'), tags(b"<c/>"), tags(b"<row>"), tags(_ROW_END)
    inside = [tags(x) for x in (b"<is>", b"<t>", b"</t>", b"</is>", b"</c>")]
    if len(opened) + len(closed) + len(empty) + 6 * len(cells) != len(lt) or any(
            len(x) != len(cells) or (x != cells + i).any() for i, x in enumerate(inside, start=1)):
        return None
    # rows follow each other without a gap, and text stands in <t> alone
    if len(opened) != len(closed) or opened[0] != 0 or (opened[1:] != closed[:-1] + 1).any():
        return None
    gaps = lt[1:] - gt[:-1] - 1
    gaps[inside[1]] = 0
    if gaps.any():
        return None
    every = np.concatenate([cells, empty])
    order = np.argsort(every, kind="stable")
    starts = np.concatenate([gt[inside[1]] + 1, gt[empty] + 1])[order]
    ends = np.concatenate([lt[inside[2]], gt[empty] + 1])[order]
    every = every[order]
    # a text array over the very bytes: every other one is a text, those between are tags
    offsets = np.column_stack([starts, ends]).ravel().astype(np.int32)
    whole = pa.StringArray.from_buffers(max(0, len(offsets) - 1), pa.py_buffer(offsets), pa.py_buffer(done))
    texts = whole.take(pa.array(np.arange(0, len(offsets), 2), mask=np.isin(every, empty)))
    if signs := done.count(b"&"):
        if signs != sum(done.count(f"&{x};".encode()) for x in _ENTITIES):
            return None
        for name, sign in sorted(_ENTITIES.items(), reverse=True):   # "&amp;" last
            texts = pc.replace_substring(texts, f"&{name};", sign)
    places = np.append(np.searchsorted(every, opened), len(every)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), texts)


def _plain_root(head: bytes) -> str:
    """The start tag of the sheet's root, if what comes before the rows is plain."""
    declared = re.search(rb'^(?:\xef\xbb\xbf)?<\?xml[^>]*encoding=["\']([\w-]+)', head)
    if b"<!" in head or (declared and declared[1].lower() != b"utf-8"):
        raise _NotPlain
    try:
        found = _ROOT.search(head.decode())
    except UnicodeDecodeError:
        raise _NotPlain from None
    if not found or f'xmlns="{_NS["m"]}"' not in found[1]:
        raise _NotPlain
    return found[0]


def _rows_of(piece: str, end: str, root: str, parser, shared: list[str], dates: set[int]) -> list[list[str | None]]:
    """The rows of ``piece``: empty ones, and one that ``end`` (cut off) ends."""
    rows, at = [], 0
    while m := _ROW_START.match(piece, at):
        at = m.end()
        if not m[1]:
            break
        rows.append([])
    plain = _plain_cells(_PLAIN_CELL.split(piece[at:]), shared, dates) if m and end else None
    if plain is None and (end or piece[at:].strip()):
        _parsed(parser, f"{piece}{end}".encode())
        data = ET.fromstring(f"{root}<sheetData>{piece}{end}</sheetData></worksheet>").find("m:sheetData", _NS)
        return [_cells(r, shared, dates) for r in data if r.tag == _ROW]
    _parsed(parser, f"{piece[:at]}{end}".encode())
    return rows if plain is None else [*rows, plain]


@lru_cache(maxsize=10_000)
def _kind(attributes: str) -> tuple[str, str] | None:
    """Type and style that a cell's attributes say; None if they also say its place or say a thing twice."""
    found = re.findall(r' ([a-z]+)="(\w*)"', attributes)
    said = dict(found)
    return None if "r" in said or len(said) < len(found) else (said.get("t", "n"), said.get("s", "0"))


def _plain_text(s: str) -> str | None:
    """The text with its signs; None if it refers to anything else."""
    text = _REFERENCE.sub(lambda m: _ENTITIES[m[1]], s)
    return text if s.count("&") == len(_REFERENCE.findall(s)) else None


def _plain_cells(parts: list[str | None], shared: list[str], dates: set[int]) -> list[str | None] | None:
    """The cells of a row that was split by ``_PLAIN_CELL``; None if it needs its tree."""
    if "".join(parts[::5]).strip():
        return None
    vals: list[str | None] = []
    place = -1
    for letters, attributes, inline, value in zip(parts[1::5], parts[2::5], parts[3::5], parts[4::5]):
        kind = _kind(attributes)
        val = inline if value is None else value
        if val and "&" in val:
            val = _plain_text(val)
            if val is None:
                return None
        if kind is None or (val is not None and (kind[0] == "inlineStr") == (inline is None)):
            return None
        place += 1
        if inline is None:
            val = "" if kind[0] == "inlineStr" else None if value is None else _value_text(*kind, val or None, shared, dates)
        idx = _col_index(letters) if letters else place
        if idx == len(vals):
            vals.append(val)
        else:
            vals.extend([None] * (idx + 1 - len(vals)))
            vals[idx] = val
    return vals


def _sheet_rows(sheet: BinaryIO, shared: list[str], dates: set[int]) -> Iterator[list[str | None]]:
    """The rows of a sheet. The tree is built chunk by chunk; rows leave it as they are complete."""
    tree = ET.TreeBuilder()
    top = tree.start("top", {})   # holds the sheet's root, so that the rows can be got at early
    parser, fault, last = ET.XMLParser(target=tree), None, False
    while not last:
        chunk = sheet.read(CHUNK)
        last = not chunk
        try:
            parser.close() if last else parser.feed(chunk)
        except ET.ParseError as e:
            fault, last = e, True
        for data in top.findall("*/m:sheetData", _NS):
            # the last element may still be open
            n = len(data) if last and not fault else max(0, len(data) - 1)
            for r in data[:n]:
                if r.tag == _ROW:
                    yield _cells(r, shared, dates)
            del data[:n]
    if fault:
        raise fault


def _cells(r: ET.Element, shared: list[str], dates: set[int]) -> list[str | None]:
    vals: list[str | None] = []
    place = -1
    for c in r:
        if c.tag != _CELL:
            continue
        place += 1
        ref = c.get("r")
        idx = _col_index(ref.rstrip("0123456789")) if ref else place
        val = _cell_text(c, shared, dates)
        if idx == len(vals):
            vals.append(val)
        else:
            vals.extend([None] * (idx + 1 - len(vals)))
            vals[idx] = val
    return vals


def _cell_text(c: ET.Element, shared: list[str], dates: set[int]) -> str | None:
    t = c.get("t", "n")
    if t == "inlineStr":
        if len(c) == 1 and len(c[0]) == 1:   # <is><t>text</t></is>
            only = c[0][0]
            if only.tag == _TEXT and not len(only):
                return only.text or ""
        return "".join(x.text or "" for x in c.iter(_TEXT))
    v = c.find(_VALUE)
    return None if v is None else _value_text(t, c.get("s", "0"), v.text, shared, dates)


def _value_text(t: str, style: str, v: str | None, shared: list[str], dates: set[int]) -> str | None:
    """The text of a value by its cell's type and style."""
    if t == "s":
        return shared[int(v)]
    if t == "b":
        return "True" if v == "1" else "False"
    if t == "n":
        if int(style) in dates:
            return (_EXCEL_EPOCH + dt.timedelta(days=float(v))).strftime("%Y-%m-%d %H:%M:%S")
        if v is not None and v.endswith(".0") and re.fullmatch(r"-?\d+\.0", v):
            return v[:-2]
    return v


def read_workbooks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(file_path, row_no, cells, error)``: the rows of every ``.xlsx`` under ``paths``, or one
    row with ``error`` for a workbook that cannot be read (after the rows before the fault)."""

    def batch_of(path: str, n: int, cells: pa.ListArray, error: str | None = None) -> pa.RecordBatch:
        k = len(cells)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(path), k), pa.array(np.arange(n, n + k)), cells, pa.repeat(pa.scalar(error, pa.string()), k)],
            names=COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("file_path"), batch.column("content")):
                path, n = path.as_py(), 0
                source = workbook_blocks(content.as_py())
                while True:
                    try:
                        cells = next(source, None)
                    except Exception as e:  # a broken workbook must not end the others
                        yield batch_of(path, 0, pa.nulls(1, CELLS), f"unreadable workbook: {type(e).__name__}")
                        break
                    if cells is None:
                        break
                    if len(cells):
                        yield batch_of(path, n + 1, cells)
                    n += len(cells)

    # a workbook is one unit of work: one file per input row, its rows streamed out
    books = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True)
             .load(list(paths)).select(F.col("_metadata.file_path").alias("file_path"), "content"))
    # the scan packs files by their bytes, but unpacking one takes long for its size: with more
    # files than cores they are dealt out to one task each
    n_files = files.list_files(spark, paths, "*.xlsx").count()
    if n_files > spark.sparkContext.defaultParallelism:
        books = books.repartitionByRange(n_files, "file_path")
    return books.mapInArrow(run, "file_path string, row_no long, cells array<string>, error string")


def ingest_xlsx(spark: SparkSession, paths: Sequence[str], batch_ts: str,
                required: Sequence[str] = REQUIRED_FILE_COLUMNS,
                typed_path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Load the workbooks under ``paths``: ``(good rows, rejected rows, rejected files)`` as
    ``files.ingest_csv`` returns them. A workbook that cannot be read to its end, has no row or
    lacks a required column is rejected as a whole."""
    path = work_path(spark, "workbook-rows")
    read_workbooks(spark, paths).write.parquet(path)  # workbooks are unpacked once
    rows = spark.read.parquet(path)
    broken = rows.where(F.col("error").isNotNull()).select("file_path", "error")
    header = F.transform("cells", lambda x: trim_ws(F.coalesce(x, F.lit(""))))
    headers = (rows.where("row_no = 1").select("file_path", *files.column_positions(header, required))
               .join(broken.select("file_path"), "file_path", "left_anti"))
    n_files = headers.count()
    data = rows.where("row_no > 1").select("file_path", "cells")
    complete = F.size("missing") == 0
    good, bad = files.typed(files.pick(data.join(small(headers.where(complete), n_files), "file_path"), required), batch_ts,
                            typed_path)
    known = rows.select("file_path").distinct()
    empty = files.list_files(spark, paths, "*.xlsx").select("file_path").join(known, "file_path", "left_anti")
    incomplete = headers.where(~complete)
    counted = data.join(small(incomplete, n_files).select("file_path"), "file_path") \
        .groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long").alias("n_rows")
    rejected = (incomplete.join(counted, "file_path", "left")
                .select("file_path", files.missing_text().alias("reject_reason"),
                        F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"))
                .unionByName(broken.select("file_path", F.col("error").alias("reject_reason"), zero))
                .unionByName(empty.select("file_path", F.lit("no header line").alias("reject_reason"), zero)))
    return good, bad, rejected
