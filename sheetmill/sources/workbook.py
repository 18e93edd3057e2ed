"""A1: decode .xlsx workbooks into a long cell grid.

An xlsx file is a zip of XML parts; the standard library decodes it, no Excel library is
needed.  Two ways in:

* ``read_workbook_cells`` reads files through the ``xlsx_cells`` data source
  (``sources.xlsx_source``), which splits large sheets into row ranges for several tasks and
  prunes sheets by filter.  It opens files itself, so they must be in a store that pyarrow reaches.
* ``decode_workbooks`` decodes the BINARY ``content`` column of a table (landed payloads, or
  ``binaryFile`` for any store that Spark reads), one workbook in one task.

Both decode a sheet in ranges of its XML: the stream is inflated, and only the rows that begin in
a range are parsed, so a task holds one range of cells (and the compressed workbook, in the
second way), however long the sheet is.  Large shared-string tables are streamed for
the strings that a range needs.

Blocks of plain cells (numbers, booleans and shared strings without formulas, as nearly all are)
are cut into columns by Arrow's string functions.  From the first block on that holds anything
else, an XML parser reads the rest of the range, with the same result.

Output: ``path, sheet_name, row_idx, col_idx, value`` (value as text; blanks absent).
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import json
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree as ET

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELL_SCHEMA = "path string, sheet_name string, row_idx int, col_idx int, value string"
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_REF = re.compile(r"([A-Z]+)(\d+)")
_BATCH = 50_000
#: Bytes of a sheet's XML that are parsed together.
RANGE = 16 << 20
#: Shared strings up to this many bytes of XML are read once per workbook.
_STRINGS_IN_MEMORY = 8 << 20
_READ = 1 << 17
_ROW_TAG = re.compile(rb"<(?:[\w.-]+:)?row(?=[\s/>])")
#: Longest piece of a row tag that a read may cut.
_TAG = 128
_CONTROL = re.compile("_x(00[01][0-9A-F])_")
#: Bytes of rows that are cut into columns together.
_BLOCK = 1 << 18
_PLAIN_HEAD = re.compile(rb"""<worksheet(?:\s[^<>]*)?\sxmlns=["']http://schemas\.openxmlformats\.org/spreadsheetml/2006/main["'][^<>]*>.*<sheetData(?:\s[^<>]*)?>\s*""", re.DOTALL)
_ENCODING = re.compile(rb"""^[^>]*\sencoding=["'](?!(?i:utf-8|us-ascii)["'])""")
#: Between cells stand ends and beginnings of rows only.
_BETWEEN = r"\s*(?:(?:</row>|<row(?:\s[^<>]*)?>)\s*)*"
#: A cell after its "<c ", and what stands before the next one.  The next byte always tells how to
#: go on, and there are four groups at most, so RE2 takes one pass over a cell.
_PLAIN_CELL = r'^r="(?P<col>[A-Z]{1,3})(?P<row>[0-9]{1,9})"(?P<marks>(?: (?:s="[0-9]+"(?: t="[nsb]")?|t="[nsb]"))?)(?:/>|></c>|><v>(?P<text>[^<>&\r]*)</v></c>)' + _BETWEEN + "$"
_STYLE, _KIND = re.compile('s="([0-9]+)"'), re.compile('t="(.)"')
_ONLY_BETWEEN = re.compile(_BETWEEN)
_EMPTY_ROW = re.compile(rb"<row(?:\s[^<>]*)?/>")
#: Whole numbers written with a point, and numbers whose text is already as shown.
_POINT_ZERO, _AS_SHOWN = r"^(-?[1-9][0-9]{0,13})\.0*$", r"^(?:0|-?[1-9][0-9]{0,13}|-?[1-9][0-9]{0,6}\.[0-9]{0,6}[1-9])$"
_RAW = pa.schema([("row", pa.int32()), ("col", pa.int32()), ("kind", pa.string()), ("style", pa.string()), ("text", pa.string())])
#: Day serials without a time, in either date system.
_WHOLE_DAY = "^[1-9][0-9]{0,4}$"
#: The built-in number formats that show a date.
_DATE_FORMATS = {"14", "15", "16", "17", "22"}


class WorkbookError(RuntimeError):
    pass


def column_number(letters: str) -> int:
    """'A' -> 0, 'Z' -> 25, 'AA' -> 26."""
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _render_number(text: str) -> str:
    try:
        x = float(text)
    except ValueError:
        return text
    if x.is_integer() and abs(x) < 1e15:
        return str(int(x))
    return repr(x)


def _render_date(serial: str, base: dt.datetime) -> str:
    """ISO date of a day serial; with the time when it has one.  Other text stays."""
    try:
        at = base + dt.timedelta(seconds=round(float(serial) * 86400))
    except (ValueError, OverflowError):
        return serial
    return at.date().isoformat() if at.time() == dt.time() else at.isoformat(sep=" ")


def _date_styles(zf: zipfile.ZipFile) -> set[str]:
    """Indices of the cell styles that show a number as a date."""
    if "xl/styles.xml" not in zf.namelist():
        return set()
    root = ET.fromstring(zf.read("xl/styles.xml"))
    custom = {f.get("numFmtId"): f.get("formatCode", "") for f in root.iter(f"{_NS}numFmt")}
    xfs = root.find(f"{_NS}cellXfs")

    def shows_date(fmt: str) -> bool:
        if fmt in custom:
            return bool(re.search("[dy]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom[fmt].lower())))
        return fmt in _DATE_FORMATS

    return {str(i) for i, xf in enumerate([] if xfs is None else xfs) if shows_date(xf.get("numFmtId", "0"))}


def _date_base(zf: zipfile.ZipFile) -> dt.datetime:
    """Day 0 of the workbook's date system (1900, or 1904 where the workbook says so)."""
    pr = ET.fromstring(zf.read("xl/workbook.xml")).find(f"{_NS}workbookPr")
    mac = pr is not None and pr.get("date1904") in ("1", "true")
    return dt.datetime(1904, 1, 1) if mac else dt.datetime(1899, 12, 30)


def _unescape(text: str) -> str:
    """Control characters, which XML cannot hold, are written as ``_x000B_``."""
    return _CONTROL.sub(lambda m: chr(int(m[1], 16)), text) if "_x00" in text else text


class SharedStrings:
    """The shared strings of a workbook: read once when small, else streamed per request."""

    PART = "xl/sharedStrings.xml"

    def __init__(self, zf: zipfile.ZipFile):
        self.zf = zf
        self.there = self.PART in zf.namelist()
        self.known: dict[int, str] | None = None
        if self.there and zf.getinfo(self.PART).file_size <= _STRINGS_IN_MEMORY:
            self.known = dict(self._stream())

    def _stream(self) -> Iterator[tuple[int, str]]:
        with self.zf.open(self.PART) as fh:
            n, root = 0, None
            for event, el in ET.iterparse(fh, events=("start", "end")):
                if event == "start":
                    root = el if root is None else root
                elif el.tag == f"{_NS}si":
                    yield n, _unescape("".join(t.text or "" for t in el.iter(f"{_NS}t")))
                    n += 1
                    root.clear()  # finished strings leave the tree

    def texts(self, wanted: set[int]) -> dict[int, str]:
        if self.known is not None or not self.there or not wanted:
            return self.known or {}
        return {i: t for i, t in self._stream() if i in wanted}


def _sheet_parts(zf: zipfile.ZipFile) -> dict[str, str]:
    """sheet name -> part path inside the zip."""
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels.iter(f"{_PKG_REL}Relationship")}
    out = {}
    for s in wb.iter(f"{_NS}sheet"):
        target = targets[s.get(f"{_REL_NS}id")].lstrip("/")
        out[s.get("name")] = target if target.startswith("xl/") else f"xl/{target}"
    return out


class Workbook:
    """An open workbook; ``file`` is seekable and binary."""

    def __init__(self, file):
        self.zf = zipfile.ZipFile(file)
        self.parts = _sheet_parts(self.zf)
        self.dates, self.base = _date_styles(self.zf), _date_base(self.zf)
        self.strings = SharedStrings(self.zf)

    def chosen(self, sheet_names: Sequence[str] | None) -> list[str]:
        wanted = list(self.parts) if sheet_names is None else list(sheet_names)
        for name in wanted:
            if name not in self.parts:
                raise WorkbookError(f"sheet '{name}' not found (sheets: {list(self.parts)})")
        return wanted

    def ranges(self, sheet: str, size: int = RANGE) -> list[tuple[int, int]]:
        """Ranges of the sheet's XML, in bytes; each row belongs to the range it begins in."""
        total = self.zf.getinfo(self.parts[sheet]).file_size
        return [(at, min(at + size, total)) for at in range(0, max(1, total), size)]

    def cells(self, sheet: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
        """(row_idx, col_idx, value) of the non-blank cells of the rows that begin in the range."""
        for row, col, value in self.batches(sheet, start, end):
            yield from zip(row.to_pylist(), col.to_pylist(), value.to_pylist(), strict=True)

    def batches(self, sheet: str, start: int, end: int) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
        """``cells`` as columns, some at a time.  Only where shared strings are not in memory are
        the range's cells held together."""
        with self.zf.open(self.parts[sheet]) as fh:
            found = _raw_batches(_row_bytes(fh, start, end))
            if self.strings.known is None and self.strings.there:
                found = list(found)
                wanted = [pc.unique(raw["text"].filter(pc.equal(raw["kind"], "s"))).to_pylist() for raw in found]
                texts = self.strings.texts({int(v) for some in wanted for v in some})
            else:
                texts = self.strings.known or {}
            for raw in found:
                value = self._values(raw, texts)
                there = pc.not_equal(value, "")
                yield raw["row"].filter(there), raw["col"].filter(there), value.filter(there)

    def _values(self, raw: pa.RecordBatch, texts: dict[int, str]) -> pa.Array:
        """The cells as shown: numbers and whole days by Arrow's functions where their text allows
        it, the rest once for each distinct cell."""
        text = raw["text"]
        isin = lambda c, values: pc.is_in(raw[c], pa.array(sorted(values), pa.string()))
        told = isin("kind", _NOT_NUMBERS)
        dated = pc.and_not(isin("style", self.dates), told)
        number = pc.invert(pc.or_(told, dated))
        value = pc.replace_with_mask(text, number, _as_numbers(text.filter(number)))
        day = pc.and_(dated, pc.match_substring_regex(text, _WHOLE_DAY))
        days = pc.add(text.filter(day).cast(pa.int32()), pa.scalar((self.base - dt.datetime(1970, 1, 1)).days, pa.int32()))
        value = pc.replace_with_mask(value, day, days.cast(pa.date32()).cast(pa.string()))
        other = pc.invert(pc.or_(number, day))
        keys = pc.binary_join_element_wise(*(raw[c].filter(other) for c in ("kind", "style", "text")), "\0").dictionary_encode()
        shown = pa.array([self._shown(*k.split("\0", 2), texts) for k in keys.dictionary.to_pylist()], pa.string())
        return pc.replace_with_mask(value, other, shown.take(keys.indices))

    def _shown(self, kind: str, style: str, text: str, texts: dict[int, str]) -> str:
        if kind == "s":
            return texts[int(text)]
        if kind == "b":
            return "True" if text == "1" else "False"
        if kind in ("str", "e", "d", "inlineStr"):
            return _unescape(text)
        return _render_date(text, self.base) if style in self.dates else _render_number(text)


_NOT_NUMBERS = {"s", "b", "str", "e", "d", "inlineStr"}


def _as_numbers(text: pa.Array) -> pa.Array:
    """Numbers as ``_render_number`` shows them; it is asked only where their text is not plain."""
    left = pc.invert(pc.match_substring_regex(text, _AS_SHOWN))
    rest = pc.replace_substring_regex(text.filter(left), _POINT_ZERO, r"\1")
    odd = pc.invert(pc.match_substring_regex(rest, _AS_SHOWN))
    rest = pc.replace_with_mask(rest, odd, pa.array([_render_number(t) for t in rest.filter(odd).to_pylist()], pa.string()))
    return pc.replace_with_mask(text, left, rest)


def _plain_block(block: bytes) -> pa.RecordBatch | None:
    """The cells of whole rows, or None where something other than plain cells is among them."""
    rows, ends = block.count(b"<row"), block.count(b"</row>")
    if b"xmlns" in block or rows != ends and rows != ends + len(_EMPTY_ROW.findall(block)):
        return None
    try:
        parts = pc.split_pattern(pa.array([block.decode()]), "<c ").flatten()
    except UnicodeDecodeError:
        return None
    if not _ONLY_BETWEEN.fullmatch(parts[0].as_py()):
        return None
    found = pc.extract_regex(parts[1:], _PLAIN_CELL)
    if found.null_count:
        return None
    col, row, marks, text = found.flatten()
    letters = col.dictionary_encode()
    columns = pa.array([column_number(x) for x in letters.dictionary.to_pylist()], pa.int32()).take(letters.indices)
    marks = marks.dictionary_encode()
    told = lambda pattern, default: pa.array([m[1] if (m := pattern.search(x)) else default for x in marks.dictionary.to_pylist()], pa.string()).take(marks.indices)
    raw = pa.RecordBatch.from_arrays([pc.subtract(row.cast(pa.int32()), pa.scalar(1, pa.int32())), columns, told(_KIND, "n"), told(_STYLE, "0"), text], schema=_RAW)
    return raw.filter(pc.not_equal(text, ""))


def _blocks(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The same bytes in blocks that begin with a row."""
    buffer = b""
    for piece in pieces:
        buffer += piece
        if len(buffer) >= _BLOCK and (cut := max(buffer.rfind(b"<row "), buffer.rfind(b"<row>"))) > 0:
            yield buffer[:cut]
            buffer = buffer[cut:]
    yield buffer


def _raw_batches(pieces: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    """Row, column, type, style and raw text of every cell with a reference and a value."""
    head = next(pieces, b"")
    left = pieces
    if b"<!" not in head and not _ENCODING.search(head) and (plain := _PLAIN_HEAD.search(head)) and plain.end() == len(head):
        blocks = _blocks(pieces)
        left = iter(())
        for block in blocks:
            rows, end, tail = block.partition(b"</sheetData>")
            raw = None if _ROW_TAG.search(tail) or b"<c " in tail else _plain_block(rows)
            if raw is None:
                left = itertools.chain([block], blocks)
                break
            if end:  # what stands after the rows must be well-formed all the same
                parser = ET.XMLPullParser(("end",))
                parser.feed(head + end + tail)
            if raw.num_rows:
                yield raw
    cells = _parsed_cells(itertools.chain([head], left))
    while some := list(itertools.islice(cells, _BATCH)):
        row, col, cell = zip(*some, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((row, col, *zip(*cell, strict=True)), _RAW, strict=True)], schema=_RAW)


def _row_bytes(fh, start: int, end: int) -> Iterator[bytes]:
    """The part's bytes before its first row, then those of the rows whose tag begins in
    [start, end).  A part that isn't in an ASCII-compatible encoding is one range."""
    buffer, at = fh.read(_READ), 0
    if buffer[:2] in (b"\xff\xfe", b"\xfe\xff"):
        while start == 0 and buffer:
            yield buffer
            buffer = fh.read(_READ)
        return
    head = b""
    while not (first := _ROW_TAG.search(buffer)):
        more = fh.read(_READ)
        if not more:
            return  # a sheet without rows
        buffer += more  # what stands before the rows is small
    head = buffer[: first.start()]
    yield head
    position = max(start, first.start())
    while not (begin := _ROW_TAG.search(buffer, max(0, position - at))):
        keep = buffer[-_TAG:]
        at += len(buffer) - len(keep)
        more = fh.read(_READ)
        if not more:
            return
        buffer = keep + more
    buffer, at = buffer[begin.start() :], at + begin.start()
    while True:
        stop = _ROW_TAG.search(buffer, max(0, end - at)) if at + len(buffer) > end else None
        if stop:
            if at + stop.start() > at:
                yield buffer[: stop.start()]
            return
        more = fh.read(_READ)
        if not more:
            yield buffer
            return
        keep = buffer[-_TAG:] if len(buffer) > _TAG else b""  # may hold the start of a row tag
        yield buffer[: len(buffer) - len(keep)] if keep else b""
        at += len(buffer) - len(keep) if keep else 0
        buffer = (keep or buffer) + more


def _parsed_cells(pieces: Iterator[bytes]) -> Iterator[tuple[int, int, tuple[str, str, str]]]:
    """(row_idx, col_idx, (type, style, raw text)) of every cell with a reference and a value."""
    parser, data = ET.XMLPullParser(("start", "end")), None
    for piece in pieces:
        parser.feed(piece)
        for event, el in parser.read_events():
            if event == "start":
                data = el if el.tag == f"{_NS}sheetData" else data
                continue
            if el.tag == f"{_NS}row" and data is not None:
                data.clear()  # finished rows leave the tree
            if el.tag != f"{_NS}c":
                continue
            m = _REF.fullmatch(el.get("r", ""))
            kind, v = el.get("t", "n"), el.find(f"{_NS}v")
            text = "".join(t.text or "" for t in el.iter(f"{_NS}t")) if kind == "inlineStr" else None if v is None else v.text
            if m and text is not None:
                yield int(m[2]) - 1, column_number(m[1]), (kind, el.get("s", "0"), text)


def iter_cells(content: bytes, sheet_names: Sequence[str] | None = None, size: int = RANGE) -> Iterator[tuple[str, int, int, str]]:
    """Yield (sheet_name, row_idx, col_idx, value) for every non-blank cell, range by range."""
    book = Workbook(io.BytesIO(content))
    for name in book.chosen(sheet_names):
        for start, end in book.ranges(name, size):
            for row, col, value in book.cells(name, start, end):
                yield name, row, col, value


def _decode_batches(sheet_names: Sequence[str] | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                buf: list[tuple] = []
                try:
                    for sheet, r, c, v in iter_cells(bytes(content), sheet_names):
                        buf.append((path, sheet, r, c, v))
                        if len(buf) >= _BATCH:
                            yield pd.DataFrame(buf, columns=["path", "sheet_name", "row_idx", "col_idx", "value"])
                            buf = []
                except Exception as e:  # one message naming the file and sheets
                    raise WorkbookError(f"could not load sheet(s) {sheet_names} from {path}: {e}") from e
                if buf:
                    yield pd.DataFrame(buf, columns=["path", "sheet_name", "row_idx", "col_idx", "value"])

    return run


def decode_workbooks(files: DataFrame, sheet_names: Sequence[str] | None = None) -> DataFrame:
    """Cell grid of every workbook in ``files`` (columns ``path`` and ``content``)."""
    return files.select("path", "content").mapInPandas(_decode_batches(sheet_names), CELL_SCHEMA)


def read_workbook_cells(spark: SparkSession, path: str, sheet_names: Sequence[str] | None = None, range_bytes: int = RANGE) -> DataFrame:
    """A1 cell grid of one or many .xlsx files (a file or a directory): one partition per row
    range of a large sheet.  Named sheets must be there."""
    from sheetmill.sources.xlsx_source import register

    register(spark)
    reader = spark.read.format("xlsx_cells").option("rangeBytes", str(range_bytes))
    if sheet_names is not None:
        reader = reader.option("sheets", json.dumps(list(sheet_names)))
    return reader.load(path)


def sheet_grid(cells: DataFrame, sheet_name: str, sheet: str = "sheet_id") -> DataFrame:
    """Cells of one named sheet as a grid keyed by the workbook path."""
    return cells.where(F.col("sheet_name") == sheet_name).select(F.col("path").alias(sheet), "row_idx", "col_idx", "value")
