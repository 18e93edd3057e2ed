"""The ``xlsx_cells`` data source: a folder of .xlsx workbooks as a cell table, and back.

Reading plans one input partition per unit of bounded work, so Spark schedules, retries and
prunes it like any other source:

* Workbooks up to ``PACKED`` bytes are packed together, about ``PACKED`` bytes to a partition.
* A larger workbook is opened while planning (only its zip directory and sheet list are read);
  every wanted sheet is cut into ranges of ``rangeBytes`` of its XML, a partition each.  A range
  holds the rows that begin in it.  A deflated part cannot be entered in the middle, so a task
  inflates it from the start but parses only its own range.

A filter on ``sheet_name`` (``=`` or ``IN``) prunes sheets before anything is opened in a task,
one on ``path`` prunes files.  The option ``sheets`` (a JSON list) names sheets that must exist.

Writing takes rows ``path, sheet_name, row_idx, col_idx, value`` and optionally ``kind`` (``n``
number, ``d`` ISO date, ``b`` true or false, anything else text), each workbook within one task
and sorted by sheet, row and column; it streams sheet after sheet into the zip.  A whole row of a
sheet may come as one: ``path, sheet_name, row_idx, values, kinds``, an array of the texts from the
first column on (null: no cell) and a text with the kind of each.  Tasks
write under a temporary folder; the commit moves finished workbooks to their names, so a failed
or repeated task leaves nothing behind.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from sheetmill.sources.workbook import CELL_SCHEMA, RANGE, Workbook, WorkbookError

PACKED = 4 << 20
#: Distinct strings that a written workbook shares; more are written in place.
SHARED = 1 << 16
_FIELDS = ["path", "sheet_name", "row_idx", "col_idx", "value"]
#: Dates whose text Arrow reads as Python does.
_PLAIN_DATE = "^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}$"
#: Day 0 of a workbook's dates, in days from 1970-01-01.
_DAY_0 = (dt.date(1899, 12, 30) - dt.date(1970, 1, 1)).days


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    try:
        return pafs.FileSystem.from_uri(path)
    except (pa.ArrowException, OSError, ValueError) as e:
        raise WorkbookError(f"no file system for {path}; read it with Spark's binaryFile and decode_workbooks: {e}") from e


@dataclass(frozen=True)
class Unit:
    """A range of one sheet, or (``sheet`` None) all wanted sheets of one workbook."""

    path: str
    sheet: str | None = None
    start: int = 0
    end: int = 0


@dataclass
class Units(InputPartition):
    units: tuple[Unit, ...]


class XlsxReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.size = int(options.get("rangebytes", options.get("rangeBytes", RANGE)))
        named = options.get("sheets")
        self.required: list[str] | None = json.loads(named) if named else None
        self.sheets: set[str] | None = None
        self.paths: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) else None
            if column not in ("sheet_name", "path"):
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            name = "sheets" if column == "sheet_name" else "paths"
            old = getattr(self, name)
            setattr(self, name, values if old is None else old & values)

    def _files(self) -> list[tuple[str, int]]:
        store, top = open_store(self.root)
        info = store.get_file_info(top)
        if info.type == pafs.FileType.NotFound:
            raise WorkbookError(f"no workbook at {self.root}")
        found = [info] if info.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(top, recursive=True))
        hidden = lambda p: any(x.startswith(("_", ".")) for x in p.removeprefix(top).split("/"))
        keep = [f for f in found if f.type == pafs.FileType.File and f.path.endswith(".xlsx") and not hidden(f.path)]
        return sorted((f.path, f.size) for f in keep if self.paths is None or f.path in self.paths)

    def _wanted(self, book: Workbook) -> list[str]:
        return [s for s in book.chosen(self.required) if self.sheets is None or s in self.sheets]

    def partitions(self) -> Sequence[Units]:
        store, _ = open_store(self.root)
        out, packed, total = [], [], 0
        for path, size in self._files():
            if size > min(PACKED, self.size):
                with store.open_input_file(path) as fh:
                    book = Workbook(fh)
                    out += [Units((Unit(path, s, a, b),)) for s in self._wanted(book) for a, b in book.ranges(s, self.size)]
                continue
            if packed and total + size > PACKED:
                out.append(Units(tuple(packed)))
                packed, total = [], 0
            packed.append(Unit(path))
            total += size
        return [*out, *([Units(tuple(packed))] if packed else [])] or [Units(())]

    def read(self, partition: Units) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.root)
        for unit in partition.units:
            try:
                with store.open_input_file(unit.path) as fh:
                    book = Workbook(fh)
                    ranges = [(unit.sheet, unit.start, unit.end)] if unit.sheet else [(s, a, b) for s in self._wanted(book) for a, b in book.ranges(s, self.size)]
                    for sheet, start, end in ranges:
                        for row, col, value in book.batches(sheet, start, end):
                            yield pa.RecordBatch.from_arrays([pa.repeat(unit.path, len(row)), pa.repeat(sheet, len(row)), row, col, value], names=_FIELDS)
            except Exception as e:  # one message naming the file and sheet
                raise WorkbookError(f"could not load sheet(s) {unit.sheet or self.required or 'all'} from {unit.path}: {e}") from e


def column_letters(i: int) -> str:
    """0 -> 'A', 25 -> 'Z', 26 -> 'AA'."""
    out, i = "", i + 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _text(value: str) -> str:
    """XML text; control characters, which XML cannot hold, as ``_x000B_``."""
    return "".join(f"_x{ord(c):04X}_" if c < " " and c not in "\t\n" else c for c in escape(value))


def _runs(batch: pa.RecordBatch, col: str) -> Iterator[tuple[str | None, pa.RecordBatch]]:
    """Each value of a text column with the rows, one after the other, that have it."""
    codes = batch[col].dictionary_encode(null_encoding="encode")
    edges = [0, *(np.flatnonzero(np.diff(codes.indices.to_numpy())) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
    for a, b in itertools.pairwise(edges):
        yield batch[col][a].as_py(), batch.slice(a, b - a)


def _with_values(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Whole rows, without those that hold no value at all."""
    of = pc.list_parent_indices(batch["values"]).filter(pc.is_valid(batch["values"].flatten()))
    kept = pc.unique(of)
    return batch if len(kept) == batch.num_rows else batch.take(kept)


def _cells(run: pa.RecordBatch) -> list[pa.Array]:
    """Row, column, value and kind of the cells with a value."""
    if "values" not in run.schema.names:
        columns = [run[c] for c in ("row_idx", "col_idx", "value", "kind")]
    else:
        value, of = run["values"].flatten(), pc.list_parent_indices(run["values"])
        sizes = pc.list_value_length(run["values"]).fill_null(0).to_numpy()
        wide = int(sizes.max(initial=0))
        col = np.arange(len(value)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        kinds = run["kinds"].fill_null("").dictionary_encode()
        letters = np.array([[ord(x) for x in k.ljust(wide)[:wide]] for k in kinds.dictionary.to_pylist()], np.int32)
        told = letters[kinds.indices.take(of).to_numpy(), col]
        kind = pa.array([chr(i) for i in range(128)]).take(pa.array(np.where(told < 128, told, 0)))
        columns = [run["row_idx"].take(of), pa.array(col, pa.int32()), value, kind]
    there = pc.is_valid(columns[2])
    return columns if columns[2].null_count == 0 else [c.filter(there) for c in columns]


def _joined(texts: pa.Array) -> bytes:
    """The texts one after the other, as they lie in memory."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return texts.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes() if ends[-1] > ends[0] else b""


class WorkbookWriter:
    """Writes one workbook, cell by cell in order, to a binary stream."""

    MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'

    def __init__(self, stream):
        self.zf = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, allowZip64=True)
        self.sheets: list[str] = []
        self.strings: dict[str, int] = {}
        self.part, self.row, self.pending, self.size = None, -1, [], 0

    def _open(self, sheet: str) -> None:
        self._close()
        if sheet in self.sheets:
            raise WorkbookError(f"cells of sheet '{sheet}' are not sorted")
        self.sheets.append(sheet)
        self.part, self.row = self.zf.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w", force_zip64=True), -1
        self.pending.append(f"{self.HEAD}<worksheet {self.MAIN}><sheetData>".encode())

    def _close(self) -> None:
        if self.part is not None:
            self.pending.append((b"</row>" if self.row >= 0 else b"") + b"</sheetData></worksheet>")
            self._flush()
            self.part.close()

    def _flush(self) -> None:
        self.part.write(b"".join(self.pending))
        self.pending.clear()
        self.size = 0

    def add(self, sheet: str, row: int, col: int, value: str, kind: str | None) -> None:
        self.add_many(sheet, *(pa.array([x], t) for x, t in ((row, pa.int32()), (col, pa.int32()), (value, pa.string()), (kind, pa.string()))))

    def add_many(self, sheet: str, row: pa.Array, col: pa.Array, value: pa.Array, kind: pa.Array) -> None:
        """Cells of one sheet, in order."""
        if not self.sheets or sheet != self.sheets[-1]:
            self._open(sheet)
        rows = row.to_numpy()
        before = np.concatenate(([self.row], rows[:-1]))
        if (rows < before).any():
            raise WorkbookError(f"rows of sheet '{sheet}' are not sorted")
        self.row = int(rows[-1])
        number = pc.add(row.cast(pa.int64()), 1).cast(pa.string())
        ends = pc.if_else(pa.array(before >= 0), "</row>", "")
        begins = pc.if_else(pa.array(rows != before), pc.binary_join_element_wise(ends, '<row r="', number, '">', ""), "")
        letters = col.dictionary_encode()
        column = pa.array([column_letters(i) for i in letters.dictionary.to_pylist()], pa.string()).take(letters.indices)
        cells = pc.binary_join_element_wise(begins, '<c r="', column, number, '"', self._bodies(value, kind), "")
        if cells.null_count:
            raise WorkbookError(f"a cell of sheet '{sheet}' has no column")
        self.pending.append(_joined(cells))
        self.size += len(self.pending[-1])
        if self.size > 1 << 18:
            self._flush()

    def _bodies(self, value: pa.Array, kind: pa.Array) -> pa.Array:
        """What follows a cell's reference: numbers as they are, dates by Arrow, the rest once for
        each distinct value."""
        other = pc.invert(pc.equal(kind, "n")).fill_null(True)
        dated = pc.and_(pc.equal(kind, "d").fill_null(False), pc.match_substring_regex(value, _PLAIN_DATE))
        try:
            days = pc.subtract(value.filter(dated).cast(pa.date32()).cast(pa.int32()), _DAY_0)
        except pa.ArrowInvalid:  # a day that no month has: as all others, for the message
            dated = pc.and_(dated, False)
            days = pa.array([], pa.int32())
        other = pc.and_not(other, dated)
        kinds = pc.if_else(pc.is_in(kind, pa.array(["d", "b"])), kind, "s")
        keys = pc.binary_join_element_wise(kinds, value, "").filter(other).dictionary_encode()
        bodies = pa.array([self._body(k[1:], k[0]) for k in keys.dictionary.to_pylist()], pa.string())
        plain = pc.replace_with_mask(value, dated, days.cast(pa.string()))
        begins = pc.if_else(dated, ' s="1"><v>', "><v>")
        return pc.replace_with_mask(pc.binary_join_element_wise(begins, plain, "</v></c>", ""), other, bodies.take(keys.indices))

    def _body(self, value: str, kind: str) -> str:
        if kind == "d":
            return f' s="1"><v>{(dt.date.fromisoformat(value) - dt.date(1970, 1, 1)).days - _DAY_0}</v></c>'
        if kind == "b":
            return f' t="b"><v>{int(value.lower() in ("1", "true"))}</v></c>'
        if value in self.strings or len(self.strings) < SHARED:
            return f' t="s"><v>{self.strings.setdefault(value, len(self.strings))}</v></c>'
        return f' t="inlineStr"><is><t xml:space="preserve">{_text(value)}</t></is></c>'

    def close(self) -> None:
        self._close()
        put = lambda name, body: self.zf.writestr(name, self.HEAD + body)
        listed = "".join(f'<sheet name="{escape(s, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, s in enumerate(self.sheets, 1))
        put("xl/workbook.xml", f'<workbook {self.MAIN} xmlns:r="{self.OFFICE}"><sheets>{listed}</sheets></workbook>')
        package = "http://schemas.openxmlformats.org/package/2006"
        targets = [(f"rId{i}", "worksheet", f"worksheets/sheet{i}.xml") for i in range(1, len(self.sheets) + 1)]
        targets += [("rId900001", "sharedStrings", "sharedStrings.xml"), ("rId900002", "styles", "styles.xml")]
        put("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">' + "".join(f'<Relationship Id="{i}" Type="{self.OFFICE}/{k}" Target="{t}"/>' for i, k, t in targets) + "</Relationships>")
        put("xl/styles.xml", f'<styleSheet {self.MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>')
        put("xl/sharedStrings.xml", f"<sst {self.MAIN}>" + "".join(f'<si><t xml:space="preserve">{_text(t)}</t></si>' for t in self.strings) + "</sst>")
        put("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{self.OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        main, sheet = (f"application/vnd.openxmlformats-officedocument.spreadsheetml.{x}+xml" for x in ("sheet.main", "worksheet"))
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{sheet}"/>' for i in range(1, len(self.sheets) + 1))
        put("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{main}"/>{parts}</Types>')
        self.zf.close()


@dataclass
class Written(WriterCommitMessage):
    moves: tuple[tuple[str, str], ...]


class XlsxWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.root, self.overwrite = options["path"], overwrite
        self.scratch = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, top = open_store(self.root)
        temporary = f"{top}/{self.scratch}/{uuid.uuid4().hex}"
        moves: dict[str, str] = {}
        name, stream, book = None, None, None

        def finish() -> None:
            if book is not None:
                book.close()
                stream.close()

        for batch in iterator:
            if "values" in batch.schema.names:
                batch = _with_values(batch)
            elif "kind" not in batch.schema.names:
                batch = batch.append_column("kind", pa.nulls(batch.num_rows, pa.string()))
            for path, run in _runs(batch, "path"):
                if path != name:
                    finish()
                    name = path
                    if path in moves:
                        raise WorkbookError(f"cells of workbook '{path}' are not sorted")
                    if not path.endswith(".xlsx") or "/" in path:
                        raise WorkbookError(f"a workbook's path is a file name ending in .xlsx, not '{path}'")
                    store.create_dir(temporary, recursive=True)
                    moves[path] = f"{temporary}/{path}"
                    stream = store.open_output_stream(moves[path])
                    book = WorkbookWriter(stream)
                for sheet, rows in _runs(run if "values" in run.schema.names else run.filter(pc.is_valid(run["value"])), "sheet_name"):
                    book.add_many(sheet, *_cells(rows))
        finish()
        return Written(tuple(moves.items()))

    def commit(self, messages: list[Written | None]) -> None:
        store, top = open_store(self.root)
        moves = [m for message in messages if message for m in message.moves]
        if len({name for name, _ in moves}) < len(moves):
            self.abort(messages)
            raise WorkbookError("cells of one workbook came from several tasks; repartition by path first")
        if self.overwrite:
            for old in store.get_file_info(pafs.FileSelector(top, allow_not_found=True)):
                if old.path.endswith(".xlsx"):
                    store.delete_file(old.path)
        for name, temporary in moves:
            store.move(temporary, f"{top}/{name}")
        self._clear(store, top)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*open_store(self.root))

    def _clear(self, store: pafs.FileSystem, top: str) -> None:
        if store.get_file_info(f"{top}/{self.scratch}").type == pafs.FileType.Directory:
            store.delete_dir(f"{top}/{self.scratch}")


class XlsxCells(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xlsx_cells"

    def schema(self) -> str:
        return CELL_SCHEMA

    def reader(self, schema) -> XlsxReader:
        return XlsxReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> XlsxWriter:
        return XlsxWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(XlsxCells)


def write_workbooks(cells: DataFrame, path: str, mode: str = "append", dealt: bool = False) -> None:
    """Cells (``path`` a file name, ``sheet_name, row_idx, col_idx, value`` and perhaps ``kind``, or
    whole rows) as .xlsx files in a folder, one task per workbook.  ``dealt``: each workbook's rows
    are in one partition already, and are not shuffled again."""
    register(cells.sparkSession)
    rows = cells if dealt else cells.repartition("path")
    order = ["path", "sheet_name", "row_idx"]
    if "values" in cells.columns:
        rows = rows.select(*order, "values", "kinds")
    else:
        rows = rows.select(*_FIELDS, *(["kind"] if "kind" in cells.columns else [])).where("value is not null")
        order.append("col_idx")
    rows.sortWithinPartitions(*order).write.format("xlsx_cells").mode(mode).save(path)
