"""The workbook reader and writer: ranges of large sheets, sheet and file pruning, commits."""

from __future__ import annotations

import io
import itertools
import tempfile
import zipfile

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from xlsx_util import write_xlsx

from sheetmill.sources import workbook as W
from sheetmill.sources import xlsx_source as X


def grid(n_rows, n_cols, seed=0):
    value = lambda r, c: [f"text {r}.{c}", f"same {c}", r * 1.5 + c, r % 2 == 0][(r + c + seed) % 4]
    return {(r, c): value(r, c) for r in range(n_rows) for c in range(n_cols) if (r * 7 + c) % 5}


def shown(v):
    return ("True" if v else "False") if isinstance(v, bool) else W._render_number(str(v)) if isinstance(v, float) else str(v)


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 60), st.integers(1, 6), st.integers(40, 5000), st.integers(1, 700))
def test_ranges_partition_a_sheet(n_rows, n_cols, size, read):
    """However the XML is cut into ranges and reads, every cell is in exactly one range."""
    out = io.BytesIO()
    cells = grid(n_rows, n_cols)
    write_xlsx(out, {"S": cells, "T": {(0, 0): "other"}})
    old = W._READ
    W._READ = read
    try:
        book = W.Workbook(io.BytesIO(out.getvalue()))
        got = [c for a, b in book.ranges("S", size) for c in book.cells("S", a, b)]
    finally:
        W._READ = old
    assert got == sorted(got) and {(r, c): v for r, c, v in got} == {k: shown(v) for k, v in cells.items()}
    assert len(got) == len(cells)


def test_ranges_with_prefixed_tags_and_row_like_names():
    """Namespace prefixes, tags that begin like a row tag, and text that looks like one."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rows = "".join(f'<x:row r="{i + 1}" spans="1:1"><x:c r="A{i + 1}" t="inlineStr"><x:is><x:t>&lt;row {i}</x:t></x:is></x:c></x:row>' for i in range(50))
    xml = f'<x:worksheet xmlns:x="{main}"><x:sheetFormatPr/><x:sheetData>{rows}</x:sheetData><x:rowBreaks count="0"/></x:worksheet>'
    pieces = lambda a, b: W._parsed_cells(W._row_bytes(io.BytesIO(xml.encode()), a, b))
    got = [(r, v[2]) for a in range(0, len(xml), 333) for r, _, v in pieces(a, a + 333)]
    assert got == [(i, f"<row {i}") for i in range(50)]


def test_large_shared_string_table_is_streamed(monkeypatch):
    out = io.BytesIO()
    cells = {(r, c): f"string {r} {c}" for r in range(200) for c in range(3)}
    write_xlsx(out, {"S": cells})
    monkeypatch.setattr(W, "_STRINGS_IN_MEMORY", 10)
    book = W.Workbook(io.BytesIO(out.getvalue()))
    assert book.strings.known is None
    assert {(r, c): v for a, b in book.ranges("S", 2000) for r, c, v in book.cells("S", a, b)} == cells


def test_sheets_and_files_are_pruned(spark, tmp_path):
    big, small = grid(4000, 5), {(0, 0): "x", (2, 1): 2.0}
    write_xlsx(str(tmp_path / "big.xlsx"), {"Data": big, "Notes": small})
    write_xlsx(str(tmp_path / "small.xlsx"), {"Data": small, "Notes": small})
    (tmp_path / "_hidden").mkdir()
    write_xlsx(str(tmp_path / "_hidden" / "no.xlsx"), {"Data": small})
    cells = W.read_workbook_cells(spark, str(tmp_path), range_bytes=64 << 10)
    data = cells.where("sheet_name = 'Data'")
    assert data.rdd.getNumPartitions() > 3  # ranges of the big sheet, and the small workbook
    got = {(r["path"].rsplit("/", 1)[1], r["row_idx"], r["col_idx"]): r["value"] for r in data.collect()}
    assert got == {**{("big.xlsx", *k): shown(v) for k, v in big.items()}, **{("small.xlsx", *k): shown(v) for k, v in small.items()}}
    assert cells.where("sheet_name IN ('Notes', 'None')").count() == 4
    assert cells.where("sheet_name = 'Notes'").rdd.getNumPartitions() < data.rdd.getNumPartitions()
    one = str(tmp_path / "small.xlsx")
    assert cells.where(f"path = '{one}'").rdd.getNumPartitions() == 1
    assert cells.where(f"path = '{one}' and value = '2'").count() == 2
    assert W.read_workbook_cells(spark, one, ["Notes"]).count() == 2
    with pytest.raises(Exception, match="sheet 'Nope' not found"):
        W.read_workbook_cells(spark, str(tmp_path), ["Nope"]).collect()
    with pytest.raises(Exception, match="no workbook at"):
        W.read_workbook_cells(spark, str(tmp_path / "none")).collect()
    (tmp_path / "broken.xlsx").write_bytes(b"not a zip")
    with pytest.raises(Exception, match="broken.xlsx"):
        W.read_workbook_cells(spark, str(tmp_path)).collect()


SCHEMA = "path string, sheet_name string, row_idx int, col_idx int, value string, kind string"


def test_workbooks_round_trip(spark, tmp_path):
    rows = []
    for b in range(3):
        for s in ("A & B", 'C "d"'):
            for r in range(0, 40, 3):
                rows += [(f"b{b}.xlsx", s, r, 0, f"<t> & {r}\n\x0b e", "s"), (f"b{b}.xlsx", s, r, 1, str(r / 4), "n"), (f"b{b}.xlsx", s, r, 27, "2031-05-06", "d"), (f"b{b}.xlsx", s, r, 30, "true", "b"), (f"b{b}.xlsx", s, r, 31, None, None)]
    folder = str(tmp_path / "out")
    X.write_workbooks(spark.createDataFrame(rows, SCHEMA).repartition(5), folder)
    want = {r[:4]: {"s": r[4], "n": W._render_number(r[4] or ""), "d": r[4], "b": "True"}[r[5]] for r in rows if r[4] is not None}
    read = lambda: {(r["path"].rsplit("/", 1)[1], r["sheet_name"], r["row_idx"], r["col_idx"]): r["value"] for r in W.read_workbook_cells(spark, folder).collect()}
    assert read() == want
    names = {p.name for p in (tmp_path / "out").iterdir()}
    assert names == {"b0.xlsx", "b1.xlsx", "b2.xlsx"}  # no temporary folder stays
    assert "[Content_Types].xml" in zipfile.ZipFile(tmp_path / "out" / "b0.xlsx").namelist()
    X.write_workbooks(spark.createDataFrame([("b9.xlsx", "S", 0, 0, "only", "s")], SCHEMA), folder, "overwrite")
    assert read() == {("b9.xlsx", "S", 0, 0): "only"}


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    folder = tmp_path / "out"
    good = [("a.xlsx", "S", r, 0, "x", "s") for r in range(50)]
    X.write_workbooks(spark.createDataFrame(good, SCHEMA), str(folder))
    bad = [*good, ("b.xlsx", "S", 0, 0, "not a date", "d")]
    with pytest.raises(Exception, match="isoformat"):
        X.write_workbooks(spark.createDataFrame(bad, SCHEMA), str(folder), "overwrite")
    assert [p.name for p in folder.iterdir()] == ["a.xlsx"]
    assert W.read_workbook_cells(spark, str(folder)).count() == 50
    unsorted = spark.createDataFrame([good[3], good[1]], SCHEMA).coalesce(1)
    with pytest.raises(Exception, match="not sorted"):
        unsorted.write.format("xlsx_cells").mode("append").save(str(folder))
    split = spark.createDataFrame(good, SCHEMA).repartition(4, "row_idx")
    with pytest.raises(Exception, match="several tasks"):
        split.sortWithinPartitions("row_idx").write.format("xlsx_cells").mode("append").save(str(folder))
    assert [p.name for p in folder.iterdir()] == ["a.xlsx"]


def test_shared_strings_of_a_written_workbook_are_bounded(monkeypatch):
    monkeypatch.setattr(X, "SHARED", 5)
    out = io.BytesIO()
    book = X.WorkbookWriter(out)
    for r in range(20):
        book.add("S", r, 0, f"v{r % 10}", "s")
    book.close()
    assert len(book.strings) == 5
    assert [v for _, _, _, v in W.iter_cells(out.getvalue())] == [f"v{r % 10}" for r in range(20)]


def _sheet(rows, head="", tail="", main='xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'):
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<worksheet {main}>{head}<sheetData>{rows}</sheetData>{tail}</worksheet>'


def _read_both(xml, monkeypatch, block):
    """Cells by whatever way the reader takes, and by the XML parser alone."""
    monkeypatch.setattr(W, "_BLOCK", block)
    book = W.Workbook.__new__(W.Workbook)
    book.dates, book.base = {"1"}, W.dt.datetime(1899, 12, 30)
    texts = {i: f"shared {i}" for i in range(9)}
    ways = []
    for batches in (W._raw_batches, lambda pieces: W._raw_batches(itertools.chain([b"<!-- -->"], pieces))):
        raw = list(batches(W._row_bytes(io.BytesIO(xml.encode()), 0, len(xml))) if batches is W._raw_batches else batches(iter([xml.split("?>\n")[1].encode()])))
        ways.append([c for r in raw for c in zip(r["row"].to_pylist(), r["col"].to_pylist(), book._values(r, texts).to_pylist(), strict=True) if c[2] != ""])
    return ways


@pytest.mark.parametrize("block", [1, 200, 1 << 18])
def test_plain_blocks_and_the_parser_agree(monkeypatch, block):
    """Numbers in many forms, dates, booleans, shared strings, and all that is not a plain cell."""
    numbers = ["0", "-0", "0.5", "-12.50", "45.0", "45.", "1e3", "1E-7", "0.00001", "123456789012345678", "999999999999999.0", "12345678901234.0", "1234567.1234567", "0012", "n/a", " 7 ", "nan", "-1.0", "3.10"]
    plain = "".join(f'<row r="{i + 1}" spans="1:9"><c r="A{i + 1}"><v>{x}</v></c><c r="AB{i + 1}" s="1"><v>{45000 + i / 2}</v></c><c r="AC{i + 1}" s="3" t="s"><v>{i % 9}</v></c><c r="AD{i + 1}" t="b"><v>{i % 2}</v></c><c r="AE{i + 1}" s="2"/><c r="AF{i + 1}"><v></v></c></row>\n' for i, x in enumerate(numbers))
    plain += '<row r="40"/><row r="41"></row><row r="42"><c r="A42"><v>9</v></c></row>'
    odd = [
        '<row r="50"><c r="A50"><f>A1+1</f><v>2.0</v></c></row>', '<row r="50"><c r="A50" t="inlineStr"><is><t>a&lt;b</t></is></c></row>', '<row r="50"><!-- <c r="A1"><v>1</v></c> --><c r="A50"><v>5</v></c></row>',
        '<row r="50"><c t="n" r="A50"><v>5</v></c></row>', '<row r="50"><c><v>5</v></c></row>', '<row r="50"><c r="A50" t="str"><v>x&amp;y</v></c></row>', '<row r="50" xmlns="urn:other"><c r="A50"><v>5</v></c></row>',
    ]
    for rows in (plain, *(f"{plain}{x}{plain}" for x in odd), ""):
        got, parsed = _read_both(_sheet(rows, "<cols/>", "<mergeCells/>"), monkeypatch, block)
        assert got == parsed and (len(got) > 60 or not rows)
    other, parsed = _read_both(_sheet(plain, main='xmlns="urn:other"'), monkeypatch, block)
    assert other == parsed == []


def test_cells_are_not_handled_one_by_one(monkeypatch):
    """Reading and writing plain cells calls Python per distinct column, not per cell."""
    calls = {"read": 0, "write": 0}
    number, letters = W.column_number, X.column_letters
    monkeypatch.setattr(W, "column_number", lambda x: (calls.__setitem__("read", calls["read"] + 1), number(x))[1])
    monkeypatch.setattr(X, "column_letters", lambda i: (calls.__setitem__("write", calls["write"] + 1), letters(i))[1])
    rows = [("a.xlsx", s, r, c, f"{r}.25" if c else f"s{r % 5}", "n" if c else "s") for s in ("S", "T") for r in range(3000) for c in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["path", "sheet_name", "row_idx", "col_idx", "value", "kind"])
    with tempfile.TemporaryDirectory() as folder:
        writer = X.XlsxWriter({"path": folder}, False)
        writer.commit([writer.write(iter([batch.slice(0, 7001), batch.slice(7001)]))])
        content = open(f"{folder}/a.xlsx", "rb").read()
    one = io.BytesIO()
    book = X.WorkbookWriter(one)
    for _, *cell in rows[:40]:
        book.add(*cell)
    book.close()
    assert list(W.iter_cells(one.getvalue())) == [r[1:5] for r in rows[:40]]
    calls["write"] -= 40
    assert list(W.iter_cells(content)) == [r[1:5] for r in rows]
    assert max(calls.values()) < len(rows) / 50


def test_whole_rows_give_the_same_workbooks(spark, tmp_path):
    """Rows of unequal lengths and kinds, blanks, rows and workbooks without any value."""
    rows = [("a.xlsx", "S", r, [f"{r}.5", None if r % 3 else "2031-05-06", "x" * (r % 4), "true"][: 1 + r % 4], ["ndsb", "sdz", "nd"][r % 3]) for r in range(60)]
    rows += [("a.xlsx", "T", 3, [None, "2031-5", None], "nsn"), ("a.xlsx", "U", 0, [None, None], "nn"), ("b.xlsx", "S", 0, [None], "n"), ("b.xlsx", "S", 1, [], ""), ("b.xlsx", "S", 2, None, None), ("c.xlsx", "S", 9, ["1", "2"], None)]
    packed = spark.createDataFrame(rows, "path string, sheet_name string, row_idx int, values array<string>, kinds string")
    flat = [(p, s, r, c, v, (k or "").ljust(9)[c]) for p, s, r, vs, k in rows for c, v in enumerate(vs or [])]
    X.write_workbooks(packed.repartition(5), str(tmp_path / "packed"))
    X.write_workbooks(packed.repartition(3, "path"), str(tmp_path / "dealt"), dealt=True)
    X.write_workbooks(spark.createDataFrame(flat, SCHEMA), str(tmp_path / "flat"))
    cells = {x: {p.name: sorted(W.iter_cells(p.read_bytes())) for p in (tmp_path / x).iterdir()} for x in ("flat", "packed", "dealt")}
    assert set(cells["flat"]) == {"a.xlsx", "c.xlsx"} and len(cells["flat"]["a.xlsx"]) > 90
    assert cells["packed"] == cells["dealt"] == cells["flat"]
    assert ("T", 3, 1, "2031-5") in cells["flat"]["a.xlsx"] and [v for *_, v in cells["flat"]["c.xlsx"]] == ["1", "2"]


@pytest.mark.parametrize("value", ["2031-02-30", "0000-01-01", "not a date", "2031-13-01"])
def test_a_value_that_is_no_date_is_named(value):
    book = X.WorkbookWriter(io.BytesIO())
    with pytest.raises(ValueError):
        book.add("S", 0, 0, value, "d")
    columns = [pa.array([0, 1, 2], pa.int32()), pa.array([0, 0, 0], pa.int32()), pa.array(["2031-05-06", value, "20310507"]), pa.array(["d", "s", "d"])]
    out = io.BytesIO()
    book = X.WorkbookWriter(out)
    book.add_many("S", *columns)
    book.close()
    assert [v for *_, v in W.iter_cells(out.getvalue())] == ["2031-05-06", value, "2031-05-07"]


def test_days_and_numbers_as_shown(monkeypatch):
    """Columns of day serials and numbers, against the functions for one cell, in both date systems."""
    texts = ["0", "1", "59", "45000", "99999", "2958465", "2958466", "-3", "45000.5", "045", "n/a", "1e3", "0.50", "12.0", "7."]
    raw = pa.RecordBatch.from_arrays([pa.array(range(2 * len(texts)), pa.int32()), pa.array([0] * 2 * len(texts), pa.int32()), pa.array(["n"] * 2 * len(texts)), pa.array(["1", "0"] * len(texts)), pa.array([t for t in texts for _ in range(2)])], schema=W._RAW)
    for base in (W.dt.datetime(1899, 12, 30), W.dt.datetime(1904, 1, 1)):
        book = W.Workbook.__new__(W.Workbook)
        book.dates, book.base = {"1"}, base
        assert book._values(raw, {}).to_pylist() == [f for t in texts for f in (W._render_date(t, base), W._render_number(t))]


def test_order_lines_are_shuffled_once(spark, tmp_path):
    """Lines go to their workbook's task once, two rows of text each, not as a row for every cell."""
    from sheetmill.exercises import sources_sinks as S

    day = W.dt.datetime(2031, 5, 6)
    lines = [(k, n, float(n), k / 4, "N", day, "O") for k in (1, 2, 16383, 16384, 40000) for n in range(1, 4)] + [(2, 1, 9.0, 0.0, "R", day + W.dt.timedelta(1), None), (7, 1, None, 5.0, None, None, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    books = S._order_books(spark, str(tmp_path))
    assert books._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert books.count() == 2 * 16
    got = sorted(tuple(r) for r in S.a1_workbook_cells(spark, str(tmp_path)).collect())
    best = {}
    for k, n, *v in lines:
        best[k, n] = [max((x for x in (a, b) if x is not None), default=None) for a, b in zip(v, best.get((k, n), [None] * 5), strict=True)]
    text = lambda q, p, f, d, _: [None if q is None else W._render_number(str(q)), W._render_number(str(p)), f, None if d is None else str(d.date())]
    assert got == sorted((f"lines-{k // 16384:06d}.xlsx", k % 16384 * 8 + n, c, v) for (k, n), x in best.items() for c, v in enumerate(text(*x)) if v is not None)
