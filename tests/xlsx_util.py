"""Write minimal .xlsx workbooks for tests (shared strings, inline strings, numbers)."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape


def col_letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def write_xlsx(path: str, sheets: dict[str, dict[tuple[int, int], object]]) -> None:
    """``sheets``: name -> {(row, col): value}; str values go to the shared-string table
    (every other one inline, to cover both encodings), numbers stay numeric."""
    strings: list[str] = []
    index: dict[str, int] = {}
    sheet_xml = []
    for name, cells in sheets.items():
        rows: dict[int, list[str]] = {}
        for n, ((r, c), v) in enumerate(sorted(cells.items())):
            ref = f"{col_letters(c)}{r + 1}"
            if isinstance(v, bool):
                xml = f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
            elif isinstance(v, (int, float)):
                xml = f'<c r="{ref}"><v>{v}</v></c>'
            elif n % 2:
                xml = f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'
            else:
                if v not in index:
                    index[v] = len(strings)
                    strings.append(v)
                xml = f'<c r="{ref}" t="s"><v>{index[v]}</v></c>'
            rows.setdefault(r, []).append(xml)
        body = "".join(f'<row r="{r + 1}">{"".join(cs)}</row>' for r, cs in sorted(rows.items()))
        sheet_xml.append(f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    wb = f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>"
    rels = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(
        f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(sheets))
    ) + "</Relationships>"
    sst = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">' + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>"
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/workbook.xml", wb)
        zf.writestr("xl/_rels/workbook.xml.rels", rels)
        zf.writestr("xl/sharedStrings.xml", sst)
        for i, xml in enumerate(sheet_xml):
            zf.writestr(f"xl/worksheets/sheet{i + 1}.xml", xml)
