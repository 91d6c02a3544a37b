"""Workbooks written here, read as long cells and on to facts."""

import zipfile

import test_sheets as T

from tidemark.operators import sheets as S
from tidemark.sources import workbooks as B

_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def _name(r, c):
    return (chr(64 + c // 26) if c >= 26 else "") + chr(65 + c % 26) + str(r + 1)


def _write(path, grids):
    """A workbook of grids: texts shared or inline by turns, numbers, dates as ``("date", serial)``."""
    shared, parts = [], {}
    for i, grid in enumerate(grids.values(), 1):
        rows = []
        for r, line in enumerate(grid):
            cells = []
            for c, v in enumerate(line):
                if v is None:
                    continue
                ref = _name(r, c)
                if isinstance(v, tuple):
                    cells.append(f'<c r="{ref}" s="1"><v>{v[1]}</v></c>')
                elif isinstance(v, str) and (r + c) % 2:
                    cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>')
                elif isinstance(v, str):
                    shared.append(v)
                    cells.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
                else:
                    cells.append(f'<c r="{ref}"><f>A1</f><v>{v}</v></c>')
            rows.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
        parts[f"xl/worksheets/sheet{i}.xml"] = f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(rows)}</sheetData></worksheet>'
    listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(grids, 1))
    parts["xl/workbook.xml"] = f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{listed}</sheets></workbook>'
    parts["xl/_rels/workbook.xml.rels"] = "<Relationships>" + "".join(f'<Relationship Id="rId{i}" Target="{"/xl/" if i % 2 else ""}worksheets/sheet{i}.xml"/>' for i in range(1, len(grids) + 1)) + "</Relationships>"
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{_MAIN}">' + "".join(f"<si><r><t>{s[:2]}</t></r><r><t>{s[2:]}</t></r></si>" for s in shared) + "</sst>"
    parts["xl/styles.xml"] = f'<styleSheet xmlns="{_MAIN}"><numFmts><numFmt numFmtId="170" formatCode="mmm\\-yy"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>'
    with zipfile.ZipFile(path, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)


def test_workbooks_become_facts_and_rejects(spark, tmp_path):
    _write(tmp_path / "a.xlsx", {"Prices": T.MATRIX, "Output": T.SERIES, "Empty": [[]]})
    _write(tmp_path / "copy.xlsx", {"Prices": T.MATRIX, "Output": T.SERIES, "Empty": [[]]})
    _write(tmp_path / "dates.xlsx", {"D": [["Month", "Males", "Females"], *[[("date", 45292 + 31 * i), i + 1, i + 2] for i in range(4)]]})
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    with zipfile.ZipFile(tmp_path / "half.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="x" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="r1" Target="worksheets/none.xml"/></R>')
    (tmp_path / "notes.txt").write_text("not read")
    cells = B.workbook_cells(spark, f"file://{tmp_path}")
    assert {(r.file, r["index"], r["name"]) for r in B.sheet_names(cells).collect()} == {(f, i, n) for f in ("a.xlsx", "copy.xlsx") for i, n in enumerate(("Prices", "Output", "Empty"))} | {("dates.xlsx", 0, "D"), ("half.xlsx", 0, "x")}
    assert {(r.file, r["name"], r.reason.split(":")[0]) for r in B.file_rejects(cells).collect()} == {("bad.xlsx", None, "BadZipFile"), ("half.xlsx", "x", "KeyError")}
    mine = {(r.r, r.c): r.value for r in cells.where("file = 'a.xlsx' and name = 'Prices' and r is not null").collect()}
    assert mine == {(r, c): str(v) for r, line in enumerate(T.MATRIX) for c, v in enumerate(line) if v is not None}
    assert [r.value for r in cells.where("file = 'dates.xlsx' and c = 0 and r > 0").orderBy("r").collect()] == ["2024-01-01", "2024-02-01", "2024-03-03", "2024-04-03"]
    facts, rejects = S.read_sheets(B.as_sheets(B.once(cells)))
    assert {(r.recipe, r["count"]) for r in facts.groupBy("recipe").count().collect()} == {("matrix-v1", 15), ("row-series-v1", 27 + 8)}
    assert [r.reason for r in rejects.collect()] == ["no data block found"]
