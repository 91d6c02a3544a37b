"""Workbooks (``.xlsx``) as long cells: a row for each cell that is not empty.

Files come from Spark's binary source, so any file system that Spark knows will do, and are dealt out one by one; a
workbook is taken apart as a stream of its XML.  A file that can't be read gives one row with its error instead.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import io
import re
import zipfile
from collections.abc import Iterator
from posixpath import join, normpath
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS = "file string, digest string, index int, name string, r int, c int, value string, error string"
#: Numbers of the built-in number formats that are dates, and the day that serial numbers count from.
_DATES, _ORIGIN = frozenset((*range(14, 23), *range(45, 48))), dt.datetime(1899, 12, 30)
_ROWS = 10_000


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    found = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, e in ElementTree.iterparse(f):
            if _local(e.tag) == "si":
                found.append("".join(t.text or "" for t in e.iter() if _local(t.tag) == "t"))
                e.clear()
    return found


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles whose number format is a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(e.get("numFmtId")) for e in root.iter() if _local(e.tag) == "numFmt" and re.search(r"[ymd]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", e.get("formatCode", "").lower()))}
    cells = next((e for e in root if _local(e.tag) == "cellXfs"), [])
    return {i for i, x in enumerate(cells) if int(x.get("numFmtId", 0)) in _DATES | own}


def sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Names and parts of a workbook's sheets, in order."""
    targets = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    out = []
    for e in root.iter():
        if _local(e.tag) == "sheet":
            target = targets[next(v for k, v in e.attrib.items() if _local(k) == "id")]
            out.append((e.get("name"), target.lstrip("/") if target.startswith("/") else normpath(join("xl", target))))
    return out


def _place(ref: str) -> tuple[int, int]:
    letters, digits = re.fullmatch(r"([A-Z]+)(\d+)", ref).groups()
    column = 0
    for x in letters:
        column = 26 * column + ord(x) - 64
    return int(digits) - 1, column - 1


def _spelt(value: str, kind: str, style: int, shared: list[str], dates: set[int]) -> str:
    if kind == "s":
        return shared[int(value)]
    if kind in ("", "n") and style in dates:
        return (_ORIGIN + dt.timedelta(days=float(value))).strftime("%Y-%m-%d")
    return value


def cells(book: zipfile.ZipFile, part: str, shared: list[str], dates: set[int]) -> Iterator[tuple[int, int, str]]:
    """``(r, c, value)`` of a sheet's cells with a value; dates as ``YYYY-MM-DD``."""
    r = c = -1
    with book.open(part) as f:
        for event, e in ElementTree.iterparse(f, ("start", "end")):
            tag = _local(e.tag)
            if event == "start":
                if tag == "row":
                    r, c = int(e.get("r", r + 2)) - 1, -1
                continue
            if tag == "c":
                r, c = _place(e.get("r")) if e.get("r") else (r, c + 1)
                kind = e.get("t", "")
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in e.iter() if _local(t.tag) == "t")
                else:
                    raw = next((x.text for x in e if _local(x.tag) == "v"), None)
                    value = None if raw is None else _spelt(raw, kind, int(e.get("s", 0)), shared, dates)
                if value not in (None, "") and kind not in ("b", "e"):
                    yield r, c, value
            elif tag == "row":
                e.clear()


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
    names = [c.split()[0] for c in CELLS.split(", ")]

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            data = content.as_py() or b""
            own, rows = (path.rpartition("/")[2], hashlib.sha256(data).hexdigest()), []
            try:
                with zipfile.ZipFile(io.BytesIO(data)) as book:
                    shared, dates = _shared(book), _date_styles(book)
                    for index, (name, part) in enumerate(sheets(book)):
                        try:
                            found = list(cells(book, part, shared, dates))
                        except (KeyError, ValueError, IndexError, AttributeError, OverflowError, ElementTree.ParseError, zipfile.BadZipFile) as why:
                            rows.append((*own, index, name, None, None, None, f"{type(why).__name__}: {why}"))
                            continue
                        rows += [(*own, index, name, *x, None) for x in found] or [(*own, index, name, None, None, None, None)]
                        if len(rows) >= _ROWS:
                            yield sent(rows)
                            rows = []
            except (KeyError, ValueError, IndexError, StopIteration, ElementTree.ParseError, zipfile.BadZipFile) as why:
                rows.append((*own, None, None, None, None, None, f"{type(why).__name__}: {why}"))
            if rows:
                yield sent(rows)


def workbook_cells(spark: SparkSession, path: str) -> DataFrame:
    """Long cells of all workbooks under ``path``, as ``CELLS``.

    A sheet without cells gives one row without a place, a file or sheet that can't be read one row with ``error``; truth values and
    errors in cells are no values.  Of files with the same content each is read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xls*").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").repartition("path").mapInArrow(_opened, CELLS)


def sheet_names(cells: DataFrame) -> DataFrame:
    """``(file, digest, index, name)`` of each sheet that could be opened."""
    return cells.where("index is not null").select("file", "digest", "index", "name").distinct()


def once(cells: DataFrame) -> DataFrame:
    """Without files whose content another file has that comes first by name."""
    files = cells.select("file", "digest").distinct()
    first = files.groupBy("digest").agg(F.min("file").alias("file"))
    return cells.join(first, ["digest", "file"], "left_semi")


def as_sheets(cells: DataFrame) -> DataFrame:
    """Cells as the sheet readers take them: a sheet is a file's digest and the sheet's index."""
    return cells.where("index is not null and error is null").select(F.concat_ws("/", "digest", F.col("index").cast("string")).alias("sheet"), "name", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("c", F.lit(0)).alias("c"), "value")


def file_rejects(cells: DataFrame) -> DataFrame:
    """``(file, digest, name, reason)`` of files and sheets that can't be read."""
    return cells.where("error is not null").select("file", "digest", "name", F.col("error").alias("reason"))
