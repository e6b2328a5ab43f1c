"""Workbooks: the first sheet of xlsx files as a table."""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator
from typing import BinaryIO
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the file format: namespaces, built-in number formats of dates and times, the first day, rows below a head.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_EPOCH = datetime.datetime(1899, 12, 30)
SHEET_ROWS = 1_048_575
# Fixed values of the file format: characters that XML can't hold stand as _xHHHH_, and so does what looks like that.
_LIKE_ESCAPE = re.compile(r"_(?=x[0-9A-Fa-f]{4}_)")
_NOT_IN_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\r￾￿]")
_ESCAPE = re.compile(r"_x([0-9A-Fa-f]{4})_")


def escaped(text: str) -> str:
    return _NOT_IN_XML.sub(lambda m: f"_x{ord(m[0]):04X}_", _LIKE_ESCAPE.sub("_x005F_", text))


def unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1], 16)), text)


def _column(reference: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def _text(node) -> str:
    return unescaped("".join(t.text or "" for t in node.iter(f"{MAIN}t")))


class Book:
    """A workbook's first sheet; shared texts and styles are read when a cell first needs them."""

    def __init__(self, file: BinaryIO) -> None:
        self.book = zipfile.ZipFile(file)
        self.parts = set(self.book.namelist())
        first = ElementTree.fromstring(self.book.read("xl/workbook.xml")).find(f"{MAIN}sheets")[0].get(_REL)
        target = next(x.get("Target") for x in ElementTree.fromstring(self.book.read("xl/_rels/workbook.xml.rels")) if x.get("Id") == first)
        self.path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        self._shared: list[str] | None = None
        self._dates: set[int] | None = None

    def sheet(self) -> BinaryIO:
        return self.book.open(self.path)

    def said_rows(self) -> int:
        """Rows below the head, as the beginning of the sheet says; 0 if it doesn't."""
        with self.sheet() as sheet:
            found = re.search(rb'<(?:\w+:)?dimension[^>]*ref="[A-Z]+\d+:[A-Z]+(\d+)"', sheet.read(4096))
        return int(found[1]) - 1 if found else 0

    @property
    def shared(self) -> list[str]:
        if self._shared is None:
            name = "xl/sharedStrings.xml"
            self._shared = [_text(x) for x in ElementTree.fromstring(self.book.read(name))] if name in self.parts else []
        return self._shared

    @property
    def dates(self) -> set[int]:
        """The styles of cells that show dates or times."""
        if self._dates is None:
            self._dates = set()
            if "xl/styles.xml" in self.parts:
                styles = ElementTree.fromstring(self.book.read("xl/styles.xml"))
                own = {int(x.get("numFmtId")): x.get("formatCode", "") for x in styles.iter(f"{MAIN}numFmt")}
                cells = styles.find(f"{MAIN}cellXfs")
                for i, x in enumerate(cells if cells is not None else []):
                    k = int(x.get("numFmtId", 0))
                    if k in _DATE_FORMATS or re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(k, "")), re.I):
                        self._dates.add(i)
        return self._dates

    def cells(self, row: ElementTree.Element, wanted: set[int] | None = None) -> list:
        """Text, float, bool, datetime or None by cell; None, too, for cells outside the wanted columns."""
        out: list = []
        for i, cell in enumerate(row):
            at = _column(cell.get("r")) if cell.get("r") else i
            out += [None] * (at + 1 - len(out))
            if wanted is not None and at not in wanted:
                continue
            kind, value = cell.get("t"), cell.find(f"{MAIN}v")
            if kind == "inlineStr":
                out[at] = _text(cell)
            elif value is None or value.text is None:
                continue
            elif kind == "s":
                out[at] = self.shared[int(value.text)]
            elif kind == "b":
                out[at] = value.text == "1"
            elif kind in ("str", "e", "d"):
                out[at] = unescaped(value.text) if kind != "e" else None
            else:
                number = float(value.text)
                out[at] = _EPOCH + datetime.timedelta(days=number) if int(cell.get("s", 0)) in self.dates else number
        return out


def sheet_rows(data: bytes) -> Iterator[list]:
    """Rows of the first sheet: text, float, bool, datetime or None by cell."""
    book = Book(io.BytesIO(data))
    with book.sheet() as sheet:
        for _, row in ElementTree.iterparse(sheet):
            if row.tag == f"{MAIN}row":
                yield book.cells(row)
                row.clear()


def cell_text(x) -> str | None:
    if x is None or x == "":
        return None
    if isinstance(x, float):
        return str(int(x)) if x.is_integer() and abs(x) < 1e15 else repr(x)
    return x.isoformat(" ") if isinstance(x, datetime.datetime) else str(x)


def column_names(head: list) -> list[str]:
    names: list[str] = []
    for i, n in enumerate(head):
        base = cell_text(n) or f"Unnamed: {i}"
        k = 0
        while (name := f"{base}.{k}" if k else base) in names:
            k += 1
        names.append(name)
    return names


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The first sheets of workbooks (a path or glob) as text columns; the first row names them. A workbook is one task's work.

    Files are read by Spark's own reader, so any store that it knows will do (workbooks.py deals a workbook's rows to
    several tasks, but reads stores that pyarrow knows only). Cells go to columns by the names of their own workbook.
    Columns are those of the first file, then the others' by name; a file without one has nulls there. Repeated names get
    .1, .2 and so on.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def heads(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "names": [column_names(next(sheet_rows(x), [])) for x in pdf["content"]]})

    found = [r["names"] for r in files.mapInPandas(heads, "path string, names array<string>").groupBy("names").agg(F.min("path").alias("path")).orderBy("path").collect()]
    names = list(found[0]) if found else []
    names += sorted({n for other in found for n in other} - set(names))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def rows(batches):
        import pandas as pd

        for pdf in batches:
            for content in pdf["content"]:
                body = sheet_rows(content)
                own = column_names(next(body, []))
                at = {n: i for i, n in enumerate(own)}
                rows = [[cell_text(r[at[n]]) if n in at and at[n] < len(r) else None for n in names] for r in body if any(x is not None for x in r)]
                yield pd.DataFrame(rows, columns=names, dtype=object)

    return files.select("content").mapInPandas(rows, schema)


def package(book: zipfile.ZipFile) -> None:
    """All parts of a workbook of one sheet but the sheet."""
    ns = MAIN[1:-1]
    book.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
    book.writestr("_rels/.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
    book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
    book.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')


def text_cell(text: str) -> str:
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(escaped(text))}</t></is></c>'


def _letters(column: int) -> str:
    out, n = "", column + 1
    while n:
        n, k = divmod(n - 1, 26)
        out = chr(65 + k) + out
    return out


def sheet_start(names: list[str], rows: int | None) -> bytes:
    """The sheet up to its first row below the head; rows, if known, are said in front."""
    said = "" if rows is None else f'<dimension ref="A1:{_letters(max(0, len(names) - 1))}{rows + 1}"/>'
    return f'<worksheet xmlns="{MAIN[1:-1]}">{said}<sheetData><row>{"".join(map(text_cell, names))}</row>'.encode()


def sheet_end() -> bytes:
    return b"</sheetData></worksheet>"


def write_sheet(df: DataFrame, names: list[str] | None = None) -> bytes:
    """A small workbook as bytes, through the driver: at most SHEET_ROWS rows, which is checked. df.write.format("workbook") of workbooks.py writes without it."""
    names = names or df.columns
    rows = df.select(*(F.col(f"`{n}`").cast("string") for n in names)).limit(SHEET_ROWS + 1).collect()
    if len(rows) > SHEET_ROWS:
        raise ValueError(f"a sheet holds {SHEET_ROWS:,} rows below its head")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        package(book)
        lines = "".join(f"<row>{''.join('<c/>' if v is None else text_cell(v) for v in r)}</row>" for r in rows)
        book.writestr("xl/worksheets/sheet1.xml", sheet_start(names, len(rows)) + lines.encode() + sheet_end())
    return out.getvalue()
