"""Workbooks as a data source: spark.read.format("workbook") and df.write.format("workbook")."""

from __future__ import annotations

import fnmatch
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

from .xlsx import MAIN, SHEET_ROWS, Book, cell_text, column_names, package, sheet_end, sheet_start, text_cell

NAME = "workbook"
#: Rows that one task reads, rows of a batch, bytes of a sheet that are unpacked at once.
TASK_ROWS, BATCH_ROWS, CHUNK = 50_000, 2_000, 1 << 20
_ROW = re.compile(rb"<(?:\w+:)?row[\s>/]")
_LOCAL = re.compile(r"\{.*\}")


def register(spark: SparkSession) -> None:
    """Makes the source known to a session."""
    spark.dataSource.register(Workbooks)


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _files(uri: str) -> tuple[pafs.FileSystem, list[str]]:
    """A file, the workbooks of a folder, or those whose names match a pattern in the last part of the path."""
    folder, _, last = uri.rstrip("/").rpartition("/")
    if any(c in last for c in "*?["):
        store, path = _store(folder)
        found = [i.path for i in store.get_file_info(pafs.FileSelector(path)) if fnmatch.fnmatchcase(i.base_name, last)]
        return store, sorted(found)
    store, path = _store(uri)
    if store.get_file_info(path).type == pafs.FileType.Directory:
        return store, sorted(i.path for i in store.get_file_info(pafs.FileSelector(path)) if i.base_name.endswith(".xlsx") and i.base_name[0] not in "_~.")
    return store, [path]


def _row_elements(book: Book, first: int, end: int | None) -> Iterator[ElementTree.Element]:
    """The rows from the first-th on (0 is the head). Those before are unpacked and counted by their tags, not parsed."""
    with book.sheet() as sheet:
        data, skipped, head = b"", 0, b""
        while first:
            chunk = sheet.read(CHUNK)
            data += chunk
            starts = [m.start() for m in _ROW.finditer(data)]
            if not head and starts:
                head = data[: starts[0]]
            if b"<!" in data:  # comments and unparsed sections may hold what looks like tags
                yield from _parsed_rows(book, first, end)
                return
            if skipped + len(starts) > first:
                data = head + data[starts[first - skipped] :]
                break
            if not chunk:
                return
            skipped += len(starts)
            keep = max(data.rfind(b"<"), 0) if data.rfind(b">") < data.rfind(b"<") else len(data)
            if starts and keep <= starts[-1]:  # the tag is cut: it is looked at again
                keep, skipped = starts[-1], skipped - 1
            data = (data[keep:] if head else data)
        parser = ElementTree.XMLPullParser(["end"])
        n = first
        chunk = data or sheet.read(CHUNK)
        while chunk:
            parser.feed(chunk)
            for _, element in parser.read_events():
                if _LOCAL.sub("", element.tag) == "row":
                    if end is not None and n >= end:
                        return
                    yield element
                    element.clear()
                    n += 1
            chunk = sheet.read(CHUNK)


def _parsed_rows(book: Book, first: int, end: int | None) -> Iterator[ElementTree.Element]:
    with book.sheet() as sheet:
        n = 0
        for _, element in ElementTree.iterparse(sheet):
            if element.tag == f"{MAIN}row":
                if n >= first and (end is None or n < end):
                    yield element
                element.clear()
                n += 1


class WorkbookReader(ds.DataSourceReader):
    """Partitions are a file's rows, TASK_ROWS at a time. Only cells of columns that the schema names are read.

    Filters are not taken over from Spark: what one query gives a Python source stays with the DataFrame, and the next
    query over it would miss rows (seen with Spark 4.1.2).
    """

    def __init__(self, uri: str, names: list[str], task_rows: int) -> None:
        self.uri, self.names, self.task_rows = uri, names, task_rows

    def partitions(self) -> list[ds.InputPartition]:
        store, files = _files(self.uri)
        out = []
        for path in files:
            with store.open_input_file(path) as file:
                rows = Book(file).said_rows()
            edges = [1, *range(1 + self.task_rows, max(2, rows - self.task_rows // 2), self.task_rows), None]
            out += [ds.InputPartition((path, a, b)) for a, b in zip(edges, edges[1:], strict=False)]
        return out or [ds.InputPartition(None)]

    def read(self, partition: ds.InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        path, first, end = partition.value
        store, _ = _store(self.uri.rstrip("/").rpartition("/")[0] or self.uri)
        with store.open_input_file(path) as file:
            book = Book(file)
            head = next(_row_elements(book, 0, 1), None)
            own = {n: i for i, n in enumerate(column_names(book.cells(head)))} if head is not None else {}
            wanted = {own[n] for n in self.names if n in own}
            held: list[list[str | None]] = []
            for element in _row_elements(book, first, end) if head is not None else ():
                if not len(element) or not any(c.find(f"{MAIN}v") is not None or c.get("t") == "inlineStr" for c in element):
                    continue
                cells = book.cells(element, wanted)
                texts = {n: cell_text(cells[i]) if i < len(cells) else None for n, i in own.items() if i in wanted}
                held.append([texts.get(n) for n in self.names])
                if len(held) >= BATCH_ROWS:
                    yield self._batch(held)
                    held = []
            if held:
                yield self._batch(held)

    def _batch(self, rows: list[list[str | None]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(len(self.names))], self.names)


@dataclass
class Written(ds.WriterCommitMessage):
    partition: int
    #: Path and rows of each file that the task wrote, in order.
    files: list[tuple[str, int]]


class WorkbookWriter(ds.DataSourceArrowWriter):
    """Without "each", one workbook: every task writes its rows as a packed part of the sheet beside it, commit() streams
    the parts into the workbook and gives it its name. each=task: a folder of workbooks, of SHEET_ROWS rows at most each.
    What commit() does not take is deleted, by it or by abort()."""

    def __init__(self, uri: str, schema: T.StructType, overwrite: bool, each: str) -> None:
        self.uri, self.names, self.folder = uri.rstrip("/"), schema.names, each == "task"
        self.parts = f"_parts_{uuid.uuid4().hex}"
        store, path = _store(self.uri)
        if not overwrite and (_files(self.uri)[1] if self.folder and self._is(store, path, pafs.FileType.Directory) else self._is(store, path, pafs.FileType.File)):
            raise ValueError(f"{uri} is there already")
        store.create_dir(self._places()[2])  # here and not by tasks: one that still runs when the job has failed finds no folder

    def _is(self, store: pafs.FileSystem, path: str, kind: pafs.FileType) -> bool:
        return store.get_file_info(path).type == kind

    def _places(self) -> tuple[pafs.FileSystem, str, str]:
        store, path = _store(self.uri)
        return store, path, f"{path if self.folder else path.rpartition('/')[0]}/{self.parts}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, _, parts = self._places()
        number, files = TaskContext.get().partitionId(), []
        out: _Part | None = None
        for batch in iterator:
            at = 0
            while at < batch.num_rows:
                if out is None:
                    path = f"{parts}/{number:05}-{len(files):03}-{uuid.uuid4().hex}"
                    out = (_BookPart if self.folder else _Part)(store, path, self.names)
                n = min(batch.num_rows - at, SHEET_ROWS - out.rows if self.folder else batch.num_rows)
                out.add(batch.slice(at, n))
                at += n
                if self.folder and out.rows == SHEET_ROWS:
                    files.append((out.close(), out.rows))
                    out = None
        if out is not None:
            files.append((out.close(), out.rows))
        return Written(number, files)

    def commit(self, messages: list[Written | None]) -> None:
        store, path, parts = self._places()
        try:
            files = [f for m in sorted((m for m in messages if m), key=lambda m: m.partition) for f in m.files]
            if self.folder:
                old = _files(self.uri)[1]
                for i, (part, _) in enumerate(files):
                    store.move(part, f"{path}/part-{i:05}.xlsx")
                for p in set(old) - {f"{path}/part-{i:05}.xlsx" for i in range(len(files))}:
                    store.delete_file(p)
                return
            if (rows := sum(n for _, n in files)) > SHEET_ROWS:
                raise ValueError(f"{rows} rows: a sheet holds {SHEET_ROWS} below its head; each=task writes as many workbooks as are needed")
            made = f"{parts}/book"
            with store.open_output_stream(made) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
                package(book)
                with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as sheet:
                    sheet.write(sheet_start(self.names, rows))
                    for part, _ in files:
                        unpack = zlib.decompressobj()
                        with store.open_input_stream(part) as packed:
                            while chunk := packed.read(CHUNK):
                                sheet.write(unpack.decompress(chunk))
                    sheet.write(sheet_end())
            store.move(made, path)
        finally:
            self._drop()

    def abort(self, messages: list[Written | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        store, _, parts = self._places()
        if self._is(store, parts, pafs.FileType.Directory):
            store.delete_dir(parts)


class _Part:
    """Rows as packed XML."""

    def __init__(self, store: pafs.FileSystem, path: str, names: list[str]) -> None:
        self.path, self.rows, self.names = path, 0, names
        self.out = store.open_output_stream(path)
        self.pack = zlib.compressobj(6)

    def put(self, data: bytes) -> None:
        self.out.write(self.pack.compress(data))

    def add(self, batch: pa.RecordBatch) -> None:
        columns = [_cells(c) for c in batch.columns]
        self.put("".join(f"<row>{''.join(r)}</row>" for r in zip(*columns, strict=True)).encode())
        self.rows += batch.num_rows

    def close(self) -> str:
        self.out.write(self.pack.flush())
        self.out.close()
        return self.path


class _BookPart(_Part):
    """A whole workbook; how many rows it has is not known at its start, so it doesn't say."""

    def __init__(self, store: pafs.FileSystem, path: str, names: list[str]) -> None:
        self.path, self.rows, self.names = path, 0, names
        self.out = store.open_output_stream(path)
        self.book = zipfile.ZipFile(self.out, "w", zipfile.ZIP_DEFLATED)
        package(self.book)
        self.sheet = self.book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.put(sheet_start(names, None))

    def put(self, data: bytes) -> None:
        self.sheet.write(data)

    def close(self) -> str:
        self.put(sheet_end())
        self.sheet.close()
        self.book.close()
        self.out.close()
        return self.path


def _cells(column: pa.Array) -> list[str]:
    """Cells of a column: numbers and booleans as such, all else as text, nulls empty."""
    kind = column.type
    if pa.types.is_boolean(kind):
        return ["<c/>" if v is None else f'<c t="b"><v>{int(v)}</v></c>' for v in column.to_pylist()]
    if pa.types.is_integer(kind) or pa.types.is_floating(kind):
        return ["<c/>" if v is None else f"<c><v>{v!r}</v></c>" if v == v and abs(v) != float("inf") else text_cell(str(v)) for v in column.to_pylist()]
    return ["<c/>" if v is None else text_cell(v if isinstance(v, str) else str(v)) for v in column.to_pylist()]


class Workbooks(ds.DataSource):
    """Options: rows (that one task reads), each (task: a folder of workbooks, one or more a task).

    Reading gives the first sheets as text columns. The first row names them, repeated names get .1, .2 and so on; of
    several files, columns are those of the first and then the others' by name, and a file has nulls where it lacks one.
    A schema given to the reader names the only columns that are read. Blank rows are left out.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        store, files = _files(self.options["path"])
        names: list[str] = []
        for path in files:
            with store.open_input_file(path) as file:
                book = Book(file)
                head = next(_row_elements(book, 0, 1), None)
                own = column_names(book.cells(head)) if head is not None else []
            names = own if not names else names + sorted(set(own) - set(names))
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    def reader(self, schema: T.StructType) -> WorkbookReader:
        if other := [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]:
            raise ValueError(f"cells are read as text: {other}")
        return WorkbookReader(self.options["path"], schema.names, int(self.options.get("rows", TASK_ROWS)))

    def writer(self, schema: T.StructType, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(self.options["path"], schema, overwrite, self.options.get("each", "book"))
