"""Rows written as Excel workbooks, by a data source of its own.

Reading stays with ``read_spreadsheets``: Spark's file scan lists folder trees on any file system
Spark knows, which a Python reader could not.
"""

from __future__ import annotations

import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "workbooks"
# A sheet has at most 1,048,576 rows, one of them for the names of the columns.
SHEET_ROWS = 1_048_575
BOOK_ROWS = 100_000

_DAY_ZERO = datetime(1899, 12, 30)
_NUMBERS = (T.IntegralType, T.DecimalType, T.FloatType, T.DoubleType)
_WRITABLE = (T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType, *_NUMBERS)

# Fixed parts of the file format.
_SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
_SHEET_END = "</sheetData></worksheet>"
_PARTS = {
    "[Content_Types].xml": (
        '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels"'
        ' ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType='
        '"application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType='
        '"application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>'
    ),
    "_rels/.rels": (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Target="xl/workbook.xml" Type='
        '"http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument"/>'
        "</Relationships>"
    ),
    "xl/workbook.xml": (
        '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        ' xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
        '<sheets><sheet name="Rows" sheetId="1" r:id="rId1"/></sheets></workbook>'
    ),
    "xl/_rels/workbook.xml.rels": (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Target="worksheets/sheet1.xml" Type='
        '"http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet"/>'
        "</Relationships>"
    ),
}
# Characters XML cannot hold, or would change, are written as _x000D_; text that looks like that
# has its first underscore written so.
_UNSAFE = re.compile("[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")


def _escaped(text: str) -> str:
    return escape(_UNSAFE.sub(lambda m: f"_x{ord(m.group()):04X}_", text))


def _cell(value) -> str:
    """A cell: times and dates as day numbers, None and NaN as an empty cell."""
    if value is None or value != value:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, date):
        at = value if isinstance(value, datetime) else datetime(*value.timetuple()[:3])
        return f"<c><v>{(at - _DAY_ZERO).total_seconds() / 86400!r}</v></c>"
    if isinstance(value, str):
        return f'<c t="inlineStr"><is><t xml:space="preserve">{_escaped(value)}</t></is></c>'
    return f"<c><v>{value}</v></c>"


class _Book:
    """A workbook under way: rows go straight into the compressed file."""

    def __init__(self, fs: pafs.FileSystem, path: str, names: list[str]):
        self.rows = 0
        self._out = fs.open_output_stream(path)
        self._zip = zipfile.ZipFile(self._out, "w", zipfile.ZIP_DEFLATED)
        for part, content in _PARTS.items():
            self._zip.writestr(part, content)
        self._sheet = self._zip.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self._sheet.write((_SHEET + self._row(names)).encode())

    @staticmethod
    def _row(values) -> str:
        return f"<row>{''.join(map(_cell, values))}</row>"

    def add(self, values) -> None:
        self._sheet.write(self._row(values).encode())
        self.rows += 1

    def close(self) -> None:
        self._sheet.write(_SHEET_END.encode())
        self._sheet.close()
        self._zip.close()
        self._out.close()


@dataclass
class _Written(WriterCommitMessage):
    """The workbooks of one task: (folder below the target, file name)."""

    books: list[tuple[str, str]]


class WorkbookWriter(DataSourceArrowWriter):
    """Tasks write below a hidden folder; the commit renames what the counted attempts wrote.

    So a task that ran twice leaves its workbooks once, and a failed job leaves none that a scan
    would read.
    """

    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        if overwrite:
            raise ValueError("workbooks are added to a folder; use mode append")
        self.target = options["path"].rstrip("/")
        self.names = schema.names
        self.at = self.names.index(options["folder"]) if "folder" in options else None
        self.most = int(options.get("rows", BOOK_ROWS))
        if not 0 < self.most <= SHEET_ROWS:
            raise ValueError(f"a workbook has 1 to {SHEET_ROWS} rows, not {self.most}")
        unread = [f.name for f in schema.fields if not isinstance(f.dataType, _WRITABLE)]
        if unread:
            raise TypeError(f"no cell can hold the columns {unread}")
        self.job = uuid.uuid4().hex

    def _open(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.target)

    def _draft(self, root: str) -> str:
        return f"{root}/_draft-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, root = self._open()
        draft = self._draft(root)
        fs.create_dir(draft, recursive=True)
        names = [n for i, n in enumerate(self.names) if i != self.at]
        books: list[tuple[str, str]] = []
        book, here = None, None
        for batch in iterator:
            columns = [c.to_pylist() for c in batch.columns]
            folders = columns.pop(self.at) if self.at is not None else [""] * batch.num_rows
            for folder, *row in zip(folders, *columns):
                if book is None or folder != here or book.rows == self.most:
                    if book is not None:
                        book.close()
                    here = folder
                    books.append((_below(folder), f"{uuid.uuid4().hex}.xlsx"))
                    book = _Book(fs, f"{draft}/{books[-1][1]}", names)
                book.add(row)
        if book is not None:
            book.close()
        return _Written(books)

    def commit(self, messages) -> None:
        fs, root = self._open()
        done = [book for message in messages if message for book in message.books]
        for folder in sorted({f for f, _ in done}):
            fs.create_dir(posixpath.join(root, folder), recursive=True)
        for folder, name in done:
            fs.move(f"{self._draft(root)}/{name}", posixpath.join(root, folder, name))
        self._drop_draft(fs, root)

    def abort(self, messages) -> None:
        self._drop_draft(*self._open())

    def _drop_draft(self, fs: pafs.FileSystem, root: str) -> None:
        if fs.get_file_info(self._draft(root)).type == pafs.FileType.Directory:
            fs.delete_dir(self._draft(root))


def _below(folder: str | None) -> str:
    """A folder name that cannot lead out of the target, or be skipped by file scans."""
    steps = (folder or "").strip("/").split("/")
    if any(s in (".", "..") or s.startswith(("_", ".")) for s in steps):
        raise ValueError(f"no folder for workbooks: {folder!r}")
    return "/".join(s for s in steps if s)


class WorkbookSink(DataSource):
    """``df.write.format("workbooks")``; see ``write_spreadsheets``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(dict(self.options), schema, overwrite)


def write_spreadsheets(
    rows: DataFrame, target: str, folder: str | None = None, book_rows: int = BOOK_ROWS
) -> None:
    """Add ``rows`` to the folder ``target`` as workbooks of at most ``book_rows`` rows each.

    The column ``folder`` names the folder below ``target`` that a row goes to (null: none), and is
    not written. Rows are gathered by folder first, and AQE cuts a large folder into several tasks;
    a task has one workbook open and holds one Arrow batch. ``target`` is a path that pyarrow opens
    on every executor (``file:``, ``hdfs:``, ``s3:`` …). No rows give no workbooks. An empty string is
    read back as null, NaN too; times are kept to the millisecond.
    """
    rows.sparkSession.dataSource.register(WorkbookSink)
    writer_options = {"rows": str(book_rows)}
    if folder is not None:
        rows = rows.hint("rebalance", folder).sortWithinPartitions(folder)
        writer_options["folder"] = folder
    rows.write.format(FORMAT).mode("append").options(**writer_options).save(target)
