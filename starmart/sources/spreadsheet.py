"""Excel workbooks (.xlsx) as a table with a declared schema."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from decimal import Decimal
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Excel counts days from the first of these dates, or from the second if the workbook says so.
_DAY_ZERO = datetime(1899, 12, 30)
_DAY_ZERO_1904 = datetime(1904, 1, 1)
_BATCH_ROWS = 10_000


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rsplit("}", 1)[-1]


# How the file format writes characters that XML cannot hold.
_CODE = re.compile("_x([0-9A-Fa-f]{4})_")


def _text_of(element: ElementTree.Element) -> str:
    text = "".join(t.text or "" for t in element.iter() if _tag(t) == "t")
    return _CODE.sub(lambda m: chr(int(m.group(1), 16)), text)


def _column_number(ref: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", ref).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return [_text_of(item) for item in root if _tag(item) == "si"]


def _first_sheet(book: zipfile.ZipFile) -> str:
    """Path of the sheet the workbook lists first."""
    workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheet = next(e for e in workbook.iter() if _tag(e) == "sheet")
    wanted = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(e.attrib["Target"] for e in links if e.attrib["Id"] == wanted)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def day_zero(content: bytes) -> datetime:
    """The date that a workbook counts its days from."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
    marks = [e.attrib.get("date1904", "0") for e in workbook if _tag(e) == "workbookPr"]
    return _DAY_ZERO_1904 if marks[:1] in (["1"], ["true"]) else _DAY_ZERO


def _cell_value(cell: ElementTree.Element, strings: list[str]):
    kind = cell.attrib.get("t", "n")
    if kind == "inlineStr":
        return _text_of(cell)
    value = next((e.text for e in cell if _tag(e) == "v"), None)
    if value is None:
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return value == "1"
    if kind == "n":
        return float(value)
    return None if kind == "e" else value


def sheet_rows(content: bytes) -> Iterator[list]:
    """The rows of the first sheet, read as a stream; an absent cell is None."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = _shared_strings(book)
        with book.open(_first_sheet(book)) as sheet:
            table = None
            for event, element in ElementTree.iterparse(sheet, ("start", "end")):
                if _tag(element) == "sheetData":
                    table = element
                if event == "start" or _tag(element) != "row":
                    continue
                row: list = []
                for position, cell in enumerate(c for c in element if _tag(c) == "c"):
                    at = _column_number(cell.attrib["r"]) if "r" in cell.attrib else position
                    row.extend([None] * (at + 1 - len(row)))
                    row[at] = _cell_value(cell, strings)
                # Rows already read are not kept.
                table.clear()
                yield row


_TIMES = (T.TimestampNTZType, T.TimestampType)
_KINDS = (*_TIMES, T.DateType, T.StringType, T.IntegralType, T.DecimalType, T.BooleanType)
_READABLE = (*_KINDS, T.FloatType, T.DoubleType)


def _time(value, zero: datetime) -> datetime:
    if isinstance(value, float):
        # Whole milliseconds: a day fraction has no finer meaning in Excel.
        return zero + timedelta(milliseconds=round(value * 86_400_000))
    return datetime.fromisoformat(value)


def _truth(value) -> bool:
    if isinstance(value, str):
        return {"true": True, "1": True, "false": False, "0": False}[value.strip().lower()]
    return value != 0


def _converted(value, kind: T.DataType, zero: datetime = _DAY_ZERO):
    if value is None or (value == "" and not isinstance(kind, T.StringType)):
        return None
    if isinstance(kind, _TIMES):
        return _time(value, zero)
    if isinstance(kind, T.DateType):
        return _time(value, zero).date()
    if isinstance(kind, T.StringType):
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, float):
            return str(int(value)) if value.is_integer() else str(value)
        return value if value != "" else None
    if isinstance(kind, T.BooleanType):
        return _truth(value)
    if isinstance(kind, T.DecimalType):
        # The shortest decimal that reads as the stored number, not its binary digits.
        return Decimal(str(value)).quantize(Decimal(1).scaleb(-kind.scale))
    if isinstance(kind, T.IntegralType):
        return int(float(value)) if isinstance(value, str) else int(value)
    return float(value)


def parse_workbooks(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of all workbooks in ``files`` (columns ``path``, ``content``) plus ``source_file``.

    The first sheet's first row names the columns; those of ``schema`` are taken by name. One
    workbook is read by one task and leaves it in batches. A task gets files of at most
    ``spark.sql.files.maxPartitionBytes`` from a file scan, or one larger file.
    """
    fields = [(f.name, f.dataType) for f in schema.fields]
    unread = [f"{n} {k.simpleString()}" for n, k in fields if not isinstance(k, _READABLE)]
    if unread:
        raise TypeError(f"no cell can be read as {', '.join(unread)}")
    out = T.StructType([*schema.fields, T.StructField("source_file", T.StringType())])

    def frame(rows: list[tuple], path: str) -> pd.DataFrame:
        table = pd.DataFrame(rows, columns=[n for n, _ in fields], dtype=object)
        for name, kind in fields:
            if isinstance(kind, _TIMES):
                table[name] = pd.to_datetime(table[name])
        table["source_file"] = path
        return table

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files_batch in batches:
            for path, content in zip(files_batch["path"], files_batch["content"]):
                rows, zero = sheet_rows(content), day_zero(content)
                header = next(rows, [])
                at = {str(name): i for i, name in enumerate(header) if name is not None}
                lacking = [n for n, _ in fields if n not in at]
                if lacking:
                    raise ValueError(f"{path}: no column {lacking}")
                done: list[tuple] = []
                for row in rows:
                    if all(v is None for v in row):
                        continue
                    done.append(
                        tuple(
                            _converted(row[at[n]] if at[n] < len(row) else None, kind, zero)
                            for n, kind in fields
                        )
                    )
                    if len(done) == _BATCH_ROWS:
                        yield frame(done, path)
                        done = []
                if done:
                    yield frame(done, path)

    return files.select("path", "content").mapInPandas(read, out)


def read_spreadsheets(
    spark: SparkSession, folder: str, schema: T.StructType, files: str = "all"
) -> DataFrame:
    """All ``*.xlsx`` below ``folder``; with ``files="last"`` only the last one by path."""
    books = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.xlsx")
        .load(folder)
    )
    if files == "last":
        last = books.agg(F.max("path")).first()[0]
        books = books.filter(F.col("path") == last)
    elif files != "all":
        raise ValueError(f"unknown files mode {files!r}")
    return parse_workbooks(books, schema)
