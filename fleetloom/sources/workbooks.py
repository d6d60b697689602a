"""Workbook (xlsx) cells of the first sheet.

A sheet ends at 1,048,576 rows, so a workbook is a bounded piece of work; the
directory is spread over tasks by Spark.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions.columns import quoted
from fleetloom.sources.csv_files import _ROWS_PER_BATCH, RAW_CELLS, RowBuffer
from fleetloom.sources.day_tables import valid_name_glob

# --- fixed values of the format ----------------------------------------------
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_DAY_ZERO = datetime(1899, 12, 30)
_DAY_ZERO_1904 = datetime(1904, 1, 1)
# -----------------------------------------------------------------------------


def _xml(book: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _text(node) -> str:
    """The text of a cell or string; phonetic hints beside it are no part of it."""
    runs = [t for part in node if part.tag != _MAIN + "rPh" for t in part.iter(_MAIN + "t")]
    return "".join(t.text or "" for t in runs)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    """The workbook's texts by number, read one after the other."""
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, item in ElementTree.iterparse(part):
            if item.tag == _MAIN + "si":
                strings.append(_text(item))
                item.clear()
    return strings


def _day_zero(book: zipfile.ZipFile) -> datetime:
    """The day that dates are counted from: some workbooks count from 1904."""
    properties = _xml(book, "xl/workbook.xml").find(_MAIN + "workbookPr")
    from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    return _DAY_ZERO_1904 if from_1904 else _DAY_ZERO


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date."""
    styles = _xml(book, "xl/styles.xml")
    if styles is None:
        return set()
    own = {
        int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", ""))
        for f in styles.iter(_MAIN + "numFmt")
    }
    dated = _DATE_FORMATS | {n for n, code in own.items() if re.search(r"[ymdhs]", code, re.I)}
    cells = styles.find(_MAIN + "cellXfs")
    return {i for i, xf in enumerate(cells if cells is not None else []) if int(xf.get("numFmtId", 0)) in dated}


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = _xml(book, "xl/workbook.xml").find(f"{_MAIN}sheets/{_MAIN}sheet")
    for link in _xml(book, "xl/_rels/workbook.xml.rels"):
        if link.get("Id") == sheet.get(_RELATION):
            target = link.get("Target")
            return target.lstrip("/") if target.startswith("/") else "xl/" + target
    raise KeyError("the first sheet is not in the workbook")


def _column_place(reference: str) -> int:
    place = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        place = place * 26 + ord(letter) - ord("A") + 1
    return place - 1


def _cell_text(cell, strings: list[str], dated: set[int], day_zero: datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = cell.find(_MAIN + "is")
        return None if inline is None else _text(inline)
    value = cell.findtext(_MAIN + "v")
    if value is None:
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "n" and int(cell.get("s", 0)) in dated:
        return str((day_zero + timedelta(days=float(value))).replace(microsecond=0))
    return value


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet, one after the other; rows and cells the file leaves out are filled in."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, dated, day_zero = _shared_strings(book), _date_styles(book), _day_zero(book)
        done = 0
        with book.open(_first_sheet(book)) as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != _MAIN + "row":
                    continue
                for _ in range(done, int(row.get("r", done + 1)) - 1):
                    yield []
                    done += 1
                cells: list[str | None] = []
                for cell in row.iter(_MAIN + "c"):
                    place = _column_place(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (place - len(cells)))
                    cells.append(_cell_text(cell, strings, dated, day_zero))
                yield cells
                done += 1
                row.clear()


def _sheet_batches(path: str, content: bytes) -> list[pa.RecordBatch]:
    """A sheet's rows as Arrow batches; none is handed on before the sheet has ended well."""
    buffer, made, first = [], [], 0

    def batch() -> pa.RecordBatch:
        numbers = pa.array(range(first, first + len(buffer)), pa.int64())
        columns = [pa.array([path] * len(buffer), pa.string()), numbers, pa.array(buffer, pa.list_(pa.string())), pa.nulls(len(buffer), pa.string())]
        return pa.RecordBatch.from_arrays(columns, RAW_CELLS.names)

    for row in sheet_rows(content):
        buffer.append(row)
        if len(buffer) == _ROWS_PER_BATCH:
            made.append(batch())
            first, buffer = first + len(buffer), []
    return [*made, batch()] if buffer else made


def _parse_workbooks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            error = None
            try:
                made = _sheet_batches(path, content.as_py())
                yield from made
                if made:
                    continue
            except (zipfile.BadZipFile, ElementTree.ParseError, LookupError, ValueError, AttributeError, OverflowError) as problem:
                error = f"{type(problem).__name__}: {problem}"
            yield from _noted_file(path, error)


def _noted_file(path: str, error: str | None) -> Iterator[pa.RecordBatch]:
    buffer = RowBuffer()
    yield from buffer.add(path, [], error)
    yield from buffer.rest()


def read_workbooks(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Cells of the first sheet of every workbook; row 0 holds the column names."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", valid_name_glob("xlsx"))
        .option("recursiveFileLookup", recursive)
        .load(path)
    )
    return files.select("path", "content").mapInArrow(_parse_workbooks, RAW_CELLS)


def headers_of(cells: DataFrame) -> DataFrame:
    """Column names per file, for ``check_headers``.

    A file is as wide as its widest row; names that are left blank, or that the header
    row does not reach, are empty texts.
    """
    per_file = cells.where("row_no >= 0").groupBy("src_file").agg(
        F.max(F.size("cells")).alias("_width"), F.max(F.when(F.col("row_no") == 0, F.col("cells"))).alias("_header")
    )
    missing = F.array_repeat(F.lit(None).cast("string"), F.greatest(F.col("_width") - F.size("_header"), F.lit(0)))
    whole = F.concat("_header", missing)
    return per_file.select("src_file", F.transform(whole, lambda c: F.coalesce(c, F.lit(""))).alias("columns"))


def column_names(header: list[str | None]) -> list[str]:
    """Names that tell all columns of a header apart: blank ones by their place, repeated ones by a number."""
    names: list[str] = []
    for place, name in enumerate(header):
        plain = name if name and name.strip() else f"Unnamed: {place}"
        taken, repeat = plain, 0
        while taken in names:
            repeat += 1
            taken = f"{plain}.{repeat}"
        names.append(taken)
    return names


def table_of_cells(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Rows below the header as text columns; ``row_no`` counts from 0."""
    return cells.where("row_no > 0").select(
        "src_file",
        (F.col("row_no") - 1).alias("row_no"),
        *[F.get(quoted("cells"), i).alias(c) for i, c in enumerate(columns)],
    )


# Executors need not have this package installed: the parsers travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
