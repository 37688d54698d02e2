"""Excel workbooks as a Spark source.

Spark lists the files and packs them into tasks by size; a task reads the first sheet
of each of its workbooks row by row. A sheet holds at most 1,048,576 rows by its file
format, so many customers means many workbooks, and those are read in parallel.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from datetime import date, datetime, time, timedelta
from io import BytesIO
from posixpath import join, normpath
from xml.etree import ElementTree
from zipfile import ZipFile

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.text import OnMissing, or_empty
from ledgerloom.tables import Table

# Send this module's functions to the tasks themselves, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 5000
DIGITS = "0123456789"

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
VALUE, INLINE, TEXT, RUN = (MAIN + tag for tag in ("v", "is", "t", "r"))
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

# Built-in number formats that are dates or passed times, and the two calendars.
DATE, ELAPSED = "date", "elapsed"
BUILT_IN = {
    "14": DATE,  # mm-dd-yy
    "15": DATE,  # d-mmm-yy
    "16": DATE,  # d-mmm
    "17": DATE,  # mmm-yy
    "18": DATE,  # h:mm AM/PM
    "19": DATE,  # h:mm:ss AM/PM
    "20": DATE,  # h:mm
    "21": DATE,  # h:mm:ss
    "22": DATE,  # m/d/yy h:mm
    "45": DATE,  # mm:ss
    "46": ELAPSED,  # [h]:mm:ss
    "47": DATE,  # mmss.0
}
EPOCH_1900, EPOCH_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
SECOND, MILLISECOND = timedelta(seconds=1), timedelta(milliseconds=1)

# Of a custom format: texts, escaped and padding characters; brackets; and what is left of it.
LITERAL = re.compile(r'"[^"]*"|\\.|_.|\*.')
BRACKETED = re.compile(r"\[[^\]]*\]")
ELAPSED_SIGNS = re.compile(r"\[(h+|m+|s+)\]", re.IGNORECASE)
DATE_SIGNS = re.compile(r"[dmyhs]", re.IGNORECASE)

# Cell texts that mean "no value".
NULL_TEXTS = frozenset(
    [
        "",
        "#N/A",
        "#N/A N/A",
        "#NA",
        "-1.#IND",
        "-1.#QNAN",
        "-NaN",
        "-nan",
        "1.#IND",
        "1.#QNAN",
        "<NA>",
        "N/A",
        "NA",
        "NULL",
        "NaN",
        "None",
        "n/a",
        "nan",
        "null",
    ]
)


def read_workbooks(
    spark: SparkSession, path: str, table: Table, on_missing: OnMissing = "raise"
) -> DataFrame:
    """The first sheet of the workbook at ``path``, or of every one in that folder, as text.

    Empty files, such as the folder marks of object stores, are passed over. The first
    row names the columns. They are matched by name, columns the table does not have are
    ignored, and a missing one fails the job. Numbers become text, whole ones without a
    decimal point. A number whose cell has a date format becomes a date and time
    (``2016-09-05 00:00:00``), a time of day (``14:30:00``) if it is less than a day, or a
    time that has passed (``1 day, 2:00:00``) if the format is of that kind.
    """
    schema = table.source_schema
    names = schema.names

    def sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                with ZipFile(BytesIO(content.as_py())) as book:
                    yield from table_batches(book, names)

    def read() -> DataFrame:
        files = spark.read.format("binaryFile").load(path).where("length > 0")
        return files.select("content").mapInArrow(sheets, schema)

    return or_empty(spark, schema, on_missing, read)


def table_batches(book: ZipFile, names: list[str]) -> Iterator[pa.RecordBatch]:
    rows = filled_rows(book)
    _, header = next(rows, (0, {}))
    position = {text: column for column, text in reversed(header.items())}
    absent = [name for name in names if name not in position]
    if absent:
        raise ValueError(f"workbook has no column {absent}; its header is {list(position)}")
    wanted = [position[name] for name in names]

    buffer: list[list[str | None]] = []
    for _, cells in rows:
        texts = [cells.get(column) for column in wanted]
        buffer.append([None if text in NULL_TEXTS else text for text in texts])
        if len(buffer) == ROWS_PER_BATCH:
            yield to_batch(buffer, names)
            buffer = []
    if buffer:
        yield to_batch(buffer, names)


def to_batch(rows: list[list[str | None]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)


def filled_rows(book: ZipFile) -> Iterator[tuple[int, dict[int, str | None]]]:
    """Rows up to the last one with content. Rows left out in between are empty rows."""
    expected = 1
    for number, cells in sheet_rows(book):
        if any(text != "" for text in cells.values()):
            for skipped in range(expected, number):
                yield skipped, {}
            yield number, cells
            expected = number + 1


def sheet_rows(book: ZipFile) -> Iterator[tuple[int, dict[int, str | None]]]:
    """(row number, {column number: text}) for each stored row of the first sheet."""
    shared = shared_texts(book)
    formats, epoch = date_formats(book), first_day(book)
    numbers: dict[str, int] = {}
    number = 0
    with book.open(first_sheet(book)) as stream:
        for element in finished(stream, MAIN + "row", MAIN + "sheetData"):
            number = int(element.get("r", number + 1))
            cells: dict[int, str | None] = {}
            column = 0
            for cell in element:
                letters = cell.get("r", "").rstrip(DIGITS)
                if letters not in numbers:
                    numbers[letters] = column_number(letters)
                column = numbers[letters] or column + 1
                cells[column] = cell_text(cell, shared, formats.get(cell.get("s")), epoch)
            yield number, cells


def finished(stream, tag: str, parent_tag: str) -> Iterator[ElementTree.Element]:
    """Each ``tag`` element once it is complete; the parent does not hold on to past ones."""
    parent = None
    for event, element in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start" and element.tag == parent_tag:
            parent = element
        elif event == "end" and element.tag == tag:
            yield element
            parent.clear()


def column_number(letters: str) -> int:
    """2 for ``B``."""
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number


def cell_text(
    cell: ElementTree.Element, shared: list[str], format: str | None = None, epoch: datetime = EPOCH_1900
) -> str | None:
    kind = cell.get("t", "n")
    value = None
    for part in cell:
        if part.tag == VALUE:
            value = part.text
        elif part.tag == INLINE and kind == "inlineStr":
            return plain_text(part)
    if value is None:
        return ""
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "e":
        return None
    if kind == "d":
        return iso_text(value)
    if kind != "n":
        return value
    return date_text(float(value), format, epoch) if format else number_text(value)


def iso_text(value: str) -> str | None:
    """A date cell that holds its date as text."""
    for read in (date.fromisoformat, time.fromisoformat, datetime.fromisoformat):
        try:
            return str(read(value.removesuffix("Z")))
        except ValueError:
            continue
    return None


def date_text(number: float, format: str, epoch: datetime) -> str | None:
    """A serial number of days as text; None, as of an error cell, where there is no such date."""
    try:
        if format == ELAPSED:
            passed = timedelta(days=number)
            return str(timedelta(seconds=passed // SECOND, milliseconds=round(passed % SECOND / MILLISECOND)))
        days, fraction = divmod(number, 1)
        part = timedelta(milliseconds=round(fraction * 86_400_000))
        if days == 0 and not part.days:
            return str((datetime.min + part).time())
        if 0 < number < 60 and epoch == EPOCH_1900:
            days += 1  # that calendar has a 29 February 1900, number 60, before which it is a day behind
        return str(epoch + timedelta(days=days) + part)
    except OverflowError:
        return None


def date_formats(book: ZipFile) -> dict[str, str]:
    """Style numbers of cells whose numbers are dates or passed times, and which of the two."""
    if "xl/styles.xml" not in book.namelist():
        return {}
    styles = ElementTree.fromstring(book.read("xl/styles.xml"))
    codes = {f.get("numFmtId"): f.get("formatCode", "") for f in styles.iterfind(f"{MAIN}numFmts/{MAIN}numFmt")}
    kinds = {}
    for number, style in enumerate(styles.iterfind(f"{MAIN}cellXfs/{MAIN}xf")):
        code = style.get("numFmtId", "0")
        kind = format_kind(codes[code]) if code in codes else BUILT_IN.get(code)
        if kind:
            kinds[str(number)] = kind
    return kinds


def format_kind(code: str) -> str | None:
    """What a number format makes of a number, by its part for positive ones."""
    positive = LITERAL.sub("", code).split(";")[0]
    if ELAPSED_SIGNS.search(positive):
        return ELAPSED
    return DATE if DATE_SIGNS.search(BRACKETED.sub("", positive)) else None


def first_day(book: ZipFile) -> datetime:
    """Day 0 of the workbook's calendar."""
    properties = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}workbookPr")
    since_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    return EPOCH_1904 if since_1904 else EPOCH_1900


def number_text(value: str) -> str:
    if value.lstrip("-").isdigit():
        return str(int(value))
    number = float(value)
    return str(int(number)) if number.is_integer() else str(number)


def plain_text(item: ElementTree.Element) -> str:
    """The text of a string item: its own text or that of its runs, without reading aids."""
    if len(item) == 1 and item[0].tag == TEXT:
        return item[0].text or ""
    parts = item.findall(TEXT) + item.findall(f"{RUN}/{TEXT}")
    return "".join(part.text or "" for part in parts)


def shared_texts(book: ZipFile) -> list[str]:
    texts: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        with book.open("xl/sharedStrings.xml") as stream:
            for item in finished(stream, MAIN + "si", MAIN + "sst"):
                texts.append(plain_text(item))
    return texts


def first_sheet(book: ZipFile) -> str:
    """The file of the worksheet listed first in the workbook; chart sheets are passed over."""
    relations = {r.get("Id"): r for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iterfind(f"{MAIN}sheets/{MAIN}sheet"):
        relation = relations.get(sheet.get(RELATION_ID))
        if relation is None:
            raise ValueError("workbook lists a sheet it does not contain")
        if relation.get("Type", "").endswith("/worksheet"):
            return normpath(join("/xl", relation.get("Target"))).lstrip("/")
    raise ValueError("workbook has no worksheet")
