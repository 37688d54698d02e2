"""Writes frames as the source files the mart reads, from Spark tasks."""

from __future__ import annotations

import sys
import zipfile
from collections.abc import Iterator
from io import BytesIO
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_WORKBOOK = 100_000
#: Order lines of a file: some 25 MB, and 4 MB if compressed.
ROWS_PER_FILE = 100_000

NAMESPACE = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(header=True, quote='"', escape='"').csv(path)


def write_json_arrays(
    df: DataFrame, path: str, compression: str = "none", rows: int | None = None
) -> None:
    """Files of a bounded number of rows, each a single JSON array, streamed in batches."""
    objects = df.select(F.to_json(F.struct("*")).alias("value"))
    rows = rows or ROWS_PER_FILE
    lines = objects.mapInArrow(lambda batches: array_lines(batches, rows), "value string")
    # An array's closing bracket is a line of its own.
    _write_bounded(lines, rows + 1, compression).text(path)


def write_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """One object per line. Compressed files, which Spark doesn't split, are of bounded size."""
    _write_bounded(df, 0 if compression == "none" else ROWS_PER_FILE, compression).json(path)


def _write_bounded(df: DataFrame, lines: int, compression: str) -> DataFrameWriter:
    return df.write.options(
        maxRecordsPerFile=lines, compression=compression, **{"zlib.compress.level": "BEST_SPEED"}
    )


def array_lines(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The lines of arrays of so many objects; the last one may have fewer."""
    written = 0

    def lines(texts: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["value"])

    for batch in batches:
        objects = batch.column(0)
        while len(objects):
            part, objects = objects.slice(0, rows - written), objects.slice(rows - written)
            before = pa.array([","] * len(part) if written else ["[", *[","] * (len(part) - 1)])
            yield lines(pc.binary_join_element_wise(before, part.cast(pa.string()), ""))
            written += len(part)
            if written == rows:
                yield lines(pa.array(["]"]))
                written = 0
    if written:
        yield lines(pa.array(["]"]))


def write_workbooks(df: DataFrame, path: str) -> None:
    """Workbooks of a bounded number of rows, one file each.

    The text sink writes a value's bytes as they are and commits files as for any other
    table, wherever the folder is. It ends each file with a line break, which the zip
    format allows.
    """
    names = df.columns

    def pack_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in chunks(batches, ROWS_PER_WORKBOOK):
            yield pd.DataFrame({"content": [workbook(names, rows)]})

    books = df.mapInPandas(pack_rows, "content binary")
    bytes_as_text = books.select(F.col("content").cast("string").alias("value"))
    bytes_as_text.write.option("maxRecordsPerFile", 1).text(path)


def chunks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[list[tuple]]:
    rows: list[tuple] = []
    for batch in batches:
        for row in batch.itertuples(index=False, name=None):
            rows.append(row)
            if len(rows) == size:
                yield rows
                rows = []
    if rows:
        yield rows


def workbook(names: list[str], rows: list[tuple]) -> bytes:
    """A one-sheet workbook: shared strings for the header, inline ones for the cells."""
    header = "".join(f'<c t="s"><v>{i}</v></c>' for i in range(len(names)))
    lines = [f'<row r="1">{header}</row>']
    for number, row in enumerate(rows, start=2):
        cells = "".join(
            f'<c r="{letters(column)}{number}" t="inlineStr"><is><t xml:space="preserve">'
            f"{escape(value)}</t></is></c>"
            for column, value in enumerate(row, start=1)
            if value is not None
        )
        lines.append(f'<row r="{number}">{cells}</row>')
    shared = "".join(f"<si><t>{escape(name)}</t></si>" for name in names)
    return pack(f'<worksheet xmlns="{NAMESPACE}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
                f'<sst xmlns="{NAMESPACE}">{shared}</sst>')


def pack(sheet: str, shared: str, target: str = "worksheets/sheet1.xml") -> bytes:
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{NAMESPACE}" xmlns:r="{RELATIONS}"><sheets>'
        '<sheet name="Customers" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": "<Relationships xmlns="
        '"http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{RELATIONS}/worksheet" Target="{target}"/></Relationships>',
        "xl/sharedStrings.xml": shared,
        f"xl/{target.removeprefix('/xl/')}": sheet,
    }
    buffer = BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return buffer.getvalue()


def letters(column: int) -> str:
    """``B`` for 2."""
    text = ""
    while column:
        column, rest = divmod(column - 1, 26)
        text = chr(ord("A") + rest) + text
    return text
