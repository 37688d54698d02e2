"""Readers of the source files. Each takes one file or a folder of files."""

from ledgerloom.sources.text import empty_table, read_csv, read_json
from ledgerloom.sources.workbook import read_workbooks

__all__ = ["empty_table", "read_csv", "read_json", "read_workbooks"]
