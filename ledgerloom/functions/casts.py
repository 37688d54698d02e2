"""Typing of source columns."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import functions as F

from ledgerloom.tables import Column


def typed(column: Column, lenient: bool = False) -> SparkColumn:
    """The source column converted to its typed form.

    Under ANSI mode a malformed value fails the job; ``lenient`` turns it into null.
    """
    value = F.col(f"`{column.source}`")
    if column.date_format:
        parse = F.try_to_date if lenient else F.to_date
        return parse(value, column.date_format)
    return value.try_cast(column.type) if lenient else value.cast(column.type)
