"""From source columns to typed columns."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.functions import typed
from ledgerloom.tables import Table

OnBadValue = Literal["fail", "null"]


def conform(df: DataFrame, table: Table, on_bad_value: OnBadValue = "fail") -> DataFrame:
    """Select, rename and type the table's columns; other columns are dropped."""
    lenient = on_bad_value == "null"
    return df.select([typed(c, lenient).alias(c.name) for c in table.columns])


def _bad_value_measures(table: Table) -> list[Column]:
    return [
        F.count_if(F.col(f"`{c.source}`").isNotNull() & typed(c, lenient=True).isNull()).alias(c.name)
        for c in table.columns
        if c.source_type != c.type
    ]


def bad_value_counts(df: DataFrame, table: Table) -> DataFrame:
    """One row: per converted column, how many values are present but malformed."""
    return df.agg(*_bad_value_measures(table))


def watch_bad_values(df: DataFrame, table: Table, observation: Observation) -> DataFrame:
    """The same counts, gathered while ``df`` is written instead of in a pass of their own."""
    return df.observe(observation, *_bad_value_measures(table))
