"""CSV and JSON sources, and what to do when a source is missing."""

from __future__ import annotations

from collections.abc import Callable
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.ranges import CsvRecords, JsonObjects, read_records
from ledgerloom.tables import Table

OnMissing = Literal["raise", "empty"]
OnMalformed = Literal["raise", "null"]
CORRUPT = "_malformed_record"


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def or_empty(
    spark: SparkSession, schema: T.StructType, on_missing: OnMissing, read: Callable[[], DataFrame]
) -> DataFrame:
    """Run ``read``; a missing path gives an empty typed frame if that is asked for."""
    try:
        return read()
    except AnalysisException as error:
        if on_missing == "empty" and error.getCondition() == "PATH_NOT_FOUND":
            return empty_table(spark, schema)
        raise


def read_csv(
    spark: SparkSession,
    path: str,
    table: Table,
    multi_line: bool = True,
    check_header: bool = True,
    on_missing: OnMissing = "raise",
    split: bool = False,
) -> DataFrame:
    """CSV with a header line, ``"`` as quote and ``""`` for a quote inside quotes.

    Columns are taken by position. With ``check_header`` a file whose header names
    differ from the table fails instead of filling the wrong columns. Quoted line
    breaks need ``multi_line``. Spark's own reader then makes one task of each file; with
    ``split`` large files are read in ranges by many tasks, to the same rows. Without quoted
    line breaks turn ``multi_line`` off, and large files are split in either case.
    """
    if multi_line and split:
        return or_empty(
            spark, table.source_schema, on_missing, lambda: _split_csv(spark, path, table, check_header)
        )
    reader = spark.read.schema(table.source_schema).options(
        header=True, multiLine=multi_line, quote='"', escape='"', enforceSchema=not check_header
    )
    return or_empty(spark, table.source_schema, on_missing, lambda: reader.csv(path))


def read_json(
    spark: SparkSession,
    path: str,
    table: Table,
    multi_line: bool = True,
    on_missing: OnMissing = "raise",
    on_malformed: OnMalformed = "null",
    watch: Observation | None = None,
    split: bool = False,
) -> DataFrame:
    """JSON objects, matched to the table's columns by name.

    With ``multi_line`` each file is one document, an array of objects. Spark's own reader
    makes one task of it, which holds it in memory as a whole. With ``split`` it is read in
    ranges by many tasks. With ``multi_line`` off, files have one object per line.

    A value of the wrong type is null and the rest of its object is kept; a document that
    is cut or isn't JSON is one row of nulls. With ``on_malformed="raise"`` either fails
    the job that reads it. ``watch`` is told the number of such records as ``records``; of an
    array that holds a malformed object Spark's own reader counts every object. With
    ``split`` a malformed object is one record, as is what follows the last whole
    object of a document that is cut, and the other objects are kept.
    """
    schema = T.StructType([*table.source_schema, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).options(
        multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT
    )
    names = [f"`{name}`" for name in table.source_schema.names]

    def read() -> DataFrame:
        df = _split_json(spark, path, schema) if multi_line and split else reader.json(path)
        if watch is not None:
            # Spark's JSON source can't read the corrupt records' column by itself.
            df = df.observe(watch, F.count(CORRUPT).alias("records"), F.count(names[0]).alias("first"))
        if on_malformed == "raise":
            fail = F.raise_error(F.concat(F.lit("malformed record: "), F.left(CORRUPT, F.lit(200))))
            whole = F.when(F.col(CORRUPT).isNull(), F.col(names[0])).otherwise(
                fail.cast(table.source_schema[0].dataType)
            )
            df = df.withColumn(table.source_schema.names[0], whole)
        return df.select(names)

    return or_empty(spark, table.source_schema, on_missing, read)


#: What may follow the last object of an array, be an array without any, or follow a plain object.
_AFTER_LAST, _EMPTY, _BLANK = r"^\s*\]", r"^\x{FEFF}?\s*\[\s*\]", r"^\x{FEFF}?\s*$"
_MARK, _SPACE = "\ufeff", " \t\n\x0b\f\r"


def _bare(text: Column) -> Column:
    return F.ltrim(text, F.lit(_SPACE))


def _behind(text: Column, sign: str) -> Column:
    """What follows ``sign`` and the space around it; null if something else comes first."""
    return F.when(_bare(text).startswith(sign), _bare(_tail(_bare(text))))


def _tail(text: Column) -> Column:
    return F.substring(text, 2, 2**31 - 1)


def _split_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of arrays, parsed one by one; ``schema`` has the column of corrupt records."""
    in_array, first, last, text = F.col("outer") == 1, F.col("first"), F.col("last"), F.col("text")
    # Before an object stand the opening bracket, a comma, or nothing outside an array. These
    # are string functions, as a pattern that depends on the row is compiled for each row.
    unmarked = F.when(text.startswith(_MARK), _tail(text)).otherwise(text)
    body = F.when(~in_array, _bare(unmarked)).when(first, _behind(unmarked, "[")).otherwise(_behind(text, ","))
    records = read_records(spark, path, JsonObjects()).withColumn("body", F.when(~last, body))
    after = F.when(~in_array, _BLANK).when(first, _EMPTY).otherwise(_AFTER_LAST)
    good = F.coalesce(F.col("body").startswith("{"), F.lit(False))
    parsed = F.from_json(F.when(good, F.col("body")), schema, {"columnNameOfCorruptRecord": CORRUPT})
    rows = records.where(~(last & F.regexp(text, after))).select(
        parsed.alias("row"), F.when(~good, text).alias("bad")
    )
    plain = [F.col("row")[name].alias(name) for name in schema.names if name != CORRUPT]
    return rows.select(*plain, F.coalesce("bad", F.col("row")[CORRUPT]).alias(CORRUPT))


def _split_csv(spark: SparkSession, path: str, table: Table, check_header: bool) -> DataFrame:
    """Records parsed one by one; the first of each file is its header."""
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    records = read_records(spark, path, CsvRecords()).select(
        F.regexp_replace("text", r"\r$|^\x{FEFF}", "").alias("text"), "first"
    )
    if check_header:
        names = table.source_schema.names
        texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
        header = F.from_csv("text", texts.simpleString()[len("struct<") : -1].replace(":", " "), options)
        expected = F.struct(*[F.lit(n).alias(f"c{i}") for i, n in enumerate(names)], F.lit(None).cast("string").alias(f"c{len(names)}"))
        fail = F.raise_error(F.concat(F.lit("CSV header doesn't name the table's columns: "), "text"))
        body = F.when(~F.col("first"), True).when(header.eqNullSafe(expected), False).otherwise(fail.cast("boolean"))
    else:
        body = ~F.col("first")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.source_schema)
    rows = records.where(body & (F.col("text") != "")).select(F.from_csv("text", ddl, options).alias("row"))
    return rows.select("row.*")
