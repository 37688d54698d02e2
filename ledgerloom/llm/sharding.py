"""Sharding by size: contiguous shards of nearly equal bytes.

Prefix sums over the whole corpus come from prefix sums inside range partitions plus the
totals of the partitions before, so no task sees more than its own range. The prefix is
then cut at equal targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch


def shard_by_bytes(docs: DataFrame, shards: int = 8, key: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with its shard, in order of ``key``.

    Returns ``key``, ``size`` (UTF-8 bytes of ``text``, none for null, plus 1),
    ``text_crc32`` (of the bytes, 0 for null), ``shard`` and ``slot``, the row's place in
    its shard from 0. Shard boundaries are the multiples of total / shards; a row belongs
    where the middle of its bytes lies, so a shard differs from the target by no more
    than half the two rows at its ends. Very large rows can leave a shard without rows.

    Rows with equal keys, repeated rows too, are ordered by size, checksum and place of
    reading, so any number of them can be dealt over several tasks and shards; null keys
    come first. An empty table gives an empty result. Columns other than ``key`` and
    ``text`` are not read. Only sizes and checksums are shuffled, never texts.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    rows = docs.select(
        F.col(key).alias("_key"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("_size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).alias("_crc"),
        F.monotonically_increasing_id().alias("_read"),
    )
    order = ["_key", "_size", "_crc", "_read"]
    # The bounds of range partitions come from a sample. Writing the parts down makes
    # sure that totals and rows speak of the same parts, also after a lost executor.
    parts = scratch.keep(
        rows.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_part")), "parts"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (  # one row for each part; these alone are ordered in a single task
        parts.groupBy("_part")
        .agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
            F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
        )
    )
    totals = scratch.keep(totals, "totals")
    inside = Window.partitionBy("_part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        parts.select(
            "*",
            F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_before"),
            F.row_number().over(inside).alias("_nth"),
        )
        .join(totals, "_part")
        .select(
            F.col("_key"),
            F.col("_size"),
            F.col("_crc"),
            (F.col("_rows_before") + F.col("_nth") - 1).alias("_row"),
            # Twice the middle of the row against twice the total, in whole numbers.
            F.least(
                F.lit(shards - 1),
                F.expr(
                    "cast((cast(2 * (_bytes_before + _before) + _size as decimal(38, 0))"
                    f" * {shards}) div (2 * _total) as int)"
                ),
            ).alias("_shard"),
        )
    )
    placed = scratch.keep(placed, "placed")
    first = placed.groupBy("_shard").agg(F.min("_row").alias("_first"))  # a row for each shard
    return placed.join(F.broadcast(first), "_shard").select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"),
        (F.col("_row") - F.col("_first")).alias("slot"),
    )
