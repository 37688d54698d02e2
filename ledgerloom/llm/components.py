"""Connected components by alternating stars, in rounds of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch


def _hung_on_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Each node's neighbours hung on its least neighbour (or on itself if that is less).

    With ``larger_only`` the neighbours above the node move (the large star), else those
    below it and the node itself (the small star). The least one is found by a partial
    aggregate and joined back, so that a node with very many neighbours is no single task.
    """
    if larger_only:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        # Edges run from the greater node (a) to the lesser (b).
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = (
            edges.join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
        )
    return moved.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, scratch: Scratch, label: str = "components") -> DataFrame:
    """``node`` and ``root``, the least node that it is linked to, for the nodes of ``edges``.

    ``edges`` has ``a`` and ``b``. Rounds go on until a whole round changes nothing, which
    takes about the logarithm of the longest chain; each is written down.
    """
    now = scratch.keep(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{label}-0",
    )
    count, check = _fingerprint(now)
    turn = 0
    while count:
        turn += 1
        now = scratch.keep(
            _hung_on_least(_hung_on_least(now, larger_only=True), larger_only=False), f"{label}-{turn}"
        )
        before, (count, check) = (count, check), _fingerprint(now)
        if before == (count, check):
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root")).distinct()


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
