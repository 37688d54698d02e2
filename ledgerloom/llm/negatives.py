"""Hard negatives by exact inner products: positives of each anchor, then rows in a score window."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch
from ledgerloom.llm.strassen import multiply

#: Rows that a cell of the grid has of each side, about; and a product's tile inside a cell.
CANDIDATE_ROWS, ANCHOR_ROWS = 2_048, 4_096
TILE = 256

#: Labels are dealt over this many buckets, which only bounds the number of cells planned for.
LABEL_BUCKETS = 64

#: Scores are below this, so that a score times a hundred has its place in 64 bits.
SCORE_LIMIT = (1 << 63) // 128
LEAST = np.iinfo(np.int64).min


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels in the window.

    A vector's components become ``floor(256 x)``; scores are integer inner products, higher
    first, ties by the smaller id. An anchor's positives are its first ``positives`` other
    rows of its label. For each positive the first ``negatives`` rows of other labels
    are returned whose score is between ``window`` hundredths of the positive's.

    Returns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``. Rows with a null label or vector, or with a null or non-finite
    component, take no part. Rows that are repeated whole (id, label, vector) count once; rows
    of one id that differ are rows of their own, and a null id comes last among ties. Shorter
    vectors count as padded with zeros, an empty one scores 0. An error is raised if a score might not fit
    into 56 bits. Other columns are not looked at; an empty table gives no rows.

    Work is a grid: candidates in cells of about ``CANDIDATE_ROWS``, anchors of about
    ``ANCHOR_ROWS``, dealt by a hash of the row, so that a label of a third of the rows lies in
    many cells. A first grid multiplies anchors with rows of their own label only, and
    keeps a heap of positives for each anchor and cell; heaps merge into the anchors' positives.
    These state the windows of the second grid, whose heaps merge in the same way.
    """
    scratch = Scratch(rows.sparkSession, "negatives")
    finite = ~F.exists(
        f"`{vector}`", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    wanted = (
        rows.withColumns({"_label": F.col(label) if isinstance(label, str) else label, "_anchor": is_anchor})
        .where(F.col("_label").isNotNull() & F.col(f"`{vector}`").isNotNull() & finite)
        .select(
            F.col(f"`{id_column}`").alias("id"),
            F.col("_label").alias("label"),
            F.coalesce("_anchor", F.lit(False)).alias("anchor"),
            F.transform(f"`{vector}`", lambda x: F.floor(256 * x.cast("double"))).alias("v"),
        )
    )
    largest = F.greatest(F.abs(F.coalesce(F.array_max("v"), F.lit(0))), F.abs(F.coalesce(F.array_min("v"), F.lit(0))))
    once = scratch.keep(
        wanted.distinct().withColumns(
            {"bucket": _dealt(F.lit(LABEL_BUCKETS), "label"), "row": F.xxhash64("id", "label", "v")}
        ),
        "rows",
    )
    sizes = once.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("anchor").alias("n_anchors"),
        F.max(largest).alias("largest"),
        F.max(F.size("v")).alias("width"),
    ).collect()  # at most LABEL_BUCKETS rows
    width = max((s.width for s in sizes), default=0)
    reach = max((int(s.largest) for s in sizes), default=0)
    if width * reach * reach >= SCORE_LIMIT:
        raise ValueError(f"inner products of {width} components up to {reach} may not fit")

    same = {s.bucket: (_cells(s.n_anchors, ANCHOR_ROWS), _cells(s.n, CANDIDATE_ROWS)) for s in sizes}
    candidates = once.select("row", "id", "label", F.col("v").cast("array<int>").alias("v"), "bucket")
    anchors = once.where("anchor").select("row", "id", "label", F.col("v").cast("array<int>").alias("v"), "bucket")
    schema = candidates.schema["id"].dataType.simpleString()
    found = _over_grid(
        anchors,
        candidates,
        same,
        "bucket",
        f"row long, anchor_id {schema}, positive_id {schema}, positive_score long",
        lambda left, right: _best_positives(left, right, width, positives),
    )
    first = Window.partitionBy("row", "anchor_id").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    kept = scratch.keep(
        found.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives), "positives"
    )
    with_positives = (
        kept.groupBy("row", F.col("anchor_id").alias("id"))
        .agg(F.array_sort(F.collect_list(F.struct("nth", "positive_id", "positive_score"))).alias("positives"))
        .alias("p")
        .join(anchors.alias("r"), (F.col("p.row") == F.col("r.row")) & F.col("p.id").eqNullSafe(F.col("r.id")))
        .select("r.*", F.col("p.positives.nth").alias("nth"), F.col("p.positives.positive_score").alias("score"))
    )
    everywhere = {
        0: (
            _cells(sum(s.n_anchors for s in sizes), ANCHOR_ROWS),
            _cells(sum(s.n for s in sizes), CANDIDATE_ROWS),
        )
    }
    in_window = _over_grid(
        scratch.keep(with_positives, "anchors"),
        candidates,
        everywhere,
        None,
        f"row long, anchor_id {schema}, nth int, negative_id {schema}, negative_score long",
        lambda left, right: _best_in_windows(left, right, width, negatives, window),
    )
    best = Window.partitionBy("row", "anchor_id", "nth").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id")
    )
    ranked = in_window.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return (
        ranked.alias("n")
        .join(
            kept.alias("k"),
            (F.col("n.row") == F.col("k.row"))
            & F.col("n.anchor_id").eqNullSafe(F.col("k.anchor_id"))
            & (F.col("n.nth") == F.col("k.nth")),
        )
        .select(
            "n.anchor_id", "k.positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score"
        )
    )


def _cells(rows: int, of: int) -> int:
    return max(1, math.ceil(rows / of))


def _dealt(parts: Column, column: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("dealt"), column), parts).cast("int")


def _over_grid(
    anchors: DataFrame,
    candidates: DataFrame,
    grid: dict[int, tuple[int, int]],
    bucket: str | None,
    schema: str,
    work: Callable[[pa.Table, pa.Table], Iterator[pa.Table]],
) -> DataFrame:
    """``work`` on each cell: a part of a bucket's anchors by a part of its candidates."""
    at = F.col(bucket) if bucket else F.lit(0)

    def parts(side: int) -> Column:
        """In how many parts a row's bucket is cut on that side of the grid."""
        known = {b: sizes[side] for b, sizes in grid.items()} or {0: 1}
        return F.create_map(*[F.lit(x) for pair in known.items() for x in pair])[at]

    def every(side: int) -> Column:
        return F.explode(F.sequence(F.lit(0), parts(side) - 1))

    left = anchors.withColumn("i", _dealt(parts(0), "row")).withColumn("j", every(1))
    right = candidates.withColumn("j", _dealt(parts(1), "row")).withColumn("i", every(0))
    keys = [bucket, "i", "j"] if bucket else ["i", "j"]
    cells = sum(i * j for i, j in grid.values())
    tasks = max(1, min(cells, max(cells // 8, 2 * anchors.sparkSession.sparkContext.defaultParallelism)))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = list(work(left, right)) if left.num_rows and right.num_rows else []
        return pa.concat_tables(parts).cast(target) if parts else target.empty_table()

    target = _arrow_schema(anchors, schema)
    return (
        left.repartition(tasks, *keys)
        .groupBy(*keys)
        .cogroup(right.repartition(tasks, *keys).groupBy(*keys))
        .applyInArrow(cell, schema)
    )


def _arrow_schema(frame: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, short ones padded with zeros."""
    vectors = vectors.combine_chunks()
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.chunk(0)
    lengths = vectors.value_lengths().to_numpy(False).astype(np.int64)
    flat = vectors.flatten().to_numpy(False).astype(np.int64)
    matrix = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    matrix[row, column] = flat
    return matrix


def _numbers(left: pa.Table, right: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where the column's values are; nulls are -1."""
    both = pa.chunked_array(left[column].chunks + right[column].chunks).combine_chunks()
    numbers = both.dictionary_encode().indices.fill_null(-1).to_numpy(False)
    return numbers[: left.num_rows], numbers[left.num_rows :]


def _tiles(left: pa.Table, right: pa.Table, width: int) -> Iterator[tuple]:
    """Tiles of the cell: both slices, scores, where labels are equal, where rows are the same.

    ``right`` is sorted by id, so that among equal scores the first column has the smallest.
    """
    across = np.ascontiguousarray(_matrix(right["v"], width).T)
    down = _matrix(left["v"], width)
    label, ids, row = (_numbers(left, right, c) for c in ("label", "id", "row"))
    for start in range(0, left.num_rows, TILE):
        part = slice(start, start + TILE)
        for offset in range(0, right.num_rows, 8 * TILE):
            other = slice(offset, offset + 8 * TILE)
            same = label[0][part, None] == label[1][None, other]
            itself = (ids[0][part, None] == ids[1][None, other]) & (row[0][part, None] == row[1][None, other])
            yield part, other, multiply(down[part], across[:, other]), same, itself


def _take_first(scores: np.ndarray, allowed: np.ndarray, count: int):
    """Row and column of each row's first ``count`` allowed places, by score, then by place."""
    open_scores = np.where(allowed, scores, LEAST)
    rows = np.arange(len(scores))
    for _ in range(min(count, scores.shape[1])):
        best = open_scores.argmax(axis=1)
        real = open_scores[rows, best] != LEAST
        if not real.any():
            return
        yield rows[real], best[real]
        open_scores[rows, best] = LEAST


def _best_positives(left: pa.Table, right: pa.Table, width: int, count: int) -> Iterator[pa.Table]:
    right = right.sort_by([("id", "ascending")])
    hashes = left["row"].to_numpy()
    for part, other, scores, same, itself in _tiles(left, right, width):
        for row, column in _take_first(scores, same & ~itself, count):
            yield pa.table(
                {
                    "row": hashes[part][row],
                    "anchor_id": left["id"].take(row + part.start),
                    "positive_id": right["id"].take(column + other.start),
                    "positive_score": scores[row, column],
                }
            )


def _best_in_windows(
    left: pa.Table, right: pa.Table, width: int, count: int, window: tuple[int, int]
) -> Iterator[pa.Table]:
    right = right.sort_by([("id", "ascending")])
    hashes = left["row"].to_numpy()
    most = max(left["score"].combine_chunks().value_lengths().to_pylist())
    given = np.full((left.num_rows, most), LEAST)
    numbers = np.zeros((left.num_rows, most), np.int32)
    for row, (scores, nth) in enumerate(zip(left["score"].to_pylist(), left["nth"].to_pylist())):
        given[row, : len(scores)] = scores
        numbers[row, : len(nth)] = nth
    low, high = window
    for part, other, scores, same, _ in _tiles(left, right, width):
        for place in range(most):
            positive = given[part, place]
            real = positive != LEAST
            # low * p <= 100 * s <= high * p, as bounds of s
            least = -((-low * np.where(real, positive, 0)) // 100)
            greatest = np.where(real, (high * np.where(real, positive, 0)) // 100, LEAST)
            allowed = (scores >= least[:, None]) & (scores <= greatest[:, None]) & ~same
            for row, column in _take_first(scores, allowed, count):
                yield pa.table(
                    {
                        "row": hashes[part][row],
                        "anchor_id": left["id"].take(row + part.start),
                        "nth": numbers[part, place][row],
                        "negative_id": right["id"].take(column + other.start),
                        "negative_score": scores[row, column],
                    }
                )
