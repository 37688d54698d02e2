"""Lines that many documents repeat: per-document keep bitmaps, and texts by these.

Native: DataFrame functions only. Lines are compared by a hash of 128 bits of their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch

#: Occurrences that one slice of a line's documents should hold, and the fewest slices.
SLICE_ROWS, LEAST_SLICES = 1_000_000, 16

#: White space that a key is without at both ends: space and the five ASCII controls.
STRIPPED = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_KEY = ["h1", "h2"]


def keep_bitmaps(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_chars: int = 40, least_docs: int = 5
) -> DataFrame:
    """Which lines of each document stay, one row for each different (id, text).

    A line's key is the line without ASCII white space at its ends and with A-Z in lower
    case. A key of ``least_chars`` code points or more that ``least_docs`` or more documents
    hold loses its lines in all documents but the last, the one of the largest id. In
    that one all of them stay, repeated ones too.

    Returns ``doc`` (the id), ``text_hash`` (null for a null text), ``n_lines``, ``n_dropped``
    and ``keep``, the bitmap as run lengths: lines kept, lines dropped, lines kept and so on,
    the first may be 0. Null and empty texts are one empty line. Rows that share an
    id are one document where documents are counted, and a null id is a document of its own
    below all others; repeated rows have one bitmap. Other columns of ``docs`` are not looked at.

    Occurrences are dealt by ranges of (hash, slice of documents) and sorted by document,
    last first, and place. Each slice streams its first occurrences: its ``least_docs`` last
    documents are all that a key's verdict needs of it. A line that a third of all rows
    hold so lies in many tasks, a slice in each.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    own = docs.select(F.col(f"`{id_column}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    lines = own.select("doc", _text_hash("text").alias("text_hash"), F.posexplode(_lines("text")).alias("pos", "line"))
    keyed = lines.where(F.length("line") >= least_chars).withColumn("key", _key("line"))
    found = scratch.keep(
        keyed.where(F.length("key") >= least_chars).select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit("second"), "key").alias("h2"),
            "doc",
            "text_hash",
            "pos",
        ),
        "occurrences",
    )
    slices = max(LEAST_SLICES, found.count() // SLICE_ROWS)
    sliced = found.withColumn("slice", F.pmod(F.xxhash64("doc"), F.lit(slices)).cast("int"))

    stream = Window.partitionBy(*_KEY, "slice").orderBy(F.desc("doc"), "pos")
    dealt = (
        sliced.select(*_KEY, "slice", "doc", "pos")
        .repartitionByRange(*_KEY, "slice")
        .sortWithinPartitions(*_KEY, "slice", F.desc("doc"), "pos")
    )
    last = (
        dealt.select(
            *_KEY,
            "slice",
            "doc",
            F.dense_rank().over(stream).alias("nth"),
            F.row_number().over(stream).alias("row"),
            F.lag("doc").over(stream).alias("above"),
        )
        .where((F.col("nth") <= least_docs) & ((F.col("row") == 1) | ~F.col("doc").eqNullSafe(F.col("above"))))
        .select(*_KEY, "slice", "doc", "nth")
    )
    of_key = Window.partitionBy(*_KEY)
    verdicts = (
        last.select(
            *_KEY,
            "slice",
            "nth",
            F.count(F.lit(1)).over(of_key).alias("n_docs"),
            F.max("doc").over(of_key).alias("last_doc"),
        )
        .where((F.col("nth") == 1) & (F.col("n_docs") >= least_docs))
        .select(*_KEY, "slice", "last_doc")
    )
    dropped = (
        sliced.join(verdicts, [*_KEY, "slice"])
        .where(F.col("doc").isNull() | (F.col("doc") < F.col("last_doc")))
        .groupBy("doc", "text_hash")
        .agg(F.array_sort(F.collect_set("pos")).alias("dropped"))
    )
    sizes = own.select(
        "doc", _text_hash("text").alias("text_hash"), F.size(_lines("text")).alias("n_lines")
    ).distinct()
    told = sizes.alias("s").join(
        dropped.alias("d"),
        F.col("s.doc").eqNullSafe(F.col("d.doc")) & (F.col("s.text_hash") == F.col("d.text_hash")),
        "left",
    )
    rows = told.select("s.doc", "s.text_hash", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    return rows.select(
        "doc", "text_hash", "n_lines", F.size("dropped").alias("n_dropped"), _runs("dropped", "n_lines").alias("keep")
    )


def keep_lines(
    docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The id and text of every row with only the lines that its bitmap keeps, and both counts.

    Columns: ``doc``, ``text``, ``n_lines``, ``n_dropped``. A document without any line left has
    an empty text; a null text is an empty one.
    """
    own = docs.select(
        F.col(f"`{id_column}`").alias("doc"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        _text_hash(f"`{text}`").alias("text_hash"),
    )
    told = own.alias("o").join(
        bitmaps.alias("b"),
        F.col("o.doc").eqNullSafe(F.col("b.doc")) & F.col("o.text_hash").eqNullSafe(F.col("b.text_hash")),
        "left",
    )
    flags = F.flatten(F.transform("keep", lambda n, i: F.array_repeat(i % 2 == 0, n)))
    kept = F.array_join(F.zip_with(_lines("text"), flags, lambda line, flag: F.when(flag, line)), "\n")
    return told.select(
        F.col("o.doc").alias("doc"),
        F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(kept).alias("text"),
        "n_lines",
        "n_dropped",
    )


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _text_hash(text: str) -> Column:
    return F.when(F.col(text).isNotNull(), F.xxhash64(text))


def _key(line: str) -> Column:
    """Stripped and in lower case. Spark's own ``lower`` does the same to ASCII, only faster."""
    bare = F.trim(line, F.lit(STRIPPED))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, CAPITALS, CAPITALS.lower()))


def _runs(dropped: str, n_lines: str) -> Column:
    """Run lengths from sorted dropped places; linear, as no lambda looks at a whole array."""
    d = F.col(dropped)
    before = F.concat(F.array(F.lit(-2)), d)
    after = F.when(F.size(d) > 0, F.slice(d, 2, F.size(d)))
    starts = F.array_compact(F.zip_with(d, before, lambda x, p: F.when(x > p + 1, x)))
    ends = F.array_compact(F.zip_with(d, after, lambda x, n: F.when(n.isNull() | (n > x + 1), x)))
    gaps = F.zip_with(
        starts, F.concat(F.array(F.lit(-1)), ends), lambda s, p: F.coalesce(s, F.col(n_lines)) - p - 1
    )
    lengths = F.zip_with(starts, ends, lambda s, e: e - s + 1)
    pairs = F.zip_with(gaps, lengths, lambda g, n: F.when(n.isNull(), F.array(g)).otherwise(F.array(g, n)))
    return F.when(F.size(d) > 0, F.flatten(pairs)).otherwise(F.array(F.col(n_lines)))
