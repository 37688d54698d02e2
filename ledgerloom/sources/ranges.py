"""Files of records that span lines or have none, read in byte ranges by many tasks.

Spark's text source deals a file's bytes over tasks, at any delimiter. What a task's first
bytes mean depends on all bytes before them: whether they lie in a quoted text, and in how
many brackets. A finite-state scan sums up each range as a function from the state it
starts in to the state it ends in. Composed in order, these functions give every range its
real first state, and with it the ends of the records in it. Records that cross ranges
come as parts and are put together afterwards.

A file is read twice, or three times if any range begins inside a record. Files that Spark
never divides are read once. One row a range, of some dozen bytes, passes through the driver,
which holds more than that for each task anyway.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Send this module's functions to the tasks themselves, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Files that Spark never divides, whatever their size.
UNDIVIDED = r"\.(gz|deflate)$"

#: More brackets than any file opens.
NONE = 1 << 60


class State(NamedTuple):
    """Before a byte: whether it is inside quotes, and how many brackets are open."""

    quoted: bool = False
    depth: int = 0


class Scan(NamedTuple):
    """Of pieces, each with its delimiter: which end a record, and the effect on a state."""

    ends: np.ndarray | None
    quoted: bool
    depth: int  # brackets opened less those closed
    least: int  # the least value of that after any delimiter that counts, or NONE


class Scanner(Protocol):
    """A format. Its delimiter ends pieces, and some pieces end records."""

    delimiter: str
    closes: str  # what a record's text ends with, of its last delimiter
    at_end: bool  # whether the end of a file ends a piece, as a delimiter does
    trailer: bool  # whether what follows the last record is told, even if it is nothing

    def outer(self, opening: str) -> int:
        """Brackets that are open between the records of a file that begins with ``opening``."""

    def signs(self, pieces: pa.Array) -> tuple:
        """What the scan needs of pieces, whatever state they start in."""

    def follow(self, signs: tuple, state: State, outer: int) -> Scan: ...


def next_state(state: State, scan: Scan, outer: int) -> State:
    """A delimiter that closes more than is open closes nothing: depth is not below ``outer`` after it."""
    lift = max(0, outer - state.depth - scan.least)
    return State(scan.quoted, state.depth + scan.depth + lift)


def scan(scanner: Scanner, pieces: pa.Array, state: State, outer: int) -> Scan:
    return scanner.follow(scanner.signs(pieces), state, outer)


class Range(NamedTuple):
    """A range that some task reads: the state it starts in, and what its file is like."""

    state: State
    outer: int
    last: bool
    terminated: bool | None  # whether the file ends with a delimiter; None if it is compressed


def read_pieces(
    spark: SparkSession, path: str, delimiter: str, undivided: int | None = None
) -> DataFrame:
    """The text between delimiters, with the file and the range in which it begins, in order.

    With ``undivided`` only of files that Spark may divide: these are larger than that.
    """
    files = spark.read.option("lineSep", delimiter).text(path)
    if undivided is not None:  # by what is listed of a file; the others aren't opened
        whole = F.col("_metadata.file_name").rlike(UNDIVIDED)
        files = files.where((F.col("_metadata.file_size") > undivided) & ~whole)
    return files.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"),
    )


def read_records(spark: SparkSession, path: str, scanner: Scanner) -> DataFrame:
    """All records of the files at ``path``.

    Columns: ``text``; ``first``, whether it is its file's first; ``outer``, the brackets open
    around it; ``last``, whether it is what a file holds after its last whole record (of
    brackets, always there, and maybe empty).
    """
    ranges = _known_ranges(spark, path, scanner)
    # Plain values, so that executors need no copy of this module to read them.
    known = spark.sparkContext.broadcast({key: (*r.state, *r[1:]) for key, r in ranges.items()})
    schema = "file long, start long, place int, text string, first boolean, outer int, last boolean, closes boolean"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {key: Range(State(*values[:2]), *values[2:]) for key, values in known.value.items()}
        return _cut(batches, scanner, at)

    cuts = read_pieces(spark, path, scanner.delimiter).mapInArrow(cut, schema)
    columns = ["text", "first", "outer", "last"]
    crossing = any(r.state.quoted or r.state.depth > r.outer for (_, start), r in ranges.items() if start)
    if not crossing:
        return cuts.select(columns)

    # A record in parts begins with a part at the end of a range and goes on in the next ones.
    parts = cuts.where("closes is not null")
    along = Window.partitionBy("file").orderBy("start", "place")
    joined = (
        parts.withColumn("record", F.sum("place").over(along))
        .groupBy("file", "record")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "place", "text"))).alias("parts"),
            F.max("first").alias("first"),
            F.max("outer").alias("outer"),
            F.max("last").alias("last"),
        )
    )
    whole = joined.select(F.array_join("parts.text", "").alias("text"), "first", "outer", "last")
    return cuts.where("closes is null").select(columns).unionByName(whole)


def _known_ranges(spark: SparkSession, path: str, scanner: Scanner) -> dict[tuple[int, int], Range]:
    """The ranges of all files that Spark may divide, by file and start."""
    # Spark makes no ranges smaller than the lesser of these two.
    undivided = min(
        _bytes(spark, "spark.sql.files.maxPartitionBytes", 128 << 20),
        _bytes(spark, "spark.sql.files.openCostInBytes", 4 << 20),
    )

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sum_up(batches, scanner)

    sums = (
        read_pieces(spark, path, scanner.delimiter, undivided)
        .mapInArrow(
            sum_up,
            "file long, start long, size long, bytes long, opening string, "
            "quoted array<boolean>, depth array<long>, least array<long>",
        )
        .collect()
    )
    return compose(sums, scanner)


def compose(sums: list, scanner: Scanner) -> dict[tuple[int, int], Range]:
    """The state in which each range starts, from what the ranges before it do."""
    ranges: dict[tuple[int, int], Range] = {}
    by_file: dict[int, list] = {}
    for row in sums:
        by_file.setdefault(row.file, []).append(row)
    for file, rows in by_file.items():
        rows.sort(key=lambda row: row.start)
        outer = scanner.outer("".join(row.opening for row in rows[:1]))
        total = sum(row.bytes for row in rows)
        state = State()
        for row in rows:
            ranges[file, row.start] = Range(state, outer, row is rows[-1], _terminated(total, row.size))
            side = int(state.quoted)
            state = next_state(state, Scan(None, row.quoted[side], row.depth[side], row.least[side]), outer)
    return ranges


def _bytes(spark: SparkSession, setting: str, default: int) -> int:
    text = spark.conf.get(setting, str(default))
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, pa.Array]]:
    """Pieces of one range that lie in one batch: (file, start, size, pieces)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, size = (batch.column(c).to_numpy() for c in ("file", "start", "size"))
        pieces = batch.column("value")
        borders = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for low, high in zip([0, *borders], [*borders, batch.num_rows]):
            low, high = int(low), int(high)
            yield int(file[low]), int(start[low]), int(size[low]), pieces.slice(low, high - low)


def _terminated(n_bytes: int, size: int) -> bool | None:
    """Pieces were counted with a delimiter each; the last of a file may have none."""
    return {size: True, size + 1: False}.get(n_bytes)


def _n_bytes(pieces: pa.Array) -> int:
    return (pc.sum(pc.binary_length(pieces)).as_py() or 0) + len(pieces)


def _first_sign(pieces: pa.Array) -> str:
    """The first character that is no white space or byte order mark."""
    for piece in pieces:
        bare = piece.as_py().lstrip("\ufeff \t\r\n")
        if bare:
            return bare[0]
    return ""


def _sum_up(batches: Iterator[pa.RecordBatch], scanner: Scanner) -> Iterator[pa.RecordBatch]:
    """One row for each range: its effect from either side of a quote, relative in depth."""
    key, row = None, None

    def done() -> pa.RecordBatch:
        sides = row.pop("sides")
        row["quoted"] = [scan.quoted for scan in sides]
        row["depth"] = [scan.depth for scan in sides]
        row["least"] = [scan.least for scan in sides]
        types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip(row.values(), types)], names=list(row)
        )

    for file, start, size, pieces in _runs(batches):
        if key != (file, start):
            if key:
                yield done()
            key = file, start
            row = {"file": file, "start": start, "size": size, "bytes": 0, "opening": "",
                   "sides": [Scan(None, False, 0, NONE), Scan(None, True, 0, NONE)]}
        row["bytes"] += _n_bytes(pieces)
        row["opening"] = row["opening"] or _first_sign(pieces)
        signs = scanner.signs(pieces)
        for side, before in enumerate(row["sides"]):
            after = scanner.follow(signs, State(before.quoted), 0)
            row["sides"][side] = Scan(
                None, after.quoted, before.depth + after.depth, min(before.least, before.depth + after.least)
            )
    if key:
        yield done()


def _cut(
    batches: Iterator[pa.RecordBatch], scanner: Scanner, known: dict[tuple[int, int], Range]
) -> Iterator[pa.RecordBatch]:
    """The records of each range, and the parts of those that cross its borders."""
    names = ["file", "start", "place", "text", "first", "outer", "last", "closes"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.bool_(), pa.bool_()]
    key = at = state = None
    size = n_bytes = 0
    beginning = goes_on = False
    waiting = held = pa.array([], pa.string())

    def rows(texts: pa.Array, first: bool, place=None, last=False, closes=None) -> pa.RecordBatch:
        n = len(texts)
        values = [*key, place, None, None, at.outer, last, closes]
        columns = [pa.array([value] * n, kind) for value, kind in zip(values, types)]
        columns[3] = texts
        columns[4] = pa.array([first and i == 0 for i in range(n)], pa.bool_())
        return pa.RecordBatch.from_arrays(columns, names=names)

    def take(pieces: pa.Array) -> Iterator[pa.RecordBatch]:
        """Scans pieces that are complete; gives the records that end in them."""
        nonlocal state, waiting, goes_on, beginning
        found = scan(scanner, pieces, state, at.outer)
        state = next_state(state, found, at.outer)
        ends = np.flatnonzero(found.ends) + len(waiting)
        waiting = pa.concat_arrays([waiting, pieces])
        if not len(ends):
            return
        offsets = np.concatenate([[0], ends + 1])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), waiting.slice(0, int(offsets[-1])))
        waiting = waiting.slice(int(offsets[-1]))
        texts = pc.binary_join_element_wise(pc.binary_join(lists, scanner.delimiter), scanner.closes, "")
        if goes_on:
            yield rows(texts.slice(0, 1), False, 0, False, True)
            texts, goes_on = texts.slice(1), False
        if len(texts):
            yield rows(texts, beginning)
            beginning = False

    def finish() -> Iterator[pa.RecordBatch]:
        """What the range holds after its last record: a part of the next, or the file's rest."""
        nonlocal held
        terminated = at.terminated if key in known else _terminated(n_bytes, size)
        if terminated is None and not scanner.at_end:
            alone = scan(scanner, held, state, at.outer)
            terminated = bool(alone.ends[-1]) and state.depth + alone.least >= at.outer
        if not at.last or terminated or scanner.at_end:
            yield from take(held)
            held = held.slice(0, 0)
        pieces = [*waiting.to_pylist(), *held.to_pylist()]
        text = scanner.delimiter.join(pieces)
        if len(waiting) and not len(held) and (terminated or not at.last):
            text += scanner.delimiter
        if (at.last and scanner.trailer) or pieces:
            yield rows(pa.array([text], pa.string()), beginning, 0 if goes_on else 1, at.last, at.last)

    for file, start, size_here, pieces in _runs(batches):
        if key != (file, start):
            if key:
                yield from finish()
            key, size, n_bytes = (file, start), size_here, 0
            if key in known:
                at = known[key]
            elif start == 0:
                at = Range(State(), scanner.outer(_first_sign(pieces)), True, None)
            else:
                raise RuntimeError(
                    "the file is divided in another way than when its ranges were looked at; read it again"
                )
            state, beginning = at.state, start == 0
            goes_on = state.quoted or state.depth > at.outer if start else False
            waiting = held = pieces.slice(0, 0)
        n_bytes += _n_bytes(pieces)
        pieces = pa.concat_arrays([held, pieces])
        held = pieces.slice(len(pieces) - 1)
        yield from take(pieces.slice(0, len(pieces) - 1))
    if key:
        yield from finish()


class JsonObjects:
    """The objects of a JSON array, or top-level objects, cut at closing braces."""

    delimiter = closes = "}"
    at_end, trailer = False, True
    QUOTE, BACKSLASH, OPEN, CLOSE = 1, 2, 3, 4

    def __init__(self) -> None:
        self.kinds = np.zeros(256, np.uint8)
        for signs, kind in ((b'"', self.QUOTE), (b"\\", self.BACKSLASH), (b"{[", self.OPEN), (b"]", self.CLOSE)):
            self.kinds[list(signs)] = kind

    def outer(self, opening: str) -> int:
        return 1 if opening == "[" else 0

    def signs(self, pieces: pa.Array) -> tuple:
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
        text = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        starts = offsets[:-1] - offsets[0]
        stops = offsets[1:] - offsets[0]
        kinds = self.kinds[text]
        places = np.flatnonzero(kinds)
        kinds = kinds[places]
        quotes = kinds == self.QUOTE
        if (kinds == self.BACKSLASH).any():
            quotes &= ~np.isin(places, self._escaped(places[kinds == self.BACKSLASH], starts))
        n_quotes = np.concatenate([[0], np.cumsum(quotes)])
        step = (kinds == self.OPEN).astype(np.int8) - (kinds == self.CLOSE)
        before = np.searchsorted(places, stops)  # signs before each closing brace
        return n_quotes, step, before

    def follow(self, signs: tuple, state: State, outer: int) -> Scan:
        n_quotes, step, before = signs
        n_quotes = n_quotes + state.quoted
        outside = (n_quotes[:-1] & 1) == 0
        depth = np.concatenate([[0], np.cumsum(step * outside, dtype=np.int64)])
        closes = (n_quotes[before] & 1) == 0
        level = depth[before] - np.cumsum(closes)
        least = int(level[closes].min()) if closes.any() else NONE
        lift = np.maximum.accumulate(np.where(closes, np.maximum(0, outer - state.depth - level), 0))
        ends = closes & (state.depth + level + lift == outer)
        return Scan(ends, bool(n_quotes[-1] & 1), int(depth[-1] - closes.sum()), least)

    @staticmethod
    def _escaped(backslashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Places after every other backslash of a run; a run doesn't go on in the next piece."""
        fresh = np.concatenate([[True], backslashes[1:] != backslashes[:-1] + 1]) | np.isin(backslashes, starts)
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(backslashes)), 0))
        escaping = (np.arange(len(backslashes)) - first) % 2 == 0
        return np.setdiff1d(backslashes[escaping] + 1, starts)


class CsvRecords:
    """CSV records, ``"`` as quote and ``""`` for a quote inside quotes, cut at line breaks.

    A quote opens a text at the beginning of a field only; elsewhere it is a character.
    """

    delimiter, closes = "\n", ""
    at_end, trailer = True, False
    FIELD = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?'
    OPENED = r'"(?:[^"]|"")*'
    FROM_OUTSIDE = rf"^(?:{FIELD},)*{OPENED}$"
    FROM_INSIDE = rf'^(?:[^"]|"")*(?:"(?:[^",][^,]*)?(?:,{FIELD})*,{OPENED})?$'

    def outer(self, opening: str) -> int:
        return 0

    def signs(self, pieces: pa.Array) -> tuple:
        quotes = np.flatnonzero(pc.match_substring(pieces, '"').to_numpy(False))
        some = pieces.take(pa.array(quotes))
        outside, inside = (
            pc.match_substring_regex(some, pattern).to_numpy(False).tolist()
            for pattern in (self.FROM_OUTSIDE, self.FROM_INSIDE)
        )
        return len(pieces), quotes.tolist(), outside, inside

    def follow(self, signs: tuple, state: State, outer: int) -> Scan:
        n, quotes, outside, inside = signs
        changes, states = [0], [state.quoted]
        quoted = state.quoted
        for place, from_outside, from_inside in zip(quotes, outside, inside):
            after = from_inside if quoted else from_outside
            if after != quoted:
                quoted = after
                changes.append(place)
                states.append(after)
        until = np.diff([*changes, n])
        after = np.repeat(np.array(states, bool), until)
        return Scan(~after, quoted, 0, NONE)
