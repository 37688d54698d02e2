"""What the corpus operators share: reading tables, scratch tables, words."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.paths import delete, work_dir

#: Characters of text that an operator in Python takes at a time, so that its memory
#: doesn't depend on how many long texts an Arrow batch holds. A single longer text is
#: taken alone.
SLICE_CHARS = 2_000_000

#: Words are runs of anything but space and the five ASCII white space controls.
WORD_GAP = r"[\x20\x09-\x0D]+"


#: The folder that holds the package.
HOME = str(Path(__file__).resolve().parents[2])


def find_package(spark: SparkSession) -> None:
    """Python workers on this machine get to know where the package is.

    On a cluster the package is installed or sent along (``--py-files``), as always. To be
    called before the session's first work in Python: executors start workers, and a process
    that forks them, anew for another environment, and the old ones keep their memory.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if HOME not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [HOME, known]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Python workers on this machine get to know where the package is."""
    find_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders of scratch tables made while ``scratch_until_done`` is in force, if it is.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch_until_done(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch tables that operators make inside, at the end.

    For a caller that has by then written down what it needs of their results. Shuffle files go
    with the frames that wrote them; Spark's cleaner sees that these are gone when the
    driver's garbage is collected, which may otherwise take half an hour.
    """
    token = _made.set([])
    try:
        yield
    finally:
        for root in _made.get():
            delete(spark, root)
        _made.reset(token)
        gc.collect()
        spark._jvm.System.gc()


class Scratch:
    """Tables that one call of an operator writes and rereads.

    A written table cuts the lineage: a later failure recomputes from it, not from the
    input, and what a nondeterministic partitioning decided once stays decided.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, work_dir(spark, label)
        if _made.get() is not None:
            _made.get().append(self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        delete(self.spark, f"{self.root}/{name}")


def beside(df: DataFrame, text: str, columns: str) -> T.StructType:
    """The schema of ``df`` with ``columns`` in the place of the column ``text``."""
    kept = [field for field in df.schema if field.name != text]
    return T.StructType(kept + T.StructType.fromDDL(columns).fields)


def slices(batch: pa.RecordBatch, text: str, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``chars`` bytes of the column ``text``."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(False))
    start = 0
    while start < batch.num_rows:
        below = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, below + chars, "right")))
        yield batch.slice(start, end - start)
        start = end


def give_back() -> None:
    """What Arrow and the C library keep of freed memory goes back to the system.

    A Python worker outlives its tasks; what it keeps, the executor's next work lacks.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def over_slices(
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    text: str = "text",
    chars: int = SLICE_CHARS,
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow``: ``make`` sets up a task, its result takes each slice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # of a task before that served another job
        work = make()
        batch = piece = None
        for batch in batches:
            for piece in slices(batch, text, chars):
                yield work(piece)
        del work, batch, piece
        give_back()

    return run


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after the other, and the number of words of each text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if lower:
        texts = lower_ascii(texts)
    parts = pc.split_pattern_regex(texts, WORD_GAP)
    flat, owner = parts.flatten(), pc.list_parent_indices(parts).to_numpy(False)
    real = pc.not_equal(flat, "")  # what precedes a leading gap or follows a trailing one
    flat = flat.filter(real)
    counts = np.bincount(owner[real.to_numpy(False)], minlength=len(texts))
    return flat, counts.astype(np.int64)


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z in lower case; bytes of other characters are never in that range.

    Of a slice only its own bytes are copied, not those of the batch that it is part of.
    """
    if not len(texts):
        return texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].copy()
    upper = data - np.uint8(65) < 26  # wraps around below A
    data |= upper.view(np.uint8) << np.uint8(5)
    return pa.Array.from_buffers(
        texts.type, len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data)]
    )


def word_codes(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """A number for each word, and the different words by number."""
    encoded = words.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.to_numpy(False).astype(np.int64), encoded.dictionary.to_pylist()
