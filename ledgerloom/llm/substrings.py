"""Removal of repeated passages, found by recompression.

Every window of 20 words has an anchor: a symbol of the recompressed text that its own
words decide, and so the same in every occurrence. Spark counts the anchors' names over all
documents. A window whose anchor occurs once occurs once itself; only the others, under
the shared names, are compared: by name and by a hash of all 20 words, 128 bits together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD_GAP, Scratch, over_slices, split_words
from ledgerloom.llm.recompress import anchors
from ledgerloom.llm.shingles import mix, window_names, word_names

WINDOW = 20


class Layout:
    """The words of a slice one after the other, with an edge behind each text."""

    def __init__(self, texts: pa.Array):
        names, self.counts = word_names(texts)
        place = np.arange(len(names)) + np.repeat(np.arange(len(self.counts)), self.counts)
        size = len(names) + len(self.counts)
        self.words = np.zeros(size, np.uint64)
        self.words[place] = names
        self.edge = np.ones(size, bool)
        self.edge[place] = False
        self.base = np.cumsum(self.counts + 1) - self.counts - 1  # first word of each text
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts + 1)
        edges = np.concatenate(([0], np.cumsum(self.edge)))
        n = max(0, size - WINDOW + 1)
        self.whole = edges[WINDOW:] == edges[:n] if n else np.zeros(0, bool)  # windows in one text
        self.anchor, self.symbols = anchors(self.words, self.edge, WINDOW)


def _lists(of: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """The values of each of n rows; ``of`` is in order."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _scanner() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("text"), "")
        lay = Layout(texts)
        used = np.unique(lay.anchor[lay.whole & (lay.anchor >= 0)])
        at = lay.symbols.start[used]
        order = np.argsort(at)
        used, at = used[order], at[order]
        of = lay.owner[at]
        loose = np.zeros(len(lay.counts), bool)
        loose[lay.owner[np.flatnonzero(lay.whole & (lay.anchor < 0))]] = True
        plain = pc.utf8_trim(pc.replace_substring_regex(texts, WORD_GAP, " "), " ").to_pylist()
        new = {
            "n_words": pa.array(lay.counts),
            "whole": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in plain]),
            "names": _lists(of, lay.symbols.name[used].view(np.int64), len(texts), pa.int64()),
            "starts": _lists(of, (at - lay.base[of]).astype(np.int32), len(texts), pa.int32()),
            "loose": pa.array(loose),
        }
        kept = {name: batch.column(name) for name in ("key", "sig")}
        return pa.RecordBatch.from_pydict(kept | new)

    return work


def _comparer() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Windows under shared names as rows: one for each anchor, with its windows' hashes.

    Of windows that a slice has several times only the first is sent; the others start
    later than another already, and are sent as stretches (no hash, but a length).
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lay = Layout(batch.column("text"))
        starts = batch.column("starts")
        shared = np.zeros(len(lay.words) + 1, bool)
        many = pc.list_value_length(starts).to_numpy(False)
        shared[np.repeat(lay.base, many) + starts.flatten().to_numpy(False)] = True
        anchored = lay.anchor >= 0
        wanted = lay.whole & ~anchored
        at = np.flatnonzero(lay.whole & anchored)
        wanted[at] = shared[lay.symbols.start[lay.anchor[at]]]
        at = np.flatnonzero(wanted)
        hashes = window_names(lay.words, WINDOW, seed=1)[at]
        free = lay.anchor[at] < 0
        names = np.where(free, mix(hashes), np.uint64(0))
        names[~free] = lay.symbols.name[lay.anchor[at[~free]]]
        sigs, keys = batch.column("sig").to_pylist(), batch.column("key").to_pylist()
        rank = _ranks(keys, sigs)[lay.owner[at]]
        offset = at - lay.base[lay.owner[at]]
        order = np.lexsort((offset, rank, hashes, names))
        new = np.ones(len(order), bool)
        a, b = order[1:], order[:-1]
        new[1:] = (names[a] != names[b]) | (hashes[a] != hashes[b])
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        # A repeated row's window is the same window, neither earlier nor later.
        later = (rank[order] != rank[first]) | (offset[order] != offset[first])
        sent, dropped = np.sort(order[new]), np.sort(order[later])
        fresh = np.ones(len(sent), bool)
        fresh[1:] = (
            (np.diff(at[sent]) != 1)
            | (lay.anchor[at[sent[1:]]] != lay.anchor[at[sent[:-1]]])
            | free[sent[1:]]
        )
        runs = sent[fresh]
        gap = np.ones(len(dropped), bool)
        gap[1:] = np.diff(at[dropped]) != 1
        spans = dropped[gap]
        sizes = np.diff(np.append(np.flatnonzero(gap), len(dropped)))
        rows = np.concatenate([runs, spans])
        of = lay.owner[at[rows]]
        lists = np.concatenate([np.cumsum(fresh) - 1, np.zeros(0, np.int64)])
        spread = mix(at[spans].astype(np.uint64) + mix(np.array(sigs, np.int64).view(np.uint64)[lay.owner[at[spans]]]))
        return pa.RecordBatch.from_pydict(
            {
                "name": pa.array(np.concatenate([names[runs], spread]).view(np.int64)),
                "key": batch.column("key").take(pa.array(of)),
                "sig": batch.column("sig").take(pa.array(of)),
                "first": pa.array(offset[rows].astype(np.int32)),
                "many": pa.array(np.concatenate([np.zeros(len(runs)), sizes]).astype(np.int32)),
                "hashes": _lists(lists, hashes[sent].view(np.int64), len(rows), pa.int64()),
            }
        )

    return work


def _ranks(keys: list, sigs: list) -> np.ndarray:
    """Places in document order, null keys first; repeated rows have one place."""
    pairs = [(k is not None, k, s) for k, s in zip(keys, sigs, strict=True)]
    place = {p: i for i, p in enumerate(sorted(set(pairs), key=lambda p: p if p[0] else (False, 0, p[2])))}
    return np.array([place[p] for p in pairs], np.int64)


def _remover() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, counts = split_words(batch.column("text"))
        base = np.cumsum(counts) - counts
        gone = np.zeros(len(words) + 1, np.int64)
        for b, spans in zip(base, batch.column("spans").to_pylist(), strict=True):
            for span in spans:
                gone[b + span["first"]] += 1
                gone[b + span["first"] + span["many"] + WINDOW - 1] -= 1
        keep = np.cumsum(gone[:-1]) == 0
        owner = np.repeat(np.arange(len(counts)), counts)
        left = np.bincount(owner[keep], minlength=len(counts))
        kept = words.filter(pa.array(keep)).to_pylist()
        ends = np.cumsum(left)
        texts = [" ".join(kept[e - n : e]) for e, n in zip(ends, left, strict=True)]
        return pa.RecordBatch.from_pydict(
            {
                "key": batch.column("key"),
                "sig": batch.column("sig"),
                "n_removed": pa.array(counts - left),
                "kept_text": pa.array(texts, pa.string()),
            }
        )

    return work


def remove_repeats(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Which words of which documents lie in a 20-word window that also starts earlier.

    Words are runs of anything but ASCII white space, as they are. Earlier is a smaller
    ``key`` or, in a document, an earlier start; windows are judged on the input, not on
    what is left. Null keys come first. Documents with one key are ordered by a hash of
    their text. Rows repeated whole are one document, which doesn't repeat itself: each
    gets the same result. Null texts have no words.

    Returns two frames. The first has a row for each row of ``docs``: ``key``, ``n_words``,
    ``n_removed`` and ``kept_sha256`` of the words kept, joined by one space. The second
    has ``key``, ``n_removed`` and ``kept_text`` for the documents that lose some words but
    aren't a copy of an earlier one, word by word; such copies of 20 words or more lose all.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    rows = docs.select(F.col(key).alias("key"), F.xxhash64("text").alias("sig"), "text")
    kind = rows.schema["key"].dataType.simpleString()
    scanned = scratch.keep(
        rows.mapInArrow(
            over_slices(_scanner),
            f"key {kind}, sig long, n_words long, whole string, names array<long>, starts array<int>,"
            " loose boolean",
        ),
        "scanned",
    )
    # Copies of whole documents: the first one stands for all of them from here on.
    order = F.struct(F.col("key").isNotNull().alias("present"), "key", "sig")
    kinds = (
        scanned.where(F.col("n_words") >= WINDOW)
        .groupBy("whole")
        .agg(F.min(order).alias("first"), F.max(order).alias("last"))
        .where("first != last")
        .select("whole", "first")
    )
    facts = scanned.select("key", "sig", "n_words", "whole").join(kinds, "whole", "left")
    facts = scratch.keep(
        facts.select("key", "sig", "n_words", "whole", F.coalesce(order != F.col("first"), F.lit(False)).alias("copy")),
        "facts",
    )
    shared = scratch.keep(
        scanned.select(F.explode("names").alias("name"))
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("name"),
        "shared",
    )
    places = scanned.select("key", "sig", F.explode(F.arrays_zip("names", "starts")).alias("at"))
    places = (
        places.select("key", "sig", F.col("at.names").alias("name"), F.col("at.starts").alias("start"))
        .join(shared, "name", "left_semi")
        .select("key", "sig", "start")
        .union(scanned.where("loose").select("key", "sig", F.lit(None).cast("int")))
        .groupBy("key", "sig")
        .agg(F.collect_set("start").alias("starts"))  # no more than a text has words
    )
    firsts = facts.where("copy").select("key", "sig").distinct()
    places = scratch.keep(_match(places, firsts, "left_anti"), "places")
    suspects = scratch.keep(
        _match(rows.where(F.length("text") > 0), places, "inner").select("key", "sig", "text", "starts"),
        "suspects",
    )
    windows = suspects.mapInArrow(
        over_slices(_comparer),
        f"name long, key {kind}, sig long, first int, many int, hashes array<long>",
    ).repartition("name")
    # Windows of one name and hash: all from one slice of text but the first are gone
    # already, so a passage that any number of documents share is a row for each slice.
    same = Window.partitionBy("name", "hash").orderBy(F.col("key").asc_nulls_first(), "sig", "start")
    later = (
        windows.select("name", "key", "sig", "first", "many", F.posexplode_outer("hashes").alias("nth", "hash"))
        .select("name", "hash", "key", "sig", "many", (F.col("first") + F.coalesce("nth", F.lit(0))).alias("start"))
        .withColumn("rank", F.rank().over(same))
        .where("rank > 1 or many > 0")
        .select("key", "sig", F.struct(F.col("start").alias("first"), F.greatest("many", F.lit(1)).alias("many")).alias("span"))
    )
    spans = scratch.keep(later.groupBy("key", "sig").agg(F.collect_set("span").alias("spans")), "spans")
    cleaned = scratch.keep(
        _match(suspects.select("key", "sig", "text"), spans, "inner")
        .mapInArrow(over_slices(_remover), f"key {kind}, sig long, n_removed long, kept_text string")
        .dropDuplicates(["key", "sig"]),
        "cleaned",
    )
    digests = cleaned.select("key", "sig", "n_removed", F.sha2("kept_text", 256).alias("kept"))
    result = _match(facts, digests, "left").select(
        F.col("key").alias(key),
        "n_words",
        F.when(F.col("copy"), F.col("n_words"))
        .otherwise(F.coalesce("n_removed", F.lit(0)))
        .cast("long")
        .alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit("").cast("binary"), 256))
        .otherwise(F.coalesce("kept", "whole"))
        .alias("kept_sha256"),
    )
    return result, cleaned.select(F.col("key").alias(key), "n_removed", "kept_text")


def _match(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on key and text hash, null keys with null keys."""
    other = right.withColumnsRenamed({"key": "key_", "sig": "sig_"})
    same = left["sig"].eqNullSafe(other["sig_"]) & left["key"].eqNullSafe(other["key_"])
    joined = left.join(other, same, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop("key_", "sig_")
