"""Benchmark passages in training text: rare n-gram seeds, then local alignment.

Every three words in a row of a benchmark item are a seed if they are rare, that is, if
the frequencies of the three words in the corpus make them unlikely to meet by chance.
Unlike a count of the seed itself that doesn't hide an item which many documents have
copied. Around a seed in a document the item is aligned with the text by
Smith-Waterman, so words that were changed, left out or put in cost a little each.

The benchmark is a stated set of queries held against all documents: it is taken in
blocks of bounded size, each broadcast, and no document is joined with another.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import beside, slices

SEED_WORDS = 3
#: A seed is rare if chance would put it at fewer than one in 2**20 places.
RARE_BITS = 20.0
MATCH, MISMATCH, GAP = 2.0, -1.0, 1.0
#: Bytes of benchmark text that are broadcast at a time.
BLOCK_BYTES = 4_000_000
_BREAK = r"[^\p{L}\p{N}]+"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of letters and digits in lower case, and how many each text has."""
    texts = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    parts = pc.split_pattern_regex(texts, _BREAK)
    flat, owner = parts.flatten(), pc.list_parent_indices(parts).to_numpy(False)
    real = pc.not_equal(flat, "")
    return flat.filter(real), np.bincount(owner[real.to_numpy(False)], minlength=len(texts))


@dataclass
class Index:
    """A block of the benchmark: its words, its items as word numbers, its seeds."""

    words: pa.Array
    items: list[np.ndarray]
    keys: dict[int, np.ndarray] = field(default_factory=dict)  # by seed length, sorted
    item_of: dict[int, np.ndarray] = field(default_factory=dict)
    place_of: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def of(cls, texts: list[str | None]) -> Index:
        flat, counts = _words(pa.array(texts, pa.string()))
        encoded = flat.dictionary_encode()
        codes = encoded.indices.to_numpy(False).astype(np.int64)
        return cls(encoded.dictionary, np.split(codes, np.cumsum(counts)[:-1]))

    def numbers(self, flat: pa.Array) -> np.ndarray:
        """The block's number of each word, -1 for a word it hasn't."""
        return pc.fill_null(pc.index_in(flat, self.words), -1).to_numpy(False).astype(np.int64)

    def seed(self, counts: np.ndarray, total: int) -> None:
        """Choose the rare seeds of each item; of an item without any, its rarest.

        An item shorter than a seed is a seed as a whole.
        """
        bits = math.log2(max(total, 1) + 1) - np.log2(np.maximum(counts, 1))
        found: dict[int, list[tuple[int, int, int]]] = {}
        for i, item in enumerate(self.items):
            n = min(SEED_WORDS, len(item))
            if not n:
                continue
            seeds = np.lib.stride_tricks.sliding_window_view(item, n)
            rarity = bits[seeds].sum(axis=1)
            chosen = np.flatnonzero(rarity >= min(RARE_BITS, rarity.max()))
            keys = _keys(item, n, len(self.words))
            found.setdefault(n, []).extend((keys[k], i, k) for k in chosen)
        for n, rows in found.items():
            table = np.array(sorted(rows), np.int64)
            self.keys[n], self.item_of[n], self.place_of[n] = table.T

    def hits(self, codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Rows of text, item, place in all words, place in the item."""
        rows = []
        for n, keys in self.keys.items():
            size = len(codes) - n + 1
            if size < 1:
                continue
            known = codes[:size] >= 0
            for k in range(1, n):
                known &= codes[k : size + k] >= 0
            at = np.flatnonzero(known & (owner[:size] == owner[n - 1 :]))
            wanted = sum(codes[at + k] * len(self.words) ** (n - 1 - k) for k in range(n))
            low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
            many = high - low
            entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            place = np.repeat(at, many)
            rows.append(np.stack([owner[place], self.item_of[n][entry], place, self.place_of[n][entry]], 1))
        return np.concatenate(rows) if rows else np.zeros((0, 4), np.int64)


def _keys(codes: np.ndarray, n: int, words: int) -> np.ndarray:
    size = len(codes) - n + 1
    return sum(codes[k : size + k] * words ** (n - 1 - k) for k in range(n))


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int, int]:
    """Best local alignment: score, first and last word of the text, words that match."""
    across = np.arange(len(text) + 1) * GAP
    rows = [np.zeros(len(text) + 1)]
    for word in item:
        above = rows[-1]
        row = np.zeros(len(text) + 1)
        row[1:] = np.maximum(above[:-1] + np.where(text == word, MATCH, MISMATCH), above[1:] - GAP)
        np.maximum(row, 0, out=row)
        # A gap along the text: the best start before, less the words left out since.
        rows.append(np.maximum.accumulate(row + across) - across)
    table = np.stack(rows)
    i, j = np.unravel_index(table.argmax(), table.shape)
    best, end, same = float(table[i, j]), int(j), 0
    while table[i, j] > 0:
        here = MATCH if text[j - 1] == item[i - 1] else MISMATCH
        if table[i, j] == table[i - 1, j - 1] + here:
            same += here > 0
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] - GAP:
            i -= 1
        else:
            j -= 1
    return best, int(j), end, same


def _passages(hits: np.ndarray, size: int, first: int, last: int) -> Iterator[tuple[int, int]]:
    """Windows of the text in which an item of ``size`` words may lie, overlapping ones joined.

    The text's words are numbers ``first`` to ``last``. A copy may be half as long again.
    """
    slack = size // 2 + 2
    starts = np.sort(hits[:, 2] - hits[:, 3]) - slack
    begin = end = None
    for start in starts:
        low, high = max(first, start), min(last, start + size + 2 * slack)
        if end is None or low > end:
            if end is not None:
                yield begin, end
            begin, end = low, high
        else:
            end = max(end, high)
    if end is not None:
        yield begin, end


def _word_counter(index: Index) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(index.words) + 1, np.int64)  # the last one: words not in the block
        for batch in batches:
            for piece in slices(batch, "text"):
                codes = index.numbers(_words(piece.column("text"))[0])
                counts += np.bincount(codes % len(counts), minlength=len(counts))
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(np.arange(len(counts))), "n": pa.array(counts)}
        )

    return run


def _aligner(index: Index, ids: pa.Array, least: float):
    kind = pa.struct(
        [("item_id", ids.type), ("score", pa.float64()), ("n_same", pa.int64())]
        + [("first_word", pa.int64()), ("end_word", pa.int64())]
    )
    names = ids.to_pylist()

    def found(texts: pa.Array) -> list[list[dict]]:
        flat, counts = _words(texts)
        codes = index.numbers(flat)
        owner = np.repeat(np.arange(len(texts)), counts)
        start = np.concatenate(([0], np.cumsum(counts)))
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        hits = index.hits(codes, owner)
        hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
        cuts = np.flatnonzero((np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) != 0)) + 1
        for group in np.split(hits, cuts) if len(hits) else []:
            doc, i = int(group[0, 0]), int(group[0, 1])
            item = index.items[i]
            best = (0.0, 0, 0, 0)
            for low, high in _passages(group, len(item), start[doc], start[doc + 1]):
                score, a, b, same = align(item, codes[low:high])
                if score > best[0]:
                    best = (score, int(low - start[doc]) + a, int(low - start[doc]) + b, same)
            share = best[0] / (MATCH * len(item))
            if share >= least:
                out[doc].append(
                    {"item_id": names[i], "score": round(share, 6), "n_same": int(best[3])}
                    | {"first_word": best[1], "end_word": best[2]}
                )
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                matches = pa.array(found(piece.column("text")), pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, matches], names=[*piece.schema.names, "_matches"]
                )

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, least_score: float = 0.4) -> DataFrame:
    """``docs`` with ``matches``: the benchmark items that each text has, as copies or edited.

    ``benchmark`` has ``item_id`` and ``text``. A match has ``item_id``; ``score``, the
    alignment's score as a share of that of the whole item unchanged; ``n_same``, the words
    that are equal; and ``first_word`` and ``end_word``, the place in the text, counted in
    words. An item is matched once in a text, where it fits best, if the score is
    ``least_score`` or more: with half of an item copied word for word it is 0.5.

    Upper case and what stands between words don't matter. Word frequencies are counted
    over all documents. Null and empty texts match nothing; repeated items are matched each;
    an item shorter than a seed must be found whole. All rows and columns of ``docs`` stay
    (one named ``matches`` would be replaced); with an empty benchmark all lists are empty.
    """
    spark = docs.sparkSession
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    match = f"struct<item_id: {id_type}, score: double, n_same: bigint, first_word: bigint, end_word: bigint>"
    # What a row has beside its text goes along as one column, so that no name in it can clash.
    kept = [c for c in docs.columns if c != "matches"]
    out = docs.select(
        F.struct(F.lit(0), *[F.col(f"`{c}`") for c in kept if c != "text"]).alias("row"),
        "text",
        F.array().cast(f"array<{match}>").alias("matches"),
    )
    schema = beside(out, "", f"_matches array<{match}>")
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        items = benchmark.where(F.length("text") > 0).where(mine).select("item_id", "text").toArrow()
        if not items.num_rows:
            continue
        index = Index.of(items.column("text").to_pylist())
        shared = spark.sparkContext.broadcast(index)
        counts = np.zeros(len(index.words) + 1, np.int64)
        counted = docs.select("text").mapInArrow(
            lambda batches, shared=shared: _word_counter(shared.value)(batches), "word long, n long"
        )
        for word, n in counted.groupBy("word").agg(F.sum("n")).collect():  # the block's words
            counts[word] = n
        index.seed(counts[:-1], int(counts.sum()))
        ids = items.column("item_id").combine_chunks()
        shared = spark.sparkContext.broadcast((index, ids))
        out = (
            out.mapInArrow(
                lambda batches, shared=shared: _aligner(*shared.value, least_score)(batches),
                schema,
            )
            .withColumn("matches", F.concat("matches", "_matches"))
            .drop("_matches")
        )
    return out.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in kept], "matches")
