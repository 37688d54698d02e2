"""Documents with nearly equal sets of word shingles, by prefixes of adaptive length.

Shingles have one order everywhere, rare ones first. Two sets that link share most of
their shingles, so they share one of the first few, and two of the first few and one
more, and so on: a document's prefix of the first n - ceil(t n) + l shingles (t is the
least similarity of a link) meets
that of any document linked with it in l places at least. A document whose prefix holds
shingles that many documents are expected to have gets a longer prefix and a higher l,
so that one shared phrase no longer makes a candidate.

Candidates are held against bitmaps first: bits in which these differ are shingles that
the sets don't share. What is left is counted exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch, beside, give_back, over_slices, slices
from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import shingle_sets, word_names

#: Bytes of text that are signed at a time; the arrays made for them are some twenty times as many.
TEXT_BYTES = 500_000
#: Shingles of all documents are counted in buckets by hash: so many buckets for up to SAMPLE_DOCS
#: documents, twice as many for twice the documents, and the most there are (8 MB of counts). Only
#: order and cost depend on it, no result.
LEAST_BUCKETS, SAMPLE_DOCS, MOST_BUCKETS = 1 << 16, 4096, 1 << 20
#: Buckets whose counts make a row.
COUNTS_A_ROW = 1 << 12
#: Documents, above those of an ordinary bucket, from which on a shingle counts as frequent: so many
#: at least, and so many times the square root of an ordinary bucket's count.
SAMPLE_LEAST, CLEARLY = 4, 4
#: Expected candidates from which on a document must share 2, 3, 4 shingles of its prefix.
COSTS = (64, 1_024, 16_384)
#: Documents with one prefix shingle up to which all its pairs are candidates.
SMALL_BUCKET = 32
#: Bits of the short bitmap that the join of prefixes itself looks at.
SHORT_BITS = 512


class Measure(NamedTuple):
    """What links two documents: words of a shingle, and the least similarity in hundredths."""

    words: int
    percent: int


class Signer:
    """Signs the texts of a slice: size, identity, prefix and bitmap of each shingle set."""

    def __init__(self, measure: Measure, expected: np.ndarray):
        self.measure = measure
        self.expected = expected  # documents that have a shingle, by its bucket

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        names, counts = word_names(batch.column("text"), lower=True)
        tokens, owner = shingle_sets(names, counts, self.measure.words)
        n = np.bincount(owner, minlength=len(counts)).astype(np.int64)
        starts = np.concatenate(([0], np.cumsum(n)))
        cost = self.expected[_bucket(tokens, len(self.expected))]
        order = np.lexsort((cost, owner))  # stable, and tokens are in order within each text
        place = np.arange(len(tokens)) - starts[owner]  # the same before and after sorting
        shared = (self.measure.percent * n + 99) // 100
        first = n - shared + 1
        expected = np.bincount(
            owner, weights=np.where(place < first[owner], cost[order], 0.0), minlength=len(counts)
        )
        need = np.minimum(1 + np.searchsorted(COSTS, expected, "right"), np.maximum(shared, 1))
        prefix = np.minimum(n - shared + need, n)
        chosen = tokens[order][place < prefix[owner]].view(np.int64)
        kinds, bits = [], []
        place = owner * SHORT_BITS + (tokens % np.uint64(SHORT_BITS)).astype(np.int64)
        odd = np.bincount(place, minlength=len(counts) * SHORT_BITS) & 1
        short = np.packbits(odd.astype(np.uint8)).view(np.int64)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            own = tokens[a:b]
            kinds.append(xxhash.xxh3_128_digest(own.tobytes()) if b > a else None)
            bits.append(_bitmap(own))
        kept = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        new = {
            "n": pa.array(n),
            "kind": pa.array(kinds, pa.binary()),
            "need": pa.array(need.astype(np.int32)),
            "prefix": pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(prefix))).astype(np.int32)), pa.array(chosen)
            ),
            "bitmap": pa.array(bits, pa.binary()),
            "short": pa.FixedSizeListArray.from_arrays(pa.array(short), SHORT_BITS // 64).cast(
                pa.list_(pa.int64())
            ),
        }
        return pa.RecordBatch.from_pydict(kept | new)


def _bitmap(tokens: np.ndarray) -> bytes:
    """Whether an odd number of shingles fall on each bit; two to four bits a shingle."""
    size = 64
    while size < 2 * len(tokens):
        size *= 2
    odd = np.bincount((tokens % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _differing_bits(a: bytes, b: bytes) -> int:
    """No more than the shingles in one set alone. A longer bitmap is folded on the shorter."""
    if len(a) > len(b):
        a, b = b, a
    x, y, size = int.from_bytes(a), int.from_bytes(b), len(b)
    while size > len(a):
        size //= 2
        y = (y >> 8 * size) ^ (y & ((1 << 8 * size) - 1))
    return (x ^ y).bit_count()


def _possible(percent: int) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = batch.column("total").to_pylist()
        bits = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), strict=True)
        keep = [
            (100 + percent) * _differing_bits(a, b) <= (100 - percent) * n
            for (a, b), n in zip(bits, total, strict=True)
        ]
        return batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return work


def _setter(words: int) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, counts = word_names(batch.column("text"), lower=True)
        tokens, owner = shingle_sets(names, counts, words)
        n = np.bincount(owner, minlength=len(counts))
        offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
        kinds = [
            xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None
            for own in np.split(tokens, np.cumsum(n)[:-1])
        ]
        sets = pa.ListArray.from_arrays(offsets, pa.array(tokens.view(np.int64)))
        return pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.binary()), "tokens": sets})

    return work


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return (tokens % np.uint64(buckets)).astype(np.int64)


def _counter(words: int, buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: how many of a task's texts have a shingle in each bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in slices(batch, "text", TEXT_BYTES):
                tokens, _ = shingle_sets(*word_names(piece.column("text"), lower=True), words)
                np.add.at(counts, _bucket(tokens, buckets), 1)
        yield _packed(enumerate(np.split(counts, buckets // COUNTS_A_ROW)))
        give_back()

    return run


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: the counts of each part of the table, added up."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in _unpacked(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            totals[part] = totals.get(part, 0) + counts
    yield _packed(totals.items())


def _packed(parts: Iterable[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Parts of a table that aren't all 0, in the least bytes that hold their counts."""
    some = [(part, counts.astype(np.min_scalar_type(counts.max()))) for part, counts in parts if counts.any()]
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array([part for part, _ in some], pa.int32()),
            "counts": pa.array([counts.tobytes() for _, counts in some], pa.binary()),
        }
    )


def _unpacked(parts: Iterable[int], packed: Iterable[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    for part, counts in zip(parts, packed, strict=True):
        yield part, np.frombuffer(counts, f"u{len(counts) // COUNTS_A_ROW}").astype(np.int64)


def _frequent(docs: DataFrame, total: int, words: int) -> np.ndarray:
    """For each bucket of shingles the documents that one of them is expected to have, 0 of rare ones.

    Every document is counted, in a table of fixed size that tasks fill and Spark adds up. What
    an ordinary bucket has, of many rare shingles, is taken off.
    """
    buckets = LEAST_BUCKETS
    while buckets < MOST_BUCKETS and buckets * SAMPLE_DOCS < LEAST_BUCKETS * total:
        buckets *= 2
    schema = "part int, counts binary"
    counted = docs.select("text").mapInArrow(_counter(words, buckets), schema)
    found = counted.repartition("part").mapInArrow(_summed, schema).collect()  # bounded by the table
    counts = np.zeros((buckets // COUNTS_A_ROW, COUNTS_A_ROW), np.int64)
    for part, row in _unpacked([r.part for r in found], [bytes(r["counts"]) for r in found]):
        counts[part] = row
    ordinary = np.median(counts)
    above = counts.ravel() - ordinary
    return np.where(above >= max(SAMPLE_LEAST, CLEARLY * np.sqrt(ordinary)), above, 0).astype(np.float32)


def _pairs(
    postings: DataFrame, signed: DataFrame, percent: int, roots: DataFrame | None = None
) -> DataFrame:
    """Documents that share as many prefix shingles as both prefixes together demand.

    Sizes too different to link are left out, and sets whose short bitmaps differ in more
    bits than linked sets differ in shingles; with ``roots`` also documents that are
    linked already.
    """
    told = signed.select("id", "short", F.col("id").alias("root"))
    if roots is not None:
        told = (
            told.drop("root")
            .join(roots.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("root", F.coalesce("root", "id"))
        )
    postings = postings.join(told, "id")
    differ = " + ".join(f"bit_count(short1[{i}] ^ short2[{i}])" for i in range(SHORT_BITS // 64))
    left, right = (postings.select([F.col(c).alias(f"{c}{k}") for c in postings.columns]) for k in "12")
    return (
        left.join(right, F.col("token1") == F.col("token2"))
        .where(f"id1 < id2 and root1 != root2 and 100 * least(n1, n2) >= {percent} * greatest(n1, n2)")
        .where(f"{100 + percent} * ({differ}) <= {100 - percent} * (n1 + n2)")
        .groupBy(F.col("id1").alias("a"), F.col("id2").alias("b"))
        .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("need1", "need2")).alias("need"))
        .where("shared >= need")
        .select("a", "b")
    )


def _links(
    pairs: DataFrame, signed: DataFrame, docs: DataFrame, measure: Measure, scratch: Scratch, name: str
) -> DataFrame:
    """The pairs whose sets are similar enough, counted exactly."""
    bits = signed.select("id", "n", "bitmap")
    with_bits = (
        pairs.join(bits.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("bits_a")), "a")
        .join(bits.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("bits_b")), "b")
        .select("a", "b", (F.col("na") + F.col("nb")).alias("total"), "bits_a", "bits_b")
    )
    possible = scratch.keep(
        with_bits.mapInArrow(
            over_slices(lambda: _possible(measure.percent), "bits_a"), "a long, b long"
        ),
        f"{name}-possible",
    )
    ids = possible.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = scratch.keep(
        signed.join(ids, "id", "left_semi").select("id", "key", "kind"), f"{name}-wanted"
    )
    keys = wanted.select("key").distinct()
    texts = docs.join(keys, docs["key"].eqNullSafe(keys["key"]), "left_semi")
    sets = texts.select("text").mapInArrow(
        over_slices(lambda: _setter(measure.words), chars=TEXT_BYTES), "kind binary, tokens array<long>"
    )
    sets = scratch.keep(
        sets.dropDuplicates(["kind"]).join(wanted.select("id", "kind"), "kind").select("id", "tokens"),
        f"{name}-sets",
    )
    both = possible.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b"
    )
    same = F.size(F.array_intersect("x", "y"))
    return scratch.keep(
        both.select("a", "b", same.alias("same"), (F.size("x") + F.size("y")).alias("total"))
        .where(f"100 * same >= {measure.percent} * (total - same)")
        .select("a", "b"),
        f"{name}-links",
    )


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", words: int = 4, percent: int = 85
) -> DataFrame:
    """Size of each document's shingle set, and the least key that its links lead to.

    Words are lower-cased (A-Z). A set holds the different shingles of ``words`` words; a
    text of fewer words is one shingle; one without words, or null, has none and is linked
    with nothing. Two documents link if their sets' Jaccard similarity is ``percent``
    hundredths or more, equal sets always. Returns ``key``, ``n_shingles`` and ``component_id``, a row for each row
    of ``docs``: repeated rows are linked. A null key is the least one. An empty table
    gives an empty result; other columns are not read.

    Equal sets become one before anything is joined. A shingle that still has very many
    documents in its prefix lists makes no pairs at first; its documents are signed again
    with frequencies estimated among themselves, where what they share no longer counts
    as rare. If that doesn't divide them they really are alike: then each is compared with
    one of them, and only those not linked by that with the others.
    """
    measure = Measure(words, percent)
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows = docs.select(F.col(key).alias("key"), "text")
    total = rows.count()
    signed = scratch.keep(_sign(rows, total, measure), "signed")
    # One document for each different set; the hash of equal sets is pre-aggregated.
    kinds = scratch.keep(
        signed.where("n > 0").groupBy("kind").agg(F.min("id").alias("id")), "kinds"
    )
    # Of so many ids, a row for nearly each document, Spark would plan with a seventh of a small file
    # and broadcast them, in many times that; so they are shuffled.
    distinct = signed.join(kinds.select("id").hint("merge"), "id", "left_semi")
    now, part, level, pairs, links = distinct, rows, 1, [], None
    while True:
        postings = now.select("id", "n", "need", F.explode("prefix").alias("token"))
        sizes = postings.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        postings = scratch.keep(postings.join(sizes, "token"), f"postings-{level}")
        large = postings.where(F.col("size") > SMALL_BUCKET)
        crowd = scratch.keep(large.select("id").distinct(), f"crowd-{level}")
        n_crowd = crowd.count()
        if not n_crowd:
            pairs.append(_pairs(postings, now, percent))
            break
        if 2 * n_crowd > total:  # alike: compare with the first document of each bucket
            star = large.groupBy("token").agg(F.min("id").alias("a"))
            star = large.join(star, "token").where("a < id").select("a", F.col("id").alias("b")).distinct()
            links = _links(star, distinct, part, measure, scratch, "star")
            pairs.append(_pairs(postings, now, percent, components(links, scratch, "star-roots")))
            break
        pairs.append(_pairs(postings.where(F.col("size") <= SMALL_BUCKET), now, percent))
        members = distinct.join(crowd, "id", "left_semi").select("key").distinct()
        level, total = level + 1, n_crowd
        part = scratch.keep(
            part.join(members, part["key"].eqNullSafe(members["key"]), "left_semi"), f"part-{level}"
        )
        again = _sign(part, total, measure).drop("id").dropDuplicates(["kind"]).join(kinds, "kind")
        now = scratch.keep(again.join(crowd, "id", "left_semi"), f"signed-{level}")
    all_pairs = pairs[0]
    for more in pairs[1:]:
        all_pairs = all_pairs.union(more)
    found = _links(all_pairs.distinct(), distinct, rows, measure, scratch, "pairs")
    links = found if links is None else links.union(found)
    roots = components(links, scratch).withColumnRenamed("node", "id")
    # From a set to its documents: the least key over all of a component's sets.
    by_kind = signed.where("n > 0").groupBy("kind").agg(F.min_by("key", F.struct(F.col("key").isNotNull(), "key")).alias("least"))
    rooted = kinds.join(by_kind, "kind").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = rooted.groupBy("root").agg(F.min_by("least", F.struct(F.col("least").isNotNull(), "least")).alias("component_id"))
    named = scratch.keep(rooted.join(least, "root").select("kind", "component_id"), "named")
    return signed.join(named, "kind", "left").select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"),
    )


def _sign(rows: DataFrame, total: int, measure: Measure) -> DataFrame:
    model = rows.sparkSession.sparkContext.broadcast(_frequent(rows, total, measure.words))
    numbered = rows.select(F.monotonically_increasing_id().alias("id"), "key", "text")
    return numbered.mapInArrow(
        over_slices(lambda: Signer(measure, model.value), chars=TEXT_BYTES),
        beside(
            numbered,
            "text",
            "n long, kind binary, need int, prefix array<long>, bitmap binary, short array<long>",
        ),
    )
