"""Spelling variants: words one code point apart, and the frequent form that each belongs to."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch
from ledgerloom.llm.fm_index import FmIndex, Words, one_error_before

#: Words of an index, about, and the most that one half of a word brings into one.
BLOCK_WORDS, HALF_WORDS = 4_096, 8_192


def near_words(words: DataFrame) -> DataFrame:
    """How many near words each word has, and the best of them: ``word, n_near, near, near_n``.

    ``words`` has different, non-null words (``word``) and their counts (``n``). Two words are near if
    one inserted, deleted or replaced code point makes one from the other. The best has the largest
    count, ties go to the smallest in code-point order. Words without any are left out.

    One error leaves one half of a word as it is: a near word has the left half as its
    start or the right half as its end. Words are dealt by halves, those that may be found under
    each half that a word one longer or shorter would look for, and packed into blocks
    of bounded size. A block holds an FM-index of its words, of the words reversed for left
    halves, so that each search of the scheme runs from its exact half over the other in one
    direction. A half that very many words share is cut into slices of words to be found;
    those that look for them go to each slice.
    """
    half = F.floor(F.length("word") / 2).cast("int")
    # A word is looked for by words of its length, one more and one less; two of these have equal halves.
    odd = F.length("word") % 2 == 1
    other = F.when(odd, half + 1).otherwise(half - 1)
    # What looks for a word under its right half may have a right half longer or shorter by one.
    right = F.length("word") - half
    other_right = F.when(odd, right - 1).otherwise(right + 1)
    entries = words.select(
        "word",
        "n",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(role).alias("role"), text.alias("half"), F.lit(asks).alias("asks"))
                    for role, asks, text in [
                        (0, True, F.left("word", half)),
                        (0, False, F.left("word", other)),
                        (1, True, F.right("word", right)),
                        (1, False, F.right("word", other_right)),
                    ]
                ]
            )
        ).alias("entry"),
    ).select("word", "n", "entry.*")
    scratch = Scratch(words.sparkSession, "halves")
    halves = scratch.keep(
        entries.groupBy("role", "half")
        .count()
        .where(F.col("count") > HALF_WORDS)
        .select("role", "half", F.ceil(F.col("count") / HALF_WORDS).cast("int").alias("slices")),
        "hot",
    )
    told = entries.join(halves, ["role", "half"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    every = F.sequence(F.lit(0), F.col("slices") - 1)
    one = F.array(F.pmod(F.xxhash64("word"), F.col("slices")).cast("int"))
    # What asks is also to be found, in its own slice.
    placed = told.withColumn("own", one[0]).withColumn("slice", F.explode(F.when(F.col("asks"), every).otherwise(one)))
    n_words = words.count()
    blocks = max(1, math.ceil(4 * n_words / BLOCK_WORDS / 2))
    rows = placed.select(
        "role",
        F.pmod(F.xxhash64("half", "slice"), F.lit(blocks)).cast("int").alias("block"),
        "word",
        "n",
        "asks",
        (F.col("slice") == F.col("own")).alias("found"),
    )
    tasks = max(1, min(2 * blocks, max(blocks // 8, 2 * words.sparkSession.sparkContext.defaultParallelism)))
    partial = (
        rows.repartition(tasks, "role", "block")
        .groupBy("role", "block")
        .applyInArrow(_search_block, "word string, n_near long, near string, near_n long")
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    return (
        partial.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    )


def _search_block(block: pa.Table) -> pa.Table:
    """All searches of one block.

    A pair that both halves would find counts for the right one. A word that lies in the block
    for another half than the one that is asked for counts where it lies for that.
    """
    by_left = block["role"][0].as_py() == 0
    listed = block.filter(block["found"])
    lies_for = {
        (_half(word, by_left, own), word)
        for word, own in zip(listed["word"].to_pylist(), listed["asks"].to_pylist())
    }
    found, counts = _different(listed)
    asking, _ = _different(block.filter(block["asks"]))
    halves = np.fromiter((len(w) // 2 for w in asking), np.int64, len(asking))
    exact = halves if by_left else np.fromiter(map(len, asking), np.int64, len(asking)) - halves
    turned = (lambda w: w[::-1]) if by_left else (lambda w: w)
    indexed = Words([turned(w) for w in found])
    queries = Words([turned(w) for w in asking], indexed.letters)
    query, near = one_error_before(FmIndex(indexed), queries, exact)
    once = np.zeros(len(query), bool)
    for place, (q, v) in enumerate(zip(query.tolist(), near.tolist())):
        asked, other = asking[q], found[v]
        once[place] = (_half(asked, by_left), other) in lies_for and not (
            by_left and other.endswith(_half(asked, False))
        )
    query, near = query[once], near[once]
    n = counts[near]
    rank = np.argsort(np.argsort(np.array(found, object))) if found else np.empty(0, np.int64)
    order = np.lexsort((rank[near], -n, query))
    query, near, n = query[order], near[order], n[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
    return pa.table(
        {
            "word": pa.array([asking[q] for q in query[first].tolist()], pa.string()),
            "n_near": pa.array(np.diff(np.r_[first, len(query)]), pa.int64()),
            "near": pa.array([found[v] for v in near[first].tolist()], pa.string()),
            "near_n": pa.array(n[first], pa.int64()),
        }
    )


def _half(word: str, left: bool, own: bool = True) -> str:
    """A word's left or right half; or the half of the words, longer or shorter by one, that differs."""
    n = len(word)
    middle = n // 2
    if not own:  # both halves meet one place later in the longer words, one earlier in the shorter
        middle += 1 if n % 2 else -1
    return word[:middle] if left else word[middle:]


def _different(rows: pa.Table) -> tuple[list[str], np.ndarray]:
    once = rows.group_by("word").aggregate([("n", "max")])
    return once["word"].to_pylist(), once["n_max"].to_numpy()


def variant_groups(words: DataFrame, factor: int = 10) -> DataFrame:
    """Each word with its frequent form and the last form that forms lead to.

    ``words`` as for ``near_words``. Returns ``word, form, root, n, n_near, form_n``: the form is the best
    near word if its count is at least ``factor`` times the word's, else null; the root is
    reached from the word by following forms, and is the word itself where there is none. As
    counts grow by ``factor`` with each step, a few rounds of doubling reach all roots.
    """
    scratch = Scratch(words.sparkSession, "variants")
    known = scratch.keep(words.select("word", "n"), "words")
    near = near_words(known)
    told = scratch.keep(
        known.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("near_n") >= factor * F.col("n"), F.struct("near", "near_n")).alias("form"),
        ),
        "near",
    )
    steps = scratch.keep(told.where("form is not null").select("word", F.col("form.near").alias("root")), "step-0")
    most = known.agg(F.max("n")).first()[0] or 1
    hops = 1
    while factor**hops <= most:  # a chain of more hops would need a larger count
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        doubled = steps.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        hops *= 2
        steps = scratch.keep(doubled, f"step-{hops}")
    return told.join(steps, "word", "left").select(
        "word",
        F.col("form.near").alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        F.col("form.near_n").alias("form_n"),
    )


def count_words(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_chars: int = 7, least: int = 2
) -> DataFrame:
    """Words of all whole texts with their counts: ``word, n``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. Where 31 divides the CRC-32 of
    ``<id>:<run>`` the run loses the code point at that number modulo its length, as a
    document's own misspelling. Words of ``least_chars`` code points and ``least`` occurrences are
    returned. Null and empty texts have none, repeated rows count each, and with a null id no run
    loses anything.
    """
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    whole = F.col(f"`{text}`")
    lowered = F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(
        F.translate(whole, capitals, capitals.lower())
    )
    # A run that is too short from the start can't become a word, so only long ones are taken out.
    runs = F.regexp_extract_all(lowered, F.lit(f"[a-zÀ-ÿ]{{{least_chars},}}"), 0)
    exploded = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.explode(runs).alias("run"))
    hashed = exploded.withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.left("run", place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run"))
    return (
        hashed.select(word.alias("word"))
        .where(F.length("word") >= least_chars)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
    )
