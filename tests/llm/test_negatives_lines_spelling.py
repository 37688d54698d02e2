"""Hard negatives, line bitmaps and spelling variants against brute force and on edge cases."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import lines, negatives, spelling
from ledgerloom.llm.lines import keep_bitmaps, keep_lines
from ledgerloom.llm.negatives import hard_negatives
from ledgerloom.llm.spelling import count_words, near_words, variant_groups
from ledgerloom.llm.strassen import multiply
from tests.conftest import bag

# Column names that the operators use inside, to clash with.
EXTRA = "row string, id string, label_ string, bucket string, v string"


# products


@settings(max_examples=60, deadline=None)
@given(st.tuples(*[st.integers(1, 70)] * 3), st.integers(0, 2**32))
def test_strassen_equals_the_plain_product(shape, seed):
    n, k, m = shape
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**28), 2**28, (n, k)), rng.integers(-(2**27), 2**27, (k, m))
    assert (multiply(a, b) == a @ b).all()


# hard negatives

VECTORS = "vec_id long, label int, embedding array<float>, row string, bucket string, v string"


def vectors(spark, records):
    return spark.createDataFrame([(i, k, v, "a", "b", "c") for i, k, v in records], VECTORS)


def brute_negatives(records, positives=5, count=3, window=(50, 95), every=3):
    kept = {
        (i, k, tuple(math.floor(256 * np.float64(np.float32(x))) for x in v))
        for i, k, v in records
        if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2]))

    def first(anchor, others):
        return sorted(others, key=lambda r: (-score(anchor, r), r[0] is None, r[0] or 0))

    found = []
    for a in (r for r in kept if r[0] is not None and r[0] % every == 0):
        for p in first(a, [r for r in kept if r[1] == a[1] and r != a])[:positives]:
            ps = score(a, p)
            fit = [r for r in kept if r[1] != a[1] and window[0] * ps <= 100 * score(a, r) <= window[1] * ps]
            for rank, n in enumerate(first(a, fit)[:count], 1):
                found.append((a[0], p[0], rank, n[0], ps, score(a, n)))
    return sorted(found, key=str)


@pytest.mark.parametrize("cells", [(4096, 2048, 256), (5, 7, 3)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, cells):
    for name, value in zip(("ANCHOR_ROWS", "CANDIDATE_ROWS", "TILE"), cells):
        monkeypatch.setattr(negatives, name, value)
    rnd = random.Random(3)
    common = [0.5, 0.25, -0.125, 0.75, 0.1]
    records = [(i, rnd.choice([1, 1, 2, 3]), [rnd.uniform(-1, 1) for _ in range(5)]) for i in range(60)]
    records += [(i, rnd.choice([1, 2]), common) for i in range(60, 90)]  # ties of one common vector
    records += [(90, None, common), (93, 1, None), (96, 1, [float("nan")] * 5), (99, 2, [1.0, None, 0.0, 0.0, 0.0])]
    records += [(102, 1, [float("inf"), 0.0]), (105, 2, [0.5]), (108, 1, []), (None, 2, common)]
    records += records[:6]  # repeated whole
    found = hard_negatives(vectors(spark, records), F.col("vec_id") % 3 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_negatives(records)


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives(vectors(spark, []), F.lit(True)).count() == 0
    assert hard_negatives(vectors(spark, [(1, 1, [0.5])]), F.lit(True)).count() == 0


def test_scores_that_may_not_fit_raise(spark):
    with pytest.raises(ValueError, match="may not fit"):
        hard_negatives(vectors(spark, [(1, 1, [1e12]), (2, 2, [1.0])]), F.lit(True))


# lines

LONG = "A line of this licence text that is long enough to count"
DOCS = "doc_id long, text string, doc string, pos int, h1 string, slice string, keep string"


def documents(spark, records):
    return spark.createDataFrame([(i, t, "d", 1, "h", "s", "k") for i, t in records], DOCS)


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(records, chars=40, docs=5):
    held = defaultdict(set)
    for i, text in records:
        for line in (text or "").split("\n"):
            held[key_of(line)].add(-1 if i is None else i)
    last = {k: max(v) for k, v in held.items() if len(k) >= chars and len(v) >= docs}
    found = []
    for i, text in records:
        of = (text or "").split("\n")
        kept = [x for x in of if key_of(x) not in last or (-1 if i is None else i) == last[key_of(x)]]
        found.append((i, "\n".join(kept), len(of), len(of) - len(kept)))
    return Counter(found)


def test_lines_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lines, "LEAST_SLICES", 3)
    rnd = random.Random(5)
    pool = [f"{LONG} {i}" for i in range(12)] + [f"ÉTÉ {LONG} É{i}" for i in range(4)] + ["short", "", " \t"]
    records = [
        (i, "\n".join(rnd.choice([str.upper, str.lower, str])(f"{rnd.choice(['', ' ', chr(9)])}{rnd.choice(pool)}")
                      for _ in range(rnd.randint(0, 9))))
        for i in range(60)
    ]
    records += [(200 + i, LONG) for i in range(30)]  # a crowd of copies
    records += [(60, None), (61, ""), (62, "\n\n"), (None, f"{LONG}\nown"), (63, f"{LONG}\r\nx\r\n{LONG}\n")]
    records += [(5, f"another text\n{LONG}"), records[7], records[7]]  # a shared id, repeated rows
    docs = documents(spark, records)
    found = keep_lines(docs, keep_bitmaps(docs))
    assert Counter(map(tuple, found.collect())) == brute_lines(records)


def test_bitmaps_are_run_lengths(spark):
    text = "\n".join([LONG, LONG, "b", LONG, "c", "d"])
    docs = documents(spark, [(i, text) for i in range(5)])
    keep = {r.doc: (r.n_lines, r.n_dropped, r.keep) for r in keep_bitmaps(docs).collect()}
    assert keep == {**{i: (6, 3, [0, 2, 1, 1, 2]) for i in range(4)}, 4: (6, 0, [6])}


def test_lines_of_a_long_text(spark):
    text = "\n".join(f"{LONG} {i}" for i in range(50_000))
    docs = documents(spark, [(i, text) for i in range(5)])
    found = {r.doc: (r.n_dropped, len(r.text)) for r in keep_lines(docs, keep_bitmaps(docs)).collect()}
    assert found == {**{i: (50_000, 0) for i in range(4)}, 4: (0, len(text))}


def test_lines_of_no_documents(spark):
    docs = documents(spark, [])
    assert keep_lines(docs, keep_bitmaps(docs)).count() == 0


def test_lines_need_no_python(spark):
    docs = documents(spark, [(1, LONG)])
    plan = keep_lines(docs, keep_bitmaps(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# spelling


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [(-n, v) for v, n in counts.items() if is_near(w, v)] for w in counts}
    form = {w: min(c) for w, c in near.items() if c and -min(c)[0] >= 10 * counts[w]}

    def root(w):
        return root(form[w][1]) if w in form else w

    return sorted(
        (w, form[w][1] if w in form else None, root(w), n, len(near[w]), -form[w][0] if w in form else None)
        for w, n in counts.items()
    )


def some_words(seed, letters, count, longest):
    rnd = random.Random(seed)
    words = {"".join(rnd.choices(letters, k=rnd.randint(1, longest))) for _ in range(count)}
    return {w: rnd.choice([2, 3, 20, 25, 400]) for w in words}


@pytest.mark.parametrize("sizes", [(4096, 8192), (16, 5)])
def test_variants_equal_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", sizes[0])
    monkeypatch.setattr(spelling, "HALF_WORDS", sizes[1])
    counts = some_words(1, "abé", 250, 9) | some_words(2, "ab", 60, 4)
    found = variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert sorted(map(tuple, found.collect())) == brute_variants(counts)


def test_a_chain_of_forms_ends_at_one_root(spark):
    counts = {"a" * 7 + "b" * i: 10**i for i in range(1, 9)}
    found = {r.word: r.root for r in variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert set(found.values()) == {"a" * 7 + "b" * 8}


@settings(max_examples=40, deadline=None)
@given(st.sets(st.text("abé\U0001f600", min_size=1, max_size=8), min_size=1, max_size=40))
def test_both_searches_of_a_block_find_every_pair_once(words):
    words = sorted(words)
    total = Counter()
    for role in (0, 1):
        n = len(words)
        block = pa.table(
            {"role": [role] * 2 * n, "word": words * 2, "n": [2] * 2 * n, "asks": [True] * n + [False] * n, "found": [True] * 2 * n}
        )
        for row in spelling._search_block(block).to_pylist():
            total[row["word"]] += row["n_near"]
    assert total == Counter({w: n for w in words if (n := sum(is_near(w, v) for v in words))})


def test_counted_words(spark):
    texts = [(1, "Strange STRANGE strängen, tiny. strange-strange"), (2, None), (3, ""), (None, "strange ÀÉÎÕÜßÿ ÀÉÎÕÜßÿ")]
    texts += [(i, "misspelled words everywhere") for i in range(400)] + [(7, "misspelled " * 30)]
    expected = Counter()
    for i, text in texts:
        for run in "".join(c if c.isalpha() else " " for c in (text or "")).split():
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            expected[run] += 1
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, word string, n int")
    assert bag(count_words(docs)) == sorted((w, n) for w, n in expected.items() if len(w) >= 7 and n >= 2)


def test_no_words(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert near_words(none).count() == 0 and variant_groups(none).count() == 0
    assert count_words(spark.createDataFrame([(1, None)], "doc_id long, text string")).count() == 0
