from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerloom.llm import jaccard, substrings
from ledgerloom.llm.common import Scratch
from ledgerloom.llm.components import components
from ledgerloom.llm.jaccard import jaccard_components
from ledgerloom.llm.substrings import Layout, remove_repeats
from tests.conftest import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, n string, kind string, key string, sig string"


def docs(spark, records):
    return spark.createDataFrame([(i, t, "x", "y", "z", "w") for i, t in records], DOCS)


def edited(rnd, words, share):
    return [rnd.choice(["zz", "yy", f"v{rnd.randint(0, 999)}"]) if rnd.random() < share else w for w in words]


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = rnd.choices(vocabulary, k=120)
    texts = [None, "", "  ", "One", "one", "ONE two", "one two three", "one two three", "é É", "a b c d"]
    texts += [" ".join(base)] * 8 + [" ".join(edited(rnd, base, s)) for s in (0.01, 0.02, 0.05, 0.2) for _ in range(12)]
    shared = " ".join(rnd.choices(vocabulary, k=30))
    texts += [f"{shared} {' '.join(rnd.choices(vocabulary, k=rnd.randint(0, 40)))}" for _ in range(40)]
    texts += [" ".join(rnd.choices(vocabulary, k=rnd.randint(1, 60))) for _ in range(60)]
    rnd.shuffle(texts)
    return list(enumerate(texts))


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def linked_by_hand(records):
    sets = {}
    for i, text in records:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[k : k + 4]) for k in range(len(words) - 3)}
        sets[i] = grams or ({tuple(words)} if words else set())
    groups = Union()
    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * same >= 85 * (len(sets[a]) + len(sets[b]) - same):
                groups.join(a, b)
    return {i: (i, len(s), groups.find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("bucket", "sample"), [(32, 4096), (4, 4096), (1, 16)])
def test_jaccard_against_brute_force(spark, monkeypatch, bucket, sample):
    """Small buckets make crowds, which are signed again or compared with a first document."""
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", bucket)
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", sample)
    records = corpus(bucket)
    found = jaccard_components(docs(spark, records))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r[0]: tuple(r) for r in found.collect()} == linked_by_hand(records)


@pytest.mark.parametrize("edits", [1, 2])
def test_a_large_group_just_under_and_over_the_similarity(spark, monkeypatch, edits):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", 6)
    rnd = random.Random(edits)
    base = [f"w{i}" for i in range(70)]
    records = []
    for i in range(150):
        words = list(base)
        for k in rnd.sample(range(70), rnd.randint(edits, edits + 2)):
            words[k] = f"x{i}-{k}"
        records.append((i, " ".join(words)))
    expected = linked_by_hand(records)
    assert len({root for _, _, root in expected.values()}) > 1
    found = jaccard_components(docs(spark, records)).collect()
    assert {r[0]: tuple(r) for r in found} == expected


def test_shingles_of_all_documents_are_counted(spark, monkeypatch):
    """Also of tables larger than SAMPLE_DOCS, from which frequencies once came."""
    import pyarrow as pa

    from ledgerloom.llm.shingles import shingle_sets, word_names

    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 16)
    shared = {7: "some words of seven", 31: "Some words of many", 3: "words of too few"}
    texts = [" ".join([f"a{i} b{i} c{i} d{i}", *(t for n, t in shared.items() if i < n)]) for i in range(400)]
    frame = docs(spark, list(enumerate(texts))).repartition(5).selectExpr("doc_id AS key", "text")
    table = jaccard._frequent(frame, 400, 4)
    tokens, _ = shingle_sets(*word_names(pa.array(shared.values()), lower=True), 4)
    found = table[jaccard._bucket(tokens, len(table))]
    assert sorted(found) == [0, 7, 31]  # fewer than SAMPLE_LEAST aren't frequent


def test_a_slice_is_lowered_without_the_batch_that_it_is_part_of():
    """Each slice once copied the text of its whole batch, several times as much as the slice."""
    import pyarrow as pa

    from ledgerloom.llm.common import lower_ascii

    texts = ["AZ@[`{", "É ẞ Straße X", "", "LONG " * 10_000]
    batch = pa.array(texts, pa.large_string())
    for start, n in ((0, 4), (0, 2), (1, 2), (2, 1), (3, 1), (4, 0)):
        part = batch.slice(start, n)
        by_hand = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in texts[start : start + n]]
        assert lower_ascii(part).to_pylist() == by_hand
    assert lower_ascii(batch.slice(0, 3)).buffers()[2].size < 100


def test_counts_of_large_tables_leave_out_what_every_bucket_has(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAST_BUCKETS", 1 << 12)
    monkeypatch.setattr(jaccard, "MOST_BUCKETS", 1 << 12)
    rnd = random.Random(5)
    texts = [" ".join(f"w{rnd.random()}" for _ in range(203)) + " one of them all" for _ in range(300)]
    frame = docs(spark, list(enumerate(texts))).selectExpr("doc_id AS key", "text")
    table = jaccard._frequent(frame, 300, 4)
    assert len(table) == 4096 and 250 < table.max() < 350 and (table > 0).sum() < 41


def test_jaccard_of_repeated_rows_and_null_keys(spark):
    text, near = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(61))
    records = [(5, text), (5, text), (5, near), (5, "other words of five"), (None, text), (7, None), (8, "x")]
    found = Counter(rows(jaccard_components(docs(spark, records))))
    assert found == Counter([(5, 57, None), (5, 57, None), (5, 58, None), (5, 1, 5), (None, 57, None), (7, 0, 7), (8, 1, 8)])


def test_nothing_to_compare(spark):
    assert rows(jaccard_components(docs(spark, []))) == []
    found = rows(jaccard_components(docs(spark, [(1, None), (2, "")])))
    assert sorted(found) == [(1, 0, 1), (2, 0, 2)]
    assert rows(remove_repeats(docs(spark, []))[0]) == []


def test_components_against_union_find(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(200)] + [(5, 5)]
    groups = Union()
    for a, b in edges:
        groups.join(a, b)
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(frame, Scratch(spark, "test")).collect()}
    assert found == {n: groups.find(n) for n in found} and {a for a, b in edges if a != b} <= set(found)


def repeats_by_hand(records, window=20):
    """Documents in order of id; rows of one id and text are one document."""
    texts = {}
    for i, t in records:
        texts.setdefault((i is not None, i, t), WORD.findall(t or ""))
    order = sorted(texts, key=lambda k: (k[0], k[1] or 0))
    seen, result = set(), {}
    for key in order:
        words, gone = texts[key], set()
        for k in range(len(words) - window + 1):
            gram = tuple(words[k : k + window])
            if gram in seen:
                gone.update(range(k, k + window))
            seen.add(gram)
        result[key[1], key[2]] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return result


def passages(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    shared = [rnd.choices(vocabulary, k=rnd.randint(18, 60)) for _ in range(6)]
    texts = [None, "", " \n", "a " * 19, "a " * 20, "a " * 90, "a b " * 60, "é " * 25, "a b c d e f g " * 20]
    for _ in range(120):
        words = []
        for _ in range(rnd.randint(1, 4)):
            words += rnd.choice(shared) if rnd.random() < 0.5 else rnd.choices(vocabulary, k=rnd.randint(0, 50))
        texts.append(rnd.choice([" ", "\n", "\t "]).join(words))
    texts += rnd.choices(texts, k=20)
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("slice_chars", [2_000_000, 300])
def test_repeats_against_brute_force(spark, monkeypatch, seed, slice_chars):
    import hashlib

    if slice_chars < 2_000_000:  # tasks see a few documents at a time only
        frame = docs(spark, passages(seed)).repartition(40)
    else:
        frame = docs(spark, passages(seed)).coalesce(1)
    expected = repeats_by_hand(passages(seed))
    found, texts = remove_repeats(frame)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {r.doc_id: tuple(r)[1:] for r in found.collect()} == {
        i: (n, gone, digest(kept)) for (i, _), (n, gone, kept) in expected.items()
    }
    by_id = {i: kept for (i, _), (_, _, kept) in expected.items()}
    assert all(r.kept_text == by_id[r.doc_id] for r in texts.collect())


def test_repeated_rows_are_one_document_and_null_keys_come_first(spark):
    text = " ".join(f"w{i}" for i in range(30))
    records = [(3, text), (3, text), (None, text + " tail"), (4, "head " + text), (3, "x " + text)]
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in remove_repeats(docs(spark, records))[0].collect())
    assert got == Counter({(3, 30, 30): 2, (None, 31, 0): 1, (4, 31, 30): 1, (3, 31, 30): 1})


def test_every_window_has_one_anchor_of_its_own(spark):
    """Equal windows have anchors of one name at one place, and none share an anchor."""
    import pyarrow as pa

    texts = [t for _, t in passages(4) if t]
    lay = Layout(pa.array(texts))
    seen, used = defaultdict(set), defaultdict(set)
    for p in range(len(lay.whole)):
        if lay.whole[p]:
            gram = lay.words[p : p + substrings.WINDOW].tobytes()
            a = lay.anchor[p]
            seen[gram].add((int(lay.symbols.name[a]), int(lay.symbols.start[a]) - p) if a >= 0 else None)
            if a >= 0:
                assert int(a) not in used[gram]
                used[gram].add(int(a))
    assert all(len(s) == 1 for s in seen.values()) and len(seen) > 500
