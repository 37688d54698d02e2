from __future__ import annotations

import os
import random
import time

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ledgerloom.llm import pieces
from ledgerloom.llm.common import over_slices
from ledgerloom.llm.decontaminate import GAP, MATCH, MISMATCH, align, find_leaks
from ledgerloom.llm.language import (
    PIECE_CHARS,
    Parser,
    _automaton_of,
    fit_languages,
    held_out,
    identify_languages,
)
from ledgerloom.llm.pieces import PieceModel, encode_pieces
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, score string, ids string, matches string"


def docs(spark, *records):
    return spark.createDataFrame([(i, t, lang, "s", "i", "m") for i, t, lang in records], DOCS)


# language


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
def test_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    moves = fit_languages(table.where(~held_out(F.col("doc_id"))))
    found = identify_languages(table, moves, "doc_id", "lang").where(held_out(F.col("doc_id")))
    right, total = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert total > 200 and right / total > 0.98


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
def test_a_language_with_little_labelled_text(spark):
    """600 characters of one language, full samples of the others: it is still told."""
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    learn = table.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull()).where("lang is not null")
    little = learn.where("lang = 'es'").orderBy("doc_id").limit(5).toPandas()
    short = " ".join(little.text)[:600]
    learn = learn.where("lang != 'es'").select("doc_id", "text", "lang").union(
        spark.createDataFrame([(-1, short, "es")], "doc_id long, text string, lang string")
    )
    found = identify_languages(table, fit_languages(learn), "doc_id", "lang")
    found = found.where(held_out(F.col("doc_id")) & (F.col("lang") == "es"))
    right, total = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert total > 10 and right / total > 0.97


def phrases_by_hand(text, sample):
    count = 0
    for at in range(0, len(text), PIECE_CHARS):
        piece, i = text[at : at + PIECE_CHARS], 0
        while i < len(piece):
            n = 1
            while i + n < len(piece) and piece[i : i + n + 1] in sample and piece[i] in sample:
                n += 1
            i, count = i + n, count + 1
    return count


def test_phrases_against_substring_search():
    rnd = random.Random(3)
    samples = {lang: "".join(rnd.choices(letters, k=400)) for lang, letters in (("p", "abc "), ("q", "bcd "))}
    samples = {k: " ".join(v.split()) for k, v in samples.items()}
    moves = pd.concat([_automaton_of(pd.DataFrame({"lang": [k], "pick": [0], "text": [v]})) for k, v in samples.items()])
    parser = Parser(moves)
    texts = [" ".join("".join(rnd.choices("abcdx ", k=rnd.randint(1, 5000))).split()) for _ in range(40)]
    texts = [t for t in texts if t]
    found = parser.phrases([parser.codes(t) for t in texts])
    assert found.tolist() == [[phrases_by_hand(t, samples[k]) for k in parser.langs] for t in texts]


def test_texts_without_letters_and_nothing_learned(spark):
    table = docs(spark, (1, "ab ab ab", "x"), (2, None, "x"), (3, " 12 !", None), (4, "", "y"), (None, "ab", None), (1, "ab ab ab", "x"), (9, "cd cd", "y"))
    moves = fit_languages(table)
    found = identify_languages(table, moves, "doc_id")
    got = sorted(((r.doc_id, r.lang_pred) for r in found.collect()), key=repr)
    assert got == sorted([(1, "x"), (1, "x"), (2, "und"), (3, "und"), (4, "und"), (9, "y"), (None, "x")], key=repr)
    assert all(0 <= r.score <= 1 for r in found.collect())
    assert rows(identify_languages(table.limit(0), moves, "doc_id")) == []
    nothing = fit_languages(table.limit(0))
    assert {r.lang_pred for r in identify_languages(table, nothing, "doc_id").collect()} == {"und"}


# leaks


def align_by_hand(item, text):
    table = np.zeros((len(item) + 1, len(text) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            step = table[i - 1, j - 1] + (MATCH if a == b else MISMATCH)
            table[i, j] = max(0, step, table[i - 1, j] - GAP, table[i, j - 1] - GAP)
    return table.max()


def test_alignment_against_the_plain_recurrence():
    rnd = random.Random(1)
    for _ in range(60):
        item, text = (np.array(rnd.choices(range(5), k=rnd.randint(1, 25))) for _ in "ab")
        score, start, end, same = align(item, text)
        assert score == align_by_hand(item, text)
        assert 0 <= start <= end <= len(text) and same <= min(len(item), end - start)


def test_copies_and_edited_copies_are_found(spark):
    rnd = random.Random(7)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(3000)]
    say = lambda n: rnd.choices(common, k=n // 2) + rnd.choices(rare, k=n - n // 2)
    items = [rnd.sample(w := say(40), len(w)) for _ in range(20)]
    records, leaks = [], set()
    for i, item in enumerate(items):
        words = [w.upper() if k % 3 else f"{w}," for k, w in enumerate(item)]
        changed = [rnd.choice(rare) if k % 6 == 2 else w for k, w in enumerate(words) if k % 9]
        records += [(100 + i, " ".join([*say(30), *words, *say(30)]), None), (200 + i, " ".join([*say(200), *changed]), None)]
        leaks |= {(100 + i, i), (200 + i, i)}
    records += [(1000 + i, " ".join(say(rnd.randint(1, 400))), None) for i in range(300)]
    records += [(5, None, None), (6, "", None), (7, "x", None), records[0]]
    benchmark = spark.createDataFrame(
        [*[(i, " ".join(w), "k") for i, w in enumerate(items)], (0, " ".join(items[0]), "k"), (77, None, "k"), (78, "", "k"), (None, "c1", "k")],
        "item_id long, text string, doc_id string",
    )
    found = find_leaks(docs(spark, *records), benchmark)
    assert found.count() == len(records) and found.columns == docs(spark).columns
    got = [(r.doc_id, m.item_id, m.score) for r in found.collect() for m in r.matches if m.item_id is not None]
    assert {g[:2] for g in got} == leaks
    assert all(score == 1.0 for d, _, score in got if d < 200)
    assert {r.doc_id: len(r.matches) for r in found.collect()}[5] == 0
    assert {len(r.matches) for r in find_leaks(docs(spark, *records), benchmark.limit(0)).collect()} == {0}
    assert rows(find_leaks(docs(spark), benchmark)) == []


# pieces


def fuzz(n):
    rnd = random.Random(5)
    bits = [*"ab  \n\t▁é́①\x00<s>#😀ة", "  ", "the ", " of", "</s>", "<0x41>", "中文", "▁▁▁", " " * 20]
    return ["".join(rnd.choices(bits, k=rnd.randint(0, 40))) for _ in range(n)]


def test_pieces_against_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [*fuzz(3000), None, "", " ", "a" * 5000, "word " * 20_000, "x\n" * 3000]
    found = encode_pieces(docs(spark, *[(i, t, None) for i, t in enumerate(texts)]), MODEL)
    for r in found.collect():
        text = texts[r.doc_id] or ""
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == library.decode(ids)
        # The pieces' source bytes, one after the other, are the text.
        ends = np.frombuffer(r.ends, "<u4").astype(int)
        source = text.encode()
        assert ends[0] == 0 and ends[-1] == len(source) and (np.diff(ends) >= 0).all()
        model_pieces = [library.id_to_piece(i) for i in ids]
        for piece, a, b in zip(model_pieces[2:-1], ends[1:], ends[2:]):
            if not library.is_byte(library.piece_to_id(piece)):
                assert source[a:b].decode().replace(" ", "▁") == piece
    assert rows(encode_pieces(docs(spark), MODEL)) == []


def test_units_merged_in_step_are_those_merged_alone():
    with open(MODEL, "rb") as file:
        model = PieceModel(file.read())
    rnd = random.Random(6)
    letters = "abcdeghinorst é日▁\n😀0ß"
    units = ["".join(rnd.choices(letters, k=rnd.randint(1, 90))) for _ in range(2000)] + ["a", "x" * 60, "e" * 61]
    found = {}
    for some, names, flat, counts in model.merge_in_step(units):
        parts = iter([names[s] for s in flat])
        found |= {unit: [next(parts) for _ in range(n)] for unit, n in zip(some, counts, strict=True)}
    assert found == {u: model.merge(u) for u in units}
    assert list(model.merge_in_step([])) == []


def _sized(number, data):
    size, out = len(data), bytearray([number << 3 | 2])
    while size > 127:
        out.append(size & 127 | 128)
        size >>= 7
    return bytes([*out, size]) + data


def test_a_model_with_a_real_map_against_the_library(spark, tmp_path):
    """The registered model's pieces behind the map of NFKC: every text goes through it."""
    from ledgerloom.llm.pieces import _fields

    proto = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    blob = next(dict(_fields(v)) for k, v in _fields(proto) if k == 3)[2]
    with open(MODEL, "rb") as file:
        plain = file.read()
    for squeeze in (0, 1):
        data = plain + _sized(3, _sized(2, blob) + bytes([3 << 3, 1, 4 << 3, squeeze, 5 << 3, 1]))
        path = tmp_path / f"mapped-{squeeze}.model"
        path.write_bytes(data)
        library = sentencepiece.SentencePieceProcessor(model_file=str(path))
        texts = [*fuzz(600), "ﬁ①é Ａ b　x ㍿", "ｶﾞ " * 500, "  a  b  ", "　", None, ""]
        found = encode_pieces(docs(spark, *[(i, t, None) for i, t in enumerate(texts)]), str(path)).collect()
        for r in found:
            text = texts[r.doc_id] or ""
            assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True), text
            ends = np.frombuffer(r.ends, "<u4").astype(int)
            assert ends[0] == 0 and ends[-1] == len(text.encode()) and (np.diff(ends) >= 0).all()


def test_a_compiled_character_map(spark):
    """Longest prefixes of a real map give the library's normal form, with its places."""
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = library.serialized_model_proto()
    model = object.__new__(PieceModel)
    from ledgerloom.llm.pieces import CharacterMap, _fields

    norm = next(dict(_fields(v)) for k, v in _fields(proto) if k == 3)
    model.map = CharacterMap(norm[2])
    model.dummy_prefix, model.squeeze, model.escape = (bool(norm.get(i, 1)) for i in (3, 4, 5))
    for text in ["ﬁ①é", "é ｶﾞ", "Ａ b", "　x ㍿", "plain", "", "ａ　ｂ" * 50, "\tq\n", "  a  b  ", "   ", "　"]:
        normal, back = model.normalise(text)
        assert normal == library.normalize(text)
        assert len(back) == len(normal.encode()) + 1 and back[-1] <= len(text.encode())
        assert (np.diff(back) >= 0).all()


def test_a_worker_lets_its_encoder_go_with_the_job(spark):
    table = docs(spark, *((i, f"word {i}", "x") for i in range(64))).repartition(8)
    assert encode_pieces(table, MODEL).agg(F.sum(F.octet_length("ids"))).first()[0] > 0

    def encoders(batches):
        for batch in batches:
            time.sleep(0.2)  # so that all workers get some
            yield pa.RecordBatch.from_pydict({"held": pa.array([len(pieces._ENCODERS)] * batch.num_rows)})

    held = spark.range(0, 32, 1, 32).mapInArrow(encoders, "held long")
    assert {r.held for r in held.collect()} == {0}


def test_an_encoder_is_kept_between_tasks(spark):
    with open(MODEL, "rb") as file:
        data = spark.sparkContext.broadcast(file.read())
    pieces._encoder(data)
    first = pieces._ENCODERS[data]
    pieces._encoder(data)
    assert pieces._ENCODERS[data] is first


def test_a_task_gives_its_freed_memory_back():
    def held():
        with open("/proc/self/status") as file:
            return next(int(line.split()[1]) / 1024 for line in file if line.startswith("RssAnon"))

    def make():
        def work(batch):
            nonlocal kept
            blocks = [bytes(1000) for _ in range(100_000)]  # too small to be mapped one by one
            kept = bytes(1000)  # the last of the heap stays in use
            return batch if blocks else None

        return work

    kept, before = None, held()
    batch = pa.RecordBatch.from_pydict({"text": ["a"]})
    assert [b.num_rows for b in over_slices(make)(iter([batch]))] == [1]
    assert held() - before < 40 and kept
