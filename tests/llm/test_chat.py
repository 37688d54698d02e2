from __future__ import annotations

import random


from ledgerloom.llm.chat import END, START, prefix_examples, read_examples
from tests.conftest import rows

SCHEMA = "conv_id long, turn long, role string, text string, turns string, example long"


def turns(spark, *records):
    return spark.createDataFrame([(*r, "x", 1) for r in records], SCHEMA)


def test_examples_of_a_conversation(spark):
    found = prefix_examples(
        turns(spark, (1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "assistant", "bé"), (1, 3, "assistant", ""), (1, 4, "user", "e"))
    ).orderBy("example")
    first = f"{START}user\na{END}{START}assistant\nbé{END}"
    second = f"{first}{START}user\nc{END}{START}assistant\n{END}"
    third = f"{second}{START}user\ne{END}"
    table = rows(found.select("n_turns", "text", "loss_start", "loss_end"))
    assert [t[:2] for t in table] == [(2, first), (4, second), (5, third)]
    assert [t[1][t[2] : t[3]] for t in table[:2]] == ["bé", ""] and table[2][2:] == (None, None)


def test_hostile_texts_come_back(spark):
    rnd = random.Random(9)
    bits = ["<|im_start|>", "<|im_end|>", "\n", "<", "|", ">", "<|", "<||", "\\", "\\n", "assistant", "user\n", "é", "", "$1", "\\E"]
    say = lambda: "".join(rnd.choices(bits, k=rnd.randint(0, 8)))
    records = [(c, t, rnd.choice(["assistant", "user", say()]), say()) for c in range(150) for t in range(rnd.randint(1, 6))]
    told = {}
    for c, _, role, text in records:
        told.setdefault(c, []).append((role, text))
    found = read_examples(prefix_examples(turns(spark, *records))).collect()
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in found} == told
    assert {r.conv_id: r.targets for r in found} == {c: [t for r, t in ts if r == "assistant"] for c, ts in told.items()}


def test_nulls_ties_and_repeated_rows(spark):
    found = read_examples(
        prefix_examples(
            turns(spark, (None, 0, "user", "a"), (5, None, None, None), (5, 1, "assistant", "b"), (5, 1, "assistant", "b"), (5, 1, "assistant", "a"))
        )
    )
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in found.collect()}
    assert got == {None: [("user", "a")], 5: [("", ""), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]}
    assert rows(read_examples(prefix_examples(turns(spark)))) == []


def test_only_native_operators(spark):
    plan = read_examples(prefix_examples(turns(spark, (1, 0, "user", "a"))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
