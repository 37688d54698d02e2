from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from ledgerloom.llm.pii import find_pii, redact
from tests.conftest import rows

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_by_hand(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else True,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), order, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(found)]


def spans(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    return {r.doc_id: r.spans for r in find_pii(docs).collect()}


def test_base_kinds_against_brute_force(spark):
    rnd = random.Random(8)
    bits = ["a@b.com", "_x@c.d-e.org", "@", "😀", "é", " ", ".", "-", "+", "1", "255", "256", "0001.2.3.4", "1.2.3.4.5.6.7.8",
            "4111 1111 1111 1111", "4111111111111112", "79927398713", "+1 (212) 555-0100", "+44", "(", ")", "\n", "x@y", "%", "12-34", "00000000000000"]
    texts = [None, "", "@" * 5000, "a" * 50_000, "1" * 50_000, "1." * 20_000, "+1 " * 20_000, "a@b.c " * 800, "a@" + "b." * 20_000 + "c"]
    texts += ["".join(rnd.choices(bits, k=rnd.randint(1, 25))) for _ in range(1500)]
    found = spans(spark, texts)
    for i, text in enumerate(texts):
        got = [(s.start, s.end, s.kind) for s in found[i] if s.kind in BASE]
        assert got == base_by_hand(text), text[:200] if text else text


def test_checksums_and_context(spark):
    texts = ["pay GB82 WEST 1234 5698 7654 32 now", "GB82WEST12345698765433", "DE89370400440532013000.", "ssn 078-05-1120", "part 078-05-1120"]
    found = spans(spark, texts)
    assert [[(t[s.start : s.end], s.kind) for s in found[i]] for i, t in enumerate(texts)] == [
        [("GB82 WEST 1234 5698 7654 32", "iban")], [], [("DE89370400440532013000", "iban")], [("078-05-1120", "ssn")], [],
    ]
    near, far = spans(spark, ["my email is a@b.io", "see a@b.io"]).values()
    assert near[0].score > far[0].score


def test_redaction(spark):
    table = [("mail a@b.io or +1 212 555 0100!", 1), (None, 2), ("clean é text", 3), ("", 4), ("1.2.3.4@x.org", 5), ("clean é text", 3)]
    docs = spark.createDataFrame(table, "text string, n long").withColumn("_other", F.lit(1))
    found = redact(docs)
    assert found.columns == docs.columns
    assert rows(found.select("text")) == [
        ("mail [EMAIL] or [PHONE]!",), (None,), ("clean é text",), ("",), ("[EMAIL]",), ("clean é text",),
    ]
    assert rows(redact(docs.limit(0))) == []


def redact_by_hand(text, found):
    out, at, until, kind = [], 0, None, None
    for s in [s for s in found if s.score >= 0.5]:
        if until is not None and s.start < until:
            until = max(until, s.end)
            continue
        if until is not None:
            out.append(f"[{kind.upper()}]")
            at = until
        out.append(text[at : s.start])
        until, kind = s.end, s.kind
    if until is not None:
        out.append(f"[{kind.upper()}]")
        at = until
    return "".join(out) + text[at:]


def test_redaction_of_overlapping_and_very_many_spans(spark):
    rnd = random.Random(4)
    bits = ["a@b.com", "1.2.3.4@x.org", "4111 1111 1111 1111", "+1 (212) 555-0100", "+41 4111111111111111", "😀", "é ", " ", "\n", "x" * 1500]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(1, 60))) for _ in range(300)]
    texts += ["a@b.c " * 16_000, "😀 a@b.c,+1 212 555 0100 " * 2_000, "é" * 5000 + " a@b.c"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n long, text string")
    found = {r.n: r.spans for r in find_pii(table).collect()}
    for r in redact(table).collect():
        assert r.text == redact_by_hand(texts[r.n], found[r.n])
    assert len(found[300]) == 16_000 and found[300][-1].end == 16_000 * 6 - 1
