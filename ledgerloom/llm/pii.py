"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Only DataFrame functions are used. A pattern's matches and the pieces of text between them
give the places: no position is searched for twice.

The patterns are written so that no text makes them slow. A run of characters is tried
from its start only (``\\G``: or from the end of the match before), and what is taken is
never given back, which changes no match because the next character can't be of the run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    sign: str  # a pattern's cheap necessary condition
    score: float  # without context
    least: float  # score under which a span is dropped
    context: str  # words before a span that raise its score


#: In the order in which spans with one start are listed. The first four are the base
#: kinds: their confirmed matches always stay.
KINDS = [
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.9,
        0.0,
        r"e-?mail|mail|contact|write|adress|correo|courriel",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]",
        0.6,
        0.0,
        r"\bip\b|address|host|server|adresse",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])",
        r"[0-9][ -]?[0-9]",
        0.7,
        0.0,
        r"card|credit|visa|karte|tarjeta|carte",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        r"\+[0-9]",
        0.7,
        0.0,
        r"phone|call|tel|mobile|fax|anruf",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}"
        r"(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}",
        0.9,
        0.5,
        r"iban|account|bank|konto|cuenta|compte",
    ),
    Kind(  # three groups of digits are a number of this kind only if the context says so
        "ssn",
        r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
        r"[0-9]{3}-[0-9]{2}-",
        0.3,
        0.5,
        r"\bssn\b|social security",
    ),
]
BASE_KINDS = [k.name for k in KINDS[:4]]
CONTEXT_CHARS, CONTEXT_BONUS = 40, 0.3
#: Code points of the blocks from which a text with spans is cut.
BLOCK = 1024
PROPOSED = (
    "array<struct<start: int, kind_no: int, end: int, kind: string, value: string, score: double>>"
)


def _digits(value: Column) -> Column:
    return F.translate(value, " ().+-", "")


def _is_luhn(value: Column) -> Column:
    digits = _digits(value)
    doubled = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(doubled, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return total % 10 == 0


def _is_mod97(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        letter = code >= 65
        return (
            rest * F.when(letter, 100).otherwise(10) + F.when(letter, code - 55).otherwise(code - 48)
        ) % 97

    chars = F.transform(
        F.sequence(F.lit(1), F.length(turned)), lambda i: F.substring(turned, i, F.lit(1))
    )
    return F.aggregate(chars, F.lit(0), step) == 1


def _is_byte(part: Column) -> Column:
    value = F.regexp_replace(part, "^0+", "")
    return (F.length(value) <= 3) & (F.coalesce(F.left(value, F.lit(3)).try_cast("int"), F.lit(0)) <= 255)


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _is_byte)
    if kind == "card":
        return _is_luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    if kind == "iban":
        return _is_mod97(value)
    return F.lit(True)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The joined values up to each place of an array that isn't empty, in log n steps.

    Each step joins to a value the one twice as far before it as in the last step. Adding
    places one by one to an array would copy it each time.
    """

    def step(acc: Column, k: Column) -> Column:
        far = F.pow(F.lit(2), k).cast("int")
        return F.transform(acc, lambda x, i: F.when(i >= far, join(x, F.get(acc, i - far))).otherwise(x))

    steps = F.sequence(F.lit(0), F.floor(F.log2(F.size(values))).cast("int"))
    return F.aggregate(steps, values, step)


def _spans(number: int, kind: Kind, found: Column, text: Column) -> Column:
    """The confirmed spans of one kind, from its matches and the text between them."""
    gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found))
    sizes = F.zip_with(gaps, found, lambda gap, value: F.length(gap) + F.length(value))
    ends = _running(sizes, lambda x, y: x + y)

    def span(x: Column) -> Column:
        near = F.lower(F.right(x["gap"], F.lit(CONTEXT_CHARS))).rlike(kind.context)
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(near, CONTEXT_BONUS).otherwise(0.0))
        return F.struct(
            (x["end"] - F.length(x["value"])).alias("start"),
            F.lit(number).alias("kind_no"),
            x["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            x["value"].alias("value"),
            score.alias("score"),
        )

    triples = F.arrays_zip(gaps.alias("gap"), found.alias("value"), ends.alias("end"))
    return F.filter(
        F.transform(triples, span),
        lambda s: _confirmed(kind.name, s["value"]) & (s["score"] >= kind.least),
    )


def find_pii(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """``docs`` with the column ``into``: spans of personal data in the whole text.

    A span has ``start`` and ``end`` (code points, end exclusive), ``kind`` and ``score``
    (0 to 1). They are in order of start, then of KINDS; spans of different kinds may
    overlap. A match that isn't confirmed is dropped and nothing inside it is tried again.
    A null text has no spans. All rows and columns stay; a column named ``into`` would be
    replaced.
    """
    # The row goes along as one column, so that no name in it can clash.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("value"),
    )
    value = F.col("value")
    nothing = F.array().cast("array<string>")
    # A step each, so that matches are looked for once and pieces only beside matches.
    found = rows.withColumns(
        {
            f"found_{k.name}": F.when(
                value.rlike(k.sign), F.regexp_extract_all(value, F.lit(k.pattern), F.lit(0))
            ).otherwise(nothing)
            for k in KINDS
        }
    )
    none = F.array().cast(PROPOSED)
    by_kind = [
        F.when(F.size(f"found_{k.name}") > 0, _spans(i, k, F.col(f"found_{k.name}"), value)).otherwise(none)
        for i, k in enumerate(KINDS)
    ]
    spans = F.transform(
        F.array_sort(F.concat(*by_kind)), lambda s: F.struct(s["start"], s["end"], s["kind"], s["score"])
    )
    any_found = sum((F.size(f"found_{k.name}") for k in KINDS), F.lit(0)) > 0
    empty = F.array().cast("array<struct<start: int, end: int, kind: string, score: double>>")
    return found.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c != into],
        F.when(any_found, spans).otherwise(empty).alias(into),
    )


def redact(docs: DataFrame, text: str = "text", least_score: float = 0.5) -> DataFrame:
    """``docs`` with every span of personal data in ``text`` replaced by its kind in brackets.

    Overlapping spans become one, named by the first. Texts without spans stay as they
    are, null ones too.
    """
    rows = docs.select(
        F.struct(F.lit(0), *[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"),
        F.col(f"`{text}`").alias("text"),
    )
    found = find_pii(rows, "text", "spans").withColumn(
        "spans", F.filter("spans", lambda s: s["score"] >= least_score)
    )
    # A span begins a stretch if all before it have ended; the stretch ends where the last
    # span before the next stretch's does.
    some = F.size("spans") > 0
    reach = F.when(some, _running(F.transform("spans", lambda s: s["end"]), F.greatest))
    reached = found.withColumn("reach", reach)
    numbered = F.transform("spans", lambda s, i: F.struct(s["start"], s["kind"], i.alias("i")))
    begins = F.filter(
        numbered, lambda s: (s["i"] == 0) | (s["start"] >= F.get("reach", s["i"] - 1))
    )
    begun = reached.withColumn("begins", F.when(some, begins))

    def end_of(j: Column) -> Column:
        after = F.get("begins", j + 1)["i"]
        return F.get("reach", F.coalesce(after, F.size("spans")) - 1)

    value = F.col("text")
    # The text in blocks of code points: what lies between stretches is cut from few of them,
    # not counted from the text's start each time.
    blocks = F.regexp_extract_all(value, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    cuttable = begun.withColumns(
        {
            "stretches": F.transform(
                "begins",
                lambda s, j: F.struct(s["start"].alias("start"), end_of(j).alias("end"), s["kind"].alias("kind")),
            ),
            "blocks": F.when(some, blocks),
        }
    )

    def cut(start: Column, end: Column) -> Column:
        first = F.floor(start / BLOCK).cast("int")
        many = F.floor(end / BLOCK).cast("int") - first + 1
        near = F.array_join(F.slice("blocks", first + 1, many), "")
        return F.substring(near, start - first * BLOCK + 1, end - start)

    before = F.transform(
        "stretches",
        lambda s, i: F.concat(
            cut(F.when(i > 0, F.get("stretches", i - 1)["end"]).otherwise(0), s["start"]),
            F.lit("["),
            F.upper(s["kind"]),
            F.lit("]"),
        ),
    )
    tail = cut(F.element_at("stretches", -1)["end"], F.length(value))
    clean = F.when(some, F.concat(F.array_join(before, ""), tail)).otherwise(value)
    return cuttable.select(
        *[clean.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    )
