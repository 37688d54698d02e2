"""Prefix-target expansion of conversations: one training example for each reply.

An example's text is ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn up to and with
one assistant turn. Only that reply's text is trainable; its place in the example's text
is given in code points.

Control strings inside texts are made harmless by one more bar after each ``<|``: there,
``<`` is then always followed by two bars or none, so no marker can appear, and taking one
bar away reads the text back. Roles are escaped alike, and kept to one line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape_text(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape_text(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def escape_role(role: Column) -> Column:
    one_line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape_text(one_line)


def unescape_role(role: Column) -> Column:
    """Doubled backslashes are set aside as a line feed, which an escaped role can't hold."""
    aside = F.replace(unescape_text(role), F.lit("\\\\"), F.lit("\n"))
    parts = F.transform(
        F.split(aside, "\n", -1), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))
    )
    return F.array_join(parts, "\\")


def prefix_examples(turns: DataFrame, target_role: str = "assistant") -> DataFrame:
    """One row for each turn of ``target_role``, with all turns before it as context.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``. A null role or text counts
    as empty, a null ``conv_id`` is a conversation of its own, null turns come first, and
    turns with one number (repeated rows, say) stay and are ordered by role and text. A
    conversation that doesn't end with a reply has one more example, without a target,
    so that nothing of it is lost. An empty table gives no examples; other columns are
    not read.

    Returns ``conv_id``, ``example`` (from 0), ``n_turns``, ``text``, and ``loss_start``
    and ``loss_end``, both null in an example without a target.

    The examples of a conversation of n replies hold its turns n times over: that is what
    the method makes. A whole conversation is held in a row, as its last example is.
    """
    said = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("said"),
    )
    whole = said.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    # Blocks are made once; an example joins its first ones.
    blocks = whole.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == target_role).alias("is_target"),
        F.transform("turns", lambda t: F.length(escape_text(t["text"]))).alias("chars"),
        F.transform(
            "turns",
            lambda t: F.concat(
                F.lit(START), escape_role(t["role"]), F.lit("\n"), escape_text(t["text"]), F.lit(END)
            ),
        ).alias("blocks"),
    )
    ends = F.filter(
        F.sequence(F.lit(1), F.size("blocks")),
        lambda n: F.element_at("is_target", n) | (n == F.size("blocks")),
    )
    examples = blocks.select("*", F.posexplode(ends).alias("example", "n_turns")).select(
        "conv_id",
        "example",
        "n_turns",
        F.array_join(F.slice("blocks", F.lit(1), F.col("n_turns")), "").alias("text"),
        F.element_at("is_target", F.col("n_turns")).alias("_is_target"),
        F.element_at("chars", F.col("n_turns")).alias("_chars"),
    )
    end = F.length("text") - len(END)
    return examples.select(
        "conv_id",
        "example",
        "n_turns",
        "text",
        F.when(F.col("_is_target"), end - F.col("_chars")).alias("loss_start"),
        F.when(F.col("_is_target"), end).alias("loss_end"),
    )


def read_examples(examples: DataFrame) -> DataFrame:
    """The conversations as the examples' texts and masks have them.

    Returns ``conv_id``, ``turns`` (role and text, from the longest example), ``targets``
    (the trainable texts in order), ``formatted_chars`` (code points of all examples) and
    ``n_examples``. Nothing but the output of ``prefix_examples`` is read.
    """
    target = F.when(
        F.col("loss_start").isNotNull(),
        unescape_text(
            F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
        ),
    )
    # Only the longest example is parsed. It is the one with the highest number.
    per_example = examples.select(
        "conv_id",
        F.length("text").cast("long").alias("chars"),
        F.struct("example", target.alias("target")).alias("reply"),
        F.struct("example", "text").alias("whole"),
    )
    grouped = per_example.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.array_sort(F.collect_list("reply")).alias("replies"),
        F.sum("chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    # The text before the first marker is empty; every other part is role, line feed, text.
    pieces = F.split(F.col("whole.text"), r"<\|im_start\|>", -1)
    parts = F.slice(pieces, F.lit(2), F.size(pieces))

    def turn(part: Column) -> Column:
        line = F.instr(part, "\n")
        body = F.substring(part, line + 1, F.length(part) - line - len(END))
        return F.struct(
            unescape_role(F.substring(part, F.lit(1), line - 1)).alias("role"),
            unescape_text(body).alias("text"),
        )

    return grouped.select(
        "conv_id",
        F.transform(parts, turn).alias("turns"),
        F.filter(F.col("replies.target"), lambda t: t.isNotNull()).alias("targets"),
        "formatted_chars",
        "n_examples",
    )
