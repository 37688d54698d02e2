"""From raw documents to token ids: five of the corpus operators, one after the other.

Each stage takes the documents that the one before has kept, written as Parquet and read
again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch, find_package, read_table, scratch_until_done
from ledgerloom.llm.decontaminate import find_leaks
from ledgerloom.llm.jaccard import jaccard_components
from ledgerloom.llm.language import UNDETERMINED, fit_languages, held_out, identify_languages
from ledgerloom.llm.pieces import encode_pieces
from ledgerloom.llm.pii import redact


#: Near copies: words of a shingle, and the least similarity in hundredths.
COPY_WORDS, COPY_PERCENT = 5, 80


def _row(docs: DataFrame) -> DataFrame:
    """Each document's text, and what else it has as one column, so that no name can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("row"), "text")


def _unrow(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(
        [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    )


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: null, empty or without a letter.

    The languages are learned from the labelled documents that aren't held out. Where nothing is
    labelled all texts with a letter stay. Repeated rows are judged alike.
    """
    find_package(spark)
    labelled = docs.select("doc_id", "text", "lang")
    moves = fit_languages(labelled.where(~held_out(F.col("doc_id"))))
    if not len(moves):  # nothing is labelled, so languages can't be told apart, but letters can
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify_languages(_row(docs), moves, "row", "text")
    return _unrow(found.where(F.col("lang_pred") != UNDETERMINED), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents the one with the least doc_id.

    Documents link if the Jaccard similarity of their five-word shingles is 0.8 or more.
    Rows that share a doc_id are told apart by a hash of all their columns; of rows
    repeated whole one is kept. Documents without words are in no group and stay.
    """
    find_package(spark)
    identity = F.struct("doc_id", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("hash"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("row"), identity.alias("doc"))
    keys = docs.select(identity.alias("doc"), "text")
    scratch = Scratch(spark, "copies")
    with scratch_until_done(spark):
        found = scratch.keep(jaccard_components(keys, "doc", COPY_WORDS, COPY_PERCENT), "found")
    gone = found.where(F.col("doc") != F.col("component_id")).select("doc").distinct()
    repeated = found.where(F.col("doc") == F.col("component_id")).groupBy("doc").count().where("count > 1")
    marked = gone.select("doc", F.lit(True).alias("gone")).union(repeated.select("doc", F.lit(False)))
    told = rows.join(scratch.keep(marked, "marked"), "doc", "left")
    once = told.where("not gone").dropDuplicates(["doc"])
    return told.where("gone is null").union(once).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, as it is or edited.

    Null and empty texts hold none and stay; repeated rows go or stay together.
    """
    found = find_leaks(_row(docs), read_table(spark, sf_dir, "benchmark"))
    return _unrow(found.where(F.size("matches") == 0), docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows. No document goes.

    Null and empty texts stay as they are, repeated rows are treated alike.
    """
    clean = redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed, with the source bytes at which pieces end.

    A null text is an empty one; repeated rows have a row each.
    """
    find_package(spark)
    encoded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids", "ends"
    )


STAGES = [
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("private_data", private_data),
    ("pieces", pieces),
]

#: SQL can't express the language and piece stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows.

    A stage's scratch tables, and the rows of the stage before, go once its own are written.
    """
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        with scratch_until_done(spark):
            docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if before:  # what a stage has read is needed until its own rows are written
            scratch.drop(before)
        before = name
    return docs
