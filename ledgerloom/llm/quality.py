"""Quality rules by host: a host most of whose documents fail loses all of them.

Every document is held against rules of its own; failures are added up by host; each
host's failure rate is drawn towards the rates of all hosts by a beta prior fitted to
them, so that a host of three bad documents isn't judged like one of three million.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch, beside, over_slices, split_words, word_codes

WINDOW = 5
FACTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeated_window_words(codes: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a window of words that their text has at least twice.

    ``codes`` numbers the words of many texts, ``owner`` the text of each. Windows are
    named exactly: a longer window is a pair of names of shorter ones, numbered anew.
    """
    hit = np.zeros(len(codes), bool)
    n = len(codes) - window + 1
    if n < 1:
        return hit
    _, single = np.unique(codes, return_inverse=True)
    names, width = single, 1
    while width < window:
        step = min(width, window - width)
        pair = names[: len(names) - step] * (len(codes) + 1) + names[step:]
        _, names = np.unique(pair, return_inverse=True)
        width += step
    inside = owner[:n] == owner[window - 1 :]
    starts = np.flatnonzero(inside)
    key = names[starts] * (owner[-1] + 1) + owner[starts]
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = starts[count[place] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _measure() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
        words, n_words = split_words(texts)
        owner = np.repeat(np.arange(len(texts)), n_words)
        chars = pc.utf8_length(words).to_numpy(False)
        codes, _ = word_codes(words)
        repeats = repeated_window_words(codes, owner, WINDOW)
        lines = pc.split_pattern(texts, "\n")
        line_owner = pc.list_parent_indices(lines).to_numpy(False)
        flat = lines.flatten()
        with_word = pc.match_substring_regex(flat, r"[^\x20\x09-\x0D]").to_numpy(False)
        flat, line_owner = flat.filter(pa.array(with_word)), line_owner[with_word]
        line_codes, _ = word_codes(flat)
        _, first = np.unique(line_codes * (len(texts) + 1) + line_owner, return_index=True)
        later = np.ones(len(line_codes), bool)
        later[first] = False
        count = lambda of, **w: np.bincount(of, minlength=len(texts), **w).astype(np.int64)
        facts = {
            "n_words": n_words,
            "word_chars": count(owner, weights=chars),
            "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").cast(pa.int64()),
            "n_dup_lines": count(line_owner[later]),
            "n_repeat_words": count(owner[repeats]),
            "n_lines": count(line_owner),
        }
        kept = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        return pa.RecordBatch.from_pydict(kept | {k: pa.array(v) for k, v in facts.items()})

    return work


def text_facts(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and what the rules need to know of each text (null: empty)."""
    kept = docs.select(*keep, "text")
    return kept.mapInArrow(over_slices(_measure), beside(kept, "text", FACTS))


def host_rules(
    docs: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    worst_rate: float = 0.5,
) -> DataFrame:
    """Base rule, rule failures and the host's verdict for every document.

    A document fails the base rule with under 10 words, or when more than a fifth of its
    words lie in five-word windows that its text has twice. It also counts as a failure of
    its host when it has over a tenth as many symbols as characters in words, or when over
    three tenths of its lines are earlier ones again. Lines are those with a word, and are
    counted as a tenth of the words at least, so that few long lines aren't judged by one or two.

    For each host, with n documents of which f fail any rule, the rate is
    (f + a) / (n + a + b). The beta prior (a, b) has the mean and variance of the failure
    rates of all hosts (by moments, each host once); with fewer than two hosts, or rates
    that don't vary, it is the uniform prior. A host is bad if its rate is over
    ``worst_rate``. ``kept`` is false for documents that fail the base rule or have a bad
    host.

    A document without a host is judged by the base rule alone; its host columns are null.
    Null texts are empty. Repeated rows count each time. An empty table gives an empty
    result. Other columns are not read.

    Counts by host are summed before the shuffle, so a host of any share of the rows is
    one row for each task. The table of hosts is written down; Spark broadcasts it where
    its size allows that and shuffles otherwise, splitting large hosts at run time.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    facts = text_facts(docs.select(F.col(key).alias("_key"), F.col(host).alias("_host"), "text"), "_key", "_host")
    judged = facts.select(
        "*",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias(
            "base_failed"
        ),
        (10 * F.col("n_symbols") > F.col("word_chars")).alias("_symbols"),
        (100 * F.col("n_dup_lines") > 3 * F.greatest(10 * F.col("n_lines"), F.col("n_words"))).alias("_lines"),
    ).withColumn("failed", F.col("base_failed") | F.col("_symbols") | F.col("_lines"))
    judged = scratch.keep(judged.drop("_symbols", "_lines"), "judged")
    hosts = scratch.keep(host_rates(judged.where(F.col("_host").isNotNull())), "hosts")
    return judged.join(hosts, "_host", "left").select(
        F.col("_key").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("host_rate") <= worst_rate, F.lit(True))).alias("kept"),
        "failed",
        "host_docs",
        "host_rate",
    )


def host_rates(judged: DataFrame) -> DataFrame:
    """Documents and shrunk failure rate of each host (rounded to six places)."""
    counts = judged.groupBy("_host").agg(
        F.count(F.lit(1)).alias("host_docs"), F.count_if("failed").alias("_failures")
    )
    rate = F.col("_failures") / F.col("host_docs")
    mean, var = counts.agg(F.avg(rate), F.var_samp(rate)).first()  # two numbers
    if var is not None and 1e-9 < var < mean * (1 - mean):
        weight = mean * (1 - mean) / var - 1
    else:
        mean, weight = 0.5, 2.0
    shrunk = (F.col("_failures") + mean * weight) / (F.col("host_docs") + weight)
    return counts.select("_host", "host_docs", F.round(shrunk, 6).alias("host_rate"))
