"""Language by cross-parsing: the language in whose text a document falls into fewest phrases.

A phrase is the longest piece of the document, from where the last one ended, that occurs
anywhere in a language's sample. A suffix automaton of the sample finds it: every path
from its start is a piece of the sample. Related text gives few long phrases, foreign text
many short ones. A phrase of a longer sample takes more bits to point at, so phrases count
with the logarithm of the sample's size: a language with little labelled text, whose phrases
are shorter for that alone, isn't put at a disadvantage.

Texts are lower-cased; a run of anything but letters is one space. The samples are a fitted
classifier's training data and bounded (``SAMPLE_CHARS`` a language); what is predicted is
predicted from whole texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import beside, over_slices

#: Bound of the training sample of a language: so many characters, from so many texts at
#: most, one from each of so many classes of a hash of text and id.
SAMPLE_CHARS, SAMPLE_TEXTS = 24_000, 256
#: Texts are parsed in pieces of this many characters, whose phrases add up. A piece ends a
#: phrase, which costs a long text one phrase in 2,000 characters in every language alike.
PIECE_CHARS = 2_000
UNDETERMINED = "und"


def _normal(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """The transitions of each state; state 0 is the start."""
    out: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(out)
        out.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in out[p]:
            out[p][c] = cur
            p = link[p]
        if p != -1:
            q = out[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(out)
                out.append(dict(out[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and out[p].get(c) == q:
                    out[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return out


def _automaton_of(samples: pd.DataFrame) -> pd.DataFrame:
    """One language's transitions as rows: its bounded sample comes as a group."""
    texts = samples.sort_values("pick").text.map(_normal)
    joined = " ".join(texts)[:SAMPLE_CHARS]
    states = suffix_automaton(joined)
    rows = [(s, c, t) for s, moves in enumerate(states) for c, t in moves.items()]
    frame = pd.DataFrame(rows, columns=["state", "char", "target"])
    frame.insert(0, "lang", samples.lang.iloc[0])
    frame["size"] = len(joined)
    return frame


class Parser:
    """Suffix automata of all languages as one table of moves.

    The table says for a state and a character where the parse goes on. If the phrase ends
    before the character, that is the state after the character alone, with a flag. A
    character that the sample hasn't is a phrase alone: it leads to a state (``base + n``)
    that goes nowhere on.
    """

    FLAG = 1 << 30

    def __init__(self, moves: pd.DataFrame):
        self.langs = sorted(moves.lang.unique())
        alphabet = sorted(set(moves.char) | {" "})
        # 0 stands for all characters that no sample has.
        self.code = {c: i + 1 for i, c in enumerate(alphabet)}
        self.space = self.code[" "]
        self.lookup = np.zeros(max(map(ord, alphabet)) + 2, np.int32)
        for c, i in self.code.items():
            self.lookup[ord(c)] = i
        sizes = moves.groupby("lang")["size"].first().reindex(self.langs)
        self.bits = np.log2(sizes.to_numpy(float) + 1)  # that a phrase takes, by language
        width, tables, self.starts, base = len(alphabet) + 1, [], [], 0
        for lang in self.langs:
            own = moves[moves.lang == lang]
            n = int(max(own.state.max(), own.target.max())) + 1
            table = np.full((n, width), -1, np.int32)
            table[own.state, own.char.map(self.code)] = own.target + base
            first = np.where(table[0] < 0, base + n, table[0])
            table = np.where(table < 0, first | self.FLAG, table)
            table[0] = first  # a text's first character ends no phrase
            tables.append(np.concatenate([table, (first | self.FLAG)[None]]))
            self.starts.append(base)
            base += n + 1
        self.width = width
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        known = self.lookup[np.minimum(points, len(self.lookup) - 1)]
        other = np.flatnonzero(known == 0)
        if len(other):  # letters that no sample has stay unknown, all else is a gap
            kinds, place = np.unique(points[other], return_inverse=True)
            gap = np.array([not chr(k).isalpha() for k in kinds])
            known[other[gap[place]]] = self.space
        gaps = known == self.space
        twice = gaps & np.concatenate(([True], gaps[:-1]))  # runs, and the text's start
        known = known[~twice]
        return known[:-1] if len(known) and known[-1] == self.space else known

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns), all pieces in step."""
        sizes = [len(t) for t in texts]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int32)
        owner, begin, size = [], [], []
        for i, n in enumerate(sizes):
            for at in range(0, n, PIECE_CHARS):
                owner.append(i)
                begin.append(starts[i] + at)
                size.append(min(PIECE_CHARS, n - at))
        size = np.array(size, np.int64)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = (np.array(x, np.int64)[order] for x in (owner, begin, size))
        state = np.tile(np.array(self.starts, np.int64)[:, None], (1, len(size)))
        count = np.ones((len(self.langs), len(size)), np.int64)
        ends = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")
        for at, live in enumerate(ends):
            move = self.table[state[:, :live] * self.width + flat[begin[:live] + at]]
            count[:, :live] += move >> 30
            state[:, :live] = move & (self.FLAG - 1)
        total = np.zeros((len(texts), len(self.langs)), np.int64)
        np.add.at(total, owner, count.T)
        return total


def _predictor(moves: pd.DataFrame, keep_text: bool = False):
    parser = Parser(moves)
    langs = [*parser.langs, UNDETERMINED]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [parser.codes(t or "") for t in batch.column("text").to_pylist()]
        letters = np.array([bool((t != parser.space).any()) for t in texts], bool)
        if not parser.langs:
            letters[:] = False
        best = np.full(len(texts), len(parser.langs))
        score, rate = np.zeros(len(texts)), np.zeros(len(texts))
        if letters.any():
            counts = parser.phrases(texts)
            costs = counts * parser.bits
            ranked = np.sort(costs, axis=1)
            first = costs.argmin(axis=1)
            best = np.where(letters, first, best)
            second = ranked[:, min(1, ranked.shape[1] - 1)]
            won = 1 - ranked[:, 0] / np.where(second > 0, second, 1.0) if ranked.shape[1] > 1 else 1.0
            score = np.where(letters, won, 0.0)
            sizes = np.array([len(t) for t in texts])
            fewest = counts[np.arange(len(texts)), first]
            rate = np.where(letters, fewest / np.maximum(sizes, 1), 0.0)
        names = [name for name in batch.schema.names if keep_text or name != "text"]
        kept = {name: batch.column(name) for name in names}
        new = {
            "lang_pred": pa.array([langs[i] for i in best], pa.string()),
            "score": pa.array(score),
            "phrase_rate": pa.array(rate),
        }
        return pa.RecordBatch.from_pydict(kept | new)

    return work


def fit_languages(labelled: DataFrame, key: str = "doc_id") -> pd.DataFrame:
    """Suffix automata of the labelled texts' languages, as rows of moves.

    ``labelled`` has ``key``, ``text`` and ``lang``; rows without text or language are left
    out. From each language the text with the least hash of each of SAMPLE_TEXTS classes
    is taken (of equal rows one), then SAMPLE_CHARS characters of them. The choice is two
    aggregates, so no language's rows meet in one task; what is broadcast, SAMPLE_TEXTS numbers
    a language, and what comes to the driver are bounded by the number of languages.
    """
    # Hashes differ for different rows, and by class only the least counts.
    rows = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        "lang", "text", F.xxhash64(F.col(key), "text").alias("pick")
    )
    picks = (
        rows.groupBy("lang", F.pmod("pick", F.lit(SAMPLE_TEXTS)).alias("class"))
        .agg(F.min("pick").alias("pick"))
        .select("lang", "pick")
    )
    sample = (
        rows.join(F.broadcast(picks), ["lang", "pick"])
        .groupBy("lang", "pick")
        .agg(F.min(F.left("text", F.lit(SAMPLE_CHARS))).alias("text"))
    )
    moves = sample.groupBy("lang").applyInPandas(
        _automaton_of, "lang string, state long, char string, target long, size long"
    )
    return moves.toPandas()


def identify_languages(docs: DataFrame, moves: pd.DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, and ``lang_pred``, ``score`` and ``phrase_rate`` of every row.

    ``score`` is the share of the phrases' bits that the winner saves over the next language (1
    with a single language); ``phrase_rate`` is the winner's phrases for each character. Of
    languages with equally many bits the first by name wins, with score 0. A null text,
    or one without a letter, is ``und`` with score 0, as is every text if nothing was
    learned. Only ``text`` is looked at. Repeated rows are rows like others; an empty table
    gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(moves)  # bounded by the samples
    keep_text = "text" in keep
    kept = docs.select(*keep) if keep_text else docs.select(*keep, "text")
    return kept.mapInArrow(
        over_slices(lambda: _predictor(model.value, keep_text)),
        beside(kept, "" if keep_text else "text", "lang_pred string, score double, phrase_rate double"),
    )


def held_out(key: Column) -> Column:
    """A quarter of the rows, by a checksum of the key as text; null keys are of the rest."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
