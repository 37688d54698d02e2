"""FM-indexes of a vocabulary in both directions, and searches with one error by halves."""

from __future__ import annotations

import numpy as np

#: The number of the delimiter before, between and after words; letters follow from 1.
DELIMITER = 0


class Words:
    """Words as numbers of their code points, one after the other."""

    def __init__(self, words: list[str], letters: np.ndarray | None = None):
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.unique(points) if letters is None else letters
        place = np.searchsorted(self.letters, points)
        known = np.minimum(place, max(len(self.letters) - 1, 0))
        self.codes = np.where(self.letters[known] == points, known + 1, -1) if len(self.letters) else place - 1


class FmIndex:
    """Backward search over the delimited words.

    Rows are the sorted suffixes. The rows that begin with a pattern are an interval of
    ranks, and a letter before the pattern leads to the interval of the longer one.
    """

    def __init__(self, words: Words):
        n_words = len(words.lengths)
        text = np.full(len(words.codes) + n_words + 1, DELIMITER, np.int64)
        owner = np.repeat(np.arange(n_words), words.lengths)
        text[np.arange(len(words.codes)) + owner + 1] = words.codes
        self.size = len(text)
        self.n_letters = len(words.letters)
        order = _suffix_order(text, int(words.lengths.max(initial=0)) + 2)
        self.before = text[order - 1]  # of the first suffix it is the last delimiter
        ranks = np.argsort(self.before, kind="stable")
        self.keys = self.before[ranks] * (self.size + 1) + ranks
        # Word that begins after the delimiter at which a row's suffix starts; -1 after the last.
        word_at = np.full(self.size, -1, np.int64)
        word_at[np.flatnonzero(text == DELIMITER)[:-1]] = np.arange(n_words)
        self.word = word_at[order]

    def step(self, low: np.ndarray, high: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with ``letter`` before what the given ones match; unknown ones are empty."""
        base = letter * (self.size + 1)
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def letters_before(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letters, without the delimiter, that may stand before each interval: (interval, letter)."""
        wide = high - low > self.n_letters
        some = np.flatnonzero(wide)
        every = np.repeat(some, self.n_letters), np.tile(np.arange(1, self.n_letters + 1), len(some))
        few = np.flatnonzero(~wide)
        counts = (high - low)[few]
        owner = np.repeat(few, counts)
        rows = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + low[owner]
        found = np.unique(owner * (self.n_letters + 1) + self.before[rows])
        interval, letter = np.divmod(found, self.n_letters + 1)
        real = letter != DELIMITER
        return np.concatenate([every[0], interval[real]]), np.concatenate([every[1], letter[real]])


def _suffix_order(text: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes sorted by at least ``longest`` characters, then by place; ranks double each round."""
    rank = text
    width = 1
    while width < longest:
        following = np.full(len(text), -1, np.int64)
        following[:-width] = rank[width:]
        pair = rank * (len(text) + 2) + following + 1
        rank = np.unique(pair, return_inverse=True)[1]
        width *= 2
    return np.argsort(rank, kind="stable")


def one_error_before(index: FmIndex, words: Words, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (word, indexed word) that end alike and differ by one code point before that.

    ``exact`` is the length of the end of each word that has to match. An inserted, deleted
    or replaced code point must lie before it, at its border included.
    """
    n = len(words.lengths)
    query = np.arange(n)
    left = words.lengths.copy()  # code points of the word that are still to match
    low, high = index.step(np.zeros(n, np.int64), np.full(n, index.size), np.full(n, DELIMITER))

    finished: list[tuple[np.ndarray, ...]] = []
    erring: list[tuple[np.ndarray, ...]] = []
    # The exact search. From the end of the exact part on it also gives states with an error.
    while len(query):
        free = left <= (words.lengths - exact)[query]
        erring.append(_with_error(index, words, query[free], left[free], low[free], high[free]))
        query, left, low, high = _match_one(index, words, query, left, low, high)
    state = tuple(np.concatenate(part) for part in zip(*erring))
    while len(state[0]):
        done = state[1] == 0
        finished.append(tuple(part[done] for part in state))
        state = _match_one(index, words, *(part[~done] for part in state))
    if not finished:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    query, _, low, high = (np.concatenate(part) for part in zip(*finished))
    low, high = index.step(low, high, np.full(len(low), DELIMITER))
    whole = (high > low) & (index.word[np.minimum(low, index.size - 1)] >= 0)
    pairs = np.unique(query[whole] * (index.size + 1) + index.word[low[whole]])
    return np.divmod(pairs, index.size + 1)


def _match_one(index: FmIndex, words: Words, query, left, low, high) -> tuple[np.ndarray, ...]:
    """The states that match one more code point of their words; others end."""
    more = left > 0
    query, left, low, high = query[more], left[more] - 1, low[more], high[more]
    low, high = index.step(low, high, words.codes[words.starts[query] + left])
    alive = high > low
    return query[alive], left[alive], low[alive], high[alive]


def _with_error(index: FmIndex, words: Words, query, left, low, high) -> tuple[np.ndarray, ...]:
    """The states with one error next: a code point replaced, or one more, or one less."""
    at = words.starts[query] + left - 1
    own = np.where(left > 0, words.codes[np.maximum(at, 0)], DELIMITER) if len(words.codes) else left
    less = left > 0
    place, letter = index.letters_before(low, high)
    other = letter != own[place]  # one more of the same letter comes again before that letter
    place, letter = place[other], letter[other]
    wider_low, wider_high = index.step(low[place], high[place], letter)
    alive = wider_high > wider_low
    place, wider_low, wider_high = place[alive], wider_low[alive], wider_high[alive]
    replaced = left[place] > 0
    return (
        np.concatenate([query[less], query[place], query[place[replaced]]]),
        np.concatenate([left[less] - 1, left[place], left[place[replaced]] - 1]),
        np.concatenate([low[less], wider_low, wider_low[replaced]]),
        np.concatenate([high[less], wider_high, wider_high[replaced]]),
    )
