"""Names for stretches of text by recompression, the same wherever a stretch occurs.

First runs of one word get a name, then in each round pairs of neighbours: names are
divided into left and right ones by a bit that the round draws from them, and a left one
followed by a right one becomes a new symbol. Its name depends on the two names alone, so
equal stretches get equal symbols everywhere, apart from their ends. How far to either
side the words reach that decided about a symbol is kept with it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ledgerloom.llm.shingles import mix

ROUNDS = 3
#: Words of the shortest symbols that serve as anchors.
ANCHOR_WORDS = 2


@dataclass
class Symbols:
    name: np.ndarray
    start: np.ndarray  # first word
    end: np.ndarray  # behind the last word
    low: np.ndarray  # first word that decided about it
    high: np.ndarray  # behind the last one

    def take(self, which: np.ndarray) -> Symbols:
        return Symbols(*(x[which] for x in (self.name, self.start, self.end, self.low, self.high)))


def _runs(words: np.ndarray, edge: np.ndarray) -> Symbols:
    """Runs of one word as symbols; the words beside a run decide where it ends."""
    first = np.ones(len(words), bool)
    first[1:] = (words[1:] != words[:-1]) | edge[1:] | edge[:-1]
    start = np.flatnonzero(first)
    end = np.append(start[1:], len(words))
    size = end - start
    name = np.where(size > 1, mix(words[start] + mix(size.astype(np.uint64))), words[start])
    return Symbols(name, start, end, start - 1, end + 1)


def _pairs(now: Symbols, edge: np.ndarray, turn: int) -> tuple[Symbols, Symbols]:
    """The symbols after a round, and those that the round made."""
    side = mix(now.name + np.uint64(turn)) & np.uint64(1)
    real = ~edge[now.start]
    left, right = real & (side == 0), real & (side == 1)
    joins = np.zeros(len(side), bool)  # with the next one
    joins[:-1] = left[:-1] & right[1:]
    joined = np.zeros(len(side), bool)  # to the one before
    joined[1:] = joins[:-1]
    # A left symbol that stays alone does so because of the next one, a right one because
    # of the one before.
    low, high = now.low.copy(), now.high.copy()
    alone_right = right & ~joined
    low[1:][alone_right[1:]] = np.minimum(low[1:], now.low[:-1])[alone_right[1:]]
    alone_left = left & ~joins
    high[:-1][alone_left[:-1]] = np.maximum(high[:-1], now.high[1:])[alone_left[:-1]]
    at = np.flatnonzero(joins)
    name = now.name.copy()
    name[at] = mix(mix(now.name[at] + np.uint64(turn)) + now.name[at + 1])
    end = now.end.copy()
    end[at] = now.end[at + 1]
    low[at] = np.minimum(now.low[at], now.low[at + 1])
    high[at] = np.maximum(now.high[at], now.high[at + 1])
    after = Symbols(name, now.start, end, low, high)
    return after.take(~joined), after.take(at)


def anchors(words: np.ndarray, edge: np.ndarray, window: int) -> tuple[np.ndarray, Symbols]:
    """The anchor of each window of words, as an index of the symbols given with it.

    ``edge`` marks places between texts. A window's anchor is the longest symbol, of equals
    that with the greatest name's hash and of equal names the leftmost, of those that only
    words of the window decided about. So every occurrence of the window's words has an
    anchor of the same name at the same place, and no two occurrences share one; -1 where
    there is none.
    """
    now = _runs(words, edge)
    made = []
    for turn in range(1, ROUNDS + 1):
        now, new = _pairs(now, edge, turn)
        made.append(new)
    pool = Symbols(*(np.concatenate([getattr(m, f) for m in made]) for f in ("name", "start", "end", "low", "high")))
    fits = (pool.end - pool.start >= ANCHOR_WORDS) & (pool.high - pool.low <= window)
    pool = pool.take(fits & (pool.low >= 0) & (pool.high <= len(words)))
    size = (pool.end - pool.start).astype(np.uint64)
    rank = (size << np.uint64(48)) + (mix(pool.name) >> np.uint64(16))
    order = np.lexsort((-pool.start, rank))
    first, last = np.maximum(pool.high - window, 0)[order], pool.low[order]
    many = last - first + 1
    # The longest is written last and stays.
    best = np.full(max(0, len(words) - window + 1), -1, np.int64)
    at = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    of = np.repeat(order, many)
    inside = at < len(best)
    best[at[inside]] = of[inside]
    used, place = np.unique(best[best >= 0], return_inverse=True)
    best[best >= 0] = place
    return best, pool.take(used)
