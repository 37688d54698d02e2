"""Word and shingle names for operators that compare texts: 64-bit hashes made in Arrow batches.

A name depends on the words alone, so tasks agree on it without talking to one another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from ledgerloom.llm.common import split_words

#: Odd multipliers and shifts of a 64-bit finaliser (fixed values).
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of a number spread over all bits; different numbers stay different."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def word_names(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A name for each word of each text, and the number of words of each text."""
    words, counts = split_words(texts, lower)
    encoded = words.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    codes, different = encoded.indices.to_numpy(False), encoded.dictionary
    if not len(different):
        return np.zeros(0, np.uint64), counts
    # The words' bytes as they lie there; a string for each would take most of the time.
    data = different.buffers()[2].to_pybytes()
    ends = np.frombuffer(different.buffers()[1], np.int64)[different.offset :][: len(different) + 1].tolist()
    names = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return np.array(names, np.uint64)[codes], counts


def window_names(names: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A name for each window of ``size`` words, also of those that cross texts."""
    n = max(0, len(names) - size + 1)
    out = np.full(n, (seed * _STEP + size) & (2**64 - 1), np.uint64)
    for k in range(size):
        out = mix(out + names[k : n + k])
    return out


def shingle_sets(
    names: np.ndarray, counts: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text in order of text and name; and the text of each.

    A text of fewer words than a shingle has is one shingle; a text without words has none.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    windows = window_names(names, size)
    inside = owner[: len(windows)] == owner[size - 1 :] if len(windows) else np.zeros(0, bool)
    found, of = [windows[inside]], [owner[: len(windows)][inside]]
    ends = np.cumsum(counts)
    for short in range(1, size):
        texts = np.flatnonzero(counts == short)
        if len(texts):
            starts = ends[texts] - short
            name = np.full(len(texts), short, np.uint64)
            for k in range(short):
                name = mix(name + names[starts + k])
            found.append(name)
            of.append(texts)
    found, of = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    return found[new], of[new]
