"""Words and shingles of texts as 64-bit hashes, with numpy.

Words are runs of bytes other than white space, A-Z in lower case; UTF-8 keeps
both rules the same for bytes and for code points.
"""

from __future__ import annotations

import numpy as np

from sluice.llm.common import SPACE

# Bytes that are worked on together; a longer text is hashed in parts, cut at white space.
PART = 1 << 22

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[ord(c) for c in SPACE]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _part_words(data: np.ndarray) -> np.ndarray:
    blank = _BLANK[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    first = np.zeros(len(data), dtype=np.int64)
    first[starts] = starts
    place = np.arange(len(data), dtype=np.int64) - np.maximum.accumulate(first)
    values = mixed((place.astype(np.uint64) << np.uint64(8)) + _LOWER[data] + np.uint64(1))
    values[blank] = 0
    return mixed(np.add.reduceat(values, starts) + (ends - starts).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """The hash of each word, in order."""
    return hashed_words(np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8))


def hashed_words(data: np.ndarray) -> np.ndarray:
    """The same of a text's bytes."""
    if len(data) <= PART:
        return _part_words(data)
    out, at = [], 0
    while at < len(data):
        end = min(at + PART, len(data))
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        out.append(_part_words(data[at:end]))
        at = end
    return np.concatenate(out)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted different shingles; a shorter text is one shingle, a text without words has none."""
    words = word_hashes(text)
    if not len(words):
        return words
    length = min(size, len(words))
    places = mixed(np.arange(1, length + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.full(len(words) - length + 1, length, dtype=np.uint64)
    for i in range(length):
        out += words[i : len(words) - length + 1 + i] * places[i]
    return np.unique(mixed(out))


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed integers."""
    one, two = np.add.reduce(mixed(shingles + np.uint64(1))), np.add.reduce(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    n = np.uint64(len(shingles))
    return tuple(mixed(np.array([one + n, two ^ n], dtype=np.uint64)).view(np.int64).tolist())
