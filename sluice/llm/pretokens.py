"""Splitting batches of texts into pre-tokens with numpy, and looking at each different pre-token once.

A batch of texts becomes one array of code points with a guard between texts.
Classes of code points decide where pre-tokens start; a 64-bit sum of mixed
code points and places stands for a pre-token, so that only those not seen before are
made into strings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

GUARD, LETTER, NUMBER, BLANK, OTHER = 0, 1, 2, 3, 4
GUARD_POINT = 0x110000
# Code points that are worked on together, and different pre-tokens that a worker remembers.
CHUNK, SEEN = 1_000_000, 1_500_000


@cache
def classes() -> np.ndarray:
    """The class of every code point, and of the guard behind them."""
    out = np.full(GUARD_POINT + 1, OTHER, dtype=np.uint8)
    points = np.array([p for p in range(GUARD_POINT) if not 0xD800 <= p < 0xE000], dtype=np.uint32)
    text = points.tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\p{White_Space}")):
        found = np.frombuffer("".join(regex.findall(pattern, text)).encode("utf-32-le"), dtype=np.uint32)
        out[found] = kind
    out[GUARD_POINT] = GUARD
    return out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' code points with a guard before, between and after them, and each text's guard."""
    guard = np.array([GUARD_POINT], dtype=np.uint32)
    parts, lengths = [guard], np.empty(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        points = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        parts += (points, guard)
        lengths[i] = len(points) + 1
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(lengths)])


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def spans_hash(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans rise, do not overlap, are not empty, and end before the last code point."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    first = np.zeros(len(points), dtype=np.uint32)
    first[starts] = starts
    place = np.arange(1, len(points) + 1, dtype=np.uint32) - np.maximum.accumulate(first)
    values = _mixed((points.astype(np.uint64) << np.uint64(32)) | place)
    sums = np.add.reduceat(values, np.stack([starts, ends], axis=1).ravel())[::2]
    return _mixed(sums + (ends - starts).astype(np.uint64))


class SeenSpans:
    """Values of spans by hash, kept from batch to batch up to ``limit`` different ones, in arrays of some 40 bytes each."""

    def __init__(self, limit: int = SEEN):
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.keys, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.flat, self.begin, self.size = np.empty(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, keys: np.ndarray, values: list[np.ndarray]) -> None:
        sizes = np.array([len(v) for v in values], dtype=np.int64)
        at, count = len(self.keys), len(values)
        grown = self.used + int(sizes.sum())
        if grown > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(grown, np.uint32)])
        if at + count > len(self.begin):
            self.begin, self.size = (np.concatenate([x[:at], np.zeros(at + count, np.int64)]) for x in (self.begin, self.size))
        self.flat[self.used : grown] = np.concatenate(values)
        self.begin[at : at + count], self.size[at : at + count] = self.used + np.cumsum(sizes) - sizes, sizes
        places = np.searchsorted(self.keys, keys)
        self.keys, self.numbers = np.insert(self.keys, places, keys), np.insert(self.numbers, places, np.arange(at, at + count))
        self.used = grown

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where keys are, and which are there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), dtype=bool)
        places = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return places, self.keys[places] == keys

    def values_of(self, points, starts, ends, make) -> tuple[np.ndarray, np.ndarray]:
        """The spans' values, one after the other, and how long each is; ``make(strings)`` gives those not seen before."""
        if not len(starts):
            return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        different, first, place = np.unique(spans_hash(points, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(different) > self.limit:
            self._forget()
        places, known = self._places(different)
        if not known.all():
            at = first[~known]
            strings = [points[a:b].tobytes().decode("utf-32-le", "surrogatepass") for a, b in zip(starts[at], ends[at], strict=True)]
            self._learn(different[~known], list(make(strings)))
            places, _ = self._places(different)
        numbers = self.numbers[places][place]
        lengths = self.size[numbers]
        shift = np.repeat(self.begin[numbers] - (np.cumsum(lengths) - lengths), lengths)
        shift += np.arange(len(shift))
        return self.flat[shift], lengths


# Cutting a long text here changes neither its pre-tokens nor its normal form.
_SAFE_CUT = regex.compile(r"(?<=\p{L}) (?=\p{L})")


def pieces(text: str, size: int) -> list[str]:
    """A text in parts of about ``size`` code points, cut only between two words of letters."""
    out, at = [], 0
    while len(text) - at > size:
        found = _SAFE_CUT.search(text, at + size)
        if not found:
            break
        out.append(text[at : found.start()])
        at = found.start()
    return [*out, text[at:]]


def grouped(texts: list[str], size: int) -> list[list[int]]:
    """Runs of consecutive texts with about ``size`` code points together."""
    out, now = [[]], 0
    for i, t in enumerate(texts):
        if out[-1] and now + len(t) > size:
            out.append([])
            now = 0
        out[-1].append(i)
        now += len(t)
    return out if out[0] else []


def column_parts(column: pa.Array, size: int) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of a column with about ``size`` bytes together, and where each run starts; NULL is empty."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(lengths) - lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lengths)] if len(lengths) else []
    for a, b in zip(cuts, cuts[1:]):
        yield a, ["" if t is None else t for t in column.slice(a, b - a).to_pylist()]


def contractions(points: np.ndarray, starts: np.ndarray, kinds: np.ndarray) -> None:
    """Where a pre-token starts with an apostrophe, move the start behind it past s, t, m, d, re, ve or ll."""
    at = np.flatnonzero(starts & (points == ord("'")))
    at = at[kinds[at + 1] == LETTER]
    if not len(at):
        return
    one, two = points[at + 1], points[np.minimum(at + 2, len(points) - 1)]
    length = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
    for a, b in ("re", "ve", "ll"):
        length[(one == ord(a)) & (two == ord(b))] = 2
    at, length = at[length > 0], length[length > 0]
    starts[at + 1] = False
    behind = at + 1 + length
    starts[behind] |= kinds[behind] == LETTER


class TextEncoder:
    """Encodes batches of texts whose pre-tokens are encoded independently of each other; keeps the ids of those seen.

    ``specials`` are texts with an id of their own, ``normal`` is applied to
    what is between them, ``spans`` gives starts and ends of the pre-tokens in
    an array of code points with their classes, ``make`` the ids of pre-tokens.
    """

    def __init__(
        self,
        specials: dict[str, int],
        normal: Callable[[str], str],
        spans: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
        make: Callable[[list[str]], Iterable[np.ndarray]],
    ):
        self.specials, self.normal, self.spans, self.make = specials, normal, spans, make
        self.seen = SeenSpans(SEEN)
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None

    def forget(self) -> None:
        """Let go of the ids of pre-tokens that were seen."""
        self.seen = SeenSpans(SEEN)

    def _segments(self, text: str) -> list[str | int]:
        """Normal parts of bounded length, and ids of special tokens written out in the text."""
        parts = self.special.split(text) if self.special and self.special.search(text) else [text]
        out: list[str | int] = []
        for part in parts:
            if part in self.specials:
                out.append(self.specials[part])
            else:
                out += [self.normal(p) for p in pieces(part, CHUNK)]
        return out

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text in turn."""
        for group in grouped(texts, CHUNK):
            segments = [self._segments(texts[i]) for i in group]
            plain = [s for parts in segments for s in parts if isinstance(s, str)]
            done = (ids for run in grouped(plain, CHUNK) for ids in self._encode(plain[run[0] : run[-1] + 1]))
            for parts in segments:
                arrays = [next(done) if isinstance(s, str) else np.array([s], dtype=np.uint32) for s in parts]
                yield np.concatenate(arrays) if len(arrays) != 1 else arrays[0]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        points, guards = code_points(texts)
        begin, end = self.spans(points, classes()[points])
        ids, lengths = self.seen.values_of(points, begin, end, self.make)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        cuts = ends[np.searchsorted(begin, guards)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _ends(starts: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts as places, and for each where the next one or a guard is."""
    begin = np.flatnonzero(starts)
    stops = np.flatnonzero(starts | (kinds == GUARD))
    return begin, stops[np.searchsorted(stops, begin, "right")] if len(begin) else begin


def _runs(kinds: np.ndarray) -> np.ndarray:
    starts = np.empty(len(kinds), dtype=bool)
    starts[0] = False
    starts[1:] = kinds[1:] != kinds[:-1]
    return starts & (kinds != GUARD)


def word_spans(points: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contractions, runs of letters, single numbers, runs of others; white space is left out."""
    starts = _runs(kinds) | (kinds == NUMBER)
    contractions(points, starts, kinds)
    begin, end = _ends(starts, kinds)
    words = kinds[begin] != BLANK
    return begin[words], end[words]


def spaced_spans(points: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contractions and runs of letters, numbers or others, each with one space before it; other white space by itself.

    Of white space before something else, the last one is apart: a space goes to what follows.
    """
    starts = _runs(kinds)
    blank = kinds == BLANK
    last = np.zeros(len(kinds), dtype=bool)
    last[:-1] = blank[:-1] & ~blank[1:] & (kinds[1:] != GUARD)
    starts |= last
    starts[1:] &= ~(last[:-1] & (points[:-1] == ord(" ")))
    contractions(points, starts, kinds)
    return _ends(starts, kinds)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in shown else next(free)) for b in range(256)]
