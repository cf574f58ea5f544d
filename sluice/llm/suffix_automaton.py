"""A suffix automaton over a set of words, and the words that end each prefix of a text.

A state stands for all factors of the words that end in the same places; its
suffix link leads to the longest shorter suffix that ends in more places. A word
begins at its own start, so it is always the longest factor of its state.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

ROOT = 0


class SuffixAutomaton:
    """Words are given as (text, number); a text that is given twice has the later number, an empty one is never found."""

    def __init__(self, words: Iterable[tuple[str, int]]):
        words = [(text, number) for text, number in words if text]
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        for text, _ in words:
            state = ROOT
            for symbol in text:
                state = self._extended(state, symbol)
        self.number = [-1] * len(self.next)
        for text, number in words:
            state = ROOT
            for symbol in text:
                state = self.next[state][symbol]
            self.number[state] = number
        # The nearest state behind suffix links that is a word: shorter states come first.
        self.shorter = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.shorter[state] = up if self.number[up] >= 0 else self.shorter[up]

    def _state(self, length: int, link: int, following: dict[str, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.next) - 1

    def _extended(self, last: int, symbol: str) -> int:
        """The state of a word's start, after one more symbol."""
        if symbol in self.next[last]:
            return self._exact(last, symbol)
        state, at = self._state(self.length[last] + 1, ROOT, {}), last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._exact(at, symbol)
        return state

    def _exact(self, at: int, symbol: str) -> int:
        """The state of the longest factor of ``at`` and a symbol that follows it; split off if it has longer ones besides."""
        found = self.next[at][symbol]
        if self.length[found] == self.length[at] + 1:
            return found
        part = self._state(self.length[at] + 1, self.link[found], dict(self.next[found]))
        self.link[found] = part
        while at >= 0 and self.next[at].get(symbol) == found:
            self.next[at][symbol] = part
            at = self.link[at]
        return part

    def matches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """``(end, number, length)`` of every word in the text, by its last place, the longest first."""
        following, link, length, numbers, shorter = self.next, self.link, self.length, self.number, self.shorter
        state, size = ROOT, 0
        for end, symbol in enumerate(text):
            target = following[state].get(symbol)
            while target is None and state != ROOT:
                state = link[state]
                size = length[state]
                target = following[state].get(symbol)
            if target is None:
                continue
            state, size = target, size + 1
            # A state may have been reached by a shorter factor than its word.
            found = state if numbers[state] >= 0 and size == length[state] else shorter[state]
            while found >= 0:
                yield end, numbers[found], length[found]
                found = shorter[found]
