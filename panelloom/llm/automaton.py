"""Generalised suffix automaton over sequences of word numbers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """Recognises every run of consecutive words of the added items; one state per set of equal end places."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, at: int, word: int) -> int:
        """The state for the strings of ``at`` plus ``word`` alone, cloned off if longer ones share it."""
        to = self.next[at][word]
        if self.length[to] == self.length[at] + 1:
            return to
        clone = self._state(self.length[at] + 1, self.link[to], dict(self.next[to]))
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = clone
            at = self.link[at]
        self.link[to] = clone
        return clone

    def add(self, words: Iterable[int]) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            new, at = self._state(self.length[last] + 1, 0, {}), last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word)
            last = new

    def finish(self, items: Sequence[tuple[int, Sequence[int]]]) -> None:
        """Note per state which items' windows end there: of ``window`` words, or a shorter item whole."""
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.holder = [0] * len(self.link)  # the state on the suffix path that has the window's length
        for s in order:
            up = self.link[s]
            if self.length[s] >= self.window:
                self.holder[s] = s if self.length[up] < self.window else self.holder[up]
        self.owners: dict[int, set[int]] = {}
        ending: dict[int, list[tuple[int, int]]] = {}
        for number, words in items:
            at = 0
            for i, word in enumerate(words):
                at = self.next[at][word]
                if i + 1 >= self.window:
                    self.owners.setdefault(self.holder[at], set()).add(number)
            if 0 < len(words) < self.window:
                while self.length[self.link[at]] >= len(words):
                    at = self.link[at]
                ending.setdefault(at, []).append((len(words), number))
        self.short: dict[int, list[tuple[int, int]]] = {}
        for s in order:
            found = ending.get(s, []) + self.short.get(self.link[s], [])
            if found:
                self.short[s] = found

    def stream(self, words: Sequence[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans ``(start, end)`` of window occurrences and the items they are of.

        The longest item run ending at each word is tracked; a span is written when it is a window long.
        """
        nexts, links, lengths, window = self.next, self.link, self.length, self.window
        spans, items = [], set()
        at = matched = 0
        for i, word in enumerate(words):
            while at and word not in nexts[at]:
                at = links[at]
                matched = lengths[at]
            to = nexts[at].get(word)
            if to is None:
                at = matched = 0
                continue
            at, matched = to, matched + 1
            if matched >= window:
                spans.append((i + 1 - window, i + 1))
                # `matched` words end in this state; its last `window` words end in the holder
                items |= self.owners[self.holder[at]]
            for size, number in self.short.get(at, ()):
                if size <= matched:
                    spans.append((i + 1 - size, i + 1))
                    items.add(number)
        return spans, items
