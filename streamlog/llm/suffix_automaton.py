"""A suffix automaton over words, for matching statistics."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class SuffixAutomaton:
    """Accepts every run of words of the passages added; about two states a word."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def add(self, passage: Iterable) -> None:
        """Append one passage; runs never reach from one passage into the next."""
        goto, link, length, last = self.next, self.link, self.length, 0
        for word in passage:
            at = goto[last].get(word)
            if at is not None:  # known from an earlier passage
                if length[at] == length[last] + 1:
                    last = at
                    continue
                last = self._split(last, word, at)
                continue
            new = len(goto)
            goto.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and word not in goto[p]:
                goto[p][word] = new
                p = link[p]
            if p >= 0:
                q = goto[p][word]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
            last = new

    def _split(self, p: int, word, q: int) -> int:
        """A copy of ``q`` for the shorter runs that ``p`` leads to."""
        goto, link, length = self.next, self.link, self.length
        copy = len(goto)
        goto.append(dict(goto[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and goto[p].get(word) == q:
            goto[p][word] = copy
            p = link[p]
        return copy

    def statistics(self, words: Iterable) -> Iterator[int]:
        """For each word the length of the longest run ending there that a passage holds."""
        goto, link, length, state, size = self.next, self.link, self.length, 0, 0
        for word in words:
            to = goto[state].get(word)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = goto[state].get(word)
            if to is None:
                size = 0
            else:
                state, size = to, size + 1
            yield size

    def holds_windows(self, words: Iterable, width: int) -> bool:
        """Whether the statistic reaches ``width`` at every word from the ``width``-th on."""
        goto, link, length, state, size, short = self.next, self.link, self.length, 0, 0, width - 1
        for word in words:
            to = goto[state].get(word)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = goto[state].get(word)
            if to is None:
                size = 0
            else:
                state, size = to, size + 1
            if short:
                short -= 1
            elif size < width:
                return False
        return True
