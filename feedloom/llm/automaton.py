"""Suffix automaton over words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence


class SuffixAutomaton:
    """Automaton of all runs of words in a set of passages, each with the place it ends at.

    Passages are kept apart by separators that no stream contains. Places count the words of all
    passages and separators from 0; ``passages`` gives the place each one starts at.
    """

    def __init__(self, passages: Iterable[Sequence[bytes]]):
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.end = [-1], [0], [-1]
        self.passages: list[int] = []
        self._last, self._size = 0, 0
        for words in passages:
            self.passages.append(self._size)
            for w in words:
                self._extend(self.ids.setdefault(w, len(self.ids)))
            self._extend(-1 - len(self.passages))

    def _extend(self, c: int) -> None:
        nxt, link, length, end = self.next, self.link, self.length, self.end
        cur = len(nxt)
        nxt.append({})
        length.append(length[self._last] + 1)
        end.append(self._size)
        link.append(0)
        p = self._last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                end.append(end[q])
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        self._last = cur
        self._size += 1

    def matches(self, words: Iterable[bytes], width: int) -> Iterator[tuple[int, int]]:
        """Where the matching statistic of the stream reaches ``width``: (index of the last word,
        first place in the passages where that run of ``width`` words ends)."""
        nxt, link, length, ids = self.next, self.link, self.length, self.ids
        v = n = 0
        for i, w in enumerate(words):
            c = ids.get(w)
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            else:
                v = n = 0
            if n >= width:
                # A longer match is not asked for: go on from the run of ``width`` words.
                while length[link[v]] >= width:
                    v = link[v]
                n = width
                yield i, self.end[v]
