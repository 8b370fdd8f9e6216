"""Many phrases in one pass over a text, in time that doesn't grow with their number.

``stems`` gives the few literals by which a text without any of the phrases is told at the speed of a substring search.
``Mentions`` finds phrases as whole words, ``Automaton`` finds them anywhere; both are made once a worker and read a text once.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator

from gazetta.functions.text import norm_python

_TOKEN = re.compile(r"[^\s\-:,/–—]+")


def stems(phrases: Iterable[str]) -> list[str]:
    """Folded words of which every text that holds one of the phrases holds one: the longest of each phrase, less those that hold another."""
    longest = {max(found, key=lambda w: (len(w), w)) for p in phrases if (found := _TOKEN.findall(norm_python(p)))}
    return sorted(w for w in longest if not any(o != w and o in w for o in longest))


class Mentions:
    """Phrases with what they stand for, found as whole words: one look-up for each word of a text, the longest phrase first.

    A phrase begins and ends where neither a letter, digit, underscore nor hyphen goes on; its words are apart by one space or hyphen.
    """

    _WORD = re.compile(r"[^\s-]+")

    def __init__(self, phrases: Iterable[tuple[str, str]]):
        #: First word -> (words, meaning), the longest first.
        self.by_first: dict[str, list[tuple[tuple[str, ...], str]]] = defaultdict(list)
        for phrase, meaning in phrases:
            words = tuple(self._WORD.findall(norm_python(phrase)))
            if words and (words, meaning) not in self.by_first[words[0]]:
                self.by_first[words[0]].append((words, meaning))
        for listed in self.by_first.values():
            listed.sort(key=lambda x: (-len(x[0]), x[0], x[1]))
        # Words may hold signs at their edges ("financas/fazenda", "desenvolvimento,"): a phrase is tried where its first word begins.
        firsts = sorted(self.by_first, key=lambda w: (-len(w), w))
        self.first = re.compile(r"(?<![\w-])(?:" + "|".join(map(re.escape, firsts)) + ")") if firsts else re.compile(r"(?!)")
        self.firsts_by_prefix: dict[str, list[str]] = {f: [g for g in firsts if f.startswith(g)] for f in firsts}

    def find(self, low: str) -> Iterator[tuple[int, int, str]]:
        """``(start, end, meaning)`` of all mentions in a folded text, by start; at one start the longest first."""
        for m in self.first.finditer(low):
            for first in self.firsts_by_prefix[m[0]]:
                for words, meaning in self.by_first[first]:
                    at = m.start() + len(first)
                    for w in words[1:]:
                        if low[at : at + 1] not in (" ", "-") or not low.startswith(w, at + 1):
                            break
                        at += 1 + len(w)
                    else:
                        after = low[at : at + 1]
                        if not after or not (after.isalnum() or after in "_-"):
                            yield m.start(), at, meaning


class Automaton:
    """Phrases found anywhere in a text (Aho and Corasick): one step a character, whatever the number of phrases."""

    def __init__(self, phrases: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        self.out: list[tuple[str, ...]] = [()]
        for phrase in dict.fromkeys(phrases):
            state = 0
            for c in phrase:
                if c not in self.next[state]:
                    self.next.append({})
                    self.out.append(())
                    self.next[state][c] = len(self.next) - 1
                state = self.next[state][c]
            if phrase:
                self.out[state] = (*self.out[state], phrase)
        self.fail = [0] * len(self.next)
        queue = deque(self.next[0].values())
        while queue:
            state = queue.popleft()
            for c, child in self.next[state].items():
                back = self.fail[state]
                while back and c not in self.next[back]:
                    back = self.fail[back]
                self.fail[child] = self.next[back].get(c, 0)
                self.out[child] = (*self.out[child], *self.out[self.fail[child]])
                queue.append(child)

    def find(self, text: str) -> Iterator[tuple[int, str]]:
        """``(end, phrase)`` of all phrases in the text."""
        state = 0
        for i, c in enumerate(text, 1):
            while state and c not in self.next[state]:
                state = self.fail[state]
            state = self.next[state].get(c, 0)
            for phrase in self.out[state]:
                yield i, phrase

    def any(self, text: str) -> bool:
        return next(self.find(text), None) is not None
