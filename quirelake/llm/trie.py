"""A trie searched with a Levenshtein automaton."""

from __future__ import annotations

from collections.abc import Iterator

_END = ""


class Trie:
    """Words in a trie; :meth:`near` enumerates those within a bounded edit distance of a query.

    The automaton's state is the row of distances of the query's prefixes to the path so far; a
    branch is left as soon as no entry of the row is within the bound. A transposition of
    neighbours counts as one edit.
    """

    def __init__(self, words=()) -> None:
        self.root: dict = {}
        for w in words:
            self.add(w)

    def add(self, word: str) -> None:
        node = self.root
        for c in word:
            node = node.setdefault(c, {})
        node[_END] = word

    def near(self, query: str, bound: int) -> Iterator[tuple[str, int]]:
        """(word, distance) of every word within ``bound`` edits of ``query``, itself included."""
        first = list(range(len(query) + 1))
        stack = [(self.root, first, None, "", _END)]
        while stack:
            node, row, before, letter, _ = stack.pop()
            if _END in node and row[-1] <= bound:
                yield node[_END], row[-1]
            for c, child in node.items():
                if c == _END:
                    continue
                new = [row[0] + 1]
                for i, q in enumerate(query, 1):
                    d = min(new[i - 1] + 1, row[i] + 1, row[i - 1] + (q != c))
                    if before is not None and i > 1 and q == letter and query[i - 2] == c:
                        d = min(d, before[i - 2] + 1)
                    new.append(d)
                if min(new) <= bound or (letter and min(row) <= bound):
                    stack.append((child, new, row, c, letter))


def osa(a: str, b: str) -> int:
    """The edit distance of two words, a transposition of neighbours being one edit."""
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(new[j - 1] + 1, row[j] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        before, row = row, new
    return row[-1]
