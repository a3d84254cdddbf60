"""Ternary search tree over sequences of turns, by any keys that compare: one block of a prefix trie and what its nodes hold."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

ROOT = 0


class TernaryTree:
    """Nodes are parallel lists; node 0 is the textless root.

    Children of a node form a binary search tree by turn: `below` and `above` are its branches,
    `inner` leads from a node to the top of its children's tree. `up` is the parent in the trie.
    """

    def __init__(self) -> None:
        self.turn, self.size, self.up, self.depth = [0], [0], [-1], [0]
        self.below, self.above, self.inner = [-1], [-1], [-1]
        #: Index of the sequence that ends at the node, -1 for none.
        self.end = [-1]

    def _child(self, node: int, turn: int, size: int) -> int:
        links, at = self.inner, node
        while links[at] >= 0:
            child = links[at]
            if turn == self.turn[child]:
                return child
            links, at = (self.below if turn < self.turn[child] else self.above), child
        made = links[at] = len(self.turn)
        for column, value in (
            (self.turn, turn), (self.size, size), (self.up, node), (self.depth, self.depth[node] + 1),
            (self.below, -1), (self.above, -1), (self.inner, -1), (self.end, -1),
        ):
            column.append(value)
        return made

    def insert(self, turns: Sequence[int], sizes: Sequence[int], index: int) -> None:
        node = ROOT
        for turn, size in zip(turns, sizes, strict=True):
            node = self._child(node, turn, size)
        self.end[node] = index

    def path(self, turns: Sequence[int], depth: int) -> list[int]:
        """Nodes of the first depth turns of a sequence that is in the tree, from the root."""
        nodes = [ROOT]
        for turn in turns[:depth]:
            nodes.append(self._child(nodes[-1], turn, 0))
        return nodes


def median_order(n: int) -> Iterator[int]:
    """0..n-1, the middle of a range before its halves, so that sorted input gives balanced trees."""
    ranges = [(0, n)]
    while ranges:
        low, high = ranges.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += [(middle + 1, high), (low, middle)]


def common_prefix(a: Sequence[int], b: Sequence[int]) -> int:
    """Number of leading turns that two sequences share."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n
