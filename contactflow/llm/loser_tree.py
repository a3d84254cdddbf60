"""k-way merge of sorted runs by a tree of losers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


def sorted_runs(keys: Sequence) -> list[tuple[int, int]]:
    """Ranges of keys that ascend as they stand."""
    starts = [0] + [i for i in range(1, len(keys)) if keys[i] < keys[i - 1]]
    return list(zip(starts, [*starts[1:], len(keys)], strict=True)) if len(keys) else []


def merge(keys: Sequence, runs: list[tuple[int, int]]) -> Iterator[int]:
    """Positions of keys in ascending order; equal keys by run, then by place in it.

    Inner node i of the tree holds the run that lost there and has the nodes 2i and 2i+1 below it;
    runs are the leaves k..2k-1. The winner moves on, and its next key plays again on the way to the root.
    """
    k = len(runs)
    at = [low for low, _ in runs]
    end = [high for _, high in runs]

    def beats(a: int, b: int) -> bool:
        if at[a] == end[a] or at[b] == end[b]:
            return at[a] < end[a]
        x, y = keys[at[a]], keys[at[b]]
        return x < y or (x == y and a < b)

    losers = [-1] * max(1, k)
    winners = [*[-1] * k, *range(k)]
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    winner = winners[1] if k else -1
    while k and at[winner] < end[winner]:
        yield at[winner]
        at[winner] += 1
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
