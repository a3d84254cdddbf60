"""Removal of repeated word passages: suffix automata of reference shards, streamed for matching statistics."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS
from .shared_windows import remove_repeats

WINDOW = 50
GRAM = 8
#: Remembered word hashes per worker, and words per automaton; they bound memory only.
MAX_WORDS, SHARD = 500_000, 40_000
FAR = 2**63 - 1


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


HASHES = _Hashes()


class WordUnits:
    """Words [^\\x20\\x09-\\x0D]+, unchanged."""

    stride = 1

    def __init__(self, window: int, gram: int) -> None:
        self.window, self.gram = window, gram

    def split(self, raw: bytes) -> list[bytes]:
        return raw.split()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))

    def join(self, words: list[bytes]) -> bytes:
        return b" ".join(words)

    def join_kept(self, words: list[bytes], begin: list[int], end: list[int]) -> list[bytes]:
        return [w for a, b in zip([0, *end], [*begin, len(words)], strict=True) for w in words[a:b]]

    def digest(self, kept: list[bytes]) -> str:
        return hashlib.sha256(b" ".join(kept)).hexdigest()


class SuffixAutomaton:
    """Automaton of the substrings of many strings; each state knows the smallest id that holds it."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.least = [FAR]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.least.append(FAR)
        return len(self.length) - 1

    def _clone(self, p: int, symbol, q: int) -> int:
        """Split q so that the strings p + symbol have a state of their own."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def add(self, string: list, number: int) -> None:
        last = 0
        for symbol in string:
            p, q = last, self.next[last].get(symbol)
            if q is not None:
                last = q if self.length[q] == self.length[p] + 1 else self._clone(p, symbol, q)
            else:
                last = self._state(self.length[p] + 1, {}, 0)
                while p >= 0 and symbol not in self.next[p]:
                    self.next[p][symbol] = last
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][symbol]
                    self.link[last] = q if self.length[q] == self.length[p] + 1 else self._clone(p, symbol, q)
            if number < self.least[last]:
                self.least[last] = number

    def close(self) -> None:
        """Hand smallest ids down to the suffixes; call once all strings are added."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            to = self.link[state]
            if self.least[state] < self.least[to]:
                self.least[to] = self.least[state]

    def holders(self, string: list, window: int) -> np.ndarray:
        """Smallest id that holds each window of a string, FAR where the match is shorter.

        Streams the string once and keeps its matching statistic: the state and length of the
        longest match that ends at the present word, cut back to the window.
        """
        state, matched, out = 0, 0, []
        for symbol in string:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                matched += 1
            while self.length[self.link[state]] >= window:
                state = self.link[state]
                matched = self.length[state]
            out.append(self.least[state] if matched >= window else FAR)
        return np.array(out[window - 1 :], np.int64)


class AutomatonEngine:
    """Contexts become automata of about SHARD words, and are streamed through the automaton of their shard."""

    def __init__(self, window: int) -> None:
        self.window = window

    def __call__(self, groups: list[list[tuple[bytes, int]]]) -> list[list[np.ndarray]]:
        out: list[list[np.ndarray]] = []
        shard: list[list[tuple[list[bytes], int]]] = []
        size = 0
        for i, group in enumerate(groups):
            shard.append([(content.split(b" "), least) for content, least in group])
            size += sum(len(words) for words, _ in shard[-1])
            if size >= SHARD or i == len(groups) - 1:
                automaton = SuffixAutomaton()
                for words, least in (c for g in shard for c in g):
                    automaton.add(words, least)
                automaton.close()
                out.extend([automaton.holders(words, self.window) for words, _ in g] for g in shard)
                shard, size = [], 0
        return out


def deduplicate(spark: SparkSession, docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(order_id, doc_id, total, removed, n_spans, kept_sha256, spans) for each row of docs(doc_id, text, ...).

    Counts and spans are in words. Each word that is covered by a run of `window` words which also
    starts in a document with a smaller doc_id is removed; runs are judged on the input. Shards of
    the reference are not broadcast, as the reference is the table itself and grows with it: a
    shard holds the contexts of the anchors dealt to it, and meets just the contexts it can match.
    A null text has no words. A null doc_id sorts last and stays null; rows that share a doc_id do
    not remove from each other; repeated rows give equal results. Other columns are not read; an
    empty table gives an empty table.
    """
    joined = F.trim(F.regexp_replace("text", BLANKS, " "))
    total = F.when(joined == "", 0).otherwise(F.length(joined) - F.length(F.replace(joined, F.lit(" "))) + 1)
    return remove_repeats(
        spark, docs, WordUnits(window, gram), AutomatonEngine(window), total, F.sha2(joined.cast("binary"), 256),
        hashlib.sha256(b"").hexdigest(),
    )
