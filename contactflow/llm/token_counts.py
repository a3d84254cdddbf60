"""Token counts by a byte-level BPE vocabulary compiled to a deterministic transducer."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how this family of byte-level tokenizers cuts a text before any merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters per chunk of a long text.
CHUNK = 1 << 16
#: Compiled states and remembered words after which a worker starts afresh; bounds memory only.
MAX_STATES = 400_000
MAX_WORDS = 500_000
SHIFT, HALF = 12, 1 << 11

PIECES = regex.compile(PATTERN)
#: No piece holds a non-space followed by a space, so a text may be cut there.
CUT = regex.compile(r"(?<=\S)(?=\s)")
#: Without white space right before a space, or a space at the end, each space begins a piece of its own.
WIDE = regex.compile(r"\s | $")


def byte_symbols() -> dict[str, int]:
    """Character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Transducer:
    """Reads the bytes of a piece; each transition is annotated with the tokens it adds.

    The tokens of every prefix of a piece are the tokens of a shorter prefix and one more: the only
    token that ends there and stays whole beside the one before it. A state therefore needs the last
    token and the token count (relative to the present one) of just those prefixes where a longer
    token may still begin: where what has been read since begins some token. That is a finite set of
    states; they are compiled when first reached and kept.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list) -> None:
        symbols = byte_symbols()
        raw = lambda s: bytes(symbols[c] for c in s)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        tokens = {raw(t) for t in vocabulary}
        self.openings = {t[:i] for t in tokens for i in range(len(t))}
        never = len(self.ranks)
        #: For each token the symbols at its right and left edge while it forms, each with the rank
        #: of the merge that uses the symbol up.
        self.right: dict[bytes, list] = {}
        self.left: dict[bytes, list] = {}
        for t in sorted(tokens, key=len):
            self.right[t] = [(t, never)]
            self.left[t] = [(t, never)]
        for (a, b), rank in self.ranks.items():
            t = a + b
            self.right[t] = [(t, never), (b, rank), *self.right[b][1:]]
            self.left[t] = [(t, never), (a, rank), *self.left[a][1:]]
        self.whole = {t for t in tokens if self.merge(t) == [t]}
        self.reset()

    def reset(self) -> None:
        start = (b"", ((None, 0),))
        self.states = [start]
        self.numbers = {start: 0}
        #: state << 8 | byte to next state << SHIFT | tokens added + HALF.
        self.moves: dict[int, int] = {}

    def merge(self, word: bytes) -> list[bytes]:
        """Tokens of a short byte string, straight from the merge list."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(p, len(self.ranks)), i) for i, p in enumerate(zip(parts, parts[1:], strict=False))]
            rank, at = min(ranked)
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, before: bytes, token: bytes) -> bool:
        """Whether no merge crosses the border of two tokens before both are formed.

        A merge across needs a symbol at each side of the border; it takes place if it ranks before
        the merge that uses up the left one and not after the one that uses up the right one, as of
        equal merges the leftmost goes first.
        """
        ranks = self.ranks
        for x, x_used in self.right[before]:
            for y, y_used in self.left[token]:
                rank = ranks.get((x, y))
                if rank is not None and rank < x_used and rank <= y_used:
                    return False
        return True

    def compile(self, state: int, byte: int) -> int:
        suffix, prefixes = self.states[state]
        suffix += bytes((byte,))
        whole = self.whole
        for at, prefix in enumerate(prefixes):
            if prefix is not None and (token := suffix[at:]) in whole:
                if prefix[0] is None or self.stays(prefix[0], token):
                    break
        else:
            raise ValueError(f"the vocabulary has no token that ends {suffix!r}")
        added = prefix[1] + 1
        openings = self.openings
        useful = [p is not None and suffix[i:] in openings for i, p in enumerate(prefixes)]
        skip = useful.index(True) if True in useful else len(useful)
        carried = [
            (p[0], p[1] - added) if u else None for u, p in zip(useful[skip:], prefixes[skip:], strict=True)
        ]
        key = (suffix[skip:], (*carried, (token, 0)))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
        move = self.moves[state << 8 | byte] = number << SHIFT | added + HALF
        return move

    def count(self, piece: bytes) -> int:
        if len(self.states) > MAX_STATES:
            self.reset()
        state = total = 0
        get = self.moves.get
        for byte in piece:
            move = get(state << 8 | byte) or self.compile(state, byte)
            state = move >> SHIFT
            total += (move & 2 * HALF - 1) - HALF
        return total


class _Known(dict):
    """Remembered counts; forgets all when full, which costs time but changes no count."""

    def __init__(self, count) -> None:
        self.count = count

    def __missing__(self, text: str) -> int:
        n = self.count(text)
        if len(text) < 40 and "\n" not in text:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[text] = n
        return n


class Counter:
    """Counts the tokens of texts; special strings count one token each, wherever they stand."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.transducer = Transducer(spec["model"]["vocab"], spec["model"]["merges"])
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.pieces = _Known(lambda piece: self.transducer.count(piece.encode()))
        #: Words by the tokens they have after one space.
        self.words = _Known(self._word)

    def _cut(self, text: str) -> int:
        return sum(map(self.pieces.__getitem__, PIECES.findall(text)))

    def _word(self, word: str) -> int:
        return self._cut(" " + word)

    def fragment(self, text: str) -> int:
        """Tokens of a text that neither begins nor ends inside a piece."""
        if WIDE.search(text):
            return self._cut(text)
        first, *words = text.split(" ")
        return self._cut(first) + sum(map(self.words.__getitem__, words))

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, tokens between the outer cuts, tail); without a cut all is head and the count None."""
        first = CUT.search(chunk)
        if first is None:
            return chunk, None, ""
        last = first.end()
        for at in range(len(chunk) - 1, last, -1):
            if chunk[at].isspace() and CUT.match(chunk, at):
                last = at
                break
        return chunk[: first.end()], self.fragment(chunk[first.end() : last]), chunk[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """Map of two neighbouring chunks; associative, so chunks may be combined in any grouping."""
        if a[1] is None and b[1] is None:
            return a[0] + b[0], None, ""
        if a[1] is None:
            # A cut may lie between the two.
            return (a[0] + b[0], b[1], b[2])
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.fragment(a[2] + b[0]) + b[1], b[2]

    def segment(self, text: str) -> int:
        if len(text) <= CHUNK:
            return self.fragment(text)
        maps = [self.chunk_map(text[at : at + CHUNK]) for at in range(0, len(text), CHUNK)]
        while len(maps) > 1:  # tree scan
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = pairs + maps[2 * len(pairs) :]
        head, between, tail = maps[0]
        if between is None:
            return self.fragment(head)
        return self.fragment(head) + between + self.fragment(tail)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None:
            return self.segment(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.segment, parts))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One compiled counter per worker process."""
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of docs(doc_id, text, ...).

    tokenizer is the path of a byte-level BPE file in the tokenizers format, readable on every
    executor. The count is that of the library without added begin or end tokens, truncation or
    padding; strings of special tokens inside a text count as those tokens. Null and empty texts
    have no bytes and no tokens. Long texts are counted by chunks whose maps are composed. A null
    doc_id stays null, repeated rows are counted each, other columns are not read, an empty table
    gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(tokenizer)
        for batch in batches:
            tokens = [tool.count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("text").cast("string").alias("text"),
    )
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
