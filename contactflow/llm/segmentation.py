"""SentencePiece encoding and decoding: sampled segmentations without replacement.

The pieces of a text form a lattice; a segmentation is a path, with the product of its piece
probabilities as weight. Distinct segmentations are sampled by Gumbel top-k: a best-first (A*)
search over sets of paths, each with a perturbed log-probability that bounds all paths in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released

SPACE = "▁"
#: A piece of rank r has weight 1 / (r + ZIPF) before sharpening.
ZIPF = 10.0
#: Exponent of the piece weights: larger values favour segmentations into few, frequent pieces.
SHARPNESS = 1.0
#: Characters of text that are segmented at once; bounds the memory of a task.
BATCH_CHARS = 150_000
#: Characters of words whose lattices a worker keeps between batches.
MAX_NODES = 800_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as a trie in sorted arrays, with log weights."""

    spelled: np.ndarray  # piece id to text
    weight: np.ndarray
    edge_key: np.ndarray  # node << 21 | character, each at its hash or the next free place, else -1
    edge_to: np.ndarray
    piece_at: np.ndarray  # node to piece id, or -1
    byte_id: np.ndarray  # byte to piece id
    depth: int
    roots: np.ndarray  # first character to node, 0 if no piece begins with it

    def follow(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the keys that are edges, in order, and the nodes these lead to."""
        slot = _slots(key, len(self.edge_key))
        found = self.edge_key[slot]
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % len(self.edge_key)
            found[open_] = self.edge_key[slot[open_]]
            open_ = open_[(found[open_] != key[open_]) & (found[open_] >= 0)]
        known = np.flatnonzero(found == key)
        return known, self.edge_to[slot[known]]


def _slots(key: np.ndarray, size: int) -> np.ndarray:
    """Hash of keys into a table whose size is a power of two."""
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _edge_table(key: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open hash table of distinct keys, at most a quarter full."""
    size = 1 << (4 * len(key)).bit_length()
    keys, goals = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    slot, left = _slots(key, size), np.arange(len(key))
    while len(left):
        free = left[keys[slot[left]] < 0]
        keys[slot[free]] = key[free]  # of several keys for a place one stays
        settled = keys[slot[left]] == key[left]
        goals[slot[left[settled]]] = to[left[settled]]
        left = left[~settled]
        slot[left] = (slot[left] + 1) % size
    return keys, goals


@lru_cache(maxsize=2)
def vocabulary(path: str, sharpness: float = SHARPNESS) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(size)]
    ranked = sorted((i for i in range(size) if not special[i]), key=lambda i: (-model.get_score(i), i))
    log_weight = np.full(size, -np.inf)
    log_weight[ranked] = -sharpness * np.log(np.arange(len(ranked)) + ZIPF)
    floor = -sharpness * np.log(len(ranked) + ZIPF) - 10.0
    byte_id = np.full(256, -1)
    for i in range(size):
        if model.is_byte(i):
            byte_id[int(pieces[i][3:5], 16)] = i
            log_weight[i] = floor
    nodes: dict[tuple[int, int], int] = {}
    ends: dict[int, int] = {}
    for i in ranked:
        at = 0
        for c in pieces[i]:
            at = nodes.setdefault((at, ord(c)), len(nodes) + 1)
        ends[at] = i
    key = np.array([a << 21 | c for a, c in nodes], np.int64)
    piece_at = np.full(len(nodes) + 1, -1)
    for at, i in ends.items():
        piece_at[at] = i
    to = np.fromiter(nodes.values(), np.int64, len(nodes))
    depth = max(len(pieces[i]) for i in ranked)
    spelled = [p.replace(SPACE, " ").encode() for p in pieces]
    for byte, i in enumerate(byte_id):
        spelled[i] = bytes([byte])
    spelled = np.array(spelled, object)
    roots = np.zeros(max(ord(pieces[i][0]) for i in ranked) + 2, np.int64)  # the last stands for all beyond
    for i in ranked:
        roots[ord(pieces[i][0])] = nodes[0, ord(pieces[i][0])]
    if any("\n" in pieces[i] for i in ranked):
        raise ValueError("pieces with line breaks are not supported")
    return Vocabulary(spelled, log_weight, *_edge_table(key, to), piece_at, byte_id, depth, roots)


def normalise(text: str) -> str:
    """Text as the lattice sees it: a space in front, spaces as marks; nothing else is changed."""
    return SPACE + text.replace(" ", SPACE) if text else ""


#: Shares e^-40 times the largest are below the precision of a double.
NEGLIGIBLE = 40.0
#: Stretches that no piece crosses, as pieces have their space marks in front and hold no line break.
STRETCH = regex.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
CUT = "\x01"


def split_words(text: str) -> list[str]:
    """Stretches of a normalised text, in order; a leading mark is written as a space."""
    if not text:
        return []
    if "  " not in text and text[0] != " " and SPACE not in text and CUT not in text:
        # The same cuts by plain replacement.
        marked = text.replace(" ", CUT + " ")
        if "\n" in marked:
            marked = marked.replace("\n", CUT + "\n" + CUT)
        return list(filter(None, (" " + marked).split(CUT)))
    return [w.replace(SPACE, " ") for w in STRETCH.findall(normalise(text))]


class Lattice(dict):
    """Lattices of words, flat, one node per character; maps a word to its number.

    For each node, the edges that end there, longest first: their start, piece (or -1 for the
    bytes of a character that no piece holds) and probability given that the path passes the node.
    A worker keeps the lattices of earlier batches; they do not depend on where a word stands.
    """

    def __init__(self, vocab: Vocabulary) -> None:
        super().__init__()
        self.vocab = vocab
        self.fresh: list[str] = []
        #: How many words, nodes and edges are filled; the arrays have room beyond.
        self.words = self.nodes = self.edges = 0
        self.start = self.piece = self.begin = self.end = np.empty(0, np.int32)
        self.log_q = np.empty(0)
        self.cumulative, self.first = np.empty(0, np.float32), np.zeros(1, np.int32)
        self.codes = np.empty(0, np.uint32)

    def _append(self, name: str, filled: int, values: np.ndarray) -> None:
        """Writes values behind the filled part; room doubles, so that few calls copy."""
        array = getattr(self, name)
        size = filled + len(values)
        if size > len(array):
            grown = np.empty(max(size, 2 * len(array)), array.dtype)
            grown[:filled] = array[:filled]
            setattr(self, name, grown)
            array = grown
        array[filled:size] = values

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def clear(self) -> None:
        """Forget all words; the room stays."""
        super().clear()
        self.words = self.nodes = self.edges = 0

    def character(self, node: int) -> bytes:
        return chr(self.codes[node]).encode("utf-8", "surrogatepass")

    def build(self) -> None:
        """Add the lattices of the words looked up since the last call."""
        if not self.fresh:
            return
        words, vocab = self.fresh, self.vocab
        self.fresh = []
        text = "".join(words).replace(" ", SPACE).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(text, np.uint32).astype(np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(length)
        begin = end - length
        word = np.repeat(np.arange(len(words)), length)
        room = end[word] - np.arange(len(codes))
        # Walk the trie from every character at once; few positions survive many steps.
        starts, ids = [], []
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for step in range(vocab.depth):
            if step:
                inside = np.flatnonzero(room[at] > step)
                at, node = at[inside], node[inside]
                if not len(at):
                    break
                known, node = vocab.follow(node << 21 | codes[at + step])
                at = at[known]
            else:
                node = vocab.roots[np.minimum(codes, len(vocab.roots) - 1)]
                at, node = at[node > 0], node[node > 0]
            piece = vocab.piece_at[node]
            is_piece = np.flatnonzero(piece >= 0)
            starts.append(at[is_piece])
            ids.append(piece[is_piece])
        single = np.zeros(len(codes), bool)
        single[starts[0]] = True
        lone = np.flatnonzero(~single)
        width = 1 + (codes[lone] >= 0x80) + (codes[lone] >= 0x800) + (codes[lone] >= 0x10000)
        # Longer pieces first, as they tend to be likelier; each step's edges are sorted already.
        steps = list(range(len(starts) - 1, -1, -1))
        start = np.concatenate([*(starts[i] for i in steps), lone])
        last = np.concatenate([*(starts[i] + i for i in steps), lone])
        piece = np.concatenate([*(ids[i] for i in steps), np.full(len(lone), -1)])
        weight = np.concatenate([vocab.weight[piece[: len(piece) - len(lone)]], vocab.weight[vocab.byte_id[0]] * width])
        order = np.argsort(last, kind="stable")
        start, last, piece, weight = start[order], last[order], piece[order], weight[order]
        # Forward pass: log of the weight of all paths that end at a node, position by position.
        total = np.full(len(codes), -np.inf)
        head = begin[word[last]]
        depth = last - head
        by_depth = np.argsort(depth.astype(np.int16) if length.max() < 1 << 15 else depth, kind="stable")
        cuts = np.cumsum(np.bincount(depth, minlength=int(length.max())))
        scored = np.empty(len(weight))
        for lo, hi in zip([0, *cuts.tolist()], cuts.tolist(), strict=False):
            e = by_depth[lo:hi]
            node = last[e]
            before = total[start[e] - 1]
            scored[e] = value = weight[e] + np.where(start[e] == head[e], 0.0, before)
            run = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            top = np.maximum.reduceat(value, run)
            size = np.diff(np.append(run, len(e)))
            total[node[run]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, size)), run))
        log_q = np.minimum(scored - total[last], 0.0)
        degree = np.bincount(last, minlength=len(codes))
        behind = np.cumsum(degree)
        # Shares are summed as integers, so that sums do not depend on the words built beside.
        share = np.rint(np.exp(log_q) * 2.0**40).astype(np.int64)
        sums = np.cumsum(share)
        cumulative = (sums - np.repeat((sums - share)[behind - degree], degree)).astype(np.float32) * np.float32(2.0**-40)
        cumulative[behind - 1] = np.inf  # a node's last edge takes the rest
        nodes, edges = self.nodes, self.edges
        self._append("first", nodes + 1, edges + behind)
        self._append("start", edges, start + nodes)
        self._append("piece", edges, piece)
        self._append("log_q", edges, log_q)
        self._append("cumulative", edges, cumulative)
        self._append("begin", self.words, begin + nodes)
        self._append("end", self.words, end + nodes)
        self._append("codes", nodes, codes)
        self.words += len(words)
        self.nodes += len(codes)
        self.edges += len(start)


def _uniform(key: np.ndarray, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
    """Uniform numbers in (0, 1) from a row key and two counters; the same on every run and split."""
    a, b = np.atleast_1d(a).astype(np.uint64), np.atleast_1d(b).astype(np.uint64)
    x = key + (a + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xD1B54A32D192ED03)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x >>= np.uint64(11)
    return (x.astype(np.float64) + 0.5) / 2.0**53


@dataclass(frozen=True)
class Paths:
    """One path for some texts, flat: steps sorted by text and word, backwards within a word."""

    text: np.ndarray  # of each step
    word: np.ndarray  # number of the word within the text
    edge: np.ndarray
    first: dict[int, int]  # text to its first step
    after: dict[int, int]


def _paths(text: np.ndarray, word: np.ndarray, edge: np.ndarray, texts: list[int]) -> Paths:
    low = np.searchsorted(text, texts).tolist()
    high = np.searchsorted(text, texts, side="right").tolist()
    return Paths(text, word, edge, dict(zip(texts, low, strict=True)), dict(zip(texts, high, strict=True)))


def _words_of(key: np.ndarray, where: np.ndarray, draw: int) -> np.ndarray:
    """A 32-bit random word for each word of a text and draw."""
    x = key + (where.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(draw * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def _steps(word: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) for the positions of words, in single precision."""
    x = word + offset.astype(np.uint32) * np.uint32(0x9E3779B9)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    return (x >> np.uint32(8)).astype(np.float32) * np.float32(2.0**-24)


def _backwards(lattice: Lattice, word: np.ndarray, node: np.ndarray, key: np.ndarray, where: np.ndarray, draw: int):
    """Sample the rest of many words at once, from a node back to the word's start.

    word is the distinct word of each occurrence, where its number in the text. Gives (occurrence,
    edge), sorted by occurrence, backwards within it.
    """
    begin = lattice.begin[word]
    noise = _words_of(key, where, draw)
    first, cumulative, start = lattice.first, lattice.cumulative, lattice.start
    live = np.flatnonzero(node >= begin).astype(np.int32)
    at, begin, noise = node[live].astype(np.int32), begin[live], noise[live]
    found, edges = [], []
    while len(live):
        u = _steps(noise, at - begin)
        edge = first[at]
        further = np.flatnonzero(cumulative[edge] <= u)
        while len(further):
            edge[further] += 1
            further = further[cumulative[edge[further]] <= u[further]]
        found.append(live)
        edges.append(edge)
        at = start[edge] - 1
        keep = at >= begin
        live, at, begin, noise = live[keep], at[keep], begin[keep], noise[keep]
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    # Deal the steps out by counting instead of sorting: step s of an occurrence follows its step s - 1.
    size = np.zeros(len(word), np.int32)
    for live in found:
        size[live] += 1
    head = np.cumsum(size) - size
    occurrence = np.repeat(np.arange(len(word), dtype=np.int32), size)
    out = np.empty(len(occurrence), np.int32)
    for s, (live, edge) in enumerate(zip(found, edges, strict=True)):
        out[head[live] + s] = edge
    return occurrence, out


class Search:
    """Best-first search for the k largest perturbed paths of each text of a batch."""

    def __init__(self, texts: list[str], keys: np.ndarray, k: int, lattice: Lattice) -> None:
        split = [split_words(t) for t in texts]
        rows = [np.fromiter(map(lattice.__getitem__, ws), np.int32, len(ws)) for ws in split]
        lattice.build()
        self.lattice = lattice
        self.rows, self.keys, self.k, self.vocab = rows, keys, k, lattice.vocab
        #: Per text the sets of paths that are left: (perturbed bound, draw, step, edges excluded there).
        self.sets: list[list[tuple]] = [[] for _ in texts]
        self.bounds: list[np.ndarray] = []
        self.draws: list[Paths] = []
        self._first()
        for draw in range(1, k):
            if not self._next(draw):
                break

    def _first(self) -> None:
        size = np.array([len(r) for r in self.rows], np.int64)
        word = np.concatenate(self.rows) if len(self.rows) else np.empty(0, np.int32)
        text = np.repeat(np.arange(len(self.rows), dtype=np.int32), size)
        where = np.arange(len(word), dtype=np.int32) - np.repeat((np.cumsum(size) - size).astype(np.int32), size)
        occ, edge = _backwards(self.lattice, word, self.lattice.end[word] - 1, self.keys[text], where, 0)
        paths = _paths(text[occ], where[occ], edge, list(range(len(self.rows))))
        bounds = -np.log(-np.log(_uniform(self.keys, 0, 1)))
        self.draws.append(paths)
        self.bounds.append(bounds)
        self._split(paths, 0, bounds, np.zeros(len(self.rows), np.int64), {})

    def _split(self, paths: Paths, draw: int, bounds: np.ndarray, origin: np.ndarray, excluded: dict) -> None:
        """Cut what is left of each newest path's set into sets that leave the path at one step.

        A set's share is what the steps before give and the edge taken, with those excluded before,
        leaves; its bound is a Gumbel number of that location below the path's own. Only as many of
        a text as draws are left, and the next one, can still matter. Shares that vanish beside the
        largest in double precision are not looked at.
        """
        if not len(paths.edge):
            return
        log_q = self.lattice.log_q[paths.edge]
        texts = np.array(list(paths.first))
        lo, hi = (np.array(list(x.values())) for x in (paths.first, paths.after))
        texts, lo, hi = (x[hi > lo] for x in (texts, lo, hi))
        sums = np.cumsum(log_q) - log_q
        left = -np.expm1(log_q)
        for text, (edges, at) in excluded.items():
            left[paths.first[text] + at] -= np.exp(self.lattice.log_q[list(edges)]).sum()
        open_ = left > 1e-12
        location = np.where(open_, sums - np.repeat(sums[lo], hi - lo) + np.log(np.where(open_, left, 1.0)), -np.inf)
        if draw:
            step = np.arange(len(paths.text)) - np.repeat(lo, hi - lo)
            location[step < origin[paths.text]] = -np.inf
        most = np.repeat(np.maximum.reduceat(location, lo), hi - lo)
        open_ = np.flatnonzero((location > -np.inf) & (location >= most - NEGLIGIBLE))
        text, location = paths.text[open_], location[open_]
        step = open_ - np.repeat(lo, hi - lo)[open_]
        waiting = -np.log(_uniform(self.keys[text], step, 2 * draw + 3))
        value = -np.logaddexp(-bounds[text], np.log(waiting) - location)
        chosen = []
        run = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])) if len(text) else text
        size = np.diff(np.append(run, len(text)))
        rest = value.copy()
        for _ in range(self.k - draw if len(text) else 0):
            top = np.maximum.reduceat(rest, run)
            best = np.flatnonzero((rest == np.repeat(top, size)) & (rest > -np.inf))
            chosen.append(best)
            rest[best] = -np.inf
        order = np.concatenate(chosen) if chosen else np.empty(0, np.int64)
        for t, v, s, e in zip(text[order].tolist(), value[order].tolist(), step[order].tolist(), paths.edge[open_[order]].tolist(), strict=True):
            barred = (e,)
            if t in excluded and s == excluded[t][1]:
                barred += excluded[t][0]
            self.sets[t].append((v, draw, s, barred))

    def _next(self, draw: int) -> bool:
        """Take the best set of each text and draw its path."""
        lattice = self.lattice
        texts, heads, rest_word, rest_node, rest_text, rest_where = [], [], [], [], [], []
        bounds = np.full(len(self.rows), -np.inf)
        origin, excluded = np.zeros(len(self.rows), np.int64), {}
        for t, sets in enumerate(self.sets):
            if not sets:
                continue
            best = max(range(len(sets)), key=sets.__getitem__)
            bounds[t], old, step, barred = sets.pop(best)
            paths = self.draws[old]
            lo = paths.first[t]
            at = lo + step
            word = int(paths.word[at])
            row = self.rows[t]
            inside = step and paths.word[at - 1] == word
            node = int(lattice.start[paths.edge[at - 1]] if inside else lattice.end[row[word]]) - 1
            first, after = int(lattice.first[node]), int(lattice.first[node + 1])
            q = np.exp(lattice.log_q[first:after])
            q[[e - first for e in barred]] = 0.0
            u = float(_uniform(self.keys[t : t + 1], step, 2 * draw + 2**20)[0])
            edge = first + int(min(np.searchsorted(np.cumsum(q), u * q.sum(), side="right"), np.flatnonzero(q)[-1]))
            texts.append(t)
            origin[t], excluded[t] = step, (barred, step)
            heads.append((t, paths.word[lo : at + 1], np.append(paths.edge[lo:at], np.int32(edge))))
            rest_word.append(row[word:])
            nodes = lattice.end[row[word:]] - 1
            nodes[0] = lattice.start[edge] - 1
            rest_node.append(nodes)
            rest_text.append(np.full(len(nodes), t, np.int32))
            rest_where.append(np.arange(word, len(row), dtype=np.int32))
        if not texts:
            return False
        text, where = np.concatenate(rest_text), np.concatenate(rest_where)
        occ, edge = _backwards(lattice, np.concatenate(rest_word), np.concatenate(rest_node), self.keys[text], where, draw)
        text = np.concatenate([*(np.full(len(w), t, np.int32) for t, w, _ in heads), text[occ]])
        word = np.concatenate([*(w for _, w, _ in heads), where[occ]])
        edge = np.concatenate([*(e for _, _, e in heads), edge])
        order = np.argsort(text.astype(np.int64) << 32 | word, kind="stable")  # a word's head stays before its rest
        paths = _paths(text[order], word[order], edge[order], texts)
        self.draws.append(paths)
        self.bounds.append(bounds)
        self._split(paths, draw, bounds, origin, excluded)
        return True

    def results(self) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
        """(text, draw, piece ids, log-probability, perturbed, inclusion), by draw.

        inclusion is the probability that the path's perturbed value exceeds the largest one that
        was not drawn: 1 if nothing is left.
        """
        left = np.array([max((s[0] for s in sets), default=-np.inf) for sets in self.sets])
        for draw, (paths, bounds) in enumerate(zip(self.draws, self.bounds, strict=True)):
            sums = np.concatenate([[0.0], np.cumsum(self.lattice.log_q[paths.edge])])
            ids, at = _ids(self.lattice, self.vocab, paths)
            for t, lo in paths.first.items():
                hi = paths.after[t]
                log_p = min(0.0, float(sums[hi] - sums[lo]))
                gap = float(log_p - left[t])
                yield t, draw, ids[at[lo] : at[hi]], log_p, float(bounds[t]), float(-np.expm1(-np.exp(min(gap, 700.0))))


def _ids(lattice: Lattice, vocab: Vocabulary, paths: Paths) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all paths in reading order, and where each step's text slice begins."""
    n = len(paths.edge)
    fresh = np.ones(n, bool)
    np.not_equal(paths.word[1:], paths.word[:-1], out=fresh[1:])
    fresh[1:] |= paths.text[1:] != paths.text[:-1]
    begin = np.flatnonzero(fresh).astype(np.int32)
    size = np.diff(np.append(begin, np.int32(n)))
    edge = paths.edge[np.repeat(2 * begin + size - 1, size) - np.arange(n, dtype=np.int32)] if n else paths.edge
    piece = lattice.piece[edge]
    lone = np.flatnonzero(piece < 0)
    if not len(lone):
        return piece, np.arange(n + 1)
    raw = [lattice.character(c) for c in lattice.start[edge[lone]].tolist()]
    width = np.ones(n, np.int32)
    width[lone] = [len(b) for b in raw]
    at = np.concatenate([[0], np.cumsum(width)])
    ids = np.repeat(piece, width)
    ids[ids < 0] = vocab.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    return ids.astype(np.int32), at


def decode(ids: list[int] | np.ndarray, vocab: Vocabulary) -> str:
    """The text that piece ids stand for: the inverse of any segmentation."""
    raw = b"".join(vocab.spelled[np.asarray(ids)].tolist())
    return raw.decode("utf-8", "surrogatepass")[1:]


LATTICES: dict[str, Lattice] = {}


def lattice_for(path: str) -> Lattice:
    """The worker's lattice for a model; starts afresh when it has grown over MAX_NODES."""
    lattice = LATTICES.get(path)
    if lattice is None:
        lattice = LATTICES[path] = Lattice(vocabulary(path))
    elif lattice.nodes > MAX_NODES:
        lattice.clear()
    return lattice


def forget() -> None:
    """Drops the worker's lattices and vocabularies."""
    LATTICES.clear()
    vocabulary.cache_clear()


def row_key(seed: int, doc_id: int | None, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{seed}:{doc_id}:".encode() + text.encode("utf-8", "surrogatepass"))


SCHEMA = "doc_id long, draw int, ids array<int>, log_prob double, perturbed double, inclusion double, decoded string"


def sample_segmentations(docs: DataFrame, model: str, k: int, seed: int = 0, with_text: bool = True) -> DataFrame:
    """Up to k distinct segmentations for each row of docs(doc_id, text, ...), one row each.

    Columns: doc_id, draw (0 is the largest perturbed value), ids, log_prob, perturbed, inclusion
    and decoded, the text read back from the ids (null without with_text). model is the path of a
    SentencePiece file, readable on every executor. Random numbers depend on seed, doc_id and text
    alone, so a repeated task and a repeated row give the same result. Texts are segmented whole.
    A null text counts as empty; an empty text has one segmentation, without pieces. Texts with
    fewer than k segmentations get them all. Spaces are marked, one is put in front, and characters
    without a piece become their bytes; a text's own U+2581 reads back as a space. Other columns are
    not read; an empty table gives an empty table.
    """

    def flush(group: list[tuple], lattice: Lattice) -> pa.RecordBatch:
        texts = [t or "" for _, t in group]
        keys = np.array([row_key(seed, d, t) for (d, _), t in zip(group, texts, strict=True)], np.uint64)
        found = list(Search(texts, keys, k, lattice).results())
        ids = [f[2] for f in found]
        sizes = np.array([0, *map(len, ids)], np.int64)
        flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([group[f[0]][0] for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), flat),
                *(pa.array([f[i] for f in found], pa.float64()) for i in (3, 4, 5)),
                pa.array([decode(x, lattice.vocab) if with_text else None for x in ids], pa.string()),
            ],
            names=[c.split()[0] for c in SCHEMA.split(", ")],
        )

    def segment(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        size = 0
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if group and size + len(row[1] or "") > BATCH_CHARS:
                yield flush(group, lattice_for(model))
                group, size = [], 0
            group.append(row)
            size += len(row[1] or "")
        if group:
            yield flush(group, lattice_for(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from segment(batch)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(released(run, forget), SCHEMA)


def summary(found: DataFrame) -> DataFrame:
    """Per segmentation its size and scores, a hash of the ids and a digest of the text read back."""
    return found.select(
        "doc_id",
        "draw",
        F.size("ids").cast("long").alias("n_pieces"),
        "log_prob",
        "perturbed",
        "inclusion",
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
