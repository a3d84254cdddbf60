"""Removal of windows that an earlier document holds, for any kind of unit (words, bytes).

A window of a document is removed if its units also stand in a document with a smaller doc_id.
How windows are compared is left to an engine; this module brings together what can be equal:

1. Each window has one anchor, its smallest k-gram (anchors.py); the stretch covered by the windows
   of an anchor is its context. Anchors are dealt to partitions by hash, packed, with a hash of
   their context. Equal contexts of an anchor are one string with the smallest id; the later
   documents lose it. What is left are the different contexts of each anchor, each at its first
   document. An anchor with one context has nothing to compare.
2. Texts cut out the contexts that are left, and contexts meet by anchor.
3. Of each context the stretches stay whose windows have a hash that another document's context of
   the anchor has too. The engine finds, for each window of them, the smallest id that holds it;
   the context's own document loses the windows that a smaller id holds.

Equal texts are one text with the smallest id; of the others nothing stays but what no window covers.
An anchor of over CROWD different contexts does not bring them together: there windows travel in
runs of up to `stride`, under a hash of the units that all windows of a full run have in common, and
are streamed in the order of ids past the smallest id of each window. What is kept of such a group
are the different units at its edges, at most stride - 1 a window, never its rows. All counts are of the input as it is given. Anchors and contexts are told apart by 112 bits of hash,
windows by their units, in the engine and in the stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchors
from .common import LAST_ID, materialize, order_id

#: Different contexts of an anchor beyond which its windows are compared one by one.
CROWD = 128
#: Bytes of text whose anchors share a partition.
SHARE = 24 << 20
#: Units that are searched for anchors, and context bytes that are compared, at once.
BATCH_UNITS, BATCH_BYTES = 4_000_000, 2_400_000
#: Bytes that are kept of an anchor's hash (beside its partition) and of its context's.
ANCHOR_BYTES, CONTEXT_BYTES = 6, 8
ANCHOR_MASK = np.uint64((1 << 8 * ANCHOR_BYTES) - 1)
#: Rows without an id are told apart by this many numbers below LAST_ID while anchors meet.
NAMELESS = 1 << 40


class Units(Protocol):
    """How a text falls into units; an instance is sent to the tasks."""

    window: int
    gram: int
    stride: int  # 1 to 4; over 1 only for bytes

    def split(self, raw: bytes): ...

    def hashes(self, units) -> np.ndarray: ...

    def join(self, units) -> bytes: ...


#: Contexts of one anchor, with their smallest ids, to the smallest id of each window of each.
Engine = Callable[[list[list[tuple[bytes, int]]]], list[list[np.ndarray]]]


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return begin, np.diff(np.append(begin, len(key)))


def _short(values: np.ndarray, size: int) -> np.ndarray:
    return values.view(np.uint8).reshape(-1, 8)[:, :size]


def _long(raw: bytes, size: int) -> np.ndarray:
    wide = np.zeros((len(raw) // size, 8), np.uint8)
    wide[:, :size] = np.frombuffer(raw, np.uint8).reshape(-1, size)
    return wide.view(np.uint64).ravel()


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column compressed, so that texts travel and sort smaller."""
    tool = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raw = pa.array([tool.compress(t) for t in batch.columns[-1].to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], raw], names=batch.schema.names)


def _pack(units: Units, partitions: int):
    def emit(orders: list[int], found: list[tuple]) -> Iterator[dict]:
        sizes = np.array([len(h) for h, _ in found], np.int64)
        hashes = np.concatenate([h for h, _ in found])
        contexts = np.concatenate([c for _, c in found])
        text = np.repeat(np.arange(len(orders)), sizes)
        part = ((hashes >> np.uint64(40)) % np.uint64(partitions)).astype(np.int32)
        by = np.argsort(part.astype(np.uint16) if partitions < 1 << 16 else part, kind="stable")
        hashes, contexts, text, part = hashes[by], contexts[by], text[by], part[by]
        ids = np.array(orders, np.int64)
        for at, size in zip(*(x.tolist() for x in _runs(part)), strict=True):
            own = slice(at, at + size)
            begin, count = _runs(text[own])
            yield {
                "part": int(part[at]),
                "orders": ids[text[own][begin]].tobytes(),
                "counts": count.astype(np.uint32).tobytes(),
                "hashes": _short(hashes[own], ANCHOR_BYTES).tobytes(),
                "contexts": _short(contexts[own], CONTEXT_BYTES).tobytes(),
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("orders", "counts", "hashes", "contexts"))])
        orders, found, size = [], [], 0
        for batch in batches:
            for order, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashed = units.hashes(units.split(raw))
                place, value, first, last = anchors.find(hashed, units.gram, units.window)
                if len(place):
                    orders.append(order)
                    found.append((value, anchors.stretch_hashes(hashed, first, last + units.window)))
                    size += len(hashed)
                if size > BATCH_UNITS:
                    yield pa.RecordBatch.from_pylist(list(emit(orders, found)), schema)
                    orders, found, size = [], [], 0
        if found:
            yield pa.RecordBatch.from_pylist(list(emit(orders, found)), schema)

    return run


def _places(hashes: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """One number for an anchor and its context, as both are known after the exchange."""
    return (hashes & ANCHOR_MASK) * np.uint64(0x9E3779B97F4A7C15) + contexts


#: What becomes of a place of a shared anchor.
SAME, MIXED, CROWDED = 1, 2, 3


def _screen(table: pa.Table, buckets: int) -> pa.Table:
    """Documents' anchors of a partition whose contexts they lose (SAME), must compare (MIXED) or split (CROWDED).

    They come packed by bucket of documents, so that their rows grow with the places, not with documents times partitions.
    """
    raw = {c: b"".join(table.column(c).to_pylist()) for c in ("orders", "counts", "hashes", "contexts")}
    orders, counts = np.frombuffer(raw["orders"], np.int64), np.frombuffer(raw["counts"], np.uint32)
    hashes, contexts = _long(raw["hashes"], ANCHOR_BYTES), _long(raw["contexts"], CONTEXT_BYTES)
    text = np.repeat(np.arange(len(orders)), counts)
    order = orders[text]
    by = np.lexsort((contexts, hashes))
    key, own, ids = hashes[by], contexts[by], np.where(order >= LAST_ID - NAMELESS, LAST_ID, order)[by]
    begin, size = _runs(key)
    # Runs of equal contexts within runs of equal anchors.
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    inner = np.flatnonzero(fresh)
    least = np.repeat(np.minimum.reduceat(ids, inner), np.diff(np.append(inner, len(key))))
    alone = np.minimum.reduceat(ids, begin) == np.maximum.reduceat(ids, begin)
    kinds = np.add.reduceat(fresh.astype(np.int64), begin)
    fate = np.where(alone | (kinds == 1), 0, np.where(kinds > CROWD, CROWDED, MIXED))
    fate = np.where(ids > least, SAME, np.repeat(fate, size))
    state = np.empty(len(key), np.int8)
    state[by] = fate
    use = np.flatnonzero(state)
    bucket = ((order[use].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    by = np.lexsort((order[use], bucket))
    use, bucket = use[by], bucket[by]
    known = _places(hashes[use], contexts[use])
    begin, size = _runs(bucket)
    rows = [slice(a, a + n) for a, n in zip(begin.tolist(), size.tolist(), strict=True)]
    runs = [_runs(order[use[r]]) for r in rows]
    return pa.table({
        "bucket": pa.array(bucket[begin], pa.int32()),
        "orders": pa.array([order[use[r]][first].tobytes() for r, (first, _) in zip(rows, runs, strict=True)], pa.binary()),
        "counts": pa.array([count.astype(np.uint32).tobytes() for _, count in runs], pa.binary()),
        "fates": pa.array([state[use[r]].tobytes() for r in rows], pa.binary()),
        "places": pa.array([known[r].tobytes() for r in rows], pa.binary()),
    })


def _gather(table: pa.Table) -> pa.Table:
    """The places of each document of a bucket, by fate."""
    orders, counts, fates, places = (
        np.frombuffer(b"".join(table.column(c).to_pylist()), t)
        for c, t in (("orders", np.int64), ("counts", np.uint32), ("fates", np.int8), ("places", np.uint64))
    )
    orders = np.repeat(orders, counts)
    by = np.lexsort((fates, orders))
    orders, fates, places = orders[by], fates[by], places[by]
    begin, size = _runs(orders)
    found: dict[str, list] = {"name": orders[begin].tolist(), "same": [], "mixed": [], "crowded": []}
    for a, n in zip(begin.tolist(), size.tolist(), strict=True):
        cut = a + np.searchsorted(fates[a : a + n], (SAME, MIXED, CROWDED, CROWDED + 1))
        for name, lo, hi in zip(("same", "mixed", "crowded"), cut[:-1], cut[1:], strict=True):
            found[name].append(places[lo:hi].tobytes())
    return pa.table({k: pa.array(v, pa.int64() if k == "name" else pa.binary()) for k, v in found.items()})


CONTEXT_SCHEMA = "key long, kind int, content binary, least long, text long, start int, edges binary, orders binary, texts binary, starts binary, ends binary"
CONTEXT_KINDS = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
CONTEXT_NAMES = [c.split()[0] for c in CONTEXT_SCHEMA.split(", ")]
#: Kinds of rows: contexts with their places, runs of windows (their common units, and the edges) with one place each, spans.
CONTEXT, WINDOW, SPANS = 0, 1, 2


def _contexts(units: Units):
    def emit(held: dict[tuple, list], rows: list[tuple]) -> pa.RecordBatch:
        for (key, content), (orders, texts, starts) in held.items():
            packed = (np.array(orders, np.int64).tobytes(), np.array(texts, np.int64).tobytes(), np.array(starts, np.int32).tobytes(), None)
            rows.append((key, CONTEXT, content, min(orders), None, None, None, *packed))
        columns = zip(*rows, strict=True) if rows else [[]] * len(CONTEXT_KINDS)
        arrays = [pa.array(v, k) for v, k in zip(columns, CONTEXT_KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=CONTEXT_NAMES)

    def windows(parts, hashed: np.ndarray, order: int, text: int, place: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Runs of windows that hold their anchor (at place) at the same offset divided by the stride."""
        spare = units.stride - 1
        run = (place - starts) // units.stride
        begin = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (run[1:] != run[:-1])]))
        count = np.diff(np.append(begin, len(starts)))
        lo, middle = starts[begin], place[begin] - units.stride * run[begin]
        end = middle + units.window - spare
        edges = np.zeros((len(begin), 2 + 2 * spare), np.uint8)
        edges[:, 0], edges[:, 1] = lo - (middle - spare), count
        if spare:
            flat = np.frombuffer(parts, np.uint8)
            for i in range(spare):
                for at, column in ((middle - spare + i, 2 + i), (end + i, 2 + spare + i)):
                    held = (at >= lo) & (at < lo + count - 1 + units.window)
                    edges[held, column] = flat[at[held]]
        keys = anchors.stretch_hashes(hashed, middle, end).view(np.int64)
        for a in range(0, len(begin), 50_000):
            of = slice(a, a + 50_000)
            content = [units.join(parts[x:y]) for x, y in zip(middle[of].tolist(), end[of].tolist(), strict=True)]
            n = len(content)
            columns = [keys[of], np.full(n, WINDOW), content, np.full(n, order), np.full(n, text), lo[of], [e.tobytes() for e in edges[of]]]
            arrays = [pa.array(v, k) for v, k in zip(columns, CONTEXT_KINDS, strict=False)]
            yield pa.RecordBatch.from_arrays([*arrays, *[pa.nulls(n, pa.binary())] * 4], names=CONTEXT_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        held: dict[tuple, list] = {}
        rows: list[tuple] = []
        size = 0

        def add(key: int, content: bytes, order: int, text: int, start: int) -> int:
            entry = held.get((key, content))
            if entry is None:
                held[key, content] = ([order], [text], [start])
                return len(content) + 300
            for column, value in zip(entry, (order, text, start), strict=True):
                column.append(value)
            return 80

        for batch in batches:
            for order, text, raw, same, mixed, crowded in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = units.split(tool.decompress(raw))
                hashed = units.hashes(parts)
                spot, value, first, last = anchors.find(hashed, units.gram, units.window)
                place = _places(value, anchors.stretch_hashes(hashed, first, last + units.window))
                value = value.view(np.int64)
                at = np.flatnonzero(np.isin(place, np.frombuffer(same, np.uint64)))
                if len(at):
                    ends = last[at] + units.window
                    new = np.flatnonzero(np.concatenate([[True], first[at][1:] > ends[:-1]]))
                    starts, ends = first[at][new].astype(np.int32), ends[np.append(new[1:], len(at)) - 1].astype(np.int32)
                    rows.append((text, SPANS, None, None, None, None, None, np.full(len(new), order).tobytes(), np.full(len(new), text).tobytes(), starts.tobytes(), ends.tobytes()))
                at = np.flatnonzero(np.isin(place, np.frombuffer(mixed, np.uint64)))
                for key, lo, hi in zip(value[at].tolist(), first[at].tolist(), last[at].tolist(), strict=True):
                    size += add(key, units.join(parts[lo : hi + units.window]), order, text, lo)
                at = np.flatnonzero(np.isin(place, np.frombuffer(crowded, np.uint64)))
                if len(at):
                    count = last[at] - first[at] + 1
                    starts = np.repeat(first[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                    yield from windows(parts, hashed, order, text, np.repeat(spot[at], count), starts)
                if size > 48 << 20 or len(rows) > 20_000:
                    yield emit(held, rows)
                    held, rows, size = {}, [], 0
        if held or rows:
            yield emit(held, rows)

    return run


def _spans(units: Units, engine: Engine):
    """Removed spans from a stream of context rows sorted by key and kind."""

    def flagged(mins: np.ndarray, row: dict, out: list[list]) -> None:
        low, high = int(mins.min()), int(mins.max())
        orders, texts, starts = (np.frombuffer(row[c], t) for c, t in (("orders", np.int64), ("texts", np.int64), ("starts", np.int32)))
        if orders.max() <= low:
            return
        whole = orders > high
        some = np.flatnonzero((orders > low) & ~whole)
        out[0].append(orders[whole])
        out[1].append(texts[whole])
        out[2].append(starts[whole])
        out[3].append(starts[whole] + len(mins) - 1 + units.window)
        for i in some.tolist():
            at = np.flatnonzero(mins < orders[i])
            begin = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
            end = np.append(begin[1:], len(at)) - 1
            out[0].append(np.full(len(begin), orders[i]))
            out[1].append(np.full(len(begin), texts[i]))
            out[2].append(starts[i] + at[begin])
            out[3].append(starts[i] + at[end] + units.window)

    def result(out: list[list]) -> pa.RecordBatch:
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["order_id", "text_key", "lo", "hi"])

    def shared(groups: list[list[tuple[bytes, int]]]) -> list[list[tuple[int, int, int]]]:
        """Per group, (context, first, last) of each run of windows whose hash another id's context of the group has."""
        parts = [units.hashes(units.split(c)) for g in groups for c, _ in g]
        size = np.array([len(p) for p in parts])
        lead = np.cumsum(size) - size
        count = size - units.window + 1
        owner = np.repeat(np.arange(len(parts)), count)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        hashed = anchors.gram_hashes(np.concatenate(parts), units.window)[lead[owner] + inner]
        least = np.array([n for g in groups for _, n in g], np.int64)[owner]
        by = np.lexsort((hashed, group[owner]))
        value, where = hashed[by], group[owner][by]
        begin = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (where[1:] != where[:-1])]))
        mixed = np.minimum.reduceat(least[by], begin) < np.maximum.reduceat(least[by], begin)
        some = np.zeros(len(owner), bool)
        some[by] = np.repeat(mixed, np.diff(np.append(begin, len(by))))
        at = np.flatnonzero(some)
        new = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | (np.diff(owner[at]) > 0)])) if len(at) else at
        ends = at[np.append(new[1:], len(at)) - 1] if len(at) else at
        begins = at[new]
        found: list[list[tuple[int, int, int]]] = [[] for _ in groups]
        first = np.concatenate([[0], np.cumsum([len(g) for g in groups])])
        for i, own, lo, hi in zip(group[owner[begins]].tolist(), owner[begins].tolist(), inner[begins].tolist(), inner[ends].tolist(), strict=True):
            found[i].append((own - int(first[i]), lo, hi))
        return found

    def compare(groups: list[dict[bytes, list[dict]]], out: list[list]) -> None:
        listed = [[(content, min(r["least"] for r in rows)) for content, rows in g.items()] for g in groups]
        stretches = shared(listed)
        strings: list[dict[bytes, int]] = []
        cuts: list[list[bytes]] = []
        for g, runs in zip(listed, stretches, strict=True):
            held: dict[bytes, int] = {}
            cuts.append([])
            for own, lo, hi in runs:
                content, least = g[own]
                piece = units.join(units.split(content)[lo : hi + units.window])
                held[piece] = min(held.get(piece, least), least)
                cuts[-1].append(piece)
            strings.append(held)
        # Equal stretches are one string; a group of one string has nothing to compare.
        chosen = [i for i, held in enumerate(strings) if len(held) > 1]
        sorted_out = dict(zip(chosen, engine([list(strings[i].items()) for i in chosen]), strict=True)) if chosen else {}
        for i, (g, runs) in enumerate(zip(groups, stretches, strict=True)):
            known = dict(zip(strings[i], sorted_out[i], strict=True)) if i in sorted_out else {}
            mins: dict[int, np.ndarray] = {}
            for (own, lo, hi), piece in zip(runs, cuts[i], strict=True):
                if own not in mins:
                    content, least = listed[i][own]
                    mins[own] = np.full(len(units.split(content)) - units.window + 1, least)
                mins[own][lo : hi + 1] = known.get(piece, strings[i][piece])
            for own, (content, rows) in enumerate(g.items()):
                least = listed[i][own][1]
                for row in rows:
                    if own in mins:
                        flagged(mins[own], row, out)
                    elif len(row["orders"]) > 8 or row["least"] > least:  # else its only place is the smallest
                        flagged(np.full(len(units.split(content)) - units.window + 1, least), row, out)

    def streamed(batch: pa.RecordBatch, before: tuple | None, out: list[list]) -> tuple:
        """Places of windows past the smallest id of their window; rows come sorted by key, content and id.

        before is the last key and content, and the smallest id of each window met under them.
        """
        key, content, order = batch.column("key").to_numpy(), batch.column("content"), batch.column("least").to_numpy()
        text, start = batch.column("text").to_numpy(), batch.column("start").to_numpy()
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | ~pc.equal(content[1:], content[:-1]).to_numpy(zero_copy_only=False)
        fresh[0] = before is None or (int(key[0]), content[0].as_py()) != before[:2]
        group = np.cumsum(fresh)  # 0 goes on from the last batch
        spare = units.stride - 1
        edges = np.frombuffer(b"".join(batch.column("edges").to_pylist()), np.uint8).reshape(len(key), -1).astype(np.int64)
        known = dict(before[2]) if group[-1] == 0 else {}
        for i in range(units.stride):
            row = np.flatnonzero((edges[:, 0] <= i) & (i < edges[:, 0] + edges[:, 1]))
            if not len(row):
                continue
            code = np.full(len(row), i, np.int64)
            for column in (*range(2 + i, 2 + spare), *range(2 + spare, 2 + spare + i)):
                code = code << 8 | edges[row, column]
            kinds, at, back = np.unique(group[row] << 32 | code, return_index=True, return_inverse=True)
            least = order[row[at]]
            for j in range(int(np.searchsorted(kinds, 1 << 32))):
                least[j] = before[2].get(int(kinds[j]), least[j])
            lead = int(group[-1]) << 32
            for j in range(int(np.searchsorted(kinds, lead)), len(kinds)):
                known[int(kinds[j]) - lead] = int(least[j])
            gone = row[order[row] > least[back]]
            starts = start[gone] + (i - edges[gone, 0])
            for out_column, values in zip(out, (order[gone], text[gone], starts, starts + units.window), strict=True):
                out_column.append(values)
        return int(key[-1]), content[-1].as_py(), known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[dict[bytes, list[dict]]] = []
        size, last, before = 0, None, None
        out: list[list] = [[], [], [], []]
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            if (kind == WINDOW).any():
                before = streamed(batch.filter(pa.array(kind == WINDOW)).drop_columns(["orders", "texts", "starts", "ends"]), before, out)
            if (kind == SPANS).any():
                some = batch.filter(pa.array(kind == SPANS))
                for column, name, of in zip(out, ("orders", "texts", "starts", "ends"), (np.int64, np.int64, np.int32, np.int32), strict=True):
                    column.append(np.frombuffer(b"".join(some.column(name).to_pylist()), of))
            if (kind == CONTEXT).any():
                for row in batch.filter(pa.array(kind == CONTEXT)).select(["key", "content", "least", "orders", "texts", "starts"]).to_pylist():
                    if row["key"] != last:
                        if size > BATCH_BYTES:
                            compare(groups, out)
                            groups, size = [], 0
                        groups.append({})
                        last = row["key"]
                    if row["content"] not in groups[-1]:
                        size += len(row["content"])
                    groups[-1].setdefault(row["content"], []).append(row)
            if len(out[0]) > 2000:
                yield result(out)
                out = [[], [], [], []]
        if groups:
            compare(groups, out)
        yield result(out)

    return run


def _removal(units: Units):
    """Counts, spans and digest of what stays, per text that loses something."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for order, text, raw, lows, highs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = units.split(tool.decompress(raw))
                edge = np.zeros(len(parts) + 1, np.int64)
                np.add.at(edge, lows, 1)
                np.add.at(edge, highs, -1)
                gone = np.cumsum(edge) > 0
                begin = np.flatnonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]])) if len(parts) else np.empty(0, np.int64)
                end = np.flatnonzero(gone[:-1] & ~gone[1:]) + 1
                kept = units.join_kept(parts, begin.tolist(), end.tolist())
                spans = [{"lo": a, "hi": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                for column, value in zip(out, (order, text, int((end - begin).sum()), len(begin), units.digest(kept), spans), strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=["order_id", "text_key", "removed", "n_spans", "kept_sha256", "spans"])

    return run


def _named(order: str, text: str) -> Column:
    """The id; for rows without one a number by their text, so that they are not gathered as one document."""
    nameless = F.lit(LAST_ID) - F.pmod(text, F.lit(NAMELESS))
    return F.when(F.col(order) == LAST_ID, nameless).otherwise(F.col(order))


def remove_repeats(
    spark: SparkSession, docs: DataFrame, units: Units, engine: Engine, total: Column, digest: Column, nothing: str
) -> DataFrame:
    """(order_id, doc_id, total, removed, n_spans, kept_sha256, spans) for each row of docs(doc_id, text).

    total and digest give a text's number of units and the digest of an untouched text, from column
    text (never null); nothing is the digest of a text that loses all. spans are in units.
    """
    rows = docs.select(
        order_id().alias("order_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("text_key", F.xxhash64("text"))
    base = materialize(
        spark,
        rows.select("order_id", "doc_id", "text_key", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.octet_length("text").alias("size"), total.cast("long").alias("total"), digest.alias("kept_sha256")),
        "texts",
    )
    first = base.groupBy("sha").agg(F.min("order_id").alias("rep"))
    known = base.join(first, "sha")
    reps = known.where(F.col("order_id") == F.col("rep")).select("order_id", "text_key").distinct()
    size = base.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARE))
    raw = rows.select("order_id", "text_key", F.col("text").cast("binary").alias("text"))
    packed = raw.select(_named("order_id", "text_key").alias("name"), "text").mapInArrow(_pack(units, partitions), "part int, orders binary, counts binary, hashes binary, contexts binary")
    shared = packed.groupBy("part").applyInArrow(lambda table: _screen(table, partitions), "bucket int, orders binary, counts binary, fates binary, places binary")
    flagged = shared.groupBy("bucket").applyInArrow(_gather, "name long, same binary, mixed binary, crowded binary")
    named = reps.withColumn("name", _named("order_id", "text_key"))
    wanted = flagged.join(named, "name")
    small = raw.mapInArrow(_squeeze, raw.schema)
    cut = small.join(wanted, ["order_id", "text_key"]).select("order_id", "text_key", "text", "same", "mixed", "crowded")
    contexts = cut.mapInArrow(_contexts(units), CONTEXT_SCHEMA)
    dealt = contexts.repartition(partitions, "key").sortWithinPartitions("key", "kind", "content", "least")
    found = dealt.mapInArrow(_spans(units, engine), "order_id long, text_key long, lo int, hi int")
    # Not written in between: so both joins with the texts share one exchange of them.
    by_text = found.groupBy("order_id", "text_key").agg(F.collect_list("lo").alias("lows"), F.collect_list("hi").alias("highs"))
    changed = small.join(by_text, ["order_id", "text_key"]).select("order_id", "text_key", "text", "lows", "highs")
    changed = changed.mapInArrow(
        _removal(units),
        "order_id long, text_key long, removed long, n_spans long, kept_sha256 string, spans array<struct<lo:int,hi:int>>",
    )
    changed = changed.withColumnRenamed("kept_sha256", "left_sha256").dropDuplicates(["order_id", "text_key"])
    copy = (F.col("order_id") > F.col("rep")) & (F.col("total") >= units.window)
    untouched = F.array().cast("array<struct<lo:int,hi:int>>")
    whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("total").cast("int").alias("hi")))
    joined = known.join(changed, ["order_id", "text_key"], "left")
    return joined.select(
        "order_id",
        "doc_id",
        "total",
        F.when(copy, F.col("total")).otherwise(F.coalesce("removed", F.lit(0))).alias("removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("left_sha256", "kept_sha256")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("spans", untouched)).alias("spans"),
    )
