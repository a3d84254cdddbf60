"""SimHash near-duplicates: byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, order_id, released
from .components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Longer posting lists are linked through one-bit variants instead of by pairs.
POSTING = 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15
#: Links that a task contracts before components are found across tasks.
LINKS = 500_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a whole text; no words give 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = np.array([digest(joined, SEED)], np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        spans = zip((ends - sizes)[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(order_id, doc_id, text_key, fp) per row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(3).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found.view(np.int64))], names=["order_id", "doc_id", "text_key", "fp"]
            )

    rows = docs.select(
        order_id().alias("order_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    return rows.mapInArrow(released(run), "order_id long, doc_id long, text_key long, fp long")


def _postings(fps: DataFrame) -> DataFrame:
    """(key, fp): six postings per fingerprint, each on four of its eight byte positions.

    The bytes form four neighbouring couples. Two changed bits touch two couples at most, so a pair
    within MAX_BITS has two untouched couples and meets in at least one posting list.
    """
    couple = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    picks = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    keys = F.array(*[
        F.lit(n << 32) + F.shiftleft(couple[i], 16) + couple[j] for n, (i, j) in enumerate(picks)
    ])
    return fps.select(F.explode(keys).alias("key"), "fp")


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, fp) arrays that hold whole runs of equal keys from a sorted stream."""
    held = [np.empty(0, np.int64)] * 2
    for batch in batches:
        held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
        key = held[0]
        whole = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if whole:
            yield held[0][:whole], held[1][:whole]
            held = [h[whole:] for h in held]
    if len(held[0]):
        yield held[0], held[1]


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _tally(max_bits: int):
    """Verified links inside posting lists of POSTING entries at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp in _sorted_runs(batches):
            for step in range(1, len(key)):
                same = np.flatnonzero(key[step:] == key[:-step])
                if not len(same):
                    break
                differ = (fp[same] ^ fp[same + step]).view(np.uint64)
                shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
                enough = shared >= 8 - max_bits
                good = same[enough][np.bitwise_count(differ[enough]) <= max_bits]
                yield _links(fp[good], fp[good + step])

    return run


def _first_of_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links each row of a run of equal keys to the run's first row; a run has 65 rows at most."""
    for key, fp in _sorted_runs(batches):
        first = np.concatenate([[True], key[1:] != key[:-1]])
        head = fp[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        yield _links(fp[~first], head[~first])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars: each node linked to the smallest it reaches inside the partition."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    nodes = np.fromiter(parent, np.int64, len(parent))
    roots = np.fromiter(map(root, parent), np.int64, len(parent))
    yield _links(nodes[nodes != roots], roots[nodes != roots])


def contracted(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Links with the same components, at most one per node and partition of LINKS links."""
    found = materialize(spark, edges, "links")
    return found.coalesce(1 + found.count() // LINKS).mapInArrow(_contract, "a long, b long")


def link_edges(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) over distinct fps(fp): links that join every pair within max_bits.

    Short posting lists are tallied by pair: candidates must share the guaranteed 8 - max_bits
    positional bytes and are then verified on all bits. A list of over POSTING fingerprints is never
    paired: its members emit their one-bit variants, and fingerprints that share a variant are at
    most two bits apart; a variant has 65 owners at most, which are linked to the first.
    """
    postings = _postings(fps)
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sized = postings.join(sizes, "key")
    short = sized.where(F.col("size") <= POSTING).select("key", "fp")
    pairs = short.repartition("key").sortWithinPartitions("key").mapInArrow(_tally(max_bits), "a long, b long")
    variants = F.transform(
        F.sequence(F.lit(0), F.lit(64)),
        lambda i: F.when(i == 64, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))),
    )
    crowded = sized.where(F.col("size") > POSTING).select("fp").distinct()
    owners = crowded.select(F.explode(variants).alias("key"), "fp")
    near = owners.repartition("key").sortWithinPartitions("key").mapInArrow(_first_of_run, "a long, b long")
    return pairs.union(near)


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, order_id, text_key, fp, component_id) for each row of docs(doc_id, text, ...).

    component_id is the smallest doc_id that links of at most max_bits differing bits reach. Equal
    fingerprints form one node before anything is paired, so copies cost one row each. A null or
    empty text has fingerprint zero and is linked like any other; fewer words than a shingle count
    as one shingle. A null doc_id sorts last (its class id, if it stands alone, is null); repeated
    rows get the same class; other columns are not read; an empty table gives an empty table.
    max_bits is 2, or 0 for equal fingerprints only: the index guarantees no more.
    """
    if max_bits not in (0, MAX_BITS):
        raise ValueError("max_bits must be 0 or 2")
    marked = materialize(spark, fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(spark, marked.groupBy("fp").agg(F.min("order_id").alias("rep")), "nodes")
    if max_bits:
        groups = connected_components(spark, contracted(spark, link_edges(nodes.select("fp"), max_bits)))
        nodes = nodes.join(groups, nodes["fp"] == groups["node"], "left")
        nodes = nodes.select("fp", "rep", F.coalesce("component", "fp").alias("class"))
        classes = nodes.groupBy("class").agg(F.min("rep").alias("component"))
        nodes = nodes.join(classes, "class").select("fp", "component")
    else:
        nodes = nodes.select("fp", F.col("rep").alias("component"))
    out = marked.join(nodes, "fp")
    component = F.when(F.col("component") == 2**63 - 1, None).otherwise(F.col("component"))
    return out.select("doc_id", "order_id", "text_key", "fp", component.alias("component_id"))
