"""Benchmark decontamination: size-partitioned MinHash containment search, verified on the shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, order_id, released

SHINGLE = 5
THRESHOLD = 0.8
#: Bits of the two bitmaps that tasks receive; their size never depends on the benchmark.
BITMAP = 1 << 23
WORD = regex.compile(r"[\p{L}\p{N}]+")
#: Remembered word hashes per worker, some 7 MB; bounds memory only, larger tables are not faster.
MAX_WORDS = 50_000


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode())
        return value


HASHES = _WordHashes()


def forget() -> None:
    """Empties the worker's word hashes."""
    HASHES.clear()


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return WORD.findall(text.lower()) if text else []


def shingle_hashes(words: list[str], size: int) -> np.ndarray:
    """64-bit hash of each run of size consecutive words."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def allowed_missing(n: int, threshold: float) -> int:
    """How many of n shingles a document may lack and still reach the threshold."""
    return int((1 - threshold) * n + 1e-9)


def sketch_size(n: int, threshold: float) -> int:
    """Minimum values kept for an item of n shingles: a function of its size partition [2^c, 2^(c+1)).

    One more than an item of the partition may lack, so a document that reaches the threshold holds
    at least one of them.
    """
    largest = (1 << n.bit_length()) - 1
    return min(n, allowed_missing(largest, threshold) + 1)


ITEM_SCHEMA = "item_key long, item_id long, words int, total int, need int, hash long, shingle string, in_sketch boolean"


def _item_shingles(size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in ITEM_SCHEMA.split(", ")}
            for key, item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                if not words:
                    continue
                span = min(size, len(words))
                found = dict(zip(shingle_hashes(words, span).tolist(), (" ".join(words[i : i + span]) for i in range(len(words) - span + 1)), strict=True))
                kept = sketch_size(len(found), threshold)
                for rank, h in enumerate(sorted(found)):
                    out["item_key"].append(key)
                    out["item_id"].append(item)
                    out["words"].append(span)
                    out["total"].append(len(found))
                    out["need"].append(kept - min(kept - 1, allowed_missing(len(found), threshold)))
                    out["hash"].append(h - (1 << 64) if h >= 1 << 63 else h)
                    out["shingle"].append(found[h])
                    out["in_sketch"].append(rank < kept)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bitmap of the top bits of the hashes; at most BITMAP / 64 rows reach the driver."""
    bit = F.shiftrightunsigned("hash", 64 - (BITMAP.bit_length() - 1))
    words = hashes.select(F.shiftright(bit, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int")).alias("bit"))
    rows = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(BITMAP // 64, np.int64)
    table[rows["at"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def _scan(shared, spans: list[int]):
    """Documents that may hold an item: their hashes that may be in a sketch, their shingles that may be in an item."""
    shift = np.uint64(64 - (BITMAP.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches, shingles = (np.unpackbits(m).view(bool) for m in shared.value)
        for batch in batches:
            rows: list[tuple] = []
            for order, doc, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                hits, found = [], set()
                for span in spans:
                    hashes = shingle_hashes(words, span)
                    at = (hashes >> shift).astype(np.int64)
                    if len(at) and (hit := sketches[at]).any():
                        hits.append(np.unique(hashes[hit]).view(np.int64))
                        found.update(" ".join(words[i : i + span]) for i in np.flatnonzero(shingles[at]).tolist())
                if hits:
                    rows.append((order, doc, key, np.concatenate(hits), list(found)))
            order, doc, key, hits, found = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_pydict({
                "order_id": pa.array(order, pa.int64()),
                "doc_id": pa.array(doc, pa.int64()),
                "text_key": pa.array(key, pa.int64()),
                "hits": pa.array(hits, pa.list_(pa.int64())),
                "shingles": pa.array(found, pa.list_(pa.string())),
            })

    return run


def contaminated(
    spark: SparkSession, docs: DataFrame, items: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD
) -> DataFrame:
    """(order_id, doc_id, text_key, item_id, shared, total) for each document row that holds an item.

    A document of docs(doc_id, text, ...) holds an item of items(item_id, text, ...) if at least
    `threshold` of the item's distinct `size`-word shingles occur in it; words are lower-cased runs
    of letters and digits. An item of fewer words is one shingle of all of them; an item or document
    without words (null, empty, only signs) matches nothing.

    Items are partitioned by size; each keeps as many minimum hash values as its partition needs for
    a certain hit. Documents of any length are streamed against a bitmap of those values, of fixed
    size; hits meet the sketch table in a join, pairs with too few sketch hits are dropped, and the
    rest is verified on the text of the shingles. Repeated rows, of documents or items, give one row;
    text_key tells rows apart that share a doc_id but not a text. A null id stays null. Empty
    tables give an empty table.
    """
    listed = items.select(F.xxhash64("item_id", "text").alias("item_key"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    table = materialize(spark, listed.mapInArrow(released(_item_shingles(size, threshold), forget), ITEM_SCHEMA), "items")
    sketch = table.where("in_sketch")
    spans = sorted(r["words"] for r in table.select("words").distinct().collect())
    maps = tuple(np.packbits(_bitmap(t.select("hash"))) for t in (sketch, table))
    shared = spark.sparkContext.broadcast(maps)
    rows = docs.select(order_id().alias("order_id"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    scanned = rows.mapInArrow(released(_scan(shared, spans), forget), "order_id long, doc_id long, text_key long, hits array<long>, shingles array<string>")
    scanned = materialize(spark, scanned, "hits")
    key = ["order_id", "text_key"]
    pairs = (
        scanned.select(*key, F.explode("hits").alias("hash"))
        .distinct()
        .join(sketch.select("hash", "item_key", "need"), "hash")
        .groupBy(*key, "item_key", "need")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n >= need")
        .select(*key, "item_key")
    )
    wanted = pairs.join(table.select("item_key", "item_id", "total", "shingle"), "item_key")
    present = scanned.select(*key, "doc_id", F.explode("shingles").alias("shingle")).distinct()
    counted = (
        wanted.join(present, [*key, "shingle"])
        .groupBy(*key, "doc_id", "item_key", "item_id", "total")
        .agg(F.count(F.lit(1)).cast("int").alias("shared"))
    )
    enough = F.col("total") - F.col("shared") <= F.floor((1 - threshold) * F.col("total") + 1e-9)
    return counted.where(enough).select("order_id", "doc_id", "text_key", "item_id", "shared", "total").distinct()
