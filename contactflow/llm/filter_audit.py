"""How an ordered chain of document filters interacts: what each order of the filters would remove.

A document's failures form a mask. Every mask stands for one wide integer that packs the outcome of
all steps of all orders into 64-bit fields, so auditing a document is one addition per part, and the
fields of a sum are the counts. Fields cannot overflow below 2^64 documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import permutations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, order_id

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: The 600 steps: (order, number of the step).
STEPS = [(order, i) for order in ORDERS for i in range(1, len(FILTERS) + 1)]
#: Counts of a step, in the order of their fields.
COUNTS = ["kept", "removed", "redundant", "good_lost", "toxic_lost"]
FIELD_BYTES = 8
WIDTH = len(STEPS) * len(COUNTS) * FIELD_BYTES
#: Sums a task holds at a time; beyond it sums are handed on and continued in the next stage.
PARTS_AT_A_TIME = 1000
#: First-level tasks per part that add the sums of map tasks.
FAN_IN = 32

UPPER = bytes(range(65, 91))
SPECIAL = b"#$%&*|"
COPY = 1 << FILTERS.index("E")


def text_failures(text: bytes) -> int:
    """Mask of the filters that a text fails by itself (A to D)."""
    words = text.split()
    rest = text.translate(None, UPPER)
    points = len(text.decode("utf-8", "replace"))
    failed = (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * (len(text) - len(rest)) > 10 * points,
        len(text.translate(None, SPECIAL)) < len(text),
    )
    return sum(1 << i for i, fails in enumerate(failed) if fails)


def _step_counts(order: str, step: int, mask: int, good: bool, toxic: bool) -> list[int]:
    """Outcome of one step for a document, one 0 or 1 per count."""
    earlier = any(mask >> FILTERS.index(f) & 1 for f in order[: step - 1])
    fails = bool(mask >> FILTERS.index(order[step - 1]) & 1)
    removed = fails and not earlier
    return [not earlier and not fails, removed, fails and earlier, removed and good, removed and toxic]


@cache
def packed_outcomes() -> dict[tuple[int, bool, bool], int]:
    """The wide integer of every mask and pair of marks."""
    table = {}
    for mask, good, toxic in product(range(1 << len(FILTERS)), (False, True), (False, True)):
        fields = [x for order, step in STEPS for x in _step_counts(order, step, mask, good, toxic)]
        table[mask, good, toxic] = int.from_bytes(np.array(fields, "<u8").tobytes(), "little")
    return table


def failure_rows(docs: DataFrame) -> DataFrame:
    """(order_id, part, mask, digest) per document: own failures and the SHA-256 of the text."""

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch["text"]]
            masks = pa.array([text_failures(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["order_id"], batch["part"], masks, digests], ["order_id", "part", "mask", "digest"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    plain = docs.select(order_id().alias("order_id"), part.alias("part"), text.alias("text"))
    return plain.mapInArrow(judge, "order_id long, part string, mask int, digest binary")


def _batch(sums: dict[str, int]) -> pa.RecordBatch:
    packed = [x.to_bytes(WIDTH, "little") for x in sums.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(packed, pa.binary())], ["part", "packed"])


def _add_outcomes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a map task per part; at most PARTS_AT_A_TIME are held."""
    table = packed_outcomes()
    sums: dict[str, int] = {}
    for batch in batches:
        for part, *key in zip(*(batch[c].to_pylist() for c in ("part", "mask", "good", "toxic")), strict=True):
            sums[part] = sums.get(part, 0) + table[tuple(key)]
            if len(sums) > PARTS_AT_A_TIME:
                yield _batch(sums)
                sums.clear()
    if sums:
        yield _batch(sums)


def _add_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sum per part from sums sorted by part."""
    part, total = None, 0
    for batch in batches:
        for name, packed in zip(batch["part"].to_pylist(), batch["packed"].to_pylist(), strict=True):
            if part is not None and name != part:
                yield _batch({part: total})
                total = 0
            part, total = name, total + int.from_bytes(packed, "little")
    if part is not None:
        yield _batch({part: total})


RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def unpack(part: str, packed: bytes) -> dict[str, list]:
    """The 600 result rows of a part, as columns."""
    counts = dict(zip(COUNTS, np.frombuffer(packed, "<u8").reshape(len(STEPS), len(COUNTS)).astype(np.int64).T, strict=True))
    letters = np.array([order[step - 1] for order, step in STEPS])
    last = np.array([step == len(FILTERS) for _, step in STEPS])
    # What the last filter of an order removes fails that filter alone.
    alone = {f: int(counts["removed"][last & (letters == f)][0]) for f in FILTERS}
    total = {f: int(counts["removed"][letters == f].sum()) for f in FILTERS}
    return {
        "part": [part] * len(STEPS),
        "filter_order": [order for order, _ in STEPS],
        "step": [step for _, step in STEPS],
        "kept": counts["kept"],
        "removed": counts["removed"],
        "redundant": counts["redundant"],
        "unique_fails": [alone[f] for f in letters],
        "good_lost": counts["good_lost"],
        "toxic_lost": counts["toxic_lost"],
        "shapley": [total[f] for f in letters],
    }


def _unpack_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    for batch in batches:
        for part, packed in zip(batch["part"].to_pylist(), batch["packed"].to_pylist(), strict=True):
            columns = unpack(part, packed)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns.values(), types, strict=True)], list(columns))


def masks(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic) of every document, copies marked across the whole table."""
    rows = materialize(spark, failure_rows(docs), "failures")
    firsts = rows.groupBy("digest").agg(F.min("order_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("order_id"))
    marks = marks.agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    marks = marks.where("good or toxic")
    copied = F.when(F.col("order_id") > F.col("first_id"), F.lit(COPY)).otherwise(F.lit(0))
    marked = rows.join(firsts, "digest", "left").join(marks, "order_id", "left")
    no = F.lit(False)
    return marked.select(
        "part", F.col("mask").bitwiseOR(copied).alias("mask"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    )


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, zeros included.

    A null text is empty, a null lang is the part of the empty text. A null doc_id sorts after all
    others: such a row is a copy of any equal text with an id, and of two without one neither is;
    it has no label. Rows that repeat a doc_id count each, and none is a copy of the other. Of
    repeated labels any mark counts. Extra columns are ignored. A text is held whole in a task, with
    the set of its words. An empty table gives no rows. Sums are made in map tasks, then in FAN_IN
    tasks per part, then one row per part is unpacked, so no task sees a part's documents.
    """
    sums = "part string, packed binary"
    dealt = masks(spark, docs, labels).mapInArrow(_add_outcomes, sums).withColumn("slot", F.spark_partition_id() % FAN_IN)
    once = dealt.repartition("part", "slot").drop("slot").sortWithinPartitions("part").mapInArrow(_add_sums, sums)
    whole = once.repartition("part").sortWithinPartitions("part").mapInArrow(_add_sums, sums)
    return whole.mapInArrow(_unpack_all, RESULT)
