"""Exact deduplication against immutable snapshots, each screened by static binary-fuse filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fuse_filter
from .common import BLANKS, LAST_ID, materialize, order_id

#: Distinct digests per filter; the number of filters grows with the snapshot.
FILTER_KEYS = 50_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def sha256(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


@dataclass(frozen=True)
class Snapshot:
    """What one batch added to the archive; written once, never changed."""

    #: (digest, keep_id, norm): the texts that stayed, one row per distinct text.
    rows: DataFrame
    #: (bucket, seed, slots): one filter for each bucket of digests.
    filters: DataFrame
    buckets: int


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def _key(digests: pd.Series) -> np.ndarray:
    """The first 64 bits of hexadecimal digests."""
    return np.fromiter((int(d[:16], 16) for d in digests), np.uint64, len(digests))


def build_snapshot(spark: SparkSession, rows: DataFrame) -> Snapshot:
    """Snapshot over rows(digest, keep_id, norm), which have been written before."""
    buckets = max(1, -(-rows.count() // FILTER_KEYS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        seed, slots = fuse_filter.build(_key(group["digest"]))
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1], "seed": [seed], "slots": [slots]})

    grouped = rows.select("digest", _bucket(buckets).alias("bucket")).groupBy("bucket")
    filters = grouped.applyInPandas(build, "bucket int, seed int, slots binary")
    return Snapshot(rows, materialize(spark, filters, "filters"), buckets)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests that a filter may hold, from a stream in which each bucket's filter comes first."""
    bucket, seed, slots = None, 0, b""
    for batch in batches:
        table = batch.to_pandas()
        maybe = []
        for at, part in table.groupby("bucket", sort=True):
            filters = part[part["slots"].notna()]
            if len(filters):
                bucket, seed, slots = at, int(filters["seed"].iloc[0]), filters["slots"].iloc[0]
            digests = part.loc[part["slots"].isna(), "digest"]
            if bucket == at and len(digests):
                maybe.extend(digests[fuse_filter.contains(seed, slots, _key(digests))])
        yield pa.RecordBatch.from_pydict({"digest": pa.array(maybe, pa.string())})


def screen(digests: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The digests (one row each) that the snapshot's filters cannot rule out.

    Digests meet the filter of their bucket in a sorted stream, so a task holds one filter at a time
    however many digests there are; the filters of a snapshot are not broadcast.
    """
    incoming = digests.select(
        _bucket(snapshot.buckets).alias("bucket"),
        F.lit(1).alias("kind"),
        "digest",
        F.lit(None).cast("int").alias("seed"),
        F.lit(None).cast("binary").alias("slots"),
    )
    filters = snapshot.filters.select("bucket", F.lit(0).alias("kind"), F.lit(None).cast("string"), "seed", "slots")
    stream = filters.union(incoming).toDF("bucket", "kind", "digest", "seed", "slots")
    dealt = stream.repartition("bucket").sortWithinPartitions("bucket", "kind")
    return dealt.select("bucket", "digest", "seed", "slots").mapInArrow(_probe, "digest string")


def ingest(
    spark: SparkSession,
    docs: DataFrame,
    snapshots: list[Snapshot],
    digest: Callable[[Column], Column] = sha256,
    archive: bool = True,
) -> tuple[DataFrame, Snapshot | None]:
    """Decide on a batch docs(order_id, doc_id, text) and return (decisions, its own snapshot).

    With archive=False no snapshot is written, for a batch that nothing follows.

    decisions(order_id, doc_id, digest, keep_id): keep_id is the id that stays for the row's text,
    from an earlier snapshot where one holds an equal text, else the batch's smallest. Digests only
    select candidates: a row joins a text's group if the bytes are equal, and rows that share a
    digest without being equal are grouped by their bytes.
    """
    norm = normalised(F.col("text"))
    rows = docs.select("order_id", "doc_id", norm.alias("norm")).select(
        "order_id", "doc_id", digest(F.col("norm")).alias("digest"), "norm"
    )
    groups = materialize(
        spark, rows.groupBy("digest").agg(F.min("order_id").alias("rep"), F.count(F.lit(1)).alias("n")), "digests"
    )
    known = spark.range(0).selectExpr("CAST(id AS STRING) AS digest", "id AS known_id", "CAST(id AS STRING) AS known_norm")
    for snapshot in snapshots:
        maybe = screen(groups, snapshot)
        found = snapshot.rows.join(maybe, "digest").select(
            "digest", F.col("keep_id").alias("known_id"), F.col("norm").alias("known_norm")
        )
        known = known.union(found)
    known = materialize(spark, known, "known") if snapshots else known
    flagged = groups.join(known.select("digest").distinct().withColumn("hit", F.lit(True)), "digest", "left")
    # One pass moves the texts to their digest, of a last batch only those that need a check.
    wanted = flagged if archive else flagged.where("n > 1 or hit")
    dealt = materialize(spark, rows.join(wanted, "digest"), "batch")
    alone = flagged.where("n = 1 and hit is null")
    single = alone.select(
        F.col("rep").alias("order_id"), F.when(F.col("rep") != LAST_ID, F.col("rep")).alias("doc_id"), "digest", F.col("rep").alias("keep_id")
    )
    checkable = dealt.where("n > 1 or hit")
    old = (
        checkable.where("hit")
        .join(known, "digest")
        .where(F.col("norm") == F.col("known_norm"))
        .select("order_id", "doc_id", "digest", F.col("known_id").alias("keep_id"))
    )
    seen = known.select("digest", F.col("known_norm").alias("norm")).distinct()
    several = checkable.where("hit is null").union(
        checkable.where("hit").join(seen, ["digest", "norm"], "left_anti").select(checkable.columns)
    )
    firsts = several.where(F.col("order_id") == F.col("rep")).select("digest", F.col("norm").alias("first")).distinct()
    firsts = firsts.groupBy("digest").agg(F.min("first").alias("first"))
    checked = several.join(firsts, "digest", "left").withColumn("equal", F.coalesce(F.col("norm") == F.col("first"), F.lit(False)))
    equal = checked.where("equal").select("order_id", "doc_id", "digest", F.col("rep").alias("keep_id"))
    others = checked.where("not equal")
    others = others.join(
        others.groupBy("digest", "norm").agg(F.min("order_id").alias("keep_id")), ["digest", "norm"]
    ).select("order_id", "doc_id", "digest", "keep_id")
    new = single.union(equal).union(others)
    if not archive:
        return old.union(new), None
    kept = equal.union(others).where(F.col("order_id") == F.col("keep_id")).select("order_id", "digest").distinct()
    columns = ["digest", F.col("order_id").alias("keep_id"), "norm"]
    added = checkable.join(kept, ["order_id", "digest"]).select(*columns).dropDuplicates(["digest", "keep_id", "norm"])
    added = dealt.where("n = 1 and hit is null").select(*columns).union(materialize(spark, added, "snapshot"))
    return old.union(new), build_snapshot(spark, added)


def deduplicate(
    spark: SparkSession, docs: DataFrame, batches: int = 2, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """(order_id, doc_id, keep_id, group_size, kept, digest) for each row of docs(doc_id, text, ...).

    The table is taken in as `batches` batches in the order of doc_id, each screened against the
    snapshots of those before it, so the smallest doc_id of equal texts stays. A null text counts as
    empty. Rows with a null doc_id come last and share one id. Rows that repeat a doc_id and its
    text are one document: all are returned, all count in group_size, all are kept or dropped
    together. Other columns are not read. An empty table gives an empty table.
    """
    rows = docs.select(order_id().alias("order_id"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = rows.approxQuantile("order_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    bounds = [None, *sorted({int(c) for c in cuts}), None]
    decisions, snapshots = [], []
    for i, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False), 2):
        batch = rows
        if low is not None:
            batch = batch.where(F.col("order_id") >= low)
        if high is not None:
            batch = batch.where(F.col("order_id") < high)
        decided, snapshot = ingest(spark, batch, snapshots, digest, archive=i < len(bounds))
        decisions.append(decided)
        snapshots.append(snapshot)
    decided = materialize(spark, reduce(DataFrame.union, decisions), "decisions")
    sizes = decided.groupBy("digest", "keep_id").agg(F.count(F.lit(1)).alias("group_size"))
    out = decided.join(sizes, ["digest", "keep_id"])
    return out.select(
        "order_id",
        "doc_id",
        F.when(F.col("keep_id") != LAST_ID, F.col("keep_id")).alias("keep_id"),
        "group_size",
        (F.col("order_id") == F.col("keep_id")).alias("kept"),
        "digest",
    )
