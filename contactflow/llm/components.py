"""Connected components over an edge table, as DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize


#: Edges per file of a round.
EDGES_PER_TASK = 200_000


def _stamp(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges(a, b); component is the smallest node reachable.

    Alternating large-star and small-star rounds: each round points nodes at the smallest
    neighbour, so the number of rounds grows with the logarithm of the longest path. A hub is never
    gathered: its neighbours only meet its minimum, by an aggregate and a join that adaptive
    execution may split. Self-loops and repeated edges are ignored; nodes without another node are
    not returned; no edges give an empty table. Nulls in either column drop the edge.
    """
    n = None

    def write(df: DataFrame, name: str) -> DataFrame:
        # Few edges need few files; the count bounds what a task holds.
        return materialize(spark, df if n is None else df.coalesce(1 + n // EDGES_PER_TASK), name)

    current = materialize(
        spark,
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    stamp = _stamp(current)
    while stamp[0]:
        n = stamp[0]
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = write(large.where("a != b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.greatest("b", "m").alias("x"), F.least("b", "m").alias("y"))
            .where("x != y")
            .union(low)
            .toDF("a", "b")
            .distinct()
        )
        current = write(small, "small-star")
        before, stamp = stamp, _stamp(current)
        if stamp == before:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
