"""Keyed building blocks shared by the jobs.

Every per-key choice is an aggregate or a limited rank, so each map task
reduces its rows before the shuffle and a key holding a third of the data
sends at most a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows one rank task may hold; ids are unique, so a range of ids bounds it.
RANK_SPAN = 1_000_000


def _rest(df: DataFrame, used: list[str]) -> list[str]:
    return [c for c in df.columns if c not in used]


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest `order` per key."""
    return _extreme(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _extreme(df, keys, order, F.max)


def _extreme(df, keys, order, agg) -> DataFrame:
    row = F.struct(*order, *_rest(df, [*keys, *order]))
    return df.groupBy(*keys).agg(agg(row).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def top_per_key(df: DataFrame, keys: list[str], order: list, k: int, rank: str = "rn") -> DataFrame:
    """The first `k` rows per key with their rank.

    The rank limit runs before the shuffle as well as after it.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def rank_by_id(
    df: DataFrame, id_col: str, rank: str = "rank", keys: tuple[str, ...] = (), span: int = RANK_SPAN,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """1-based rank by an integer id, without one task per key; `ties` order equal ids.

    Rows are ranked inside id ranges of `span`; the range counts give each
    range its starting rank.
    """
    tagged = df.withColumn("_range", F.expr(f"`{id_col}` div {span}"))
    before = (
        Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        tagged.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(id_col, *ties)
    return (
        tagged.join(starts, [*keys, "_range"])
        .withColumn(rank, F.col("_start") + F.row_number().over(inside))
        .drop("_range", "_start")
    )


def next_id(existing: DataFrame) -> Column:
    """One above the largest id, as a scalar subquery."""
    return existing.agg(F.coalesce(F.max("id"), F.lit(0)) + 1).scalar()


def assign_ids(new: DataFrame, existing: DataFrame, order: str, name: str = "id") -> DataFrame:
    """Adds `name`: ids above every existing id, ascending in `order`.

    `order` is unique and not negative, so adding it to the next free id is
    enough: no rank and no shuffle. Ids may have gaps, as a sequence has
    after ignored inserts; `rank_by_id` numbers without gaps.
    """
    return new.withColumn(name, next_id(existing) + F.col(order))


def spread_nulls(fk: str, row_id: str) -> Column:
    """A foreign key to join on, with NULLs turned into keys that match nothing.

    A left join sends all NULL keys to one task; ids are not negative, so
    these values meet no parent and spread evenly.
    """
    return F.coalesce(F.col(fk), -1 - F.col(row_id))


def collated(keys: list[str], collation: str | None) -> list[Column]:
    return [F.collate(F.col(k).cast("string"), collation) if collation else F.col(k) for k in keys]


def insert_ignore(
    target: DataFrame,
    delta: DataFrame,
    keys: list[str],
    order: list[str],
    key_collation: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Rows of `delta` to append: first writer per key, none already stored.

    `unique` says that `delta` has one row per exact key already.
    """
    if key_collation is None:
        fresh = delta if unique else first_per_key(delta, keys, order)
        return fresh.join(target.select(*keys).distinct(), keys, "left_anti")
    names = [f"_k{i}" for i in range(len(keys))]

    def keyed(df):
        return df.withColumns(dict(zip(names, collated(keys, key_collation), strict=True)))

    fresh = first_per_key(keyed(delta), names, order)
    return fresh.join(keyed(target).select(*names).distinct(), names, "left_anti").drop(*names)


def upsert(
    target: DataFrame,
    delta: DataFrame,
    keys: list[str],
    update: dict[str, Column] | None = None,
    insert: dict[str, Column] | None = None,
) -> DataFrame:
    """New snapshot of `target` with `delta` (unique per key) merged in.

    `update` and `insert` give a column's value for matched and new rows;
    they see target columns by name and delta columns as `new_<name>`.
    Columns left out take the delta value, or stay as they are.
    """
    update, insert = update or {}, insert or {}
    names = [c for c in delta.columns if c not in keys]
    d = delta.select(*keys, *(F.col(c).alias(f"new_{c}") for c in names)).withColumn("_in_d", F.lit(True))
    t = target.withColumn("_in_t", F.lit(True))
    joined = t.join(d, keys, "full_outer")

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        new = F.col(f"new_{c}") if c in names else F.col(c)
        return (
            F.when(F.col("_in_t").isNull(), insert.get(c, new))
            .when(F.col("_in_d").isNull(), F.col(c))
            .otherwise(update.get(c, new))
            .cast(target.schema[c].dataType)
        )

    return joined.select(*(value(c).alias(c) for c in target.columns))


def update_join(target: DataFrame, delta: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Replaces `columns` where the key matches, NULLs included."""
    d = delta.select(*keys, *(F.col(c).alias(f"new_{c}") for c in columns)).withColumn("_hit", F.lit(True))
    joined = target.join(d, keys, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return joined.select(
        *(
            F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        )
    )


def mark_ids(
    state: DataFrame, ids: DataFrame, columns: dict[str, Column], guard: Column | None = None
) -> DataFrame:
    """Sets `columns` on rows whose id is in `ids` and that pass `guard`."""
    marked = state.join(ids.select("id").distinct().withColumn("_hit", F.lit(True)), "id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))
    return marked.select(
        *(
            F.when(hit, columns[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in state.columns
        )
    )
