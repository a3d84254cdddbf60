"""Data-quality checks; each returns counts or the violating rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.outcome import is_unresolved


def empty_messages(distribution: DataFrame) -> DataFrame:
    bad = F.col("mensagem").isNull() | (F.trim("mensagem") == "")
    return distribution.agg(F.count(F.lit(1)).alias("n_linhas"), F.count_if(bad).alias("n_violacoes"))


def unbalanced_days(summary: DataFrame) -> DataFrame:
    """Days whose active and inactive parts do not add up to the total."""
    days = summary.where(F.col("dia") != "Total")
    bad = F.col("ativos") + F.col("inativos") != F.col("total")
    return days.agg(F.count(F.lit(1)).alias("n_linhas"), F.count_if(bad).alias("n_violacoes"))


def unmapped_statuses(state: DataFrame, mapped: list[str]) -> DataFrame:
    """Status codes present in the data but not in `mapped`."""
    known = state.sparkSession.createDataFrame([(s,) for s in mapped], "status string")
    return state.select("status").distinct().join(known, "status", "left_anti")


def total_row_check(summary: DataFrame) -> DataFrame:
    is_total = F.col("dia") == "Total"
    return summary.agg(
        F.coalesce(F.sum(F.when(~is_total, F.col("total"))), F.lit(0)).cast("long").alias("soma_dias"),
        F.max(F.when(is_total, F.col("total"))).alias("linha_total"),
    ).withColumn("ok", F.coalesce(F.col("soma_dias") == F.col("linha_total"), F.lit(True)))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Counts of two sides by key; `n_diff` is how many keys disagree."""
    a = left.groupBy(*keys).agg(F.sum("n").cast("long").alias("_a"))
    b = right.groupBy(*keys).agg(F.sum("n").cast("long").alias("_b"))
    same = [a[k].eqNullSafe(b[k]) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    joined = a.join(b, condition, "full_outer")
    return joined.agg(
        F.lit(check).alias("verificacao"),
        F.count(F.lit(1)).alias("n_chaves"),
        F.coalesce(F.sum("_a"), F.lit(0)).cast("long").alias("n_base"),
        F.coalesce(F.sum("_b"), F.lit(0)).cast("long").alias("n_rollup"),
        F.count_if(~F.coalesce(F.col("_a") == F.col("_b"), F.lit(False))).alias("n_diff"),
    )


def reconcile_rollup(state: DataFrame, catalogue: DataFrame, rollup: DataFrame) -> DataFrame:
    """Rollup against direct counts: total, status, message, day, and the
    invariant that every resolved row has an outcome.

    Both sides are one stream of counts, summed over all four groupings in one pass, so each is read once.
    """
    counts = state.groupBy("status", "resposta_id", F.to_date("data_update").alias("dia")).agg(F.count(F.lit(1)).alias("n"))
    resolved = (F.col("status") != "pendente") & F.col("resposta_id").isNotNull()
    none = F.lit(None).cast("long")
    keys = ["status", "mensagem", "dia"]
    base = counts.join(catalogue.select(F.col("id").alias("resposta_id"), "mensagem"), "resposta_id", "left").select(
        *keys,
        F.when(resolved, F.col("n")).alias("a"),
        none.alias("b"),
        F.col("n").alias("rows"),
        F.when(is_unresolved(F.col("status"), F.col("resposta_id")), F.col("n")).alias("open"),
    )
    rolled = rollup.select(*keys, none.alias("a"), F.col("qtd").cast("long").alias("b"), none.alias("rows"), none.alias("open"))
    sums = base.unionByName(rolled).groupingSets([[], ["status"], ["mensagem"], ["dia"]], *keys).agg(
        F.grouping_id().alias("g"), *(F.sum(c).alias(c) for c in ("a", "b", "rows", "open"))
    )

    def check(name: str, bits: int) -> Column:
        mine = (F.col("g") == bits) & (F.col("a").isNotNull() | F.col("b").isNotNull())
        total = {c: F.coalesce(F.sum(F.when(mine, F.col(c))), F.lit(0)).cast("long") for c in ("a", "b")}
        differs = mine & ~F.coalesce(F.col("a") == F.col("b"), F.lit(False))
        return F.struct(
            F.lit(name).alias("verificacao"), F.count_if(mine).alias("n_chaves"), total["a"].alias("n_base"),
            total["b"].alias("n_rollup"), F.count_if(differs).alias("n_diff"),
        )

    all_rows, left_open = (F.coalesce(F.sum(F.when(F.col("g") == 7, F.col(c))), F.lit(0)).cast("long") for c in ("rows", "open"))
    invalid = F.struct(
        F.lit("sem_resposta").alias("verificacao"), all_rows.alias("n_chaves"), all_rows.alias("n_base"),
        (all_rows - left_open).alias("n_rollup"), left_open.alias("n_diff"),
    )
    # A grouping's bits tell the columns that it leaves out, the first of keys being the highest.
    checks = [check("total", 7), check("status", 3), check("mensagem", 5), check("dia", 6), invalid]
    return sums.agg(F.array(*checks).alias("c")).select(F.inline("c"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys stored more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(df: DataFrame, fk: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """Foreign key values without a parent and how many rows carry them."""
    counts = df.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("fk")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(parent.select(F.col(key).alias("fk")), "fk", "left_anti")


def outside_domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values outside a closed list, NULL included, with their row counts."""
    ok = F.coalesce(F.col(column).isin(allowed), F.lit(False))
    return df.where(~ok).groupBy(F.col(column).alias("valor")).agg(F.count(F.lit(1)).alias("n"))
