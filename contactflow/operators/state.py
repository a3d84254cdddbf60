"""The work queue as data: each step maps one state snapshot to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    CLAIMED,
    CONTRACT_OPEN,
    DEFAULT_BATCH,
    OPEN_STATES,
    PENDING,
    PHONE_OK,
    RUNNER_BATCH,
    VALIDATED,
)
from ..functions.outcome import FINAL_OUTCOMES, code_status, result_code
from ..functions.text import trim_ws
from .keyed import assign_ids, first_per_key, last_per_key, mark_ids, next_id, rank_by_id, upsert


def latest_pending(state: DataFrame, clients: DataFrame) -> DataFrame:
    """Newest pending row per national id.

    Reduced per client before the join, so a hot client costs one row.
    """
    pending = state.where(F.col("status") == PENDING)
    per_client = last_per_key(pending, ["cliente_id"], ["data_update", "id"])
    named = per_client.join(clients.select(F.col("id").alias("cliente_id"), "rut"), "cliente_id")
    return last_per_key(named, ["rut"], ["data_update", "id"]).select(*state.columns, "rut")


def claimable(state: DataFrame, clients: DataFrame, batch_size: int | None = None) -> DataFrame:
    """Oldest pending rows first."""
    n = batch_size if batch_size and batch_size > 0 else DEFAULT_BATCH
    return latest_pending(state, clients).orderBy("data_update", "id").limit(n)


def id_batch(state: DataFrame, clients: DataFrame, n: int = RUNNER_BATCH) -> DataFrame:
    return (
        state.where(F.col("status") == PENDING)
        .select("id", "cliente_id")
        .join(clients.select(F.col("id").alias("cliente_id"), "rut", "dv"), "cliente_id")
        .orderBy("id")
        .limit(n)
    )


def seed(state: DataFrame, clients: DataFrame, now: Column) -> DataFrame:
    """State rows with defaults for clients that have none."""
    fresh = clients.select(F.col("id").alias("cliente_id")).join(
        state.select("cliente_id").distinct(), "cliente_id", "left_anti"
    )
    return assign_ids(fresh, state, "cliente_id").select(
        "id",
        "cliente_id",
        F.lit(5).alias("resposta_id"),
        F.lit(PENDING).alias("status"),
        F.lit(0).alias("extraido"),
        now.alias("data_update"),
    )


def claim(state: DataFrame, batch: DataFrame) -> DataFrame:
    return mark_ids(state, batch, {"status": F.lit(CLAIMED)})


def changed_rows(state: DataFrame, batch: DataFrame, columns: dict[str, Column], guard: Column | None = None) -> DataFrame:
    """The rows of a batch of ids that pass `guard`, with `columns` set: what a change log stores of `mark_ids`."""
    rows = state.join(batch.select("id").distinct(), "id", "left_semi")
    if guard is not None:
        rows = rows.where(guard)
    return rows.withColumns(columns).select(*state.columns)


def claimed_rows(state: DataFrame, batch: DataFrame) -> DataFrame:
    return changed_rows(state, batch, {"status": F.lit(CLAIMED)})


def reverted_rows(state: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Claimed rows, of a batch or all, as they are back in the queue."""
    claimed = F.col("status") == CLAIMED
    if batch is None:
        return state.where(claimed).withColumn("status", F.lit(PENDING)).select(*state.columns)
    return changed_rows(state, batch, {"status": F.lit(PENDING)}, claimed)


def consumed_rows(state: DataFrame, selected: DataFrame, now: Column) -> DataFrame:
    return changed_rows(state, selected, {"extraido": F.lit(1), "data_extracao": now})


def claim_contracts(state: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """Guarded claim of the older model: only open rows, and it stamps them."""
    return mark_ids(
        state,
        batch,
        {"status": F.lit(CLAIMED), "data_update": now},
        guard=F.col("status").isin(CONTRACT_OPEN),
    )


def revert(state: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Claimed rows back to the queue: a failed batch, or all at start-up."""
    back = {"status": F.lit(PENDING)}
    if batch is not None:
        return mark_ids(state, batch, back, guard=F.col("status") == CLAIMED)
    status = F.when(F.col("status") == CLAIMED, PENDING).otherwise(F.col("status"))
    return state.withColumn("status", status)


def resolve_results(results: DataFrame, order: list[str]) -> DataFrame:
    """One outcome per key from its result lines in file order.

    The first line with a final outcome decides; without one, the last line.
    Both picks are aggregates over (outcome, order), so lines combine before
    the shuffle.
    """
    ordering = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    code = result_code(*(F.col(c) for c in ("sucesso", "telefone_validado", "email_validado", "erro")))
    lines = results.select(
        trim_ws(F.col("rut")).alias("rut"),
        code.alias("code"),
        ordering.alias("at"),
    ).where(F.col("rut") != "")
    final_at = F.when(F.col("code").isin(FINAL_OUTCOMES), F.col("at"))
    chosen = F.coalesce(F.min_by("code", final_at), F.max_by("code", F.col("at")))
    return lines.groupBy("rut").agg(chosen.alias("resposta_id")).withColumn(
        "status", code_status(F.col("resposta_id"))
    )


def client_outcomes(results: DataFrame, clients: DataFrame, order: list[str]) -> DataFrame:
    """Outcome per known client; lines of unknown keys fall out."""
    return resolve_results(results, order).join(
        clients.select("rut", F.col("id").alias("cliente_id")), "rut"
    )


def apply_results(
    state: DataFrame, results: DataFrame, clients: DataFrame, order: list[str], now: Column
) -> DataFrame:
    """Next snapshot after a result file.

    Finished rows keep their outcome and only get a new data_update; clients
    without a row are inserted. Contact links and export flags stay.
    """
    outcomes = client_outcomes(results, clients, order).select("cliente_id", "resposta_id", "status")
    return apply_outcomes(state, outcomes, now)


def result_rows(
    state: DataFrame, results: DataFrame, clients: DataFrame, order: list[str], now: Column
) -> DataFrame:
    """The rows that a result file changes or adds: what a change log stores of `apply_results`."""
    outcomes = client_outcomes(results, clients, order).select("cliente_id", "resposta_id", "status")
    touched = state.join(outcomes.select("cliente_id"), "cliente_id", "left_semi").select(*state.columns)
    return apply_outcomes(touched, outcomes, now, next_id(state))


def apply_outcomes(state: DataFrame, outcomes: DataFrame, now: Column, first_id: Column | None = None) -> DataFrame:
    """One outcome per client merged into the state in a single join.

    New rows get ids from `first_id` on, the next free id of `state` unless given.
    """
    is_open = F.col("status").isin(OPEN_STATES)
    update = {
        c: F.when(is_open, F.col(f"new_{c}")).otherwise(F.col(c)) for c in ("resposta_id", "status")
    }
    first_id = next_id(state) if first_id is None else first_id
    insert = {"id": first_id + F.col("cliente_id"), "extraido": F.lit(0), "data_criacao": now}
    update["data_update"] = insert["data_update"] = now
    return upsert(state, outcomes, ["cliente_id"], update, insert)


def apply_by_id(state: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Unguarded overwrite by row id; `outcomes` is unique per id."""
    d = outcomes.select("id", F.col("resposta_id").alias("_r"), F.col("status").alias("_s"))
    hit = F.col("_s").isNotNull()
    new = {"resposta_id": F.col("_r"), "status": F.col("_s"), "data_update": now}
    return state.join(d, "id", "left").select(
        *(F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in state.columns)
    )


def unconsumed(state: DataFrame, status: str = PHONE_OK) -> DataFrame:
    return state.where((F.col("status") == status) & (F.col("extraido") == 0))


def consume(state: DataFrame, selected: DataFrame, now: Column) -> DataFrame:
    """Marks exactly the selected ids as handed out."""
    return mark_ids(state, selected, {"extraido": F.lit(1), "data_extracao": now})


def paged(selected: DataFrame, page_size: int = DEFAULT_BATCH) -> DataFrame:
    """Selected rows with the page each one falls in, by id."""
    return rank_by_id(selected, "id", "_rank").withColumn(
        "pagina", F.expr(f"(_rank - 1) div {page_size}")
    ).drop("_rank")


def repair_unresolved(state: DataFrame) -> DataFrame:
    """Retry rows without an outcome are pending rows."""
    bad = (F.col("status") == "reprocessar") & F.col("resposta_id").isNull()
    return state.withColumn("status", F.when(bad, PENDING).otherwise(F.col("status")))


def upsert_catalogue(catalogue: DataFrame, entries: DataFrame) -> DataFrame:
    return upsert(catalogue, entries, ["id"])


def link_contacts(state: DataFrame, phones: DataFrame, emails: DataFrame) -> DataFrame:
    """Optional step: points each row at its client's first validated contacts."""
    def firsts(contacts, name):
        ok = contacts.where(F.col("origem") == VALIDATED).select("cliente_id", "id")
        return first_per_key(ok, ["cliente_id"], ["id"]).withColumnRenamed("id", name)

    joined = state.join(firsts(phones, "_p"), "cliente_id", "left").join(
        firsts(emails, "_e"), "cliente_id", "left"
    )
    return joined.withColumns(
        {"telefone_id": F.coalesce("telefone_id", "_p"), "email_id": F.coalesce("email_id", "_e")}
    ).select(*state.columns)


def open_import(imports: DataFrame, filename: str, now: Column) -> DataFrame:
    """Ledger with one more row in state processing."""
    one = imports.sparkSession.range(1)
    values = {"id": next_id(imports), "filename": F.lit(filename), "status": F.lit("processing"), "started_at": now}
    fresh = one.select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in imports.schema)
    )
    return imports.unionByName(fresh)


def close_import(imports: DataFrame, import_id: Column, counters: DataFrame, failed: bool, now: Column) -> DataFrame:
    """Adds a file's totals to its ledger row and closes it."""
    me = F.col("id") == import_id
    add = {c: counters.select(c).scalar() for c in ("total_rows", "rows_success", "rows_failed")}
    columns = {c: F.coalesce(F.col(c), F.lit(0)) + v for c, v in add.items()}
    columns["status"] = F.lit("failed" if failed else "completed")
    columns["finished_at"] = now
    return imports.select(
        *(
            F.when(me, columns[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in columns
            else F.col(f.name)
            for f in imports.schema
        )
    )


def fail_open(imports: DataFrame, now: Column) -> DataFrame:
    """Ledger in which imports that are still open are closed as failed."""
    is_open = F.col("status") == "processing"
    return imports.withColumns({
        "finished_at": F.when(is_open, now).otherwise(F.col("finished_at")),
        "status": F.when(is_open, F.lit("failed")).otherwise(F.col("status")),
    })


def ledger_totals(counters: DataFrame) -> DataFrame:
    """Accumulated totals per import over all of its files."""
    return counters.groupBy("staging_id").agg(
        *(F.sum(c).cast("long").alias(c) for c in ("total_rows", "rows_success", "rows_failed"))
    )


def latest_import(imports: DataFrame) -> DataFrame:
    return imports.orderBy(F.desc("id")).limit(1)
