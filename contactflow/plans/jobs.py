"""The daily jobs from files to stored tables and back to files.

A job publishes all of its tables in one commit at its end, so one that dies
leaves them as they were, and it can run again: inserts skip what is stored.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import OUTCOMES
from ..operators import export, ingest, report, rollups, state
from ..operators.keyed import assign_ids
from ..schemas import BUCKETED, LOGGED, TABLES
from ..sources import files
from ..sources.catalog import LOG_PARTS, Catalog, Changes

LINE = ["line_no"]


@dataclass
class Store:
    """Stored tables below one folder that all executors reach."""

    spark: SparkSession
    base: str

    def __post_init__(self) -> None:
        self.catalog = Catalog(self.spark, self.base)

    def read(self, name: str) -> DataFrame:
        return self.catalog.read(name, TABLES[name])

    def append(self, changes: Changes, name: str, rows: DataFrame) -> None:
        rows = self._shaped(name, rows)
        if name in BUCKETED:
            changes.put_buckets(name, rows, *BUCKETED[name])
        else:
            changes.append(name, rows)

    def replace(self, changes: Changes, name: str, rows: DataFrame) -> None:
        changes.replace(name, self._shaped(name, rows))

    def change(self, changes: Changes, name: str, rows: DataFrame) -> None:
        """Publishes rows that are new or differ, for a table with a log."""
        changes.change(name, self._shaped(name, rows), LOGGED[name])

    def fold_logs(self) -> None:
        """Writes new bases for tables whose log has grown long; the scheduled part of every job that changes rows."""
        tables = self.catalog.version()["tables"]
        for name in LOGGED:
            if len(tables.get(name, {}).get("log", [])) > LOG_PARTS:
                self.catalog.fold(name, TABLES[name])

    def _shaped(self, name: str, rows: DataFrame) -> DataFrame:
        """`rows` in the declared column order and types; absent columns are NULL."""
        fields = self.spark.createDataFrame([], TABLES[name]).schema
        return rows.select(
            *((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields)
        )


def at(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def close_lost_imports(store: Store, now: dt.datetime) -> int:
    """Closes imports that were opened and never closed as failed; gives their number.

    An import's rows and its closing are one commit, so an open one has published nothing.
    """
    imports = store.read("imports")
    lost = imports.where(F.col("status") == "processing").count()
    if lost:
        with store.catalog.commit() as c:
            store.replace(c, "imports", state.fail_open(imports, at(now)))
    return lost


def import_customers(
    store: Store, path: str, now: dt.datetime, limit: int | None = None, dry_run: bool = False, multiline: bool = False
) -> dict[str, int]:
    """Customers and first addresses from a raw file; returns the counters.

    The ledger row is opened before, which records the job; its rows and the closed ledger are published
    together. A job that fails closes its import as failed, one that dies leaves that to the next.
    """
    lines = files.read_customers(store.spark, path, positions=True, multiline=multiline)
    lines = ingest.row_limited(files.with_line_no(lines), limit)
    if dry_run:
        return ingest.import_counters(lines, store.read("clients"), store.read("addresses")).first().asDict()
    close_lost_imports(store, now)
    with store.catalog.commit() as c:
        store.replace(c, "imports", state.open_import(store.read("imports"), path.rsplit("/", 1)[-1], at(now)))
    import_id = state.latest_import(store.read("imports")).first().id
    try:
        with store.catalog.commit() as c:
            return _publish_customers(store, c, lines, import_id, now)
    except Exception:
        close_lost_imports(store, now)
        raise


def _publish_customers(store: Store, c: Changes, lines: DataFrame, import_id: int, now: dt.datetime) -> dict[str, int]:
    clients, addresses = store.read("clients"), store.read("addresses")
    totals = ingest.import_counters(lines, clients, addresses).first().asDict()
    staged = ingest.stage_rows(lines, clients.select("rut"))
    store.append(c, "import_rows", staged.withColumns({
        "staging_id": F.lit(import_id), "row_idx": F.col("line_no"), "processed_at": at(now),
    }))
    store.append(c, "clients", ingest.new_clients(lines, clients, import_id))
    fresh = ingest.new_addresses(lines, c.read("clients", TABLES["clients"]), addresses)
    store.append(c, "addresses", assign_ids(fresh, addresses, "cliente_id"))
    done = store.spark.createDataFrame(
        [(totals["lidos"], totals["clientes_inseridos"], totals["ignorados"] + totals["quarentena"])],
        "total_rows long, rows_success long, rows_failed long",
    )
    store.replace(c, "imports", state.close_import(store.read("imports"), F.lit(import_id), done, False, at(now)))
    return totals


def import_contacts(
    store: Store, path: str, kind: str, import_id: int | None = None, limit: int | None = None, dry_run: bool = False,
    multiline: bool = False,
) -> dict[str, int]:
    """Historic phones or e-mails, added under an import (the latest by default)."""
    table, column, phone = ("phones", "numero", True) if kind == "telefone" else ("emails", "endereco", False)
    raw = files.with_line_no(files.read_delimited(store.spark, path, "ISO-8859-1", multiline, positions=True))
    value = "Celular" if phone else "Email"
    lines = ingest.row_limited(raw.select(F.col("Rut").alias("rut"), value, "line_no"), limit)
    clients, stored = store.read("clients"), store.read(table)
    totals = ingest.contact_counters(lines, clients, stored, value, column, LINE, phone).first().asDict()
    if dry_run:
        return totals
    if import_id is None:
        latest = state.latest_import(store.read("imports")).first()
        if latest is None:
            raise RuntimeError("import customers first: there is no import to add contacts to")
        import_id = latest.id
    fresh = ingest.new_contacts(lines, clients, stored, value, column, LINE, phone)
    imports = store.read("imports")
    counts = {
        "total_rows": totals["lidos"],
        "rows_success": totals["inseridos"],
        "rows_failed": totals["invalidos"] + totals["sem_cliente"],
    }
    me = F.col("id") == import_id
    added = {c: F.coalesce(F.col(c), F.lit(0)) + F.when(me, F.lit(n)).otherwise(0) for c, n in counts.items()}
    with store.catalog.commit() as c:
        store.append(c, table, assign_ids(fresh, stored, "line_no").withColumn("staging_id", F.lit(import_id)))
        store.replace(c, "imports", imports.withColumns(added))
    return totals


def clean_addresses(
    store: Store, path: str, out: str, limit: int | None = None, multiline: bool = False
) -> dict[str, int]:
    """Writes the cleaned copy of a raw customer file."""
    raw = files.read_customers(store.spark, path, positions=True, multiline=multiline)
    lines = ingest.row_limited(files.with_line_no(raw), limit) if limit else raw.drop(*files.LINE_ORDER)
    files.write_customers(ingest.clean_customer_file(lines), out)
    return ingest.cleaning_counters(lines).first().asDict()


def update_addresses(store: Store, cleaned: str, dry_run: bool = False) -> dict[str, int]:
    """Replaces stored addresses by key from a cleaned file; only buckets with such a key are written."""
    lines = files.with_line_no(files.read_customers(store.spark, cleaned, "UTF-8", positions=True))
    keys = lines.select(ingest.rut_digits(F.col("rut")).alias("rut"))
    totals = keys.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("rut") == "").alias("sem_rut")
    ).first().asDict()
    if not dry_run:
        delta = ingest.address_changes(store.read("clients"), lines)
        with store.catalog.commit() as c:
            c.update("addresses", TABLES["addresses"], delta, *BUCKETED["addresses"], ingest.put_addresses)
    return totals


def seed_state(store: Store, now: dt.datetime) -> None:
    current = store.read("state")
    fresh = state.seed(current, store.read("clients"), at(now)).withColumn("data_criacao", at(now))
    with store.catalog.commit() as c:
        store.change(c, "state", fresh)
    store.fold_logs()


def claim_batch(store: Store, size: int | None = None) -> DataFrame:
    """Claims the oldest pending rows and returns them; writes no other row."""
    current = store.read("state")
    batch = state.claimable(current, store.read("clients"), size)
    with store.catalog.commit() as c:
        store.change(c, "state", state.claimed_rows(current, batch))
    store.fold_logs()
    return batch


def revert_claims(store: Store, ids: list[int] | None = None) -> int:
    """Claimed rows back to the queue: those of the ids, or all; gives their number."""
    current = store.read("state")
    batch = None if ids is None else store.spark.createDataFrame([(i,) for i in ids], "id long")
    back = state.reverted_rows(current, batch)
    n = back.count()
    if n:
        with store.catalog.commit() as c:
            store.change(c, "state", back)
        store.fold_logs()
    return n


def load_results(store: Store, paths: str, now: dt.datetime, dry_run: bool = False) -> dict[str, int]:
    """Validated contacts and outcomes from result files in name order."""
    lines = files.with_line_no(files.read_results(store.spark, paths, positions=True)) if _has_files(store, paths) else None
    if lines is None:
        return {}
    clients, current = store.read("clients"), store.read("state")
    totals = report.result_counters(lines, clients).first().asDict()
    if dry_run:
        return totals
    with store.catalog.commit() as c:
        for table, kind in (("phones", "telefone"), ("emails", "email")):
            stored = store.read(table)
            fresh = ingest.validated_contacts(lines, clients, stored, kind, LINE)
            store.append(c, table, assign_ids(fresh, stored, "line_no"))
        store.change(c, "state", state.result_rows(current, lines, clients, LINE, at(now)))
    store.fold_logs()
    return totals


def _has_files(store: Store, paths: str) -> bool:
    return "*" not in paths or files.matches(store.spark, paths)


def export_customers(store: Store, folder: str, now: dt.datetime) -> tuple[str | None, int]:
    """Writes the unconsumed customers, then marks exactly those rows.

    The dated file is written over, so a run that died before the mark can be
    repeated, and a second run on a day replaces the first one's file.
    """
    current = store.read("state")
    selected = export.export_selection(current)
    n = selected.count()
    if n == 0:
        return None, 0
    rows = export.export_rows(
        selected, store.read("clients"), store.read("addresses"), store.read("phones"), store.read("emails"),
        F.lit(now.date()), ["id"], ["id"],
    )
    path = files.export_path(folder, now.date())
    files.write_delimited(rows, path, bom=True, mode="overwrite")
    with store.catalog.commit() as c:
        store.change(c, "state", state.consumed_rows(current, selected, at(now)))
    store.fold_logs()
    return path, n


def refresh_rollups(store: Store, now: dt.datetime) -> dict[str, str]:
    catalogue = store.spark.createDataFrame(OUTCOMES, "id int, mensagem string, status string")
    return rollups.refresh(
        f"{store.base}/rollups", state=store.read("state"), catalogue=catalogue,
        imports=store.read("imports"), clients=store.read("clients"), now=at(now),
    )
