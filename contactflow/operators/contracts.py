"""Older contract model: priority batches, unit resolution and its exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    ACTIVE_CONTRACT_MESSAGE,
    CONTRACT_OPEN,
    CONTRACT_REPORT_FILE,
    DEFAULT_BATCH,
    DEFAULT_SUPPLIER,
    PENDING,
    PROVENANCE_FILE,
)
from ..functions.outcome import supplier_or_default
from ..functions.text import full_address
from .keyed import first_per_key, rank_by_id, spread_nulls

# Order values per piece of a joined text; the result does not depend on it.
PIECE = 10_000


def first_units(units: DataFrame) -> DataFrame:
    """Smallest unit id per client and distributor."""
    return units.groupBy("cliente_id", "distribuidora_id").agg(F.min("id").alias("_first_uc"))


def with_unit(state: DataFrame, units: DataFrame) -> DataFrame:
    """Rows with their own unit, or else the client's first at the distributor.

    Rows that resolve to no stored unit fall out.
    """
    resolved = state.join(first_units(units), ["cliente_id", "distribuidora_id"], "left").withColumn(
        "_uc_id", F.coalesce("cliente_uc_id", "_first_uc")
    )
    return resolved.join(units.select(F.col("id").alias("_uc_id"), "uc"), "_uc_id").drop("_uc_id", "_first_uc")


def with_supplier(state: DataFrame, suppliers: DataFrame | None) -> DataFrame:
    """Adds the supplier; without a supplier table every row has the default.

    A client listed under two suppliers appears once per supplier.
    """
    if suppliers is None:
        return state.withColumn("fornecedor", F.lit(DEFAULT_SUPPLIER))
    joined = state.join(suppliers.select("cliente_id", "fornecedor"), "cliente_id", "left")
    return joined.withColumn("fornecedor", supplier_or_default(F.col("fornecedor")))


def optional_table(spark, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def priority_batch(
    state: DataFrame,
    clients: DataFrame,
    units: DataFrame,
    companies: DataFrame,
    suppliers: DataFrame | None,
    n: int = DEFAULT_BATCH,
) -> DataFrame:
    """Pending before retry, default supplier first, then oldest, then id."""
    rows = state.where(F.col("status").isin(CONTRACT_OPEN)).select(
        "id", "cliente_id", "distribuidora_id", "cliente_uc_id", "status", "data_update"
    )
    joined = (
        with_supplier(with_unit(rows, units), suppliers)
        .join(clients.select(F.col("id").alias("cliente_id"), "cpf"), "cliente_id")
        .join(companies.select(F.col("id").alias("distribuidora_id"), F.col("nome").alias("empresa")), "distribuidora_id")
    )
    order = [
        F.desc(F.col("status") == PENDING),
        F.desc(F.col("fornecedor") == DEFAULT_SUPPLIER),
        F.asc("data_update"),
        F.asc("id"),
        F.asc("fornecedor"),
    ]
    return joined.orderBy(*order).limit(n).select(
        F.col("id").alias("macro_id"),
        "cpf",
        F.col("uc").alias("codigo cliente"),
        "empresa",
        F.col("status").alias("status_atual"),
        "fornecedor",
    )


def batch_composition(batch: DataFrame) -> DataFrame:
    return batch.groupBy("status_atual", "fornecedor").agg(F.count(F.lit(1)).alias("qtd"))


def phone_rows(phones: DataFrame, order: str = "id") -> DataFrame:
    """(cliente_id, posicao, numero): distinct phones per client, numbered from 1 in id order.

    Positions come from ranks inside id ranges and the counts of the ranges before, so a client of
    any number of phones is many small rows and is held by no task.
    """
    distinct = phones.where(F.col("numero").isNotNull()).groupBy("cliente_id", "numero").agg(F.min(order).alias("_at"))
    return rank_by_id(distinct, "_at", "posicao", ("cliente_id",), ties=("numero",)).select("cliente_id", F.col("posicao").cast("long").alias("posicao"), "numero")


def phones_of(chosen: DataFrame, phones: DataFrame, order: str = "id") -> DataFrame:
    """`phone_rows` of the clients in `chosen`: the phone list of a report, to be read beside it."""
    return phone_rows(phones.join(chosen.select("cliente_id").distinct(), "cliente_id", "left_semi"), order)


def phone_text(
    phones: DataFrame, separator: str = ";", order: str = "id", max_cell: int | None = None
) -> DataFrame:
    """Distinct phones per client, joined in id order; one row per client, with `parte` 0.

    Phones are made distinct before they are collected, and joined in pieces
    of an id range, so that only the last step, which writes a client's text,
    sees all of the client. With `max_cell` the caller asks for several cells
    instead (`parte` 0, 1, ...), each below twice that number; no job does.
    `phone_rows` gives the same list without a text per client.
    """
    distinct = phones.groupBy("cliente_id", "numero").agg(F.min(order).alias("_at"))
    if max_cell:
        return _cells(distinct, separator, max_cell)
    return (
        distinct.groupBy("cliente_id", F.expr(f"_at div {PIECE}").alias("_range"))
        .agg(F.when(F.count("numero") > 0, _in_order(separator, "_at", "numero")).alias("_text"))
        .groupBy("cliente_id")
        .agg(_in_order(separator, "_range", "_text").alias("telefones"))
        .select("cliente_id", F.lit(0).alias("parte"), "telefones")
    )


def _in_order(separator: str, at: str, text: str) -> Column:
    """The texts of a group, joined in the order of `at`."""
    ordered = F.array_sort(F.collect_list(F.struct(at, text)))
    return F.array_join(F.transform(ordered, lambda x: x[text]), separator)


def _cells(distinct: DataFrame, separator: str, max_cell: int) -> DataFrame:
    """Cells by id ranges, whose counts say which cell a range belongs to."""
    ranged = distinct.withColumn("_range", F.expr(f"_at div {max_cell}"))
    before = Window.partitionBy("cliente_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        ranged.groupBy("cliente_id", "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("cliente_id", "_range", F.expr(f"_before div {max_cell}").alias("parte"))
    )
    return (
        ranged.join(cells, ["cliente_id", "_range"])
        .groupBy("cliente_id", "parte")
        .agg(_in_order(separator, "_at", "numero").alias("telefones"))
    )


def with_phone_text(rows: DataFrame, chosen: DataFrame, phones: DataFrame, separator: str = ";") -> DataFrame:
    """Rows with their client's phones; only phones of the `chosen` clients are joined.

    Comes after all other joins, so that the text does not travel through them.
    """
    kept = phones.join(chosen.select("cliente_id").distinct(), "cliente_id", "left_semi")
    return rows.join(phone_text(kept, separator).drop("parte"), "cliente_id", "left")


def active_history(history: DataFrame) -> DataFrame:
    """Distinct (client, unit, distributor) with a confirmed answer."""
    return history.where(F.col("resposta_id") == "3").select("cpf", "uc", "distribuidora_id").dropDuplicates()


def history_counts(history: DataFrame) -> DataFrame:
    return active_history(history).agg(
        F.count(F.lit(1)).alias("combos"), F.count_distinct("cpf").alias("cpfs")
    )


def resolve_by_history(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Rows without a unit, matched to history units by client and distributor.

    One match, several matches (a row each) or none, tagged as such. The
    number of matches is counted on the history side.
    """
    keyed = rows.withColumns({"_cpf": F.col("cpf"), "_d": F.col("distribuidora_id").cast("string")})
    return _with_history(keyed, history).withColumn("origem_uc", _history_tag()).drop("_cpf", "_d", "_n")


def _with_history(keyed: DataFrame, history: DataFrame) -> DataFrame:
    known = active_history(history).toDF("_cpf", "uc", "_d")
    sizes = known.groupBy("_cpf", "_d").agg(F.count(F.lit(1)).alias("_n"))
    return keyed.join(known.join(sizes, ["_cpf", "_d"]), ["_cpf", "_d"], "left")


def _history_tag() -> Column:
    return (
        F.when(F.col("_n") == 1, "historico_unico")
        .when(F.col("_n") > 1, "historico_multiplo")
        .otherwise("sem_historico")
    )


def confirmed(state: DataFrame) -> DataFrame:
    return state.where(F.col("resposta_id") == 3)


def confirmed_rows(
    state: DataFrame, clients: DataFrame, companies: DataFrame, addresses: DataFrame
) -> DataFrame:
    """Rows with a confirmed answer and the client data of the title report."""
    return (
        confirmed(state)
        .select("id", "cliente_id", "distribuidora_id", "cliente_uc_id")
        .join(clients.select(F.col("id").alias("cliente_id"), "cpf", "nome"), "cliente_id")
        .join(companies.select(F.col("id").alias("distribuidora_id"), F.col("nome").alias("distribuidora")), "distribuidora_id")
        .join(
            addresses.select("cliente_id", "distribuidora_id", *ADDRESS_COLUMNS).distinct(),
            ["cliente_id", "distribuidora_id"],
            "left",
        )
    )


ADDRESS_COLUMNS = ["endereco", "numero", "bairro", "cidade", "uf", "cep"]


def provenance_report(
    state: DataFrame,
    clients: DataFrame,
    companies: DataFrame,
    units: DataFrame,
    addresses: DataFrame,
    phones: DataFrame,
    history: DataFrame,
) -> DataFrame:
    """Confirmed rows with their unit and where the unit came from."""
    rows = confirmed_rows(state, clients, companies, addresses)
    has_unit = F.col("cliente_uc_id").isNotNull()
    # Only rows without a unit look into the history, so one pass serves the
    # three provenances; the others get a key of their own that matches nothing.
    keyed = rows.withColumns({
        "_cpf": F.when(has_unit, F.concat(F.lit("row "), F.col("id"))).otherwise(F.col("cpf")),
        "_d": F.col("distribuidora_id").cast("string"),
        "_uc_id": spread_nulls("cliente_uc_id", "id"),
    })
    own = units.select(F.col("id").alias("_uc_id"), F.col("uc").alias("_own"))
    both = _with_history(keyed, history).join(own, "_uc_id", "left")
    found = both.where(~has_unit | F.col("_own").isNotNull()).withColumns({
        "uc": F.coalesce("_own", "uc"),
        "origem_uc": F.when(has_unit, "cliente_uc_id").otherwise(_history_tag()),
    })
    return with_phone_text(found, confirmed(state), phones).select(*PROVENANCE_FILE)


def first_full_address(addresses: DataFrame) -> DataFrame:
    """Address with the smallest id per client, printed on one line."""
    parts = ["endereco", "numero", "complemento", "bairro", "cidade", "uf", "cep"]
    first = first_per_key(addresses.select("cliente_id", "id", *parts), ["cliente_id"], ["id"])
    return first.select("cliente_id", full_address(*(F.col(c) for c in parts)).alias("endereco_completo"))


def active_contract_report(
    state: DataFrame,
    clients: DataFrame,
    units: DataFrame,
    companies: DataFrame,
    addresses: DataFrame,
    phones: DataFrame,
    catalogue: DataFrame,
) -> DataFrame:
    """Consolidated rows of active contracts, one per distinct combination."""
    answers = catalogue.where(F.col("mensagem") == ACTIVE_CONTRACT_MESSAGE).select(
        F.col("id").alias("resposta_id"), F.col("mensagem").alias("retorno")
    )
    active = (
        state.where(F.col("status") == "consolidado")
        .select("cliente_id", "distribuidora_id", "cliente_uc_id", "resposta_id")
        .distinct()
        .join(answers, "resposta_id")
    )
    rows = (
        active
        .join(clients.select(F.col("id").alias("cliente_id"), "cpf", "nome"), "cliente_id")
        .join(units.select(F.col("id").alias("cliente_uc_id"), F.col("uc").alias("uc_ativa")), "cliente_uc_id", "left")
        .join(companies.select(F.col("id").alias("distribuidora_id"), F.col("nome").alias("distribuidora")), "distribuidora_id", "left")
        .join(first_full_address(addresses), "cliente_id", "left")
    )
    columns = ["uc_ativa", "cpf", "nome", "telefones", "endereco_completo", "distribuidora", "retorno"]
    narrow = rows.select("cliente_id", *(c for c in columns if c != "telefones")).distinct()
    return with_phone_text(narrow, active, phones, "; ").select(*columns).distinct().orderBy("cpf")


def report_layout(report: DataFrame) -> DataFrame:
    """Report columns under their printed names."""
    columns = ["uc_ativa", "cpf", "nome", "telefones", "endereco_completo", "distribuidora", "retorno"]
    return report.select(*(F.col(a).alias(b) for a, b in zip(columns, CONTRACT_REPORT_FILE, strict=True)))
