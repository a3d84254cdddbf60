"""Contact slots, the customer export and the client contact listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import EXPORT_EMAILS, EXPORT_FILE, EXPORT_PHONES, VALIDATED
from ..functions.identity import age_on, print_date
from .keyed import first_per_key, top_per_key
from .state import unconsumed


def contact_slots(contacts: DataFrame, value: str, prefix: str, k: int, order: list[str]) -> DataFrame:
    """One row per client with its first `k` contacts, validated ones first.

    The rank limit trims every map task to `k` rows per client, so a client
    with many contacts costs no more than any other.
    """
    validated_first = F.when(F.col("origem") == VALIDATED, 0).otherwise(1)
    top = top_per_key(
        contacts.select("cliente_id", value, "origem", *order), ["cliente_id"], [validated_first, *order], k
    )
    return top.groupBy("cliente_id").agg(
        *(F.max(F.when(F.col("rn") == i, F.col(value))).alias(f"{prefix}_{i}") for i in range(1, k + 1))
    )


def first_address(addresses: DataFrame, order: str = "id") -> DataFrame:
    return first_per_key(
        addresses.select("cliente_id", order, "direccion", "comuna", "region"), ["cliente_id"], [order]
    ).drop(order)


def clients_of(clients: DataFrame, selected: DataFrame) -> DataFrame:
    """Clients named by the selected rows."""
    return clients.join(selected.select(F.col("cliente_id").alias("id")).distinct(), "id", "left_semi")


def export_rows(
    selected: DataFrame,
    clients: DataFrame,
    addresses: DataFrame,
    phones: DataFrame,
    emails: DataFrame,
    today: Column,
    phone_order: list[str],
    email_order: list[str],
) -> DataFrame:
    """The 16 export columns for the selected state rows, blanks for NULL."""
    people = (
        selected.select("cliente_id")
        .join(clients.withColumnRenamed("id", "cliente_id"), "cliente_id", "left")
        .join(first_address(addresses), "cliente_id", "left")
        .join(contact_slots(phones, "numero", "telefone", EXPORT_PHONES, phone_order), "cliente_id", "left")
        .join(contact_slots(emails, "endereco", "email", EXPORT_EMAILS, email_order), "cliente_id", "left")
    )
    birth = F.col("data_nascimento")
    named = people.withColumns({"IDADE": age_on(birth, today), "_birth": print_date(birth)})
    source = {
        "RUT": "rut", "DV": "dv", "NOME": "nome", "SEXO": "sexo", "DATA_NASCIMENTO": "_birth",
        "DIRECCION": "direccion", "COMUNA": "comuna", "REGION": "region",
    }
    return named.select(
        *(F.coalesce(F.col(source.get(c, c)), F.lit("")).alias(c) for c in EXPORT_FILE)
    )


def export_selection(state: DataFrame) -> DataFrame:
    return unconsumed(state).select("id", "cliente_id")


def client_contacts(
    clients: DataFrame, addresses: DataFrame, phones: DataFrame, emails: DataFrame
) -> DataFrame:
    """Every address, phone and e-mail of every client, one per row.

    Clients without any contact keep one row of kind NULL. Combining a
    client's phones with its e-mails would multiply them; this keeps each
    once, so the size stays the sum of the inputs.
    """
    def text(*cols):
        return [F.col(c).cast("string") if isinstance(c, str) else c for c in cols]

    none = F.lit(None).cast("string")
    kinds = [
        (addresses, "endereco", text("direccion", "comuna", "region"), none),
        (phones, "telefone", [F.col("numero"), none, none], F.col("origem")),
        (emails, "email", [F.col("endereco"), none, none], F.col("origem")),
    ]
    contacts = None
    for df, kind, (value, commune, region), origin in kinds:
        part = df.select(
            "cliente_id",
            F.lit(kind).alias("tipo"),
            value.alias("valor"),
            commune.alias("comuna"),
            region.alias("region"),
            origin.alias("origem"),
        )
        contacts = part if contacts is None else contacts.unionByName(part)
    people = clients.select(
        F.col("id").alias("cliente_id"), "rut", "dv", "nome", "sexo", "data_nascimento"
    )
    # The contacts lead an inner join, which can be split where one client
    # holds many of them; the clients without any are added.
    without = people.join(contacts.select("cliente_id").distinct(), "cliente_id", "left_anti")
    return contacts.join(people, "cliente_id").unionByName(without, allowMissingColumns=True)
