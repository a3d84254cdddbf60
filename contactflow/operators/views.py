"""The queue and contact views under their SQL names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import PHONE_NOT_OK, PHONE_OK
from .export import client_contacts
from .keyed import spread_nulls
from .state import latest_pending


def with_client(state: DataFrame, clients: DataFrame) -> DataFrame:
    """State rows with the id and name of their client."""
    return state.join(clients.select(F.col("id").alias("cliente_id"), "rut", "dv", "nome"), "cliente_id")


def finished_rows(state: DataFrame, clients: DataFrame, phones: DataFrame, emails: DataFrame) -> DataFrame:
    """Finished rows with the contacts they link to, NULL where unlinked."""
    finished = state.where(F.col("status").isin(PHONE_OK, PHONE_NOT_OK)).withColumns(
        {"_p": spread_nulls("telefone_id", "id"), "_e": spread_nulls("email_id", "id")}
    )
    linked = (
        with_client(finished, clients)
        .join(phones.select(F.col("id").alias("_p"), F.col("numero").alias("telefone_extraido")), "_p", "left")
        .join(emails.select(F.col("id").alias("_e"), F.col("endereco").alias("email_extraido")), "_e", "left")
    )
    created = [c for c in ("data_criacao",) if c in state.columns]
    return linked.select(
        "id", "rut", "dv", "nome", "telefone_extraido", "email_extraido", "status", *created, "data_update"
    )


def register_views(
    spark: SparkSession, state: DataFrame, clients: DataFrame, addresses: DataFrame, phones: DataFrame, emails: DataFrame
) -> None:
    latest_pending(state, clients).createOrReplaceTempView("view_pending")
    finished_rows(state, clients, phones, emails).createOrReplaceTempView("view_finished")
    client_contacts(clients, addresses, phones, emails).createOrReplaceTempView("view_client_contacts")
