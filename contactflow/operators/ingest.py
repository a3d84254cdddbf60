"""Import jobs: customers, contacts, addresses and their counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, identity, text
from ..functions.fixed_values import ENRICHED, VALIDATED
from ..functions.identity import MAX_ID_DIGITS, is_storable, phone_digits, rut_digits
from .keyed import assign_ids, first_per_key, insert_ignore, last_per_key, update_join


def row_limited(df: DataFrame, limit: int | None, line_no: str = "line_no") -> DataFrame:
    """The first `limit` input lines; zero or None reads everything."""
    return df.where(F.col(line_no) < limit) if limit else df


def customer_lines(raw: DataFrame, clean: bool = False) -> DataFrame:
    """Typed customer lines, rut '' where there is no key.

    `clean` also repairs region and commune.
    """
    if clean:
        rows = geo.with_clean_commune(raw, "comuna", "_comuna")
        commune, region = F.col("_comuna"), geo.clean_region(F.col("region"))
    else:
        rows = raw
        commune, region = (text.trim_truncate(F.col(c), 100) for c in ("comuna", "region"))
    return rows.select(
        "line_no",
        rut_digits(F.col("rut")).alias("rut"),
        identity.normalize_dv(F.col("dv")).alias("dv"),
        text.trim_truncate(F.col("nombre"), 255).alias("nome"),
        identity.normalize_sex(F.col("sexo")).alias("sexo"),
        identity.parse_date(F.col("fecha_nac")).alias("data_nascimento"),
        text.trim_truncate(F.col("direccion"), 255).alias("direccion"),
        commune.alias("comuna"),
        region.alias("region"),
    )


def stage_rows(raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One ledger row per input line with a status and a reason.

    `existing` holds the customer ids stored before this file.
    """
    rows = raw.select(
        "line_no",
        F.col("rut").alias("raw_rut"),
        F.col("nombre").alias("raw_nome"),
        rut_digits(F.col("rut")).alias("_rut"),
        identity.normalize_dv(F.col("dv")).alias("normalized_dv"),
    )
    firsts = rows.where(is_storable(F.col("_rut"))).groupBy("_rut").agg(F.min("line_no").alias("_first"))
    known = F.lit(False)
    if existing is not None:
        firsts = firsts.join(
            existing.select(F.col("rut").alias("_rut"), F.lit(True).alias("_known")), "_rut", "left"
        )
        known = F.coalesce(F.col("_known"), F.lit(False))
    joined = rows.join(firsts, "_rut", "left").withColumn("normalized_rut", text.blank_to_null(F.col("_rut")))
    message = (
        F.when(text.trim_ws(F.coalesce(F.col("raw_rut"), F.lit(""))) == "", "blank key")
        .when(F.col("normalized_rut").isNull(), "key is not numeric")
        .when(F.length("normalized_rut") > MAX_ID_DIGITS, "key is too long")
        .when(known, "key already stored")
        .when(F.col("_first") < F.col("line_no"), "key repeated in file")
    )
    status = (
        F.when(message.isNull(), "valid")
        .when(message.startswith("key already") | message.startswith("key repeated"), "skipped")
        .otherwise("invalid")
    )
    return joined.select(
        "line_no",
        "raw_rut",
        "raw_nome",
        "normalized_rut",
        "normalized_dv",
        status.alias("validation_status"),
        message.alias("validation_message"),
    )


def rejected_rows(raw: DataFrame) -> DataFrame:
    """Lines without a usable key, with the reason."""
    rut = F.col("_rut")
    reason = (
        F.when(text.trim_ws(F.coalesce(F.col("rut"), F.lit(""))) == "", "blank key")
        .when(rut == "", "key is not numeric")
        .otherwise("key is too long")
    )
    rows = raw.withColumn("_rut", rut_digits(F.coalesce(F.col("rut"), F.lit(""))))
    return rows.where(~is_storable(rut)).withColumn("reason", reason).drop("_rut")


def new_clients(raw: DataFrame, clients: DataFrame, staging_id: int) -> DataFrame:
    """Customer rows to append: first line per key, none stored before."""
    rows = customer_lines(raw).where(is_storable(F.col("rut")))
    fresh = insert_ignore(
        clients,
        rows.select("rut", "line_no", "dv", "nome", "sexo", "data_nascimento"),
        ["rut"],
        ["line_no"],
    )
    return assign_ids(fresh, clients, "line_no").select(
        "id", "rut", "dv", "nome", "sexo", "data_nascimento", F.lit(staging_id).alias("staging_id")
    )


def new_addresses(raw: DataFrame, clients: DataFrame, addresses: DataFrame, clean: bool = False) -> DataFrame:
    """First address line of each client that has no address yet."""
    rows = customer_lines(raw, clean).where(F.col("rut") != "")
    firsts = first_per_key(
        rows.select("rut", "line_no", "direccion", "comuna", "region"), ["rut"], ["line_no"]
    )
    return (
        firsts.join(clients.select("rut", F.col("id").alias("cliente_id")), "rut")
        .join(addresses.select("cliente_id").distinct(), "cliente_id", "left_anti")
        .select("cliente_id", "direccion", "comuna", "region")
    )


def contact_lines(raw: DataFrame, value: str, phone: bool, order: list[str]) -> DataFrame:
    """Contact lines with key and value, '' where there is none."""
    clean = phone_digits(F.col(value)) if phone else text.trim_ws(F.col(value))
    return raw.select(rut_digits(F.col("rut")).alias("rut"), clean.alias("valor"), *order)


def resolve_contacts(
    raw: DataFrame, clients: DataFrame, value: str, order: list[str], phone: bool
) -> DataFrame:
    """Usable contact lines with the client ids of their key.

    Lines are cut to the first per (key, value) before the join. A client has
    one key, so the result is also unique per (client, value).
    """
    rows = contact_lines(raw, value, phone, order).where((F.col("rut") != "") & (F.col("valor") != ""))
    firsts = first_per_key(rows, ["rut", "valor"], order)
    return firsts.join(clients.select("rut", F.col("id").alias("cliente_id")), "rut")


def new_contacts(
    raw: DataFrame,
    clients: DataFrame,
    stored: DataFrame,
    value: str,
    column: str,
    order: list[str],
    phone: bool,
    key_collation: str | None = None,
) -> DataFrame:
    """Historic contacts to append under the key (client, value, origin)."""
    rows = resolve_contacts(raw, clients, value, order, phone).select(
        "cliente_id", F.col("valor").alias(column), F.lit(ENRICHED).alias("origem"), *order
    )
    keys = ["cliente_id", column, "origem"]
    return insert_ignore(stored, rows, keys, order, key_collation, unique=True)


def contact_counters(
    raw: DataFrame, clients: DataFrame, stored: DataFrame, value: str, column: str, order: list[str], phone: bool
) -> DataFrame:
    """Read, inserted, duplicate, unmatched and invalid line counts.

    Lines are counted per (key, value) first, so only distinct pairs reach
    the joins.
    """
    pairs = contact_lines(raw, value, phone, []).groupBy("rut", "valor").agg(F.count(F.lit(1)).alias("n"))
    usable = F.coalesce((F.col("rut") != "") & (F.col("valor") != ""), F.lit(False))
    found = pairs.join(clients.select("rut", F.col("id").alias("cliente_id")), "rut", "left").join(
        stored.where(F.col("origem") == ENRICHED)
        .select("cliente_id", F.col(column).alias("valor"), F.lit(True).alias("_old"))
        .distinct(),
        ["cliente_id", "valor"],
        "left",
    )
    matched = usable & F.col("cliente_id").isNotNull()
    new = matched & F.col("_old").isNull()

    def total(expr):
        return F.coalesce(F.sum(expr), F.lit(0)).cast("long")

    zero = F.lit(0).cast("long")
    return found.agg(
        total(F.col("n")).alias("lidos"),
        total(F.when(new, 1)).alias("inseridos"),
        total(F.when(matched, F.when(new, F.col("n") - 1).otherwise(F.col("n"))).otherwise(zero)).alias("duplicados"),
        total(F.when(usable & F.col("cliente_id").isNull(), F.col("n"))).alias("sem_cliente"),
        total(F.when(~usable, F.col("n"))).alias("invalidos"),
    )


def import_counters(raw: DataFrame, clients: DataFrame, addresses: DataFrame) -> DataFrame:
    """Counters of a customer import, computed without writing anything."""
    per_key = customer_lines(raw).groupBy("rut").agg(F.count(F.lit(1)).alias("n"))
    known = clients.join(addresses.select(F.col("cliente_id").alias("id")).distinct().withColumn("_addr", F.lit(True)), "id", "left")
    joined = per_key.join(known.select("rut", "_addr", F.lit(True).alias("_old")), "rut", "left")
    old = F.coalesce(F.col("_old"), F.lit(False))
    ok = F.coalesce(is_storable(F.col("rut")), F.lit(False))
    no_key = F.coalesce(F.col("rut") == "", F.lit(True))

    def total(cond, value=None):
        return F.coalesce(F.sum(F.when(cond, F.lit(1) if value is None else value)), F.lit(0)).cast("long")

    return joined.agg(
        total(F.lit(True), F.col("n")).alias("lidos"),
        total(no_key, F.col("n")).alias("ignorados"),
        total(~no_key & ~ok, F.col("n")).alias("quarentena"),
        total(ok & ~old).alias("clientes_inseridos"),
        total(ok & F.col("_addr").isNull()).alias("enderecos_inseridos"),
        total(ok, F.col("n") - F.when(old, 0).otherwise(1)).alias("duplicados"),
    )


def clean_customer_file(raw: DataFrame) -> DataFrame:
    """Input columns with cleaned address fields; lines without a key as they were."""
    rows = geo.with_clean_commune(raw, "comuna", "_comuna").withColumns({
        "_keep": rut_digits(F.coalesce(F.col("rut"), F.lit(""))) == "",
        "_region": geo.clean_region(F.col("region")),
        "_direccion": F.substring(text.trim_ws(F.col("direccion")), 1, 255),
    })

    def cleaned(name):
        new = F.coalesce(F.col(f"_{name}"), F.lit(""))
        return F.when(F.col("_keep"), F.col(name)).otherwise(new).alias(name)

    replaced = ("region", "comuna", "direccion")
    return rows.select(*(cleaned(c) if c in replaced else F.col(c) for c in raw.columns))


def cleaning_counters(raw: DataFrame) -> DataFrame:
    rows = geo.with_clean_commune(raw, "comuna", "c1").select(
        (rut_digits(F.coalesce(F.col("rut"), F.lit(""))) != "").alias("ok"),
        text.trim_ws(F.coalesce(F.col("region"), F.lit(""))).alias("r0"),
        geo.clean_region(F.col("region")).alias("r1"),
        text.trim_ws(F.coalesce(F.col("comuna"), F.lit(""))).alias("c0"),
        "c1",
    )
    ok = F.col("ok")
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~ok).alias("sem_rut"),
        F.count_if(ok & (F.col("r0") != "") & (F.col("r1") != F.col("r0"))).alias("region_expandida"),
        F.count_if(ok & (F.col("r0") != "") & F.col("r1").isNull()).alias("region_nulificada"),
        F.count_if(ok & (F.col("c0") != "") & F.col("c1").isNull()).alias("comuna_nulificada"),
    )


ADDRESS_FIELDS = ["direccion", "comuna", "region"]


def address_changes(clients: DataFrame, raw: DataFrame) -> DataFrame:
    """(cliente_id, address fields) of known clients from a cleaned file; the last line wins."""
    rows = raw.select(
        "line_no",
        rut_digits(F.col("rut")).alias("rut"),
        *(text.blank_to_null(F.col(c)).alias(c) for c in ADDRESS_FIELDS),
    ).where(F.col("rut") != "")
    matched = last_per_key(rows, ["rut"], ["line_no"]).join(clients.select("rut", F.col("id").alias("cliente_id")), "rut")
    return matched.select("cliente_id", *ADDRESS_FIELDS)


def put_addresses(addresses: DataFrame, delta: DataFrame) -> DataFrame:
    return update_join(addresses, delta, ["cliente_id"], ADDRESS_FIELDS)


def replace_addresses(addresses: DataFrame, clients: DataFrame, raw: DataFrame) -> DataFrame:
    """Addresses overwritten by key from a cleaned file; the last line wins."""
    return put_addresses(addresses, address_changes(clients, raw))


def validated_contacts(
    results: DataFrame, clients: DataFrame, stored: DataFrame, kind: str, order: list[str]
) -> DataFrame:
    """Contacts a result file confirms, whatever the outcome of the line."""
    if kind == "telefone":
        column, value = "numero", phone_digits(F.col("telefone_validado"))
    else:
        column, value = "endereco", text.trim_ws(F.col("email_validado"))
    rows = results.select(text.trim_ws(F.col("rut")).alias("rut"), value.alias(column), *order)
    rows = rows.where((F.col("rut") != "") & (F.col(column) != ""))
    firsts = first_per_key(rows, ["rut", column], order)
    matched = firsts.join(clients.select("rut", F.col("id").alias("cliente_id")), "rut").select(
        "cliente_id", column, F.lit(VALIDATED).alias("origem"), *order
    )
    return insert_ignore(stored, matched, ["cliente_id", column, "origem"], order, unique=True)


def remaining(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work not yet done, by key and never by position."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")
