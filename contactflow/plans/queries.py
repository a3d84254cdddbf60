"""Registered queries: one per operator, each over the whole input."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..functions import geo, identity, outcome, registry, text
from ..functions.fixed_values import (
    CONTRACT_ACTIVE,
    CONTRACT_INACTIVE,
    IMPORT_STATES,
    ORIGINS,
    PENDING,
    PHONE_NOT_OK,
    PHONE_OK,
    ROW_STATES,
    STATES,
    VALIDATED,
)
from ..operators import contracts, export, ingest, quality, report, rollups, state, views
from ..operators.keyed import first_per_key, rank_by_id, update_join
from ..session import configure, work_path
from ..sources import files
from ..sources.catalog import Catalog
from ..streaming import jobs as streams
from ..streaming import key_machine
from .fixtures import PHONE_ORDER, TABLES, Inputs

TODAY = dt.date(2026, 2, 28)
NOW = "2026-04-07 12:00:00"
LINE = ["line_no"]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def today():
    return F.lit(TODAY)


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which every reader of a result prints alike."""
    days = [f.name for f in df.schema if isinstance(f.dataType, DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in days}) if days else df


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dates_as_text(fn(Inputs(configure(spark), sf_dir)))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


def col(name: str):
    return F.col(name)


# --- sources and sinks -------------------------------------------------------
FILE_COLUMNS = ["rut", "dv", "nombre", "sexo", "direccion", "comuna", "region", "fecha_nac"]


@query
def s01_bulk_source(i):
    path = files.write_customers(i.raw_clients, work_path(i.spark, "bulk"), "ISO-8859-1")
    return files.read_customers(i.spark, path).select(*FILE_COLUMNS)


@query
def s02_clean_source(i):
    path = files.write_customers(ingest.clean_customer_file(i.raw_clients), work_path(i.spark, "clean"))
    return files.read_customers(i.spark, path, "UTF-8").select("rut", "direccion", "comuna", "region")


def result_files(i, mixed: bool = True) -> str:
    """Result files of three runs, if mixed one with its columns in another order; returns the glob over all of them."""
    root, results = work_path(i.spark, "results"), i.macro_result
    for name, code in [("a", "0"), ("b", "1"), ("c", "")]:
        part = results.where(col("sucesso") == code).orderBy("line_no")
        files.write_results(part, f"{root}/{name}_RESULTADO.csv", reverse=mixed and name == "b", bom=True)
    return f"{root}/*_RESULTADO.csv"


@query
def s03_result_source(i):
    return files.read_results(i.spark, result_files(i))


@query
def s04_key_lookup(i):
    keys = i.raw_phones.select(identity.rut_digits(col("rut")).alias("rut")).distinct()
    return i.clients.select("id", "rut").join(keys, "rut", "left_semi")


@query
def s05_cleaned_file_sink(i):
    path = files.write_customers(ingest.clean_customer_file(i.raw_clients), work_path(i.spark, "cleaned"))
    return files.read_customers(i.spark, path, "UTF-8")


def export_df(i) -> DataFrame:
    return export.export_rows(
        export.export_selection(i.work_state_u), i.clients, i.addresses, i.phones, i.emails, today(), PHONE_ORDER, ["id"]
    )


@query
def s06_customer_export_sink(i):
    path = files.export_path(work_path(i.spark, "export"), TODAY)
    files.write_delimited(export_df(i), path, bom=True)
    return files.read_delimited(i.spark, path)


def contract_report(i) -> DataFrame:
    phones = i.phones.withColumnRenamed("line_no", "id")
    return contracts.active_contract_report(
        i.contract_state, i.contract_clients, i.units, i.companies, i.contract_addresses, phones, i.contract_respostas
    )


@query
def s07_report_export_sink(i):
    path = work_path(i.spark, "report")
    files.write_delimited(contracts.report_layout(contract_report(i)), path)
    return files.read_delimited(i.spark, path)


def priority(i, n=2000, suppliers=True) -> DataFrame:
    return contracts.priority_batch(
        i.contract_state, i.contract_clients, i.units, i.companies, i.suppliers if suppliers else None, n
    )


@query
def s08_batch_handoff(i):
    where = files.write_batch(priority(i), work_path(i.spark, "batch"), now())
    meta = i.spark.read.schema(
        "total long, dry_run boolean, registro struct<macro_id:long,cpf:string,`codigo cliente`:string,empresa:string,fornecedor:string>"
    ).json(where["meta"])
    return meta.select("total", "dry_run", "registro.*")


def new_phones(i) -> DataFrame:
    return ingest.new_contacts(
        i.raw_phones, i.clients, i.phones.drop(*PHONE_ORDER), "celular", "numero", PHONE_ORDER, phone=True
    )


@query
def s09_insert_ignore_clients(i):
    known = i.clients.where(col("sexo") == "F")
    return ingest.new_clients(i.raw_clients, known, staging_id=7)


@query
def s09_insert_ignore_phones(i):
    return new_phones(i)


@query
def s09_insert_ignore_emails(i):
    return ingest.new_contacts(i.raw_emails, i.clients, i.emails, "email", "endereco", LINE, phone=False)


@query
def s09_insert_ignore_emails_collated(i):
    stored = i.emails.where(col("origem") == VALIDATED)
    added = ingest.new_contacts(
        i.raw_emails, i.clients, stored, "email", "endereco", LINE, phone=False, key_collation="UNICODE_CI_AI"
    )
    return added.select("cliente_id", "endereco", "origem", "line_no")


def closed_state(i) -> DataFrame:
    """State of the clients that have left the queue; the rest have no row."""
    return i.work_state_u.where(col("status") != PENDING)


@query
def s10_state_upsert(i):
    return state.apply_results(closed_state(i), i.macro_result, i.clients, LINE, now())


@query
def s11_update_join(i):
    rows = ingest.customer_lines(i.raw_clients).where(col("rut") != "")
    delta = first_per_key(rows.select("rut", "line_no", "nome", "sexo"), ["rut"], LINE)
    return update_join(i.clients, delta, ["rut"], ["nome", "sexo"])


def written_rollups(i, name) -> str:
    path = work_path(i.spark, name)
    rollups.refresh(path, state=i.work_state, catalogue=i.respostas, imports=i.imports, clients=i.clients, now=now())
    return path


@query
def s12_full_refresh(i):
    path = written_rollups(i, "refresh")
    return i.spark.read.parquet(f"{path}/day").drop("mes")


@query
def s13_rollup_reader(i):
    return rollups.read_rollups(i.spark, written_rollups(i, "rollups"))["staging"]


@query
def s14_row_limited(i):
    return ingest.row_limited(i.raw_clients, 1000).select("line_no", "rut")


@query
def s15_dry_run(i):
    return ingest.import_counters(i.raw_clients, i.clients, i.addresses)


@query
def s16_resume(i):
    done = i.macro_result.where(col("sucesso") != "")
    return ingest.remaining(i.clients.select("id", "rut"), done, ["rut"])


@query
def s17_history_source(i):
    path = work_path(i.spark, "history")
    files.write_delimited(i.history, path, bom=True)
    return contracts.active_history(files.read_history(i.spark, path))


# --- projections -------------------------------------------------------------
@query
def p01_normalize_rut(i):
    return i.raw_clients.select("line_no", identity.normalize_rut(col("rut")).alias("rut"))


@query
def p02_normalize_dv(i):
    return i.raw_clients.select("line_no", identity.normalize_dv(col("dv")).alias("dv"))


@query
def p03_normalize_sex(i):
    return i.raw_clients.select("line_no", identity.normalize_sex(col("sexo")).alias("sexo"))


@query
def p04_parse_date(i):
    return i.raw_clients.select("line_no", identity.parse_date(col("fecha_nac")).alias("data_nascimento"))


@query
def p05_trim_truncate(i):
    return i.raw_clients.select(
        "line_no",
        text.trim_truncate(col("nombre"), 12).alias("nome"),
        text.trim_truncate(col("direccion")).alias("direccion"),
        text.trim_truncate(col("region"), 100).alias("region"),
    )


@query
def p06_normalize_phone(i):
    return i.raw_phones.select(*PHONE_ORDER, identity.normalize_phone(col("celular")).alias("numero"))


@query
def p07_clean_region(i):
    return i.raw_clients.select("line_no", geo.clean_region(col("region")).alias("region"))


@query
def p08_clean_commune(i):
    return geo.with_clean_commune(i.raw_clients.select("line_no", "comuna"), "comuna", "comuna")


@query
def p08_clean_commune_folded_keys(i):
    return geo.with_clean_commune(i.raw_clients.select("line_no", "comuna"), "comuna", "comuna", fold_keys=True)


@query
def p09_fold_accents(i):
    return i.raw_clients.select("line_no", text.fold_accents(col("comuna")).alias("chave"))


@query
def p10_normalize_spacing(i):
    return i.raw_clients.select("line_no", text.normalize_spacing(col("comuna")).alias("comuna"))


@query
def p11_trim_whitespace(i):
    return i.raw_clients.select("line_no", text.trim_ws(col("rut")).alias("rut"), text.trim_ws(col("direccion")).alias("direccion"))


@query
def p12_age(i):
    return i.clients.select("id", identity.age_on(col("data_nascimento"), today()).alias("idade"))


@query
def p13_print_date(i):
    return i.clients.select("id", identity.print_date(col("data_nascimento")).alias("data"))


RESULT_FIELDS = ("sucesso", "telefone_validado", "email_validado", "erro")


@query
def p14_interpret_result(i):
    o = outcome.interpret_result(*(col(c) for c in RESULT_FIELDS))
    return i.macro_result.select("line_no", o.alias("o")).select("line_no", "o.*")


@query
def p15_interpret_body(i):
    return outcome.interpret_bodies(i.legacy_body, "body").select("event_id", "resposta_id", "status")


@query
def p15_interpret_body_catalogue(i):
    rows = outcome.interpret_bodies(i.legacy_body, "body", i.contract_respostas)
    return rows.select("event_id", "resposta_id", "status")


@query
def p15_interpret_body_wide_ids(i):
    """Catalogue ids beyond one byte: one per code 250 to 309 that the events give."""
    code = (F.lit(250) + col("event_id") % 60).cast("int")
    bodies = i.legacy_body.select("event_id", F.concat(F.lit('{"CodigoRetorno":"'), code, F.lit('"}')).alias("body"))
    state = F.when(code % 2 == 0, "consolidado").otherwise("excluir")
    catalogue = i.legacy_body.select(code.alias("id"), state.alias("status")).distinct()
    return outcome.interpret_bodies(bodies, "body", catalogue).select("event_id", "resposta_id", "status")


@query
def p16_catalogue_status(i):
    joined = i.contract_state.join(i.contract_respostas.select(col("id").alias("resposta_id"), col("status").alias("s")), "resposta_id", "left")
    return joined.select("id", outcome.catalogue_state(col("s")).alias("estado"))


@query
def p17_status_label(i):
    return i.work_state.select("id", outcome.status_label(col("status")).alias("rotulo"))


@query
def p18_sentence_case(i):
    return i.texts.select("event_id", text.sentence_case(col("mensagem")).alias("mensagem"))


@query
def p19_request_error(i):
    return i.texts.select("event_id", outcome.is_request_error(i.texts).alias("erro"))


@query
def p21_full_address(i):
    parts = ["endereco", "numero", "complemento", "bairro", "cidade", "uf", "cep"]
    return i.contract_addresses.select("id", text.full_address(*(col(c) for c in parts)).alias("endereco_completo"))


@query
def p22_supplier_default(i):
    rows = i.contract_clients.join(i.suppliers.withColumnRenamed("cliente_id", "id"), "id", "left")
    return rows.select("id", outcome.supplier_or_default(col("fornecedor")).alias("fornecedor"))


@query
def p23_origin_file(i):
    rows = i.work_state.withColumn("f", F.when(col("id") % 3 == 0, F.concat(F.lit("f"), col("id") % 4)))
    return rows.select(
        "id",
        outcome.origin_file(col("data_extracao"), col("f")).alias("arquivo_origem"),
        outcome.origin_file(col("data_extracao"), col("f"), "Histórico", "desconhecido").alias("origem"),
    )


@query
def p24_percent_text(i):
    return i.contract_clients.select(
        "id", text.percent_text(col("id") % 13, col("id") % 29, "-").alias("pct")
    )


@query
def p25_month_key(i):
    day = F.to_date("data_update")
    return i.work_state.select("id", identity.month_key(day).alias("mes"), identity.month_label(day).alias("rotulo"))


@query
def p26_write_coercion(i):
    rows = i.raw_clients.select(
        "line_no", identity.rut_digits(col("rut")).alias("rut"), identity.normalize_dv(col("dv")).alias("dv")
    )
    return rows.where(identity.is_storable(col("rut")))


@query
def p27_code_rename(i):
    origin = outcome.rename_code(col("origem"), {"enriquecimento": "extraido_api"})
    back = outcome.rename_code(origin, {"extraido_api": "validado"})
    return i.emails.select("id", back.alias("origem"))


@query
def p28_short_file_name(i):
    day, file = (col("staging_id") % 5 + 1).cast("string"), (col("staging_id") % 20).cast("string")
    path = F.concat(F.lit("C:\\dados\\2026-04-0"), day, F.lit("\\carga_"), file, F.lit(".csv"))
    return i.staging_rows.select("id", text.short_file_name(path).alias("arquivo"))


@query
def p29_landed_fields(i):
    rows = i.answer_bodies.select("line_no", "rut", outcome.landed_fields(col("body")).alias("r"))
    return rows.select("line_no", "rut", "r.*")


@query
def p29_landed_pages(i):
    """Pages as forms are written by hand: bare and single quotes, nested tags, named and numeric entities."""
    ok = F.concat(
        F.lit("<FORM><p>T&eacute;l<INPUT class=x id=telefono VALUE='"), "telefone_validado", F.lit("'><br><input value=\""),
        F.replace("email_validado", F.lit("@"), F.lit("&#64;")), F.lit("\" id='correoElectronico' disabled></form>"),
    )
    bad = F.concat(
        F.lit("<ul><li>a<li>b</ul><div class=\"error x alerta\"> La <b>p&oacute;liza <i>n&#xBA;</i></b> <span>"),
        "line_no", F.lit("<script>var x = '</b>';</script></span><br/> &lt;no&gt; existe </div> fin"),
    )
    rows = i.macro_result.select("line_no", F.when(col("sucesso") == "1", ok).otherwise(bad).alias("body"))
    return rows.select("line_no", outcome.landed_fields(col("body")).alias("r")).select("line_no", "r.*")


# --- filters -----------------------------------------------------------------
@query
def f01_rejected_rows(i):
    return ingest.rejected_rows(i.raw_clients).select("line_no", "rut", "reason")


@query
def f02_status_set(i):
    return i.work_state.where(~outcome.is_open(col("status"))).select("id", "status")


def day_rollup(i) -> DataFrame:
    return rollups.day_status_message(i.work_state, i.respostas)


@query
def f03_day_selection(i):
    return rollups.select_days(day_rollup(i), ["mes:1997-05", "1998-10-03"])


@query
def f03_month_without_days(i):
    return rollups.select_days(day_rollup(i), ["mes:2031-01"])


@query
def f03_stored_days(i):
    """The selection on the stored rollup, two of whose days were written anew by themselves."""
    path = written_rollups(i, "days")
    rollups.refresh_days(path, i.work_state, i.respostas, [dt.date(1997, 5, 3), dt.date(1998, 10, 3)], now())
    return rollups.stored_days(i.spark, path, ["mes:1997-05", "1998-10-03"])


def contract_rollup(i) -> DataFrame:
    return rollups.contract_rollup(
        i.contract_state, i.contract_respostas, i.companies, i.suppliers, i.contract_clients, i.staging_rows, i.imports
    )


@query
def f04_dimension_filters(i):
    rows = rollups.select_dimension(contract_rollup(i), "fornecedor", "fornecedor1")
    rows = rollups.select_dimension(rows, "arquivo_origem", ["Dados históricos", "carga_3.csv"])
    return rollups.select_dimension(rows, "empresa", ["AFRICA"])


@query
def f05_not_consumed(i):
    return state.unconsumed(i.work_state).select("id", "cliente_id")


@query
def f05_not_consumed_contracts(i):
    return state.unconsumed(i.contract_state, "consolidado").select("id", "cliente_id")


@query
def f06_pages(i):
    return state.paged(state.unconsumed(i.contract_state, "consolidado").select("id", "cliente_id"), 500)


@query
def f07_incomplete_rows(i):
    return i.macro_result.where(F.coalesce(col("sucesso"), F.lit("")) == "").select("line_no")


@query
def f08_report_validation(i):
    return i.raw_clients.select(
        "line_no", geo.report_region(col("region")).alias("region"), geo.report_commune(col("comuna")).alias("comuna")
    )


@query
def f09_reportable_messages(i):
    return i.texts.where(outcome.reportable_message(col("mensagem"))).select("event_id", "mensagem")


@query
def f10_unresolved(i):
    return i.work_state.where(outcome.is_unresolved(col("status"), col("resposta_id"))).select("id", "status")


# --- joins -------------------------------------------------------------------
@query
def j01_contact_clients(i):
    return ingest.resolve_contacts(i.raw_phones, i.clients, "celular", PHONE_ORDER, phone=True)


@query
def j01_email_clients(i):
    return ingest.resolve_contacts(i.raw_emails, i.clients, "email", LINE, phone=False)


@query
def j02_result_clients(i):
    return i.macro_result.select("line_no", text.trim_ws(col("rut")).alias("rut")).join(
        i.clients.select("rut", col("id").alias("cliente_id")), "rut"
    )


@query
def j03_state_client(i):
    return views.with_client(i.work_state.select("id", "cliente_id", "status"), i.clients)


@query
def j04_finished_contacts(i):
    return views.finished_rows(i.work_state, i.clients, i.linked_phones, i.emails)


def with_creation(i) -> DataFrame:
    return i.work_state.withColumn("data_criacao", col("data_update") - F.expr("INTERVAL 1 DAY"))


@query
def j04_finished_contacts_created(i):
    return views.finished_rows(with_creation(i), i.clients, i.linked_phones, i.emails)


@query
def j05_client_contacts(i):
    return export.client_contacts(i.clients, i.addresses, i.phones, i.emails)


@query
def j06_state_catalogue(i):
    messages = i.respostas.select(col("id").alias("resposta_id"), "mensagem")
    return i.work_state.select("id", "resposta_id").join(messages, "resposta_id", "left")


@query
def j07_import_client_state(i):
    clients = i.clients.select(col("id").alias("cliente_id"), "staging_id")
    imports = i.imports.select(col("id").alias("staging_id"), "filename")
    return i.work_state.select("id", "cliente_id", "status").join(clients, "cliente_id").join(imports, "staging_id")


@query
def j08_unit_or_first(i):
    return contracts.with_unit(i.contract_state, i.units).select("id", "cliente_id", "uc")


@query
def j09_optional_supplier(i):
    return contracts.with_supplier(i.contract_state.select("id", "cliente_id"), i.suppliers)


@query
def j09_without_supplier_table(i):
    absent = contracts.optional_table(i.spark, "no_supplier_table")
    return contracts.with_supplier(i.contract_state.select("id", "cliente_id"), absent)


@query
def j10_first_address(i):
    return i.clients.select(col("id").alias("cliente_id")).join(export.first_address(i.addresses), "cliente_id", "left")


def without_unit(i) -> DataFrame:
    rows = i.contract_state.where((col("resposta_id") == 3) & col("cliente_uc_id").isNull())
    people = i.contract_clients.select(col("id").alias("cliente_id"), "cpf")
    return rows.select("id", "cliente_id", "distribuidora_id").join(people, "cliente_id")


@query
def j11_history_resolve(i):
    return contracts.resolve_by_history(without_unit(i), i.history)


@query
def j12_latest_file_enrichment(i):
    tagged = rollups.with_origin_file(i.work_state, i.clients, i.staging_rows, i.imports)
    messages = i.respostas.select(col("id").alias("resposta_id"), "mensagem")
    return tagged.join(messages, "resposta_id", "left").select("id", "status", "mensagem", "arquivo_origem")


@query
def j13_clients_of_selection(i):
    return export.clients_of(i.clients, export.export_selection(i.work_state_u)).select("id", "rut", "nome")


@query
def j14_clients_without_email(i):
    return ingest.remaining(i.clients.select(col("id").alias("cliente_id"), "rut"), i.emails, ["cliente_id"])


@query
def j15_two_key_join(i):
    rows = i.contract_state.select("id", "cliente_id", "distribuidora_id")
    where = i.contract_addresses.select("cliente_id", "distribuidora_id", "endereco", "cep")
    return rows.join(where, ["cliente_id", "distribuidora_id"], "left")


# --- aggregations ------------------------------------------------------------
@query
def a01_day_status_message(i):
    return day_rollup(i)


@query
def a02_status_distribution(i):
    return rollups.status_distribution(i.work_state)


@query
def a03_import_statistics(i):
    return rollups.import_statistics(i.imports, i.clients, i.work_state)


@query
def a04_daily_summary(i):
    return rollups.daily_summary(day_rollup(i))


@query
def a05_summary_with_total(i):
    return rollups.summary_and_total(day_rollup(i))


@query
def a05_single_day_has_no_total(i):
    rows = day_rollup(i)
    one = rows.where(col("dia") == rows.agg(F.min("dia")).scalar())
    return rollups.summary_with_total(rollups.daily_summary(one))


@query
def a06_message_distribution(i):
    return rollups.message_distribution(day_rollup(i))


@query
def a06_contract_message_distribution(i):
    return rollups.message_distribution(contract_rollup(i))


@query
def a07_status_as_messages(i):
    return rollups.status_as_messages(rollups.status_distribution(i.work_state))


@query
def a08_info(i):
    return rollups.info(day_rollup(i))


def customers(i) -> DataFrame:
    rows = ingest.customer_lines(i.raw_clients, clean=True)
    return report.report_customers(rows)


@query
def a09_customers_by_commune(i):
    return report.by_commune(customers(i))


@query
def a10_customers_by_region(i):
    return report.by_region(customers(i))


@query
def a11_report_summary(i):
    return report.report_summary(customers(i), "clientes.txt", now())


@query
def a12_phone_text(i):
    return contracts.phone_text(i.phones, order="line_no")


@query
def a12_phone_rows(i):
    return contracts.phone_rows(i.phones, order="line_no")


@query
def a13_contract_report(i):
    return contract_report(i)


@query
def a14_batch_composition(i):
    return contracts.batch_composition(priority(i))


@query
def a15_import_counters(i):
    return ingest.import_counters(i.raw_clients, i.clients.where(col("sexo") == "F"), i.addresses)


@query
def a15_contact_counters(i):
    return ingest.contact_counters(i.raw_phones, i.clients, i.phones, "celular", "numero", PHONE_ORDER, phone=True)


@query
def a16_cleaning_counters(i):
    return ingest.cleaning_counters(i.raw_clients)


@query
def a17_message_histogram(i):
    return report.message_histogram(i.texts.select("mensagem"))


@query
def a18_history_counts(i):
    return contracts.history_counts(i.history)


@query
def a19_file_statistics(i):
    stats = i.file_stats
    return report.file_statistics(stats.withColumn("data_carga", F.to_date("data_carga")))


@query
def a20_staging_state(i):
    return report.staging_state(i.staging_rows)


@query
def a21_table_profile(i):
    return report.table_profile({name: getattr(i, name) for name in TABLES})


@query
def a22_result_counters(i):
    return report.result_counters(i.macro_result, i.clients)


# --- windows and ranks -------------------------------------------------------
@query
def w01_latest_pending(i):
    return state.latest_pending(i.work_state, i.clients).select("id", "cliente_id", "rut", "data_update")


@query
def w02_latest_file(i):
    return rollups.latest_file(i.staging_rows, i.imports)


@query
def w03_contact_slots(i):
    return export.contact_slots(i.phones, "numero", "telefone", 5, PHONE_ORDER)


@query
def w03_email_slots(i):
    return export.contact_slots(i.emails, "endereco", "email", 2, ["id"])


@query
def w04_first_row_per_key(i):
    rows = ingest.customer_lines(i.raw_clients).where(col("rut") != "")
    return first_per_key(rows, ["rut"], LINE).select("rut", "line_no", "dv", "nome", "sexo", "data_nascimento")


@query
def w05_assign_ids(i):
    return rank_by_id(i.raw_clients.select("line_no", "rut"), "line_no", "id")


@query
def w06_first_address(i):
    return export.first_address(i.addresses)


# --- sorts and limits --------------------------------------------------------
@query
def t01_fifo_batch(i):
    return state.claimable(i.work_state, i.clients, 500).select("id", "cliente_id", "rut", "data_update")


@query
def t01_default_batch(i):
    return state.claimable(i.work_state, i.clients, 0).select("id", "rut")


@query
def t02_id_batch(i):
    return state.id_batch(i.work_state, i.clients)


@query
def t03_priority_batch(i):
    return priority(i)


@query
def t03_priority_batch_no_suppliers(i):
    return priority(i, 500, suppliers=False)


@query
def t04_top_files(i):
    return rollups.top_files(rollups.with_origin_file(i.work_state, i.clients, i.staging_rows, i.imports))


@query
def t05_day_options(i):
    return rollups.day_options(day_rollup(i))


@query
def t05_month_options(i):
    return rollups.month_options(day_rollup(i))


@query
def t06_sorted_rollup(i):
    return day_rollup(i).orderBy(F.desc("dia"), "status", "mensagem")


# --- set operations ----------------------------------------------------------
@query
def u01_provenance_union(i):
    phones = i.phones.withColumnRenamed("line_no", "id")
    return contracts.provenance_report(
        i.contract_state, i.contract_clients, i.companies, i.units, i.contract_addresses, phones, i.history
    )


@query
def u01_provenance_phones(i):
    """The phone lists of the provenance report, one number per row."""
    return contracts.phones_of(contracts.confirmed(i.contract_state), i.phones, "line_no")


@query
def u02_total_row(i):
    return rollups.summary_total(rollups.daily_summary(contract_rollup(i), CONTRACT_ACTIVE, CONTRACT_INACTIVE))


@query
def u03_distinct_history(i):
    return contracts.active_history(i.history)


@query
def u04_multi_file_precedence(i):
    lines = files.read_results(i.spark, result_files(i), positions=True)
    return state.resolve_results(lines, files.LINE_ORDER)


@query
def u05_unmapped_statuses(i):
    return quality.unmapped_statuses(i.work_state, [PHONE_OK, PHONE_NOT_OK])


# --- state table -------------------------------------------------------------
@query
def m01_seed(i):
    return state.seed(closed_state(i), i.clients, now())


@query
def m02_claim(i):
    return state.claim(i.work_state, state.claimable(i.work_state, i.clients, 500)).select("id", "cliente_id", "status", "data_update")


@query
def m02_claim_contracts(i):
    batch = priority(i).select(col("macro_id").alias("id"))
    return state.claim_contracts(i.contract_state, batch, now()).select("id", "status", "data_update")


@query
def m03_apply_results(i):
    return state.apply_results(i.work_state_u, i.macro_result, i.clients, LINE, now())


@query
def m04_apply_by_id(i):
    ids = i.work_state_u.select("id", "cliente_id")
    outcomes = state.client_outcomes(i.macro_result, i.clients, LINE).join(ids, "cliente_id")
    return state.apply_by_id(i.work_state, outcomes, now()).select("id", "resposta_id", "status", "data_update")


@query
def m05_revert_batch(i):
    batch = i.work_state.select("id").orderBy("id").limit(500)
    return state.revert(i.work_state, batch).select("id", "status")


@query
def m05_revert_all(i):
    return state.revert(i.work_state).select("id", "status")


@query
def m06_consume(i):
    selected = export.export_selection(i.work_state_u)
    return state.consume(i.work_state_u, selected, now()).select("id", "extraido", "data_extracao")


def logged(i, name: str, table: DataFrame, change) -> DataFrame:
    """A table after change(table), which gives the rows that differ, went through a change log."""
    catalog = Catalog(i.spark, work_path(i.spark, name))
    with catalog.commit() as c:
        c.replace("state", table, "id")
    with catalog.commit() as c:
        c.change("state", change(c.read("state", table.schema)), "id")
    return catalog.read("state", table.schema)


@query
def m02_claim_log(i):
    found = logged(i, "m02", i.work_state, lambda t: state.claimed_rows(t, state.claimable(t, i.clients, 500)))
    return found.select("id", "cliente_id", "status", "data_update")


@query
def m03_apply_results_log(i):
    return logged(i, "m03", i.work_state_u, lambda t: state.result_rows(t, i.macro_result, i.clients, LINE, now()))


@query
def m05_revert_batch_log(i):
    found = logged(i, "m05", i.work_state, lambda t: state.reverted_rows(t, t.select("id").orderBy("id").limit(500)))
    return found.select("id", "status")


@query
def m06_consume_log(i):
    found = logged(i, "m06", i.work_state_u, lambda t: state.consumed_rows(t, export.export_selection(t), now()))
    return found.select("id", "extraido", "data_extracao")


@query
def m07_paged_consume(i):
    selected = state.unconsumed(i.contract_state, "consolidado")
    done = state.consume(i.contract_state, selected, now())
    pages = state.paged(selected.select("id"), 500)
    return done.join(pages, "id").select("id", "pagina", "extraido", "data_extracao")


@query
def m08_ledger_totals(i):
    counters = i.staging_rows.groupBy("staging_id", "validation_status").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(col("validation_status").isin("new", "valid")).alias("rows_success"),
        F.count_if(col("validation_status").isin("invalid", "skipped")).alias("rows_failed"),
    )
    return state.ledger_totals(counters)


@query
def m08_import_ledger(i):
    opened = state.open_import(i.imports.withColumn("finished_at", F.lit(None).cast("timestamp_ntz")).withColumn("started_at", F.lit(None).cast("timestamp_ntz")), "nova.csv", now())
    me = state.latest_import(opened).select("id").scalar()
    counters = ingest.import_counters(i.raw_clients, i.clients, i.addresses).select(
        col("lidos").alias("total_rows"), (col("lidos") - col("ignorados")).alias("rows_success"), col("ignorados").alias("rows_failed")
    )
    closed = state.close_import(opened, me, counters, False, now())
    return closed.select("id", "filename", "status", "total_rows", "rows_success", "rows_failed", "finished_at")


@query
def m09_replace_addresses(i):
    return ingest.replace_addresses(i.addresses, i.clients, ingest.clean_customer_file(i.raw_clients))


def bucketed(i, name: str, table: DataFrame, delta: DataFrame, key: str, step) -> DataFrame:
    """A table in hash buckets after the buckets of delta's keys were written anew by step(their rows, delta)."""
    catalog = Catalog(i.spark, work_path(i.spark, name))
    with catalog.commit() as c:
        c.put_buckets("t", table, [key], 16)
    with catalog.commit() as c:
        c.update("t", table.schema, delta, [key], 16, step)
    return catalog.read("t", table.schema)


@query
def m09_update_buckets(i):
    delta = ingest.address_changes(i.clients, ingest.clean_customer_file(i.raw_clients))
    return bucketed(i, "m09", i.addresses, delta, "cliente_id", ingest.put_addresses)


@query
def s11_update_buckets(i):
    rows = ingest.customer_lines(i.raw_clients).where(col("rut") != "")
    delta = first_per_key(rows.select("rut", "line_no", "nome", "sexo"), ["rut"], LINE)
    return bucketed(i, "s11", i.clients, delta, "rut", lambda t, d: update_join(t, d, ["rut"], ["nome", "sexo"]))


@query
def m10_repair_unresolved(i):
    return state.repair_unresolved(i.contract_state).select("id", "status")


@query
def m10_upsert_catalogue(i):
    seen = i.work_state.where(col("resposta_id").isNotNull()).groupBy(col("resposta_id").alias("id"))
    entries = seen.agg(F.count(F.lit(1)).cast("string").alias("mensagem"), F.max("status").alias("status"))
    return state.upsert_catalogue(i.contract_respostas, entries)


@query
def m11_validated_phones(i):
    return ingest.validated_contacts(i.macro_result, i.clients, i.linked_phones, "telefone", LINE)


@query
def m11_validated_emails(i):
    return ingest.validated_contacts(i.macro_result, i.clients, i.emails, "email", LINE)


@query
def m12_address_if_none(i):
    have = i.addresses.where(col("comuna") == "MAIPU")
    return ingest.new_addresses(i.raw_clients, i.clients, have)


# --- quality -----------------------------------------------------------------
@query
def v01_empty_messages(i):
    return quality.empty_messages(rollups.message_distribution(contract_rollup(i)))


@query
def v02_unbalanced_days(i):
    return quality.unbalanced_days(rollups.daily_summary(contract_rollup(i), CONTRACT_ACTIVE, ["excluido"]))


@query
def v03_status_coverage(i):
    return quality.unmapped_statuses(i.contract_state, CONTRACT_ACTIVE + CONTRACT_INACTIVE)


@query
def v04_total_row(i):
    return quality.total_row_check(rollups.summary_with_total(rollups.daily_summary(day_rollup(i))))


@query
def v05_reconcile_rollup(i):
    return quality.reconcile_rollup(i.work_state, i.respostas, day_rollup(i))


@query
def v06_reconcile_filters(i):
    resolved = i.contract_state.where((col("status") != PENDING) & col("resposta_id").isNotNull())
    one_row = i.suppliers.groupBy("cliente_id").agg(F.count(F.lit(1)).alias("f"))
    base = (
        resolved.join(one_row, "cliente_id", "left")
        .groupBy(F.to_date("data_update").alias("dia"), col("distribuidora_id").alias("id"))
        .agg(F.sum(F.coalesce("f", F.lit(1))).alias("n"))
        .join(i.companies, "id")
        .select("dia", col("nome").alias("empresa"), "n")
    )
    rolled = contract_rollup(i).withColumnRenamed("qtd", "n")
    by_day = quality.reconcile(base, rolled, ["dia"], "dia")
    return by_day.unionByName(quality.reconcile(base, rolled, ["empresa"], "empresa"))


@query
def v07_staging_rows(i):
    return ingest.stage_rows(i.raw_clients, i.clients.where(col("sexo") == "F").select("rut"))


@query
def v08_duplicate_contacts(i):
    return quality.duplicate_keys(i.phones, ["cliente_id", "numero", "origem"])


@query
def v08_orphan_contacts(i):
    return quality.orphans(i.units, "cliente_id", i.contract_clients)


@query
def v09_domain_check(i):
    checks = [
        ("state", i.work_state, "status", STATES),
        ("origin", i.phones, "origem", ORIGINS),
        ("import", i.imports, "status", IMPORT_STATES),
        ("row", i.staging_rows, "validation_status", ROW_STATES),
        ("contract", i.contract_state, "status", STATES),
    ]
    result = None
    for name, df, column, allowed in checks:
        bad = quality.outside_domain(df, column, allowed).withColumn("dominio", F.lit(name))
        result = bad if result is None else result.unionByName(bad)
    return result


# --- streaming ---------------------------------------------------------------
@query
def r01_incremental_ingest(i):
    root = work_path(i.spark, "r01")
    streams.ingest_results(i.spark, result_files(i), f"{root}/out", f"{root}/checkpoint")
    return streams.read_ingested(i.spark, f"{root}/out")


@query
def r02_continuous_results(i):
    root = work_path(i.spark, "r02")
    source = streams.land(i.macro_result, f"{root}/in")
    streams.apply_stream(i.spark, source, i.work_state_u, i.clients, f"{root}/state", f"{root}/checkpoint", LINE, NOW)
    return streams.read_state(i.spark, f"{root}/state")


@query
def r03_first_wins_contacts(i):
    root = work_path(i.spark, "r03")
    rows = ingest.resolve_contacts(i.raw_emails, i.clients, "email", LINE, phone=False)
    source = streams.land(rows.select("cliente_id", col("valor").alias("endereco"), "line_no"), f"{root}/in")
    streams.first_wins(i.spark, source, f"{root}/out", f"{root}/checkpoint", ["cliente_id", "endereco"], LINE)
    return i.spark.read.parquet(f"{root}/out/*")


@query
def r04_daily_rollup(i):
    root = work_path(i.spark, "r04")
    source = streams.land(i.events.select(col("ts").cast("timestamp").alias("ts"), "event_type"), f"{root}/in")
    streams.daily_rollup(i.spark, source, f"{root}/out", f"{root}/checkpoint", "ts", ["event_type"])
    return streams.read_rollup(i.spark, f"{root}/out", ["event_type"])


@query
def r05_key_state(i):
    root = work_path(i.spark, "r05")
    source = streams.land(i.macro_result, f"{root}/in")
    streams.key_states(i.spark, source, f"{root}/out", f"{root}/checkpoint")
    return streams.read_key_states(i.spark, f"{root}/out")


@query
def r05_key_transitions(i):
    root = work_path(i.spark, "r05t")
    source = streams.land(i.macro_result, f"{root}/in")
    key_machine.key_transitions(i.spark, source, f"{root}/out", f"{root}/checkpoint")
    return key_machine.read_transitions(i.spark, f"{root}/out")


# --- function and API surface ------------------------------------------------
@query
def x01_sql_functions(i):
    registry.register(i.spark)
    i.raw_clients.createOrReplaceTempView("x01_lines")
    return i.spark.sql("""
        SELECT line_no, normalizar_rut(rut) AS rut, limpar_region(region) AS region, limpar_comuna(comuna) AS comuna
        FROM x01_lines""")


@query
def x01_sql_interpret(i):
    registry.register(i.spark)
    i.macro_result.createOrReplaceTempView("x01_results")
    return i.spark.sql("""
        SELECT line_no, o.resposta_id, o.status, normalizar_telefone(telefone_validado) AS numero
        FROM (SELECT *, interpretar(sucesso, telefone_validado, email_validado, erro) AS o FROM x01_results)""")


@query
def x01_sql_interpret_body(i):
    registry.register(i.spark)
    i.legacy_body.createOrReplaceTempView("x01_bodies")
    return i.spark.sql("SELECT event_id, o.* FROM (SELECT event_id, interpretar_corpo(body) AS o FROM x01_bodies)")


@query
def x02_claimable(i):
    return state.claimable(i.work_state, i.clients).select("id", "cliente_id", "rut")


@query
def x02_refresh(i):
    path = written_rollups(i, "x02")
    return i.spark.read.parquet(f"{path}/status").select("status", "qtd", "atualizado_em")


def registered(i) -> SparkSession:
    views.register_views(i.spark, i.work_state, i.clients, i.addresses, i.linked_phones, i.emails)
    return i.spark


@query
def x03_view_pending(i):
    return registered(i).sql("SELECT status, count(*) AS n, max(id) AS max_id FROM view_pending GROUP BY status")


@query
def x03_view_finished(i):
    return registered(i).sql("""
        SELECT status, count(*) AS n, count(telefone_extraido) AS telefones, count(email_extraido) AS emails
        FROM view_finished GROUP BY status""")


@query
def x03_view_client_contacts(i):
    return registered(i).sql("""
        SELECT tipo, origem, count(*) AS n, count(DISTINCT cliente_id) AS clientes
        FROM view_client_contacts GROUP BY tipo, origem""")


def registered_whole(i) -> SparkSession:
    views.register_views(i.spark, with_creation(i), i.clients, i.addresses, i.linked_phones, i.emails)
    return i.spark


@query
def x03_rows_pending(i):
    return registered_whole(i).sql("SELECT id, cliente_id, rut, data_update FROM view_pending")


@query
def x03_rows_finished(i):
    return registered_whole(i).sql("SELECT * FROM view_finished")


@query
def x03_rows_client_contacts(i):
    return registered_whole(i).sql("SELECT * FROM view_client_contacts")


@query
def x04_dashboard_file_statistics(i):
    stats = i.file_stats.withColumn("data_carga", F.to_date("data_carga"))
    return rollups.dashboard(contract_rollup(i), kind="contract", supplier="fornecedor2", file_stats=stats)["file_statistics"]


@query
def x04_dashboard_nothing_selected(i):
    found = rollups.dashboard(day_rollup(i), rollups.status_distribution(i.work_state), days=["2031-01-01"])
    return found["distribution"].unionByName(found["summary"].select(col("dia").alias("mensagem"), col("total").alias("quantidade")))


@query
def x04_dashboard_summary(i):
    return rollups.dashboard(day_rollup(i), rollups.status_distribution(i.work_state), days=["mes:1997-05", "mes:1998-10"])["summary"]


@query
def x04_dashboard_distribution(i):
    return rollups.dashboard(contract_rollup(i), kind="contract", supplier="fornecedor1", company="AMERICA")["distribution"]


@query
def x04_dashboard_files(i):
    return rollups.dashboard(contract_rollup(i), kind="contract", supplier="fornecedor2")["files"]
