"""Rollup tables and the dashboard queries over them."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    CONTRACT_ACTIVE,
    CONTRACT_INACTIVE,
    OPEN_STATES,
    PENDING,
    PHONE_NOT_OK,
    PHONE_OK,
)
from ..functions.identity import month_key, month_label
from ..functions.outcome import origin_file, supplier_or_default
from ..functions.text import percent_text, trim_ws
from .keyed import last_per_key
from .report import file_statistics


def _long_sum(c) -> Column:
    return F.sum(c).cast("long")


def day_status_message(state: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Finished rows per day, status and message.

    Counted by outcome id first; the catalogue meets only the counts.
    """
    counts = (
        state.where(~F.col("status").isin(OPEN_STATES))
        .groupBy(F.to_date("data_update").alias("dia"), "status", "resposta_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    messages = catalogue.select(F.col("id").alias("resposta_id"), "mensagem")
    return (
        counts.join(messages, "resposta_id", "left")
        .groupBy("dia", "status", "mensagem")
        .agg(_long_sum("n").alias("qtd"))
    )


def status_distribution(state: DataFrame) -> DataFrame:
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("qtd")).orderBy(F.desc("qtd"), "status")


def import_statistics(imports: DataFrame, clients: DataFrame, state: DataFrame) -> DataFrame:
    """Clients and their states per completed import.

    State rows are counted per client, then per import, before the ledger
    joins in; a client is one row by then, so no distinct count is needed.
    """
    status = F.col("status")
    flags = {
        "processados": ~status.isin(OPEN_STATES),
        "pendentes": status == PENDING,
        "com_telefone": status == PHONE_OK,
        "sem_telefone": status == PHONE_NOT_OK,
    }
    per_client = state.groupBy(F.col("cliente_id").alias("id")).agg(
        *(F.count_if(cond).alias(c) for c, cond in flags.items())
    )
    per_import = (
        clients.select("id", "staging_id")
        .join(per_client, "id")
        .groupBy("staging_id")
        .agg(F.count(F.lit(1)).alias("clientes_no_banco"), *(_long_sum(c).alias(c) for c in flags))
    )
    return (
        imports.where(F.col("status") == "completed")
        .select(
            F.col("id").alias("staging_id"),
            F.col("filename").alias("arquivo"),
            F.to_date("created_at").alias("data_carga"),
        )
        .join(per_import, "staging_id")
        .drop("staging_id")
        .orderBy(F.desc("data_carga"), "arquivo")
    )


def build_rollups(
    state: DataFrame, catalogue: DataFrame, imports: DataFrame, clients: DataFrame, now: Column
) -> dict[str, DataFrame]:
    """The three rollups, stamped with one shared time."""
    rollups = {
        "day": day_status_message(state, catalogue),
        "status": status_distribution(state),
        "staging": import_statistics(imports, clients, state),
    }
    return {name: df.withColumn("atualizado_em", now) for name, df in rollups.items()}


#: The stored daily rollup lies in a folder per month, of rows in the order of their days: a folder
#: per day would hold some ten rows.
DAY_SCHEMA = "dia date, status string, mensagem string, qtd long, atualizado_em timestamp_ntz, mes date"


def _write_days(days: DataFrame, path: str, only_its_months: bool = False) -> None:
    rows = days.withColumn("mes", F.trunc("dia", "month")).repartition("mes").sortWithinPartitions("mes", "dia")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only_its_months else "static")
    writer.partitionBy("mes").parquet(path)


def refresh(path: str, **tables) -> dict[str, str]:
    """Rewrites the rollup tables below `path`; returns where each one is."""
    written = {}
    for name, df in build_rollups(**tables).items():
        written[name] = f"{path}/{name}"
        if name == "day":
            _write_days(df, written[name])
        else:
            df.write.mode("overwrite").parquet(written[name])
    return written


def refresh_days(path: str, state: DataFrame, catalogue: DataFrame, days: list[dt.date], now: Column) -> None:
    """Counts the months of these days anew and overwrites their folders alone.

    A month without any row left keeps what it had; the next full refresh takes it out.
    """
    months = sorted({d.replace(day=1) for d in days})
    rows = state.where(F.trunc(F.to_date("data_update"), "month").isin(months))
    fresh = day_status_message(rows, catalogue).withColumn("atualizado_em", now)
    _write_days(fresh, f"{path}/day", only_its_months=True)


def read_days(spark, path: str) -> DataFrame:
    """The stored daily rollup; conditions on `mes` select folders, those on `dia` parts of files."""
    return spark.read.schema(DAY_SCHEMA).parquet(f"{path}/day").select("dia", "status", "mensagem", "qtd", "mes")


def stored_days(spark, path: str, selection: list[str] | None) -> DataFrame:
    """`select_days` on the stored daily rollup: only files of months with a chosen day are read."""
    rows = read_days(spark, path)
    wanted, explicit = _wanted_days(selection or [])
    if wanted is None:
        return rows.drop("mes")
    months = _wanted_months(selection)
    chosen = rows.where(wanted if months is None else wanted & F.col("mes").isin(months))
    return (rows if not explicit and chosen.isEmpty() else chosen).drop("mes")


def as_count(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast("long"), F.lit(0)).alias(c)


def read_rollups(spark, path: str) -> dict[str, DataFrame]:
    """Stored rollups in display order, counts made whole."""
    day = read_days(spark, path).drop("mes")
    status = spark.read.parquet(f"{path}/status").select("status", "qtd")
    counts = ["clientes_no_banco", "processados", "pendentes", "com_telefone", "sem_telefone"]
    staging = spark.read.parquet(f"{path}/staging")
    return {
        "day": day.orderBy(F.desc("dia")),
        "status": status.orderBy(F.desc("qtd")),
        "staging": staging.select("arquivo", "data_carga", *(as_count(c) for c in counts)).orderBy(
            F.desc("data_carga")
        ),
    }


def select_days(rollup: DataFrame, selection: list[str] | None) -> DataFrame:
    """Keeps the chosen days and `mes:YYYY-MM` months.

    A selection of months without any day in the data filters nothing; an
    explicit day always filters.
    """
    wanted, explicit = _wanted_days(selection or [])
    if wanted is None:
        return rollup
    if explicit:
        return rollup.where(wanted)
    wanted = F.coalesce(wanted, F.lit(False))
    matched = rollup.agg(F.coalesce(F.bool_or(wanted), F.lit(False))).scalar()
    return rollup.where(wanted | ~matched)


MONTH = re.compile(r"(\d{4})-(\d{2})")


def _wanted_months(selection: list[str]) -> list[dt.date] | None:
    """First days of the months that a selection can meet; None if that cannot be told."""
    months = set()
    for pick in map(str, selection):
        try:
            months.add(dt.date.fromisoformat(pick.removeprefix("mes:") + "-01" * pick.startswith("mes:")).replace(day=1))
        except ValueError:
            return None
    return sorted(months)


def _wanted_days(selection: list[str]) -> tuple[Column | None, bool]:
    """Condition on `dia` for days and months, and whether it names a day; None for no selection.

    Days and whole months are compared as dates, which reach the files; other texts as text.
    """
    wanted, explicit = None, False
    for pick in map(str, selection):
        explicit |= not pick.startswith("mes:")
        prefix = pick.removeprefix("mes:")
        month = MONTH.fullmatch(prefix)
        if pick.startswith("mes:") and month and 1 <= int(month[2]) <= 12:
            first = dt.date(int(month[1]), int(month[2]), 1)
            after = (first + dt.timedelta(days=31)).replace(day=1)
            this = (F.col("dia") >= F.lit(first)) & (F.col("dia") < F.lit(after))
        elif pick.startswith("mes:"):
            this = F.col("dia").cast("string").startswith(prefix)
        else:
            try:
                this = F.col("dia") == F.lit(dt.date.fromisoformat(pick))
            except ValueError:
                this = F.col("dia").cast("string") == pick
        wanted = this if wanted is None else wanted | this
    return wanted, explicit


def select_dimension(rollup: DataFrame, column: str, value) -> DataFrame:
    """Equality with one value or a list, compared as text; no value, no filter."""
    if not value or column not in rollup.columns:
        return rollup
    values = value if isinstance(value, list) else [value]
    return rollup.where(F.col(column).cast("string").isin([str(v) for v in values]))


def daily_summary(
    rollup: DataFrame, active: list[str] | None = None, inactive: list[str] | None = None
) -> DataFrame:
    active, inactive = active or [PHONE_OK], inactive or [PHONE_NOT_OK]

    def part(states):
        return F.coalesce(_long_sum(F.when(F.col("status").isin(states), F.col("qtd"))), F.lit(0))

    days = rollup.where(F.col("dia").isNotNull()).groupBy(F.col("dia").cast("string").alias("dia")).agg(
        _long_sum("qtd").alias("total"), part(active).alias("ativos"), part(inactive).alias("inativos")
    )
    return _with_percents(days, "-").orderBy("dia")


def _with_percents(df: DataFrame, when_zero: str) -> DataFrame:
    total = F.col("total")
    return df.withColumns({
        "pct_ativos": percent_text(F.col("ativos"), total, when_zero),
        "pct_inativos": percent_text(F.col("inativos"), total, when_zero),
    })


def summary_total(summary: DataFrame) -> DataFrame:
    """The grand total row; empty unless there are two days or more."""
    sums = summary.agg(
        F.count(F.lit(1)).alias("_days"),
        *(_long_sum(c).alias(c) for c in ("total", "ativos", "inativos")),
    ).where(F.col("_days") > 1)
    return _with_percents(sums.withColumn("dia", F.lit("Total")), "0%").select(*summary.columns)


def summary_with_total(summary: DataFrame) -> DataFrame:
    return summary.unionByName(summary_total(summary))


def summary_and_total(
    rollup: DataFrame, active: list[str] | None = None, inactive: list[str] | None = None
) -> DataFrame:
    """`summary_with_total` of the daily summary in one pass: days and grand total are groupings of the same scan."""
    parts = {"ativos": active or [PHONE_OK], "inativos": inactive or [PHONE_NOT_OK]}
    sums = {n: F.sum(F.when(F.col("status").isin(states), F.col("qtd"))) for n, states in parts.items()}
    rows = rollup.where(F.col("dia").isNotNull()).withColumn("dia", F.col("dia").cast("string"))
    found = rows.rollup("dia").agg(
        F.grouping("dia").alias("_all"),
        (F.min("dia") != F.max("dia")).alias("_several"),
        _long_sum("qtd").alias("total"),
        *(F.coalesce(s.cast("long"), F.lit(0)).alias(n) for n, s in sums.items()),
    )
    whole = F.col("_all") == 1
    shown = found.where(~whole | F.col("_several"))
    text = {f"pct_{n}": F.when(whole, percent_text(F.col(n), F.col("total"), "0%")).otherwise(percent_text(F.col(n), F.col("total"), "-")) for n in parts}
    ordered = shown.withColumns({**text, "dia": F.when(whole, F.lit("Total")).otherwise(F.col("dia"))}).orderBy("_all", "dia")
    return ordered.select("dia", "total", "ativos", "inativos", "pct_ativos", "pct_inativos")


def message_distribution(rollup: DataFrame) -> DataFrame:
    rows = rollup.where(F.col("mensagem").isNotNull())
    if "resposta_status" in rollup.columns:
        rows = rows.where(F.col("resposta_status").isNotNull() & (F.col("resposta_status") != PENDING))
    return (
        rows.groupBy(trim_ws(F.col("mensagem")).alias("mensagem"))
        .agg(_long_sum("qtd").alias("quantidade"))
        .orderBy(F.desc("quantidade"), "mensagem")
    )


def status_as_messages(status_rollup: DataFrame) -> DataFrame:
    return status_rollup.select(F.col("status").alias("mensagem"), F.col("qtd").alias("quantidade"))


def info(rollup: DataFrame) -> DataFrame:
    return rollup.agg(
        F.coalesce(_long_sum("qtd"), F.lit(0)).alias("processados"), F.count_distinct("dia").alias("dias")
    )


def day_options(rollup: DataFrame) -> DataFrame:
    return rollup.where(F.col("dia").isNotNull()).select("dia").distinct().orderBy("dia")


def month_options(rollup: DataFrame) -> DataFrame:
    months = rollup.where(F.col("dia").isNotNull()).select(
        month_key(F.col("dia")).alias("value"), month_label(F.col("dia")).alias("label")
    )
    return months.distinct().orderBy("value")


def latest_file(rows: DataFrame, imports: DataFrame) -> DataFrame:
    """Most recent import file per normalised key, valid rows only."""
    valid = rows.where(F.col("validation_status") == "valid").select("normalized_rut", "id", "staging_id")
    latest = last_per_key(valid, ["normalized_rut"], ["id"])
    files = imports.select(F.col("id").alias("staging_id"), "filename")
    return latest.join(files, "staging_id").select("normalized_rut", "filename")


def with_origin_file(state: DataFrame, clients: DataFrame, rows: DataFrame, imports: DataFrame, key: str = "rut") -> DataFrame:
    """State rows tagged with the file their client last came from."""
    per_client = clients.select(F.col("id").alias("cliente_id"), F.col(key).alias("normalized_rut")).join(
        latest_file(rows, imports), "normalized_rut"
    )
    return (
        state.join(per_client.select("cliente_id", "filename"), "cliente_id", "left")
        .withColumn("arquivo_origem", origin_file(F.col("data_extracao"), F.col("filename")))
        .drop("filename")
    )


def top_files(tagged: DataFrame, n: int = 10) -> DataFrame:
    return (
        tagged.groupBy("arquivo_origem")
        .agg(F.count(F.lit(1)).alias("quantidade"))
        .orderBy(F.desc("quantidade"), "arquivo_origem")
        .limit(n)
    )


def contract_rollup(
    state: DataFrame,
    catalogue: DataFrame,
    companies: DataFrame,
    suppliers: DataFrame,
    clients: DataFrame,
    rows: DataFrame,
    imports: DataFrame,
) -> DataFrame:
    """Older model: resolved rows per day, status, message, company, supplier and file.

    Counted per client before the client-level tags join in, so a hot client
    meets its supplier and file rows as a few counts.
    """
    resolved = state.where((F.col("status") != PENDING) & F.col("resposta_id").isNotNull())
    counts = resolved.groupBy(
        "cliente_id",
        F.to_date("data_update").alias("dia"),
        "status",
        "resposta_id",
        "distribuidora_id",
        F.col("data_extracao").isNull().alias("_historic"),
    ).agg(F.count(F.lit(1)).alias("n"))
    files = clients.select(F.col("id").alias("cliente_id"), F.col("cpf").alias("normalized_rut")).join(
        latest_file(rows, imports), "normalized_rut"
    )
    tagged = (
        counts.join(suppliers.select("cliente_id", "fornecedor"), "cliente_id", "left")
        .join(files.select("cliente_id", "filename"), "cliente_id", "left")
        .withColumns({
            "fornecedor": supplier_or_default(F.col("fornecedor")),
            "arquivo_origem": origin_file(
                F.when(~F.col("_historic"), F.lit(1)), F.col("filename")
            ),
        })
    )
    dims = ["dia", "status", "resposta_id", "distribuidora_id", "fornecedor", "arquivo_origem"]
    sums = tagged.groupBy(*dims).agg(_long_sum("n").alias("qtd"))
    messages = catalogue.select(
        F.col("id").alias("resposta_id"), "mensagem", F.col("status").alias("resposta_status")
    )
    firms = companies.select(F.col("id").alias("distribuidora_id"), F.col("nome").alias("empresa"))
    return (
        sums.join(messages, "resposta_id", "left")
        .join(firms, "distribuidora_id", "left")
        .select("dia", "status", "mensagem", "resposta_status", "empresa", "fornecedor", "arquivo_origem", "qtd")
    )


def dashboard(
    rollup: DataFrame,
    status_rollup: DataFrame | None = None,
    kind: str = "contact",
    days: list[str] | None = None,
    company=None,
    supplier: str | None = None,
    file=None,
    file_stats: DataFrame | None = None,
    granularity: str = "combo",
) -> dict[str, DataFrame]:
    """Summary, distribution and counts of all files of one dashboard request.

    `kind` is "contact" (status distribution in place of messages, not
    filtered by day) or "contract". A selection without any row has an empty
    distribution. `file_stats` adds the statistics per file, whatever is
    selected; their counts are of combinations, the one granularity there is.
    """
    if granularity != "combo":
        raise ValueError(f"no file statistics by {granularity}")
    rows = select_dimension(rollup, "fornecedor", supplier)
    rows = select_dimension(rows, "arquivo_origem", file)
    rows = select_days(rows, days)
    rows = select_dimension(rows, "empresa", company)
    states = () if kind == "contact" else (CONTRACT_ACTIVE, CONTRACT_INACTIVE)
    distribution = message_distribution(rows)
    if kind == "contact" and status_rollup is not None:
        selected = rows.limit(1).agg(F.count(F.lit(1))).scalar()
        distribution = status_as_messages(status_rollup.where(selected > 0))
    result = {"summary": summary_and_total(rows, *states), "distribution": distribution}
    if file_stats is not None:
        result["file_statistics"] = file_statistics(file_stats)
    if "arquivo_origem" in rows.columns:
        result["files"] = (
            rows.groupBy("arquivo_origem")
            .agg(_long_sum("qtd").alias("quantidade"))
            .orderBy(F.desc("quantidade"), "arquivo_origem")
        )
    return result
