"""Customer reports, file statistics, message histograms and table profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import NO_COMMUNE, NO_REGION
from ..functions.geo import report_commune, report_region
from ..functions.identity import phone_digits
from ..functions.outcome import pick_message_column, reportable_message
from ..functions.text import percent_text, sentence_case, trim_ws
from .keyed import first_per_key


def report_customers(cleaned: DataFrame) -> DataFrame:
    """First line per key of a cleaned file, with report region and commune."""
    rows = cleaned.select(
        trim_ws(F.col("rut")).alias("rut"),
        "line_no",
        report_region(F.col("region")).alias("region"),
        report_commune(F.col("comuna")).alias("comuna"),
    ).where(F.col("rut") != "")
    return first_per_key(rows, ["rut"], ["line_no"])


def by_commune(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy(
            F.coalesce("region", F.lit(NO_REGION)).alias("region"),
            F.coalesce("comuna", F.lit(NO_COMMUNE)).alias("comuna"),
        )
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy("region", "comuna")
    )


def by_region(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy(F.coalesce("region", F.lit(NO_REGION)).alias("region"))
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), "region")
    )


def report_summary(customers: DataFrame, source: str, now: Column) -> DataFrame:
    """The report's head lines as (name, value) rows."""
    totals = by_commune(customers).agg(
        F.coalesce(F.sum("total"), F.lit(0)).cast("string").alias("n"),
        F.count(F.lit(1)).cast("string").alias("communes"),
        F.count_distinct("region").cast("string").alias("regions"),
    )
    entries = [
        ("Total clientes únicos", F.col("n")),
        ("Cidades (comunas)", F.col("communes")),
        ("Regiões (inc. sem região)", F.col("regions")),
        ("Arquivo base", F.lit(source)),
        ("Data de geração", F.date_format(now, "dd/MM/yyyy HH:mm:ss")),
    ]
    pairs = F.array(*(F.struct(F.lit(k).alias("informacao"), v.alias("valor")) for k, v in entries))
    return totals.select(F.inline(pairs))


# Counters of a file statistics row.
FILE_COUNTERS = [
    "cpfs_no_arquivo", "cpfs_processados", "ativos", "inativos",
    "cpfs_ineditos", "ucs_ineditas",
    "combos_processadas", "combos_ativas", "combos_inativas",
    "ineditos_processados", "ineditos_ativos", "ineditos_inativos",
]


def file_statistics(stats: DataFrame) -> DataFrame:
    """Per-file combination counts with pending and percentages."""
    present = {
        c: F.coalesce(F.col(c), F.lit(0)).cast("long") if c in stats.columns else F.lit(0).cast("long")
        for c in FILE_COUNTERS
    }
    done = F.col("combos_processadas")
    return stats.withColumns(present).select(
        "arquivo",
        F.col("data_carga").cast("string").alias("data_carga"),
        "cpfs_no_arquivo",
        "ucs_ineditas",
        "combos_processadas",
        F.greatest(F.col("ucs_ineditas") - done, F.lit(0)).alias("combos_pendentes"),
        "combos_ativas",
        _percent("combos_ativas", done).alias("pct_combos_ativas"),
        "combos_inativas",
        _percent("combos_inativas", done).alias("pct_combos_inativas"),
    )


def _percent(part: str, total: Column) -> Column:
    return F.when(total > 0, percent_text(F.col(part), total, "-")).otherwise(F.lit("-"))


def message_histogram(df: DataFrame, column: str | None = None) -> DataFrame:
    """Counts per exact message text, labelled in sentence case.

    Texts that differ only in case keep their own rows.
    """
    column = column or pick_message_column(df)
    text = trim_ws(F.col(column))
    return (
        df.where(reportable_message(F.col(column)))
        .groupBy(text.alias("_text"))
        .agg(F.count(F.lit(1)).alias("quantidade"))
        .select(sentence_case(F.col("_text")).alias("mensagem"), "quantidade")
        .orderBy(F.desc("quantidade"), "mensagem")
    )


def staging_state(rows: DataFrame) -> DataFrame:
    return rows.groupBy("staging_id", "validation_status").agg(
        F.count_if(F.col("processed_at").isNull()).alias("pendentes"), F.count(F.lit(1)).alias("total")
    )


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    counts = (
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)


def result_counters(results: DataFrame, clients: DataFrame) -> DataFrame:
    """Applied, skipped, phone and e-mail line counts of a result file.

    Lines are counted per key first; the client table meets the counts.
    """
    per_key = results.groupBy(trim_ws(F.col("rut")).alias("rut")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(phone_digits(F.col("telefone_validado")) != "").alias("tel"),
        F.count_if(trim_ws(F.col("email_validado")) != "").alias("mail"),
    )
    found = per_key.join(clients.select("rut", F.lit(True).alias("_hit")), "rut", "left")
    hit = F.col("_hit").isNotNull()

    def total(cond, c):
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("long")

    return found.agg(
        total(hit, "n").alias("ok"),
        total(~hit, "n").alias("skip"),
        total(hit, "tel").alias("telefones"),
        total(hit, "mail").alias("emails"),
        F.count_if(hit).alias("clientes"),
    )
