"""Delimited file sources and sinks. Every field is read as text."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import CUSTOMER_FILE

BOM = "﻿"
LINE_ORDER = ["file_path", "block_start", "row_seq"]


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "UTF-8",
    multiline: bool = False,
    positions: bool = False,
    header: list[str] | None = None,
) -> DataFrame:
    """`;` file with a header; absent fields are ''.

    `positions` adds the columns of LINE_ORDER, which sort lines as they
    stand in the files: rows of one block are read in order by one task.
    `multiline` reads fields with quoted line breaks; such files are not
    split. `header` names the columns in place of the first file's header.
    """
    reader = spark.read
    if header:
        reader = reader.schema(", ".join(f"`{c}` string" for c in header))
    raw = (
        reader.option("sep", ";")
        .option("header", True)
        .option("inferSchema", False)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    names = [c.strip().removeprefix(BOM) for c in raw.columns]
    fields = [
        F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in zip(raw.columns, names, strict=True)
    ]
    if positions:
        fields += [
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("row_seq"),
        ]
    return raw.select(*fields)


def with_line_no(df: DataFrame) -> DataFrame:
    """0-based line number over all files in name order.

    Ranked inside each file block; block counts give the starting number.
    """
    block = ["file_path", "block_start"]
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*block)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*block).orderBy("row_seq")
    return (
        df.join(starts, block)
        .withColumn("line_no", F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_start", *LINE_ORDER)
    )


def read_customers(
    spark: SparkSession, path, encoding: str = "ISO-8859-1", positions: bool = False, multiline: bool = False
) -> DataFrame:
    df = read_delimited(spark, path, encoding, multiline, positions)
    return df.withColumnRenamed("FECHA NAC", "fecha_nac")


def headers(spark: SparkSession, path) -> DataFrame:
    """First line of each file: columns file_path and header."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_seq"),
        "value",
    )
    return lines.where("block_start = 0").groupBy("file_path").agg(F.min_by("value", "row_seq").alias("header"))


def _names(header: str) -> list[str]:
    return [c.strip().lower() for c in next(csv.reader([header.removeprefix(BOM)], delimiter=";"), [])]


def read_results(spark: SparkSession, path, positions: bool = False, multiline: bool = False) -> DataFrame:
    """One or many result files; pass a glob, an explicit file or a list of files.

    Columns go by name in each file: files are read grouped by header, and a
    column that a file lacks is ''. A glob without files is an empty table, as
    are files without any line; a missing explicit file fails.
    """
    if "*" in path and not matches(spark, path):
        return spark.createDataFrame([], RESULT_SCHEMA)
    first = headers(spark, path)
    kinds = sorted(r.header for r in first.select("header").distinct().collect())
    if not kinds:
        return spark.createDataFrame([], RESULT_SCHEMA)
    if len({tuple(_names(k)) for k in kinds}) < 2:
        df = read_delimited(spark, path, multiline=multiline, positions=positions)
        return df.toDF(*(c.lower() for c in df.columns))
    parts = []
    for kind in kinds:
        files = [r.file_path for r in first.where(F.col("header") == kind).select("file_path").collect()]
        lines = read_delimited(spark, path, multiline=multiline, positions=True, header=_names(kind))
        parts.append(lines.where(F.col("file_path").isin(files)))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [c for c in df.columns if c not in LINE_ORDER]
    return df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in names), *(LINE_ORDER if positions else []))


RESULT_SCHEMA = (
    "rut string, dv string, telefone_validado string, email_validado string, sucesso string, erro string"
)


def matches(spark: SparkSession, glob: str) -> bool:
    """Whether any path matches the glob."""
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_history(spark: SparkSession, path) -> DataFrame:
    return read_delimited(spark, path).select("cpf", "uc", "distribuidora_id", "resposta_id")


def read_table_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options
) -> DataFrame:
    """A live table read in key ranges, one per task."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, numPartitions=str(partitions))
        .options(lowerBound=str(lower), upperBound=str(upper), **options)
        .load()
    )


def write_delimited(
    df: DataFrame, path: str, encoding: str = "UTF-8", bom: bool = False, single_file: bool = False, sep: str = ";",
    mode: str = "error",
) -> str:
    """Writes text columns with a header; NULL and '' become empty fields.

    `bom` prefixes the header with a byte-order mark. `single_file` is for
    files whose size is bounded by a report or a batch limit. `mode` says
    what happens to an earlier file of that name.
    """
    out = df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns))
    if bom:
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    if single_file:
        out = out.coalesce(1)
    (
        out.write.option("sep", sep)
        .option("header", True)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .mode(mode)
        .csv(path)
    )
    return path


def write_customers(raw: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    df = raw.withColumnRenamed("fecha_nac", "FECHA NAC").select(*CUSTOMER_FILE)
    return write_delimited(df, path, encoding)


def write_results(results: DataFrame, path: str, reverse: bool = False, **options) -> str:
    """Result file; `reverse` writes the columns in reverse order."""
    names = RESULT_SCHEMA.replace(" string", "").split(", ")[:: -1 if reverse else 1]
    return write_delimited(results.select(*(F.col(c).alias(c.upper()) for c in names)), path, **options)


def write_batch(batch: DataFrame, path: str, now, dry_run: bool = False) -> dict[str, str]:
    """Hand-off of a claimed batch: the work file and its metadata.

    The batch has a row limit, so one file each; a dry run writes nothing.
    """
    where = {"work": f"{path}/work", "meta": f"{path}/meta"}
    if dry_run:
        return where
    write_delimited(batch.select("cpf", "codigo cliente", "empresa"), where["work"], single_file=True, sep=",")
    total = batch.agg(F.count(F.lit(1))).scalar()
    records = batch.select(
        now.alias("gerado_em"),
        total.alias("total"),
        F.lit(dry_run).alias("dry_run"),
        F.struct("macro_id", "cpf", "codigo cliente", "empresa", "fornecedor").alias("registro"),
    )
    records.coalesce(1).write.json(where["meta"])
    return where


def export_path(folder: str, today) -> str:
    return f"{folder}/extracao_{today:%Y-%m-%d}.csv"


