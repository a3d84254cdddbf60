"""The file jobs as streams.

Every batch writes to a folder named by its batch id and overwrites it, so a
batch that runs again after a failure leaves the same result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.outcome import FINAL_OUTCOMES, code_status, result_code
from ..functions.text import trim_ws
from ..operators.keyed import insert_ignore, last_per_key
from ..operators.state import result_rows
from ..schemas import LOGGED
from ..sources.catalog import BUCKET_PARTS, LOG_PARTS, Catalog
from ..sources.files import RESULT_SCHEMA, matches, read_results

#: Signs in a file's name that a reader would take as a pattern.
GLOB_SIGNS = re.compile(r"[\\{}\[\]*?]")

#: Buckets of the keys that a first-wins stream remembers.
KEY_BUCKETS = 256

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def land(df: DataFrame, path: str) -> tuple[str, StructType]:
    """Writes a stream's source files; returns their path and schema."""
    df.write.mode("append").parquet(path)
    return path, df.schema


def _source(spark: SparkSession, source: tuple[str, StructType], files_per_batch: int | None) -> DataFrame:
    path, schema = source
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _run(writer, checkpoint: str) -> None:
    """Processes everything that has arrived, then stops."""
    stream = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()


def ingest_results(spark: SparkSession, glob: str, out: str, checkpoint: str) -> None:
    """Each result file once, a folder per batch; columns go by name in each file, as in read_results.

    The stream finds the files and only takes their paths; the lines are read per batch.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        paths = [GLOB_SIGNS.sub(r"\\\g<0>", r.path) for r in batch.select("path").distinct().collect()]
        if paths:
            read_results(spark, paths).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    found = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).load(glob).select("path")
    _run(found.writeStream.foreachBatch(step), checkpoint)


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """All ingested lines; a column that a batch lacks is ''."""
    if not matches(spark, f"{out}/batch=*"):
        return spark.createDataFrame([], RESULT_SCHEMA)
    lines = spark.read.option("mergeSchema", True).parquet(f"{out}/batch=*")
    return lines.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in lines.columns))


def apply_stream(
    spark: SparkSession,
    source: tuple[str, StructType],
    state: DataFrame,
    clients: DataFrame,
    base: str,
    checkpoint: str,
    order: list[str],
    now: str,
    files_per_batch: int | None = None,
) -> None:
    """Result lines applied to the state: a batch writes the rows that it changes or adds.

    The commit of a batch carries its number, so one that runs again finds itself applied.
    """
    catalog = Catalog(state.sparkSession, base)
    schema = state.schema
    if not catalog.holds("state"):
        with catalog.commit() as c:
            c.replace("state", state, LOGGED["state"])
    stamp = F.lit(now).cast("timestamp_ntz")

    def step(batch: DataFrame, batch_id: int) -> None:
        with catalog.commit("results", batch_id) as c:
            if not c.replayed:
                rows = result_rows(catalog.read("state", schema, c.before), batch, clients, order, stamp)
                c.change("state", rows, LOGGED["state"])
        if len(catalog.version()["tables"]["state"]["log"]) > LOG_PARTS:
            catalog.fold("state", schema)

    _run(_source(spark, source, files_per_batch).writeStream.foreachBatch(step), checkpoint)


def read_state(spark: SparkSession, base: str) -> DataFrame:
    catalog = Catalog(spark, base)
    return catalog.read("state", catalog.schema("state"))


def first_wins(
    spark: SparkSession,
    source: tuple[str, StructType],
    out: str,
    checkpoint: str,
    keys: list[str],
    order: list[str],
    files_per_batch: int | None = None,
    buckets: int = KEY_BUCKETS,
) -> None:
    """Rows whose key no earlier line or batch has stored.

    The memory is a table of keys in hash buckets, of which a batch opens those that its own keys
    fall into; stored rows are not read again. A batch writes its rows, then publishes its keys with
    its number: one that died in between has published no key and writes the same rows once more.
    """
    _, schema = source
    known = ", ".join(f"`{k}` {schema[k].dataType.simpleString()}" for k in keys)
    memory = Catalog(spark, f"{checkpoint}-keys")

    def step(batch: DataFrame, batch_id: int) -> None:
        with memory.commit("rows", batch_id) as c:
            if c.replayed:
                return
            touched = c.buckets_of(batch, keys, buckets)
            stored = memory.read_buckets("keys", known, touched, c.before)
            path = f"{out}/batch={batch_id}"
            insert_ignore(stored, batch, keys, order).write.mode("overwrite").parquet(path)
            fresh = batch.sparkSession.read.schema(schema).parquet(path).select(*keys)
            held = c.before["tables"].get("keys", {}).get("buckets", {})
            long = [n for n in touched if len(held.get(str(n), [])) >= BUCKET_PARTS]
            if long:  # buckets of many small files are written anew with what is added
                fresh = fresh.unionByName(memory.read_buckets("keys", known, long, c.before))
            c.put_buckets("keys", fresh, keys, buckets, long)

    _run(_source(spark, source, files_per_batch).writeStream.foreachBatch(step), checkpoint)


def _write_updates(out: str):
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return step


def daily_rollup(
    spark: SparkSession,
    source: tuple[str, StructType],
    out: str,
    checkpoint: str,
    time: str,
    dims: list[str],
    lateness: str = "1 day",
    files_per_batch: int | None = None,
) -> None:
    """Rows per day and dimension, kept fresh; rows later than `lateness` are dropped."""
    counts = (
        _source(spark, source, files_per_batch)
        .withWatermark(time, lateness)
        .groupBy(F.window(time, "1 day"), *dims)
        .agg(F.count(F.lit(1)).alias("qtd"))
        .select(F.to_date("window.start").alias("dia"), *dims, "qtd")
    )
    _run(counts.writeStream.outputMode("update").foreachBatch(_write_updates(out)), checkpoint)


def _updates(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*")


def read_rollup(spark: SparkSession, out: str, dims: list[str]) -> DataFrame:
    """The newest count per day and dimension."""
    keys = ["dia", *dims]
    return last_per_key(_updates(spark, out), keys, ["batch"]).select(*keys, "qtd")


def key_states(
    spark: SparkSession, source: tuple[str, StructType], out: str, checkpoint: str, files_per_batch: int | None = None
) -> None:
    """Per key: the first final outcome, the last retry and the lines seen.

    The three aggregates are the whole state of a key, and lines combine
    before the shuffle.
    """
    code = result_code(*(F.col(c) for c in ("sucesso", "telefone_validado", "email_validado", "erro")))
    lines = _source(spark, source, files_per_batch).select(
        trim_ws(F.col("rut")).alias("rut"), code.alias("code"), "line_no"
    )
    final_at = F.when(F.col("code").isin(FINAL_OUTCOMES), F.col("line_no"))
    states = lines.where(F.col("rut") != "").groupBy("rut").agg(
        F.min_by("code", final_at).alias("final"),
        F.max_by("code", "line_no").alias("last"),
        F.count(F.lit(1)).alias("tentativas"),
    )
    _run(states.writeStream.outputMode("update").foreachBatch(_write_updates(out)), checkpoint)


def read_key_states(spark: SparkSession, out: str) -> DataFrame:
    newest = last_per_key(_updates(spark, out), ["rut"], ["batch"])
    code = F.coalesce("final", "last")
    return newest.select("rut", code.alias("resposta_id"), code_status(code).alias("status"), "tentativas")
