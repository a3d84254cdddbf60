"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

#: Stands for a null doc_id, which so sorts after every other id.
LAST_ID = 2**63 - 1
#: White space between words, as a Java and DuckDB character class.
BLANKS = "[\\x20\\x09-\\x0D]+"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def order_id(name: str = "doc_id") -> Column:
    """The id as a sortable, never-null long."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST_ID))


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(run: Callable[[Iterable], Iterator], *forget: Callable[[], None]) -> Callable[[Iterable], Iterator]:
    """The task function run, which gives free memory back at its end, after forget() of each cache.

    Python workers serve one task after another; what one leaves is missing to the next. Each forget
    is a function of a module. A function inside another one, like run, comes to a worker as a copy
    with globals of its own, so that what it clears by name is not what the module's functions use.
    """

    def task(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            for each in forget:
                each()
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return task


def id_bucket(modulus: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo modulus; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus
