"""Stored tables that change by little: one manifest names the folders of every table.

Rows are written to new folders, which nobody reads until a commit names them; one commit can
publish several tables. A version is a manifest file that is created once, so of two writers one
fails, and a job that dies leaves the tables as they were. A pointer says where to start looking for
the newest version, so no folder is listed.

A table is held in one of three ways:

* parts: folders of rows that are added, or replaced as a whole;
* a base and a log of changed rows by key: a change writes the changed rows alone, a reader takes
  the newest of each key, and the log is folded into a new base once it has many parts;
* buckets by hash of a key: an update opens and writes the buckets that its keys fall into.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Parts of a log, and of a bucket, beyond which they are folded.
LOG_PARTS, BUCKET_PARTS = 16, 16
#: Changes of one table in one commit.
PER_COMMIT = 1000
SEQ, BUCKET = "change_no", "bucket_no"


class Conflict(RuntimeError):
    """Another writer has published the version that this one meant to publish."""


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class Catalog:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    # Manifests

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _fs(self):
        return self._path("versions").getFileSystem(self._conf)

    def _load(self, name: str) -> str | None:
        path = self._path(name)
        fs = self._fs()
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _put(self, name: str, content: str, once: bool) -> None:
        """Write a small file in one step; with once, fail if it is there."""
        spare = self._path(f"versions/.{uuid.uuid4().hex}")
        stream = self._fs().create(spare)
        try:
            stream.write(content.encode())
        finally:
            stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark._sc._gateway.new_array(rename, 1)
        options[0] = rename.NONE if once else rename.OVERWRITE
        qualified = self._path(name).makeQualified(self._fs().getUri(), self._fs().getWorkingDirectory())
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), self._conf)
        try:
            context.rename(spare, self._path(name), options)
        except Exception as e:
            self._fs().delete(spare, False)
            if once and self._fs().exists(self._path(name)):
                raise Conflict(name) from e
            raise

    def version(self) -> dict:
        """The newest manifest: number, tables, applied batches."""
        number = int(self._load("versions/newest") or 0)
        while self._fs().exists(self._path(f"versions/{number + 1}.json")):
            number += 1  # the pointer may lag behind a writer that died
        return json.loads(self._load(f"versions/{number}.json")) if number else {"number": 0, "tables": {}, "applied": {}}

    def publish(self, manifest: dict) -> None:
        self._put(f"versions/{manifest['number']}.json", json.dumps(manifest), once=True)
        self._put("versions/newest", str(manifest["number"]), once=False)

    # Reading

    def holds(self, name: str) -> bool:
        return name in self.version()["tables"]

    def schema(self, name: str) -> StructType:
        """The schema that a stored table was last replaced with."""
        return self.spark.read.parquet(self.version()["tables"][name]["parts"][0]).schema

    def read(self, name: str, schema: str | StructType, version: dict | None = None) -> DataFrame:
        """All rows of a table as of a version (the newest by default); no rows if it was never written."""
        table = (version or self.version())["tables"].get(name)
        empty = self.spark.createDataFrame([], schema)
        if table is None:
            return empty
        parts = [p for found in table["buckets"].values() for p in found] if "buckets" in table else table["parts"]
        rows = self.spark.read.schema(empty.schema).parquet(*parts) if parts else empty
        if not table.get("log"):
            return rows
        changed = self._newest(table, empty)
        return rows.join(changed.select(table["key"]), table["key"], "left_anti").unionByName(changed)

    def _newest(self, table: dict, empty: DataFrame) -> DataFrame:
        key = table["key"]
        log = self.spark.read.schema(empty.withColumn(SEQ, F.lit(0).cast("long")).schema).parquet(*table["log"])
        if len(table["log"]) == 1:
            return log.drop(SEQ)
        row = F.struct(*(c for c in empty.columns if c != key))
        return log.groupBy(key).agg(F.max_by(row, SEQ).alias("_row")).select(key, "_row.*").select(*empty.columns)

    def read_buckets(self, name: str, schema: str, numbers: list[int], version: dict | None = None) -> DataFrame:
        """The rows of some buckets; the files of the others stay closed."""
        table = (version or self.version())["tables"].get(name, {"buckets": {}})
        parts = [p for n in numbers for p in table["buckets"].get(str(n), [])]
        empty = self.spark.createDataFrame([], schema)
        return self.spark.read.schema(empty.schema).parquet(*parts) if parts else empty

    # Writing

    @contextmanager
    def commit(self, source: str | None = None, batch: int = 0):
        """Changes that are published together when the block ends well.

        A source names a stream and batch its number: `replayed` tells a block that it was published before.
        """
        changes = Changes(self, source, batch)
        yield changes
        changes.finish()

    def fold(self, name: str, schema: str | StructType) -> None:
        """Write a table's base anew from its log."""
        with self.commit() as c:
            c.replace(name, self.read(name, schema, c.before), key=c.before["tables"][name].get("key"))

    def clean(self) -> int:
        """Remove the folders that the newest version does not name; readers of earlier versions must have ended."""
        tables = self.version()["tables"]
        named = {p for t in tables.values() for p in [*t.get("parts", []), *t.get("log", [])]}
        named |= {p for t in tables.values() for found in t.get("buckets", {}).values() for p in found}
        top = {p.split(f"/{BUCKET}=")[0] for p in named}
        removed = 0
        for name in tables:
            for status in self._fs().listStatus(self._path(name)):
                if f"{self.folder}/{name}/{status.getPath().getName()}" not in top:
                    removed += self._fs().delete(status.getPath(), True)
        return removed


class Changes:
    def __init__(self, catalog: Catalog, source: str | None, batch: int) -> None:
        self.catalog, self.before = catalog, catalog.version()
        self.number = self.before["number"] + 1
        self.tables = json.loads(json.dumps(self.before["tables"]))
        self.applied = dict(self.before["applied"])
        self.replayed = source is not None and self.applied.get(source, -1) >= batch
        if source is not None and not self.replayed:
            self.applied[source] = batch
        self.steps = 0

    def _write(self, name: str, rows: DataFrame, by: str | None = None) -> str:
        path = f"{self.catalog.folder}/{name}/{self.number}-{uuid.uuid4().hex[:8]}"
        writer = rows.write.mode("error")
        (writer.partitionBy(by) if by else writer).parquet(path)
        return path

    def read(self, name: str, schema: str | StructType) -> DataFrame:
        """The table as this commit would leave it."""
        return self.catalog.read(name, schema, {"tables": self.tables})

    def append(self, name: str, rows: DataFrame) -> None:
        self.tables.setdefault(name, {"parts": []})["parts"].append(self._write(name, rows))

    def replace(self, name: str, rows: DataFrame, key: str | None = None) -> None:
        self.tables[name] = {"parts": [self._write(name, rows)]} | ({"key": key, "log": []} if key else {})

    def change(self, name: str, rows: DataFrame, key: str) -> None:
        """Rows that are new or differ from what is stored, one per key and whole; nothing else is written."""
        self.steps += 1
        table = self.tables.setdefault(name, {"parts": []})
        if table.setdefault("key", key) != key:
            raise ValueError(f"{name} is kept by {table['key']}, not by {key}")
        seq = F.lit(self.number * PER_COMMIT + self.steps).cast("long")
        table.setdefault("log", []).append(self._write(name, rows.withColumn(SEQ, seq)))

    def buckets_of(self, rows: DataFrame, keys: list[str], buckets: int) -> list[int]:
        """Numbers of the buckets that rows fall into; at most `buckets` of them reach the driver."""
        return sorted(r[0] for r in rows.select(bucket_of(keys, buckets)).distinct().collect())

    def put_buckets(
        self, name: str, rows: DataFrame, keys: list[str], buckets: int, emptied: list[int] = ()
    ) -> list[int]:
        """Write rows to their buckets, beside what these hold, after taking `emptied` out; gives the numbers written.

        A bucket that adaptive execution finds too large is written by several tasks.
        """
        table = self.tables.setdefault(name, {"buckets": {}, "count": buckets, "keys": keys})
        if (table["count"], table["keys"]) != (buckets, keys):
            raise ValueError(f"{name} has {table['count']} buckets by {table['keys']}")
        path = self._write(name, rows.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", F.col(BUCKET)), BUCKET)
        names = [s.getPath().getName() for s in self.catalog._fs().listStatus(self.catalog._jvm.org.apache.hadoop.fs.Path(path))]
        written = sorted(int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}="))
        for n in emptied:
            table["buckets"].pop(str(n), None)
        for n in written:
            table["buckets"].setdefault(str(n), []).append(f"{path}/{BUCKET}={n}")
        return written

    def update(
        self, name: str, schema: str, delta: DataFrame, keys: list[str], buckets: int, step: Callable[[DataFrame, DataFrame], DataFrame]
    ) -> list[int]:
        """Replace the buckets that delta's keys fall into by step(their rows, delta); gives their numbers."""
        touched = self.buckets_of(delta, keys, buckets)
        stored = self.catalog.read_buckets(name, schema, touched, self.before)
        self.put_buckets(name, step(stored, delta), keys, buckets, touched)
        return touched

    def mark(self, name: str, value) -> None:
        """A small value of its own, published with the tables."""
        self.applied[name] = value

    def finish(self) -> None:
        if self.tables != self.before["tables"] or self.applied != self.before["applied"]:
            self.catalog.publish({"number": self.number, "tables": self.tables, "applied": self.applied})
