"""Web archives: WARC files from pages, capture runs read back from them, one globally ordered index.

Archives are written by Spark's text writer: a record's text, then CRLF CRLF, is the WARC format.
Every archive file yields a run of captures sorted by URL key and time; ranges of all runs are merged
by loser trees into capture histories.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from . import loser_tree
from .common import LAST_ID, materialize, order_id

#: Equal payloads from this size on are written once.
LEAST_REVISIT = 100
#: Captures merged at a time.
SHARD_CAPTURES = 100_000
#: Bytes of archive file that are unpacked at a time.
CHUNK = 1 << 20

CRLF = "\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# Writing


def _header_value(value: Column) -> Column:
    """A url as header value: no line breaks, blanks at the ends, or bare percent signs that reading would undo."""
    safe = F.regexp_replace(value, "%", "%25")
    for raw, escaped in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09")):
        safe = F.regexp_replace(safe, raw, escaped)
    return safe


def plan_records(pages: DataFrame) -> DataFrame:
    """(page, url, payload, digest, refers_to) per page; refers_to is the page whose record holds the same payload."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(order_id("page_id").alias("page"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    large = rows.where(F.octet_length("payload") >= LEAST_REVISIT)
    firsts = large.groupBy("digest").agg(F.min("page").alias("first_page"), F.count("*").alias("n")).where("n > 1").drop("n")
    refers = F.when(F.col("page") > F.col("first_page"), F.col("first_page"))
    return rows.join(firsts, "digest", "left").select("page", "url", "payload", "digest", refers.alias("refers_to"))


def record_text(records: DataFrame) -> DataFrame:
    """One text column: the WARC record of each row without its closing line breaks."""
    revisit = F.col("refers_to").isNotNull()
    shown = F.when(F.col("page") != LAST_ID, F.col("page").cast("string")).otherwise(F.lit(""))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    # No capture time is given: a page's place in the crawl, one second a page, stands for it.
    moment = F.timestamp_seconds(F.pmod(F.when(F.col("page") != LAST_ID, F.col("page")).otherwise(0), F.lit(2**32)))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), shown, F.lit(">")),
        F.concat(F.lit("WARC-Date: "), F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), _header_value(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")),
        F.when(revisit, f"WARC-Profile: {PROFILE}"),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
    ]
    head = F.concat_ws(CRLF, *lines)  # lines without a value fall out
    keys = ["page", "url", "digest", "refers_to"]
    return records.select(*keys, block.alias("block")).select(F.concat(head, F.lit(CRLF + CRLF), F.col("block")).alias("value"))


def write_archive(spark: SparkSession, pages: DataFrame) -> str:
    """Write a WARC record per page below the shared folder; gives the archive's folder.

    A file is one gzip stream of records; its size follows that of a shuffle partition.
    """
    path = work_path(spark, "archive")
    record_text(plan_records(pages)).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)
    return path


# Reading


class _Inflated:
    """Bytes of a gzip file, unpacked as they are asked for."""

    def __init__(self, packed: bytes) -> None:
        self.packed, self.read_to = memoryview(packed), 0
        self.gzip = zlib.decompressobj(31)
        self.buffer, self.position = bytearray(), 0

    def _more(self) -> bool:
        if self.gzip.eof:  # the next member, if any
            rest = self.gzip.unused_data
            if not rest and self.read_to == len(self.packed):
                return False
            self.gzip = zlib.decompressobj(31)
            self.buffer += self.gzip.decompress(rest)
            return True
        if self.read_to == len(self.packed):
            return False
        self.buffer += self.gzip.decompress(self.packed[self.read_to : self.read_to + CHUNK])
        self.read_to = min(len(self.packed), self.read_to + CHUNK)
        return True

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        if len(self.buffer) < n:
            raise ValueError(f"archive ends {n - len(self.buffer)} bytes early")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.position += n
        return out

    def until(self, mark: bytes) -> bytes:
        """What comes before mark, which is passed over; empty at the end."""
        found, searched = -1, 0
        while (found := self.buffer.find(mark, searched)) < 0:
            searched = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer:
                    raise ValueError("archive ends within a header")
                return b""
        return self.take(found + len(mark))[: -len(mark)]


def read_records(packed: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset in the unpacked file, headers, block) of each record of a gzip archive."""
    source = _Inflated(packed)
    while True:
        offset = source.position
        head = source.until(END)
        if not head:
            return
        version, *lines = head.decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {offset}")
        headers = dict(line.split(": ", 1) for line in lines)
        block = source.take(int(headers["Content-Length"]))
        if source.take(len(END)) != END:
            raise ValueError(f"record at byte {offset} does not end where it says")
        yield offset, headers, block


PAGE_URN = re.compile(r"<urn:page:(-?\d*)>")
RUNS = (
    "url_key string, captured string, file string, offset long, length long, page long, url string, "
    "record_type string, refers_to long, digest string, payload_bytes long"
)
_TYPES = [pa.int64() if part.endswith("long") else pa.string() for part in RUNS.split(", ")]
_NAMES = [part.split()[0] for part in RUNS.split(", ")]


def _page(urn: str | None) -> int | None:
    if urn is None:
        return None
    digits = PAGE_URN.fullmatch(urn)[1]
    return int(digits) if digits else LAST_ID


def url_key(url: str) -> str:
    """Sort key of a url: host labels from the last to the first, a bracket, then path and query."""
    rest = re.sub(r"^[^:/?#]*://", "", url).split("#", 1)[0]
    host = re.match(r"[^/?]*", rest)[0]
    labels = re.sub(r"^www[0-9]*\.", "", host.lower()).split(".")
    return ",".join(reversed(labels)) + ")" + rest[len(host) :]


def capture(file: str, offset: int, headers: dict[str, str], block: bytes) -> tuple:
    """Index row of a record; the digest of a payload that is there is made anew and compared."""
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    payload_bytes = None
    if headers["WARC-Type"] == "response":
        payload = block[block.index(END) + len(END) :]
        payload_bytes = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of the record at byte {offset} of {file} is damaged")
    url = headers.get("WARC-Target-URI")
    url = None if url is None else unquote(url)
    return (
        url_key(url or ""), headers["WARC-Date"], file, offset, int(headers["Content-Length"]),
        _page(headers["WARC-Record-ID"]), url, headers["WARC-Type"], _page(headers.get("WARC-Refers-To")), digest, payload_bytes,
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of an archive's records, sorted by (url_key, captured, offset) within each file.

    A file comes in whole and packed (up to 2 GB, the limit of a cell), is unpacked in pieces, and of
    its records only their index rows are kept.
    """

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                file = name.as_py().rsplit("/", 1)[-1]
                rows = sorted(capture(file, *record) for record in read_records(content.as_buffer()))
                columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(index, RUNS)


# Merging


ORDER = ["url_key", "captured", "file", "offset"]


def merge_runs(spark: SparkSession, runs: DataFrame) -> DataFrame:
    """Capture histories: all captures in order of (url_key, captured, file, offset).

    `shard` and `place` number the order: every shard is a range of the whole key, so captures of one
    url may fill many shards, and it merges the runs that reach into it.
    """

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches([b]) for b in batches]
        if not tables:
            return
        table = pa.concat_tables(tables)
        keys = list(zip(*(table[c].to_pylist() for c in ORDER), strict=True))
        order = pa.array(loser_tree.merge(keys, loser_tree.sorted_runs(keys)), pa.int64())
        table = table.take(order).append_column("place", pa.array(range(len(keys)), pa.int64())).combine_chunks()
        yield from table.to_batches(max_chunksize=10_000)

    ranges = max(1, -(-runs.count() // SHARD_CAPTURES))
    dealt = runs.repartitionByRange(ranges, *ORDER).withColumn("shard", F.spark_partition_id())
    return dealt.mapInArrow(merged, f"{RUNS}, shard int, place long")


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Capture histories of pages that were written to archives and read back, revisits with the size they refer to.

    A null html is empty, a null url stays null and has the key of an empty one. A null page_id sorts
    after all others and is null in the result. Of equal payloads of LEAST_REVISIT bytes or more the
    smallest page_id is the response; rows that repeat it with the same payload are responses too.
    Repeated rows are records of their own. Extra columns are ignored; an empty table gives an empty
    archive. A page is one record whatever its size, up to the 2 GB of a cell.
    """
    runs = materialize(spark, read_runs(spark, write_archive(spark, pages)), "runs")
    histories = merge_runs(spark, runs)
    sizes = runs.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.first("payload_bytes").alias("held_bytes"))
    # Only revisits need a size, and each refers to one response.
    referred = runs.where("record_type = 'revisit'").select("digest").distinct().join(sizes, "digest")
    found = histories.join(referred, "digest", "left")
    shown = F.when(F.col("page") != LAST_ID, F.col("page"))
    return found.select(
        shown.alias("page_id"),
        "url",
        "url_key",
        "captured",
        "shard",
        "place",
        "file",
        "offset",
        "length",
        "record_type",
        "refers_to",
        F.col("digest").alias("payload_digest"),
        F.coalesce("payload_bytes", "held_bytes").alias("payload_bytes"),
    )
