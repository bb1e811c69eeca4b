"""WARC archives: a writer and a Python data source.

The source plans files into partitions, parses each record's header block
first and asks the pushed-down predicates (record type and other header
fields) before it looks at the body: a rejected record's body is skipped
(by seeking in a plain file, by discarding in a gzip stream) and never
decoded, and so is an accepted one's when payloads are not asked for.

The writer needs no Python: a record is a header block, an empty line, the
body and an empty line, so Spark's text writer with that separator writes
valid archives to any store Spark knows.

Defined cases: a null html is an empty payload; a null url leaves the target
out, line ends in it become blanks.  A null page_id is smaller than any other
when the response of equal payloads is chosen, and rows of one page_id with
equal payloads are alike (all response or all revisit).  An empty table gives
an archive without records.
"""
from __future__ import annotations

import gzip
import io
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, IsNull, StringContains, StringEndsWith,
                                    StringStartsWith)

from tidewell.session import ship_package

CRLF = "\r\n"
REVISIT_BYTES = 1000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# column -> header field, lower case
FIELDS = {"warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
          "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "warc_date": "warc-date"}
SCHEMA = ", ".join(f"{c} string" for c in FIELDS) + ", payload binary"
ARROW = pa.schema([(c, pa.string()) for c in FIELDS] + [("payload", pa.binary())])


# --- writing ---------------------------------------------------------------

def _http_head(length: Column) -> Column:
    return F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    length.cast("string"), F.lit(CRLF + CRLF))


def record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), digest,
                    F.lit(">"))


def records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, date: str = DATE) -> DataFrame:
    """One text column ``value``: the WARC record of each page.  Of pages with
    equal payloads of at least ``revisit_bytes``, the largest page_id is the
    response and the others revisit it."""
    payload = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(pages["page_id"], pages["url"].cast("string").alias("url"), payload.alias("payload"),
                        F.octet_length(payload).alias("n"), F.sha1(payload).alias("digest"))
    groups = (rows.filter(F.col("n") >= revisit_bytes).groupBy("digest", "n")
                  .agg(F.max("page_id").alias("response"), F.count("*").alias("rows")).filter("rows > 1")
                  .select("digest", "n", "response"))
    rows = rows.join(groups, ["digest", "n"], "left")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    head = _http_head(F.col("n"))
    body = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    fields = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "), record_id(F.col("page_id"), F.col("digest")),
        F.lit(f"{CRLF}WARC-Date: {date}"),
        F.coalesce(F.concat(F.lit(f"{CRLF}WARC-Target-URI: "), F.translate("url", CRLF, "  ")), F.lit("")),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "),
                                 record_id(F.col("response"), F.col("digest")))).otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http;msgtype=response{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(CRLF + CRLF))
    return rows.select(F.concat(fields, body).alias("value"))


def write_warc(pages: DataFrame, path: str, compression: str = "gzip", **params) -> None:
    records(pages, **params).write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)


# --- reading ---------------------------------------------------------------

def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    url = urlparse(path)
    if url.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(url.path)
    return pafs.FileSystem.from_uri(path)


class Files(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


def _test(f: Filter) -> Callable[[dict], bool] | None:
    """The predicate on a record's header fields, or None if it can't be asked of them."""
    column = getattr(f, "attribute", ())
    if len(column) != 1 or column[0] not in FIELDS:
        return None
    key, value = FIELDS[column[0]], getattr(f, "value", None)
    tests = {
        EqualTo: lambda h: h.get(key) == value, EqualNullSafe: lambda h: h.get(key) == value,
        In: lambda h: h.get(key) in value, IsNull: lambda h: key not in h, IsNotNull: lambda h: key in h,
        StringStartsWith: lambda h: h.get(key, "").startswith(value) and key in h,
        StringEndsWith: lambda h: h.get(key, "").endswith(value) and key in h,
        StringContains: lambda h: value in h.get(key, "") and key in h}
    return tests.get(type(f))


def _skip(stream, n: int) -> None:
    while n > 0:
        got = stream.read(min(n, 1 << 20))
        if not got:
            raise EOFError("a WARC record ends early")
        n -= len(got)


def _headers(stream) -> dict[str, str] | None:
    """The next record's header fields, lower-case names; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    out: dict[str, str] = {}
    last = None
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise EOFError("a WARC header ends early")
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and last:            # folded
            out[last] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def read_records(stream, tests, payload: bool, seek: bool = False) -> Iterator[tuple[dict, bytes | None]]:
    """(header fields, payload) of the records that pass ``tests``."""
    while (h := _headers(stream)) is not None:
        n = int(h.get("content-length", 0))
        if not all(t(h) for t in tests):
            wanted = False
        else:
            wanted = payload and h.get("warc-type") != "revisit"
            if not wanted:
                yield h, None
        if wanted:
            body = stream.read(n)
            if len(body) < n:
                raise EOFError("a WARC record ends early")
            if h.get("content-type", "").startswith("application/http"):
                body = body.partition(b"\r\n\r\n")[2]
            yield h, body
        elif seek:
            stream.seek(n, io.SEEK_CUR)
        else:
            _skip(stream, n)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", 8 << 20))
        self.tests: list = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            test = _test(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[Files]:
        fs, path = _filesystem(self.path)
        info = fs.get_file_info(path)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        files = sorted((x.path, x.size) for x in found
                       if x.type == pafs.FileType.File and x.size and x.base_name[0] not in "._")
        out, room = [], 0
        for name, size in files:
            if not out or size > room:
                out.append(Files([]))
                room = self.partition_bytes
            out[-1].files.append(name)
            room -= size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(self.path)
        rows, held = [], 0
        for name in partition.files:
            packed = name.endswith(".gz")
            raw = fs.open_input_stream(name, compression=None) if packed else fs.open_input_file(name)
            with raw, (gzip.open(raw) if packed else io.BufferedReader(raw)) as stream:
                for h, body in read_records(stream, self.tests, self.payload, seek=not packed):
                    rows.append([h.get(k) for k in FIELDS.values()] + [body])
                    held += len(body or b"")
                    if held > 4 << 20 or len(rows) >= 1000:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


class WarcSource(DataSource):
    """``spark.read.format("warc")``; options: payload (true), partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def pages_of(spark: SparkSession, path: str) -> DataFrame:
    """The pages in an archive: (page_id, payload_bytes, payload_digest,
    record_type, refers_to).  Length and digest of a response come from the
    payload read; a revisit takes those of its response."""
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]*):", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    full = read_warc(spark, path).filter(F.col("warc_type") == "response").select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"))
    revisits = read_warc(spark, path, payload=False).filter(F.col("warc_type") == "revisit").select(
        "record_id", "refers_to")
    known = full.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest"))
    again = revisits.join(known, "refers_to")
    return full.select(number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                       F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")
                       ).unionByName(again.select(
                           number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                           F.lit("revisit").alias("record_type"), number(F.col("refers_to")).alias("refers_to")))
