"""Web archives: legacy ARC files to WARC, written and read by Spark.

An ARC file starts with a version block that names the fields of the header lines after it: five in
version 1, ten in version 2. A record is one header line, whose last field is the declared length,
and so many bytes. ``arc_to_warc`` walks the declared lengths and makes the matching WARC fields: an
identifier from archive name and offset, the timestamp, the type and the payload's digest. Records
whose payload occurs before (by the smallest ``X-Page-Id``) become revisits without a payload.

WARC files are Spark text files whose line separator is the blank lines that end a record, gzipped or
not, so any file system that Spark writes to will do. They are read whole, one file per row, and
unpacked as a stream. A file has at most ``records_per_file`` records, and fewer where the mean payload
(measured in the pass that looks for repeated payloads) would take it past ``file_bytes``.

Defined cases: null html is an empty payload; a null url is archived as ``-`` and has no target URI; a null
page_id has no id header, is never the first of its payload unless all are, and is never referred to;
rows repeated under the first page_id are all responses; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from greenlane.llm.common import shared_path, slices, table, written

CHUNK_BYTES, RECORDS_PER_FILE, FILE_BYTES, BROADCAST_ROWS = 4 << 20, 20_000, 256 << 20, 100_000
#: Rows that hold whole archives: a row group for each, however well it compresses, so writers and readers hold one archive at a
#: time. Parquet's own bounds are looked at after a hundred rows only, which are 400 MB of archives.
ARCHIVE_ROWS = {"parquet.block.size": "1", "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}
CAPTURED = "20260101000000"
#: The fields of ARC header lines by version.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ARC ---------------------------------------------------------------------------------------


def arc_start(name: str, version: int) -> bytes:
    """The version block of an archive."""
    body = f"{version} 0 greenlane\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    middle = " 200 - - 0 " + name if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {CAPTURED} text/plain{middle} {len(body)}\n".encode() + body


def arc_record(url: str | None, page_id: int | None, html: str | None, name: str, offset: int, version: int) -> bytes:
    """One record: header line, HTTP header with the page's id, payload."""
    page = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    payload = (html or "").encode()
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{page}\r\n".encode() + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "-")
    middle = f" 200 {digest(payload)} - {offset} {name}" if version == 2 else ""
    return f"{target} 0.0.0.0 {CAPTURED} text/html{middle} {len(body)}\n".encode() + body + b"\n"


def parse_arc(data: BinaryIO, name: str) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(header fields, offset, content) of each record after the version block, by declared lengths.

    The number of fields comes from the block; a url with spaces keeps them (fields count from the right).
    """
    head = data.readline()
    if not head.startswith(b"filedesc://"):
        raise ValueError(f"{name}: no version block")
    block = data.read(int(head.rsplit(b" ", 1)[1]))
    fields = block.split(b"\n")[1].decode().split(" ")
    at = len(head) + len(block)
    while line := data.readline():
        if line.strip():
            values = line.rstrip(b"\r\n").decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
            if len(values) != len(fields) or not values[-1].isdigit():
                raise ValueError(f"{name}: bad header at {at}: {line[:80]!r}")
            content = data.read(int(values[-1]))
            if len(content) != int(values[-1]):
                raise ValueError(f"{name}: record at {at} ends early")
            yield dict(zip(fields, values, strict=True)), at, content
            at += len(content)
        at += len(line)


def pages_to_arc(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(name, content): the pages as ARC archives of about ``chunk_bytes``, both versions in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        name, out = f"part-{part:06d}-{n:06d}.arc", bytearray()
        done = lambda: pa.RecordBatch.from_arrays([pa.array([name]), pa.array([bytes(out)], pa.binary())], names=["name", "content"])
        for batch in batches:
            for rows in slices(batch, 256, chunk_bytes):
                for page_id, url, html in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    version = 1 + n % 2
                    if not out:
                        out += arc_start(name, version)
                    out += arc_record(url, page_id, html, name, len(out), version)
                    if len(out) >= chunk_bytes:
                        yield done()
                        n += 1
                        name, out = f"part-{part:06d}-{n:06d}.arc", bytearray()
        if out:
            yield done()

    return pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html")).mapInArrow(
        run, "name string, content binary")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of ARC files, gzipped or not."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def values(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """The rows of a batch of files, one file copied at a time."""
    return ((name.as_py(), content.as_py()) for name, content in zip(*batch.columns, strict=True))


def opened(content: bytes) -> BinaryIO:
    return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


# --- conversion --------------------------------------------------------------------------------

HEAD_SCHEMA = "record_id string, date string, uri string, ip string, kind string, mime string, page_id long, head string, payload_digest string, payload_bytes long"


def http_parts(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its blank line) and payload; a content without an HTTP header is all payload."""
    if content.startswith(b"HTTP/"):
        at = content.find(b"\r\n\r\n")
        if at >= 0:
            return content[: at + 4], content[at + 4:]
    return b"", content


def page_of(head: bytes) -> int | None:
    m = re.search(rb"^X-Page-Id: (-?\d+)\r$", head, re.M)
    return int(m[1]) if m else None


def arc_to_warc(arcs: DataFrame, payloads: bool = True) -> DataFrame:
    """WARC fields of each ARC record; with ``payloads`` also the payload (binary).

    Types: ``response`` where the content is an HTTP message, else ``resource``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in values(batch):
                rows = []
                for fields, at, body in parse_arc(opened(content), name):
                    head, payload = http_parts(body)
                    stamp = fields["Archive-date"].ljust(14, "0")
                    row = (f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}')}>",
                           f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z",
                           fields["URL"], fields["IP-address"], "response" if head else "resource",
                           "application/http;msgtype=response" if head else fields["Content-type"], page_of(head), head.decode("latin-1"), digest(payload), len(payload))
                    rows.append((*row, payload) if payloads else row)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    schema = HEAD_SCHEMA + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in schema.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]] for f in schema.split(", ")]
    return arcs.mapInArrow(run, schema)


def revisited(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(payload_digest, first_*): the first record of each payload that occurs more than once."""
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "record_id", "uri", "date"))
    groups = heads.filter((F.col("payload_bytes") >= min_bytes) & (F.col("kind") == "response")).groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), first.alias("f"))
    return groups.filter("n > 1").select("payload_digest", *[F.col(f"f.{c}").alias(f"first_{c}") for c in ("page_id", "record_id", "uri", "date")])


def warc_text(records: DataFrame) -> DataFrame:
    """One column of whole records without their closing blank lines, revisits by ``first_record_id``."""
    again = F.col("first_record_id").isNotNull() & (F.col("kind") == "response") & ~F.col("page_id").eqNullSafe(F.col("first_page_id")) & (
        F.col("record_id") != F.col("first_record_id"))
    body = F.when(F.col("again"), F.lit("").cast("binary")).otherwise(F.col("payload"))
    size = F.octet_length("head") + F.octet_length(body)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    only = lambda test, column: F.when(test, column).otherwise("")
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(F.col("again"), "revisit").otherwise(F.col("kind"))), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")), only(F.col("uri") != "-", line("WARC-Target-URI", F.col("uri"))), line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        only(F.col("again"), F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", F.col("first_record_id")),
                                      only(F.col("first_uri") != "-", line("WARC-Refers-To-Target-URI", F.col("first_uri"))), line("WARC-Refers-To-Date", F.col("first_date")))),
        line("Content-Type", F.col("mime")), line("Content-Length", size.cast("string")), F.lit("\r\n"))
    return records.withColumn("again", F.coalesce(again, F.lit(False))).select(
        F.concat(header.cast("binary"), F.col("head").cast("binary"), body).cast("string").alias("value"))


def write_warc(arcs: DataFrame, path: str, compression: str = "gzip", records_per_file: int = RECORDS_PER_FILE, min_bytes: int = 0,
               file_bytes: int = FILE_BYTES, broadcast_rows: int = BROADCAST_ROWS) -> None:
    """Convert ARC archives and write WARC files to ``path``; up to ``broadcast_rows`` repeated payloads are broadcast."""
    seen = Observation("warc-payloads")
    heads = arc_to_warc(arcs, payloads=False).observe(seen, F.avg("payload_bytes").alias("mean"))
    first = written(revisited(heads, min_bytes), "warc-first")
    records_per_file = max(1, min(records_per_file, int(file_bytes / max(1.0, seen.get["mean"] or 0.0))))
    records = arc_to_warc(arcs)
    if first.limit(broadcast_rows + 1).count() <= broadcast_rows:
        first = F.broadcast(first)
    text = warc_text(records.join(first, "payload_digest", "left"))
    text.write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path)


# --- reading -----------------------------------------------------------------------------------


def parse_warc(data: BinaryIO, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record, by declared lengths."""
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: not a record: {line[:80]!r}")
        fields = {}
        while (line := data.readline()).strip():
            key, _, value = line.decode().partition(":")
            fields[key.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = data.read(size)
        if len(block) != size:
            raise ValueError(f"{name}: a record ends early")
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, page_id, uri, payload_digest, payload_bytes (null for revisits), refers_to_id.

    A payload that does not have its declared digest fails the read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in values(batch):
                rows = []
                for fields, block in parse_warc(opened(content), name):
                    head, payload = http_parts(block)
                    said, again = fields.get("warc-payload-digest", "").removeprefix("sha1:"), fields["warc-type"] == "revisit"
                    if not again and said and digest(payload) != said:
                        raise ValueError(f"{name}: {fields['warc-record-id']} does not have its digest")
                    rows.append((fields["warc-record-id"], fields["warc-type"], page_of(head), fields.get("warc-target-uri"), said, None if again else len(payload), fields.get("warc-refers-to")))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    schema = "record_id string, record_type string, page_id long, uri string, payload_digest string, payload_bytes long, refers_to_id string"
    names = [f.split()[0] for f in schema.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64()}[f.split()[1]] for f in schema.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of read records."""
    def cols(bytes_: Column, to: Column) -> list:
        return ["page_id", bytes_.alias("payload_bytes"), "payload_digest", "record_type", to.cast("long").alias("refers_to")]

    firsts = records.filter("record_type != 'revisit'")
    target = firsts.select(F.col("record_id").alias("refers_to_id"), F.col("payload_bytes").alias("first_bytes"), F.col("page_id").alias("first_page"))
    again = records.filter("record_type = 'revisit'").join(target, "refers_to_id", "left")
    return firsts.select(*cols(F.col("payload_bytes"), F.lit(None))).unionByName(again.select(*cols(F.col("first_bytes"), F.col("first_page"))))


def op8_warc(spark, sf_dir: str) -> DataFrame:
    arcs = written(pages_to_arc(table(spark, sf_dir, "pages")), "arc", ARCHIVE_ROWS)
    path = shared_path(spark, "warc")
    write_warc(arcs, path)
    return resolved(written(read_warc(spark, path), "warc-read"))


_B32 = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr(sha, {at}, 5) as bigint) >> {shift}) & 31), 1)"
ORACLE_SQL = f"""
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
d as (select page_id, octet_length(body) as payload_bytes, sha1(body) as sha from p),
r as (select page_id, payload_bytes, {' || '.join(_B32.format(at=1 + 5 * k, shift=s) for k in range(8) for s in (15, 10, 5, 0))} as payload_digest,
    min(page_id) over (partition by sha) as first from d)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id = first then null else first end as refers_to from r
"""
