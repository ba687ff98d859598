"""ARC and WARC: round trips, declared lengths, revisits."""

import base64
import gzip
import hashlib
import io
import tempfile

import duckdb
import pyarrow.parquet as pq
import pytest

from greenlane.llm import archives as A
from greenlane.llm import queries
from greenlane.llm.common import written

from .conftest import SF

PAGES = [
    (1, "http://a.org/x", "<p>one</p>"), (2, "http://a.org/y z", "<p>one</p>"), (3, None, None), (4, "http://b.org/", ""),
    (5, "http://c.org/", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\r\nHTTP/1.1 200 OK\r\n\r\nx"), (6, "http://c.org/é", "é漢\r\n\r\n" * 4000),
    (None, "http://d.org/", "<p>one</p>"), (8, "filedesc://x", "\n\n"), (9, "http://e.org/", "<p>one</p>"),
]
SCHEMA = "page_id long, url string, html string"


def want(rows):
    first = {}
    for i, _, h in rows:
        h = h or ""
        if i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        h = h or ""
        again = h in first and first[h] != i
        out.append((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=repr)


def round_trip(spark, pages, **kw):
    path = tempfile.mkdtemp(prefix="greenlane-warc-") + "/w"
    A.write_warc(written(A.pages_to_arc(pages, 3000), "arc"), path, **kw)
    return path, sorted(map(tuple, A.resolved(A.read_warc(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, compression):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    assert round_trip(spark, pages, compression=compression)[1] == want(PAGES)


def test_min_bytes_and_files_of_few_records(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(2)
    path, rows = round_trip(spark, pages, min_bytes=11, records_per_file=2)
    assert all(r[3] == "response" for r in rows if r[1] < 11)
    assert spark.read.format("binaryFile").load(path).count() >= 5


def test_revisits_by_a_shuffled_join(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    assert round_trip(spark, pages, broadcast_rows=0)[1] == want(PAGES)


def test_files_are_bounded_by_bytes(spark):
    rows = [(i, f"http://a.org/{i}", f"{i:05d}" * 200) for i in range(200)]
    path, got = round_trip(spark, spark.createDataFrame(rows, SCHEMA).coalesce(1), compression="none", file_bytes=10_000, records_per_file=100)
    sizes = [len(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert got == want(rows) and max(sizes) < 20_000 and len(sizes) >= 20


def test_records_are_standard(spark):
    path, _ = round_trip(spark, spark.createDataFrame(PAGES[:2], SCHEMA).coalesce(1))
    [content] = [bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect() if gzip.decompress(bytes(r.content))]
    records = list(A.parse_warc(io.BytesIO(gzip.decompress(content)), "t"))
    assert [f["warc-type"] for f, _ in records] == ["response", "revisit"]
    fields, block = records[0]
    assert fields["warc-date"] == "2026-01-01T00:00:00Z" and fields["warc-target-uri"] == "http://a.org/x" and fields["content-type"] == "application/http;msgtype=response"
    assert block.endswith(b"\r\n\r\n<p>one</p>") and int(fields["content-length"]) == len(block)
    again, block = records[1]
    assert again["warc-refers-to"] == fields["warc-record-id"] and again["warc-profile"] == A.REVISIT_PROFILE and block.endswith(b"\r\n\r\n")
    assert again["warc-payload-digest"] == fields["warc-payload-digest"] and again["warc-target-uri"] == "http://a.org/y%20z"


@pytest.mark.parametrize("version", [1, 2])
def test_arc_headers_of_both_versions(version):
    data = A.arc_start("a.arc", version) + A.arc_record("http://a/", 7, "x\ny", "a.arc", 0, version)
    data += b"http://with a space/ 1.2.3.4 19990102030405 text/plain" + (b" 200 - - 9 a.arc" if version == 2 else b"") + b" 5\nab\n\nc\n"
    rows = list(A.parse_arc(io.BytesIO(data), "a.arc"))
    assert [f["URL"] for f, _, _ in rows] == ["http://a/", "http://with a space/"]
    assert rows[1][2] == b"ab\n\nc" and rows[1][0]["Archive-date"] == "19990102030405"
    assert A.page_of(A.http_parts(rows[0][2])[0]) == 7 and A.http_parts(rows[0][2])[1] == b"x\ny"


def test_truncated_and_foreign_files_fail():
    good = A.arc_start("a", 1) + A.arc_record("http://a/", 1, "xyz", "a", 0, 1)
    for bad in (good[:-3], b"nothing", good + b"http://b/ oops\n"):
        with pytest.raises(ValueError):
            list(A.parse_arc(io.BytesIO(bad), "a"))
    with pytest.raises(ValueError):
        list(A.parse_warc(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"), "a"))


def test_arc_files_on_disk_convert(spark, tmp_path):
    data = A.arc_start("b.arc", 1) + A.arc_record("http://a/", 7, "x", "b.arc", 0, 1) + b"dns:a.org 1.2.3.4 19990102 text/dns 3\nabc\n"
    (tmp_path / "b.arc.gz").write_bytes(gzip.compress(data))
    rows = {r.uri: r for r in A.arc_to_warc(A.read_arc(spark, str(tmp_path))).collect()}
    assert (rows["http://a/"].kind, rows["http://a/"].page_id, bytes(rows["http://a/"].payload)) == ("response", 7, b"x")
    dns = rows["dns:a.org"]
    assert (dns.kind, dns.mime, dns.date, bytes(dns.payload)) == ("resource", "text/dns", "1999-01-02T00:00:00Z", b"abc")
    assert dns.record_id != rows["http://a/"].record_id


def test_table_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    rows = queries.QUERIES["op8_warc"](spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, rows)) == sorted(con.execute(queries.ORACLE["op8_warc"]).fetchall())


def test_archives_cross_spark_one_at_a_time(spark, tmp_path, monkeypatch):
    """The row groups of the table of archives hold one archive each, however many a task writes."""
    rows = [(i, f"http://a.org/{i}", f"{i:04d}" * 50_000) for i in range(80)]  # 16 MB
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    made = {}
    monkeypatch.setattr(A, "written", lambda df, tag, *a: made.setdefault(tag, written(df, tag, *a)))
    got = sorted(map(tuple, A.op8_warc(spark, str(tmp_path)).collect()), key=repr)
    groups = [f.metadata.row_group(g).num_rows for f in map(pq.ParquetFile, [f.removeprefix("file://") for f in made["arc"].inputFiles()]) for g in range(f.metadata.num_row_groups)]
    assert got == want(rows) and sum(groups) >= 4 and max(groups) == 1


def test_empty_table_and_extra_columns(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(PAGES, SCHEMA).withColumns({"kind": F.lit("x"), "payload": F.lit(1)})
    assert round_trip(spark, pages)[1] == want(PAGES)
    assert round_trip(spark, pages.limit(0))[1] == []
