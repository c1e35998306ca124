import gzip
import hashlib

import pytest

from fieldloom.llm import queries as Q
from fieldloom.llm.arc_warc import convert, parse_arc, parse_warc, read_arc, read_warc, to_warc, write_arc, write_warc
from fieldloom.llm.common import shared_path

SCHEMA = "page_id long, url string, html string, key string, type string"


def brute(rows, least=100):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(b) if i is not None else None
        rev = f is not None and i != f
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if rev else "response", f if rev else None))
    return sorted(out, key=repr)


PAGES = ([(i, f"http://x.example/{i}", f"<p>{i % 7} äöü 漢 " + "body " * 40) for i in range(60)]
         + [(100, None, "a" * 200), (101, "", "a" * 200), (102, "http://a b\nc", "a" * 200), (103, "u", None), (104, "u", ""),
            (105, "u", "short"), (106, "u", "short"), (107, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\nfiledesc://x 1\n" * 4),
            (108, "u", "\r\n\r\nHTTP/1.1 200 OK\r\nX-Record-Key: 9\r\n\r\n" * 5), (None, "u", "b" * 300), (109, "u", "b" * 300),
            (110, "u", "dup" * 100), (110, "u", "dup" * 100), (111, "u", "x" * 3_000_000), (112, "u", "x" * 3_000_000), (-5, "u", "a" * 200),
            (113, "u", "e" * 99), (114, "u", "e" * 99), (115, "u", "é" * 50), (116, "u", "é" * 50)])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "t") for r in rows], SCHEMA)


def digest(back):
    from pyspark.sql import functions as F

    from fieldloom.llm.arc_warc import http_field
    whole = F.when(F.col("type") == "revisit", http_field(F.col("head"), "Content-Length").cast("long")).otherwise(F.octet_length("body"))
    return sorted((tuple(r) for r in back.select("key", whole.cast("long"), "payload_digest", "type", "refers_key").collect()), key=repr)


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, version):
    assert digest(convert(frame(spark, PAGES), version, max_records=9)) == brute(PAGES)


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_tiny(spark, rows):
    assert digest(convert(frame(spark, rows))) == brute(rows)


def test_files_keep_their_formats(spark):
    arc = write_arc(frame(spark, PAGES[:5]).coalesce(1), shared_path(spark, "arc"), 2)
    raw = b"".join(gzip.decompress(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(arc).collect())
    lines = raw.split(b"\n")
    assert lines[0].startswith(b"filedesc://") and lines[1] == b"2 0 fieldloom" and lines[2].startswith(b"URL IP-address Archive-date")
    rows = read_arc(spark, arc)
    assert {(r.version, bytes(r.body).decode()) for r in rows.collect()} == {(2, h) for _, _, h in PAGES[:5]}
    warc = write_warc(to_warc(rows), shared_path(spark, "warc"))
    back = read_warc(spark, warc).collect()
    assert all(r.record_id.startswith("urn:uuid:") and r.date == "2000-01-01T00:00:00Z" for r in back)
    assert len({r.record_id for r in back}) == 5


def test_malformed_archives_are_refused():
    block = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    head = b"filedesc://a 0.0.0.0 20000101000000 text/plain %d\n" % len(block) + block
    assert [r[-1] for r in parse_arc(head + b"\nu 0.0.0.0 20000101000000 text/html 3\nabc\n")] == [b"abc"]
    for bad in (head + b"\nu 0.0.0.0 20000101000000 text/html 9\nabc\n", head + b"\nu text/html 3\nabc\n",
                b"u 0.0.0.0 20000101000000 text/html 3\nabc\n", head.replace(b"1 0 x", b"7 0 x")):
        with pytest.raises(ValueError):
            list(parse_arc(bad))
    with pytest.raises(ValueError):
        list(parse_warc(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/pages.parquet").collect()]
    df = Q.op8_arc_warc(spark, sf)
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == brute(rows)
