"""Legacy archive converter: ARC to WARC (operator 8).

``read_arc`` parses ARC 1 and ARC 2 files by their version block and by each
record's header line and declared length.  ``to_warc`` synthesises what a WARC
record has and an ARC record lacks: an identifier, an ISO timestamp, the record
type and SHA-256 digests.  Of records with equal payloads of at least
``min_bytes`` the one with the smallest key is a response and the others are
revisits that refer to it.  ``read_warc`` reads WARC files back by their
declared lengths.

Files are written with Spark's text sink (one archive per task, gzip), so they
land on any file system Spark can write; they are read with its binary source.
``max_records`` bounds a file.  A record's HTTP head carries the record key, so
ARC rows can be matched to their source.

Edge cases: a null payload is empty; null or unfit URLs become ``-`` or are
percent-encoded, since ARC header lines are separated by spaces; a null key is
written as ``-`` and read back as null, and such a record is always a response;
rows that repeat a key are records of their own, and of equal payloads under
one key all are the response; an empty table gives no records; other columns
are ignored.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import on_executors, shared_path, stored

# Field lists of the two ARC version blocks.
ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
CRAWLED = "20000101000000"  # pages carry no date; ARC needs one


def _octets(c: Column) -> Column:
    return F.octet_length(c)


def write_arc(pages: DataFrame, path: str, version: int = 1, key_col: str = "page_id", url_col: str = "url",
              body_col: str = "html", crawled: str = CRAWLED, max_records: int = 4000) -> str:
    """Write ``pages`` as ARC files below ``path``: a version block per file, then a
    record per row (header line, HTTP head, body)."""
    body = F.coalesce(F.col(body_col), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    _octets(body).cast("string"), F.lit("\r\nX-Record-Key: "), F.coalesce(F.col(key_col).cast("string"), F.lit("-")),
                    F.lit("\r\n\r\n"))
    url = F.coalesce(F.regexp_replace(F.col(url_col), r"[\x00-\x20\x7f]", "%20"), F.lit("-"))
    url = F.when(url == "", "-").otherwise(url)
    fields = [url, F.lit("0.0.0.0"), F.lit(crawled), F.lit("text/html")]
    if version == 2:
        fields += [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("-")]
    length = (_octets(F.col("__head")) + _octets(F.col("__body"))).cast("string")
    record = F.concat(F.concat_ws(" ", *fields, length), F.lit("\n"), F.col("__head"), F.col("__body"))
    block = f"{version} 0 fieldloom\n{ARC_FIELDS[version]}\n"
    first = f"filedesc://fieldloom.arc 0.0.0.0 {crawled} text/plain {'200 - - 0 - ' if version == 2 else ''}{len(block)}\n{block}"
    rows = pages.withColumn("__head", head).withColumn("__body", body).select(record.alias("value"))
    _write(rows, path, "\n", first, max_records)
    return path


def _write(records: DataFrame, path: str, end: str, first: str | None, max_records: int) -> None:
    """Records as gzip text files; ``first`` opens every file."""
    if first is not None:
        # a file begins where a task begins and again after every max_records rows
        ix = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        records = records.select(F.when(ix % max_records == 0, F.concat(F.lit(first + end), F.col("value")))
                                 .otherwise(F.col("value")).alias("value"))
    (records.write.option("lineSep", end).option("compression", "gzip").option("maxRecordsPerFile", max_records)
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def _files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")


ARC_ROW = pa.schema([("version", pa.int32()), ("url", pa.string()), ("ip", pa.string()), ("archived", pa.string()),
                     ("content_type", pa.string()), ("head", pa.binary()), ("body", pa.binary())])
ARC_DDL = "version int, url string, ip string, archived string, content_type string, head binary, body binary"


def _bounded(rows, schema, limit: int = 8 << 20):
    """Batches of rows with at most about ``limit`` bytes of binary values."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, bytes)) + 200
        if size > limit:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def parse_arc(data: bytes):
    """Records of one ARC file (plain bytes); raises ValueError on a malformed one."""
    at, names, version = 0, None, None
    while at < len(data):
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        if not line:
            at = end + 1
            continue
        values = line.split(" ")
        length = int(values[-1])
        block = data[end + 1:end + 1 + length]
        if len(block) != length:
            raise ValueError("an ARC record is shorter than its declared length")
        at = end + 1 + length
        if values[0].startswith("filedesc://"):
            lines = block.decode("utf-8", "replace").splitlines()
            version, names = int(lines[0].split(" ")[0]), lines[1].split(" ")
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            continue
        if names is None or len(values) != len(names):
            raise ValueError("an ARC record does not fit its version block")
        r = dict(zip(names, values, strict=True))
        cut = block.find(b"\r\n\r\n")
        head, body = (block[:cut + 4], block[cut + 4:]) if block.startswith(b"HTTP/") and cut >= 0 else (b"", block)
        yield version, r["URL"], r["IP-address"], r["Archive-date"], r["Content-type"], head, body


def read_arc(spark, path: str) -> DataFrame:
    """One row per ARC record below ``path`` with its ``head`` and ``body``."""
    on_executors(spark)

    def run(batches):
        for b in batches:
            for content in b.column(0):
                yield from _bounded(parse_arc(gzip.decompress(content.as_py())), ARC_ROW)
    return _files(spark, path).mapInArrow(run, ARC_DDL)


def http_field(head: Column, name: str) -> Column:
    v = F.regexp_extract(head.cast("string"), rf"(?i)\r\n{name}: *([^\r\n]*)", 1)
    return F.when(v != "", v)


def to_warc(arc: DataFrame, min_bytes: int = 100) -> DataFrame:
    """WARC fields for each ARC row: ``record_id``, ``date``, ``type``, digests,
    ``refers_to`` (a record id), and the block as text."""
    key = F.expr("try_cast(__key as bigint)")
    rows = (arc.withColumn("__key", http_field(F.col("head"), "X-Record-Key"))
            .select(key.alias("key"), "url", "archived", "head", "body", F.sha2("body", 256).alias("digest"),
                    F.octet_length("body").cast("long").alias("bytes")))
    large = (F.col("bytes") >= min_bytes) & F.col("key").isNotNull()
    # digests that several records share, stored so that the join has stored tables on both sides
    shared = (rows.where(large).groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last"))
              .where("last > first").select("digest", "first"))
    shared = stored(shared, "shared-payloads")
    rows = rows.join(shared, "digest", "left")
    revisit = large & F.col("first").isNotNull() & (F.col("key") > F.col("first"))

    def uri(k: Column) -> Column:
        h = F.sha2(F.concat_ws("|", F.lit("fieldloom-record"), k.cast("string")), 256)
        return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), F.concat(F.lit("8"), h.substr(14, 3)),
                                                        F.concat(F.lit("a"), h.substr(18, 3)), h.substr(21, 12)))
    own = F.when(F.col("key").isNull(), uri(F.concat_ws("|", "url", "digest"))).otherwise(uri(F.col("key")))
    date = F.date_format(F.try_to_timestamp(F.col("archived"), F.lit("yyyyMMddHHmmss")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select("key", "url", own.alias("record_id"), date.alias("date"), F.when(revisit, "revisit").otherwise("response").alias("type"),
                       "digest", "bytes", F.when(revisit, uri(F.col("first"))).alias("refers_to"),
                       F.col("head").cast("string").alias("head"),
                       F.when(revisit, "").otherwise(F.col("body").cast("string")).alias("body"))


def write_warc(warc: DataFrame, path: str, max_records: int = 4000) -> str:
    """Write ``to_warc`` rows as WARC/1.1 files below ``path``.  A revisit's block is its HTTP head alone."""
    block = F.concat("head", "body")

    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    revisit = F.col("type") == "revisit"
    record = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("type")), line("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))),
        line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.when(F.col("url") != "-", F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")), line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(block, 256))),
        line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To", F.concat(F.lit("<"), "refers_to", F.lit(">"))),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "), _octets(block).cast("string"),
        F.lit("\r\n\r\n"), block)
    _write(warc.select(record.alias("value")), path, "\r\n\r\n", None, max_records)
    return path


WARC_ROW = pa.schema([("type", pa.string()), ("record_id", pa.string()), ("date", pa.string()), ("target", pa.string()),
                      ("payload_digest", pa.string()), ("refers_to", pa.string()), ("head", pa.binary()), ("body", pa.binary())])
WARC_DDL = ("type string, record_id string, date string, target string, payload_digest string, refers_to string, "
            "head binary, body binary")


def parse_warc(data: bytes):
    """Records of one WARC file (plain bytes); raises ValueError on a malformed one."""
    at = 0
    while at < len(data):
        if data.startswith(b"\r\n", at):
            at += 2
            continue
        if not data.startswith(b"WARC/", at):
            raise ValueError("a WARC record does not begin where the last one ends")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        h = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(h["content-length"])
        block = data[end + 4:end + 4 + length]
        if len(block) != length:
            raise ValueError("a WARC record is shorter than its declared length")
        at = end + 4 + length
        cut = block.find(b"\r\n\r\n")
        head, body = (block[:cut + 4], block[cut + 4:]) if block.startswith(b"HTTP/") and cut >= 0 else (b"", block)
        ids = [h.get(k, "").strip("<>") or None for k in ("warc-record-id", "warc-refers-to")]
        yield (h.get("warc-type"), ids[0], h.get("warc-date"), h.get("warc-target-uri"),
               (h.get("warc-payload-digest") or "").removeprefix("sha256:") or None, ids[1], head, body)


def read_warc(spark, path: str) -> DataFrame:
    """One row per WARC record below ``path``."""
    on_executors(spark)

    def run(batches):
        for b in batches:
            for content in b.column(0):
                yield from _bounded(parse_warc(gzip.decompress(content.as_py())), WARC_ROW)
    return _files(spark, path).mapInArrow(run, WARC_DDL)


def convert(pages: DataFrame, version: int | None = 1, min_bytes: int = 100, key_col: str = "page_id", **kw) -> DataFrame:
    """Pages to ARC files, ARC to WARC files, and the WARC records read back, all
    in the shared folder.  ``version`` None writes each page as ARC 1 or ARC 2 by a
    hash of its key.  ``key`` is the source row's key; ``refers_key`` the key
    of the record that a revisit refers to."""
    spark = pages.sparkSession
    if version is None:
        second = F.pmod(F.xxhash64(key_col), F.lit(2)) == 1
        parts = [write_arc(pages.where(c), shared_path(spark, "arc"), v, key_col, **kw) for v, c in ((1, ~second), (2, second))]
        arc = read_arc(spark, parts[0]).unionByName(read_arc(spark, parts[1]))
    else:
        arc = read_arc(spark, write_arc(pages, shared_path(spark, "arc"), version, key_col, **kw))
    warc = write_warc(to_warc(arc, min_bytes), shared_path(spark, "warc"))
    back = (read_warc(spark, warc).withColumn("key", http_field(F.col("head"), "X-Record-Key").try_cast("bigint")))
    named = stored(back.where("refers_to is not null").select(F.col("refers_to").alias("__id")).distinct(), "referred")
    ids = stored(back.where("type = 'response'").select(F.col("record_id").alias("__id"), F.col("key").alias("refers_key"))
                 .join(named, "__id", "left_semi").distinct(), "responses")
    return back.join(ids, F.col("refers_to") == F.col("__id"), "left").drop("__id")
