"""WARC archives: writing captures, reading records, assembling transactions.

Writing: every page becomes three WARC/1.1 records (request, response or
revisit, metadata) that are tied by ``WARC-Concurrent-To``. The records are the
lines of Spark's text sink with the WARC record end (CR LF CR LF) as the line
separator, so archives are written by all executors through Spark's commit
protocol to any file system that Spark can write to, gzip-compressed.

Reading: ``binaryFile`` deals out whole archives; each is decompressed as a
stream and cut by its Content-Length headers, and response payloads are hashed
again and checked against their digest header.

Assembly: request and metadata records are joined to the response or revisit
that their concurrent-to identifier names. As each of the three sides carries
that one identifier, the equi-join is a single grouping on it: one exchange, one
nested row per capture.

Payload digests: of the records with equal payloads of at least
``min_revisit_bytes`` bytes, the one with the largest page id is the response
and the others revisit it. Only digests that occur more than once are joined
back to the pages, and the join may be skewed (a third of all pages may be
copies of one): its small side is materialised and counted; up to
``BROADCAST_DIGESTS`` rows it is broadcast, and payloads are not shuffled for it,
beyond that the optimizer splits the hot partition.

Nulls and odd input: null html is an empty payload; a null url is kept as null;
a null page id ranks below all others and never becomes a revisit target if
another copy has an id; rows equal in page id and payload are one capture (the
smallest url stays); pages that share an id but not the payload are separate
captures; an empty table gives no rows. Other input columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm.common import cut, prepare, shared_path, table

CRLF = "\r\n"
END = CRLF * 2
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD_SCHEMA = ("record_id string, type string, concurrent_to string, refers_to string, "
                 "payload_digest string, payload_bytes long, block binary")
READ_BYTES = 8 << 20
BROADCAST_DIGESTS = 200_000  # about 100 bytes each
ARCHIVE_RECORDS = 6_000      # an archive is read whole by one task


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 SHA-1: ten hex digits are eight base32 digits."""
    h = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(h, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def with_roles(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Pages with payload_bytes, payload_digest, record_type and refers_to (a
    page id, null unless the record is a revisit)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    p = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                      html.alias("html"))
         .withColumn("payload_bytes", F.octet_length("html").cast("long"))
         .withColumn("payload_digest", base32_sha1(F.encode("html", "UTF-8"))))
    twice = cut(p.filter(F.col("payload_bytes") >= min_revisit_bytes)
                .groupBy(F.col("payload_digest").alias("digest"))
                .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
                .filter("n > 1 and first_id is not null").drop("n"))
    if twice.count() <= BROADCAST_DIGESTS:  # else the payloads are shuffled to their digests
        twice = F.broadcast(twice)
    j = p.join(twice, F.col("payload_digest") == F.col("digest"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (j.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("first_id"))).drop("digest", "first_id"))


def _id(kind: str, page_id: Column) -> Column:
    return F.concat(F.lit("<urn:capture:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"),
                    F.col("payload_digest"), F.lit(f":{kind}>"))


def _record(headers: list[tuple[str, Column | str | None]], block: Column) -> Column:
    lines = [F.lit("WARC/1.1" + CRLF)]
    for name, value in headers:
        v = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(name + ": "), v, F.lit(CRLF)), F.lit("")))
    lines += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block]
    return F.concat(*lines)


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> str:
    """Write three records per page below ``path`` and return it."""
    p = with_roles(pages, min_revisit_bytes)
    me = _id("response", F.col("page_id"))
    # Control characters must not reach a header; the exact url is in the metadata record.
    uri = F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    is_revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    response = _record([
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", me), ("WARC-Date", date), ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", digest),
        ("WARC-Profile", F.when(is_revisit, F.lit(REVISIT_PROFILE))),
        ("WARC-Refers-To", F.when(is_revisit, _id("response", F.col("refers_to")))),
        ("Content-Type", "application/http;msgtype=response")],
        F.when(is_revisit, http).otherwise(F.concat(http, F.col("html"))))
    request = _record([
        ("WARC-Type", "request"), ("WARC-Record-ID", _id("request", F.col("page_id"))), ("WARC-Date", date),
        ("WARC-Target-URI", uri), ("WARC-Concurrent-To", me), ("Content-Type", "application/http;msgtype=request")],
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1" + END)))
    metadata = _record([
        ("WARC-Type", "metadata"), ("WARC-Record-ID", _id("metadata", F.col("page_id"))), ("WARC-Date", date),
        ("WARC-Concurrent-To", me), ("Content-Type", "application/json")],
        F.to_json(F.struct("page_id", "url")))
    (p.select(F.explode(F.array(request, response, metadata)).alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path))
    return path


def parse_archive(stream) -> tuple[dict, bytes]:
    """Records of an archive, given as a binary stream: (headers, block)."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            continue
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != END.encode():
            raise ValueError(f"record {headers.get('warc-record-id')} is cut short")
        yield headers, block


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path`` (``RECORD_SCHEMA``). A response's block is its
    payload; ``payload_digest`` and ``payload_bytes`` are of the full payload."""
    prepare(spark)
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def rows(content: bytes):
        stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
        for head, block in parse_archive(io.BufferedReader(stream, 1 << 20)):
            kind, digest, size = head["warc-type"], None, None
            if kind in ("response", "revisit"):
                http, _, payload = block.partition(END.encode())
                said = head["warc-payload-digest"].partition(":")[2]
                if kind == "response":
                    digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
                    if digest != said:
                        raise ValueError(f"digest of {head['warc-record-id']} does not match its payload")
                else:
                    lengths = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                    digest, size = said, int(lengths[0].split(b":")[1])
                block = payload
            yield (head["warc-record-id"], kind, head.get("warc-concurrent-to"), head.get("warc-refers-to"),
                   digest, size, block)

    def read(batches):
        schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "block" else pa.string())
                            for n in names])
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for r in rows(content.as_py()):
                    held.append(r)
                    size += len(r[-1])
                    if size > READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(read, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, page_id, url, request, response,
    metadata). A request or metadata record whose response is missing gives a
    row with a null response; of several, the smallest block stays."""
    r = records.withColumn("capture_id", F.coalesce("concurrent_to", "record_id"))
    of = lambda kind, *cols: F.min(F.when(F.col("type") == kind, F.struct(*cols)))
    g = r.groupBy("capture_id").agg(
        of("request", "block", "record_id").alias("request"),
        F.first(F.when(F.col("type").isin("response", "revisit"),
                       F.struct("record_id", "type", "payload_bytes", "payload_digest", "refers_to",
                                F.col("block").alias("payload"))), ignorenulls=True).alias("response"),
        of("metadata", F.col("block").cast("string").alias("block"), "record_id").alias("metadata"))
    meta = F.from_json(F.col("metadata.block"), "page_id long, url string")
    return g.withColumn("page_id", meta["page_id"]).withColumn("url", meta["url"])


def page_of(record_id: Column) -> Column:
    """The page id within a record identifier."""
    return F.regexp_extract(record_id, r"^<urn:capture:(-?\d+):", 1).cast("long")


def round_trip(pages: DataFrame, path: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write the pages to archives, read them back, assemble the captures."""
    spark = prepare(pages.sparkSession)
    path = path or shared_path(spark, "warc", uuid.uuid4().hex)
    return assemble(read_records(spark, write_archives(pages, path, min_revisit_bytes)))


def op3(spark, sf_dir):
    c = round_trip(table(spark, sf_dir, "pages"))
    return c.select("page_id", F.col("response.payload_bytes").alias("payload_bytes"),
                    F.col("response.payload_digest").alias("payload_digest"),
                    F.col("response.type").alias("record_type"), page_of(F.col("response.refers_to")).alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
b AS (SELECT page_id, payload_bytes,
        list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          1 + ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (5 * (7 - i % 8))) & 31), 1)), 'string_agg', '') AS payload_digest
      FROM d),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM m
"""

QUERIES = {"op3_warc_transactions": op3}
ORACLES = {"op3_warc_transactions": ORACLE}
