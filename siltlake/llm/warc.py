"""WARC archives: writing, reading back and assembling transactions.

write() turns pages into request, response (or revisit) and metadata records and lets Spark's text
writer lay them out in gzip files of bounded size in the shared folder. read() parses archives by
their content lengths. assemble() brings the records of a transaction together through their
concurrent-to identifiers and gives one nested row per capture.

Among pages with equal payloads of at least least_bytes bytes, the one with the largest page_id is
the response and the others are revisits that refer to it. A record's identifier has the page_id, the
payload's digest and a tag of the url, so captures that differ in any of them stay apart. Only identifiers and digests
are grouped; payloads are joined with the groups' results where they stand, and a digest that holds a large share of the
pages is one key of that join, which Spark's skew join splits.

Defined results: a null html is an empty payload; a null url becomes `urn:page:<page_id>`; a null
page_id counts as smaller than any other and stays null; equal rows are stored, and come back, as
often as they occur; of pages with one page_id and payload all are responses; line breaks in a url are percent-encoded; an empty
table makes no captures; payloads of any length are stored whole; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import scratch, table

#: Bytes of payload that an archive file holds on average at most.
FILE_BYTES = 16 << 20
#: Payloads below this many bytes are never revisits.
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
URN = "urn:capture"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EOL = "\r\n"
RECORDS = "record_id string, record_type string, target_uri string, concurrent_to string, refers_to string, payload_digest string, payload_bytes long, block string, payload binary"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits make four characters."""
    hexed, out = F.sha1(payload), []
    for k in range(8):
        bits = F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def captures(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, tag and first: page_id and tag of the response, or null where the row is one."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", base32_sha1(F.col("html")))
    rows = rows.withColumn("tag", F.hex(F.xxhash64("url")))
    firsts = rows.where((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull()).groupBy("payload_digest").agg(F.max(F.struct("page_id", "tag")).alias("first"))
    joined = rows.join(firsts, "payload_digest", "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("payload_bytes") >= least_bytes)
    return joined.withColumn("first", F.when(other, F.col("first")))


def record(kind: str, own: Column, uri: Column, content_type: str, block: Column, *headers: Column) -> Column:
    """A record's text, without the two line breaks that end it."""
    fixed = [F.lit(f"WARC/1.1{EOL}WARC-Type: {kind}{EOL}WARC-Record-ID: <"), own, F.lit(f">{EOL}WARC-Date: {DATE}{EOL}WARC-Target-URI: "), uri]
    return F.concat(*fixed, *headers, F.lit(f"{EOL}Content-Type: {content_type}{EOL}Content-Length: "), F.octet_length(block).cast("string"), F.lit(EOL + EOL), block)


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Archives pages under path, three records a page."""
    total = pages.agg(F.sum(F.octet_length(F.col("html").cast("string"))).alias("b"), F.count(F.lit(1)).alias("n")).first()
    per_file = 3 * max(1, int(file_bytes / max(1.0, (total["b"] or 0) / max(1, total["n"]) + 1)))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    named = lambda which, number=page, tag=F.col("tag"): F.concat(F.lit(f"{URN}:"), number, F.lit(":"), F.col("payload_digest"), F.lit(":"), tag, F.lit(f":{which}"))
    main = named("main")
    uri = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.concat(F.lit("urn:page:"), page)), "\r", "%0D"), "\n", "%0A")
    header = lambda name, value: F.concat(F.lit(f"{EOL}{name}: "), value)
    angled = lambda value: F.concat(F.lit("<"), value, F.lit(">"))
    digest = header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(EOL + EOL))
    response = record("response", main, uri, "application/http; msgtype=response", F.concat(http, "html"), digest)
    first = named("main", F.col("first.page_id").cast("string"), F.col("first.tag"))
    revisit = record("revisit", main, uri, "application/http; msgtype=response", http, digest, header("WARC-Profile", F.lit(PROFILE)), header("WARC-Refers-To", angled(first)))
    request = record("request", named("request"), uri, "application/http; msgtype=request", F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{EOL}Accept: text/html{EOL}{EOL}")), header("WARC-Concurrent-To", angled(main)))
    metadata = record("metadata", named("metadata"), uri, "application/warc-fields", F.concat(F.lit("page-id: "), page, F.lit(EOL)), header("WARC-Concurrent-To", angled(main)))
    rows = captures(pages, least_bytes).select(F.explode(F.array(request, F.when(F.col("first").isNull(), response).otherwise(revisit), metadata)).alias("value"))
    rows.write.option("lineSep", EOL + EOL).option("compression", "gzip").option("maxRecordsPerFile", per_file).mode("errorifexists").text(path)


def parse(data: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Header fields, names in lower case, and block of each record."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            fields[name.strip().lower()] = value.strip()
        begin = end + 4
        at = begin + int(fields[b"content-length"])
        yield fields, data[begin:at]


def read_batches(with_payload: bool):
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def row(fields: dict[bytes, bytes], block: bytes) -> tuple:
        text = lambda name: fields[name].decode() if name in fields else None
        angled = lambda name: v.strip("<>") if (v := text(name)) else None
        kind = text(b"warc-type")
        digest, size, payload = (text(b"warc-payload-digest") or "").removeprefix("sha1:") or None, None, None
        if kind in ("response", "revisit"):
            head, _, body = block.partition(b"\r\n\r\n")
            if kind == "response":
                digest, size, payload = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body), body if with_payload else None
            else:  # it has no body; its headers tell that of the response it refers to
                size = next((int(h.partition(b":")[2]) for h in head.split(b"\r\n") if h.lower().startswith(b"content-length:")), None)
        return angled(b"warc-record-id"), kind, text(b"warc-target-uri"), angled(b"warc-concurrent-to"), angled(b"warc-refers-to"), digest, size, None if kind in ("response", "revisit") else block.decode(errors="replace"), payload

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                yield pd.DataFrame([row(*x) for x in parse(data)], columns=names).astype({"payload_bytes": "Int64"})

    return run


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under path."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return found.mapInPandas(read_batches(with_payload), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its identifier, request, response and metadata.

    A request or a metadata record whose transaction has no response or revisit makes no capture.
    """
    is_main = F.col("record_type").isin("response", "revisit")
    of = lambda kind, *columns: F.first(F.when(kind, F.struct(*columns)), ignorenulls=True)
    met = records.groupBy(F.when(is_main, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture_id")).agg(
        of(F.col("record_type") == "request", "record_id", "target_uri", "block").alias("request"),
        of(is_main, "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload").alias("response"),
        of(F.col("record_type") == "metadata", "record_id", "block").alias("metadata"),
        F.count_if(is_main).alias("copies"),
    )
    return met.where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")


def page_of(identifier: Column) -> Column:
    number = F.element_at(F.split(identifier, ":"), 3)
    return F.when(number != "null", number).cast("long")


def op7_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    found = assemble(read(spark, path, with_payload=False))
    page = F.regexp_extract(F.col("metadata.block"), r"page-id: (-?\d+)", 1)
    return found.select(
        F.when(page != "", page).cast("long").alias("page_id"), "response.payload_bytes", "response.payload_digest", "response.record_type",
        page_of(F.col("response.refers_to")).alias("refers_to"),
    )


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h FROM p),
b AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(h, 1 + 5 * (k // 4), 5))::INTEGER >> (15 - 5 * (k % 4)))::INTEGER) & 31)::INTEGER, 1)), '') AS payload_digest FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM b
"""
