"""WARC archives of pages: written, read back, and assembled to one row per capture.

Each capture is three records: a request, a response (or a revisit of an equal payload that another response
holds), and metadata. Request and metadata name their response in WARC-Concurrent-To, and the joins over these names put captures together.

Spark's text writer makes the files: a row is a bundle of whole records up to a few megabytes, a file a few bundles, so
that an archive can be read into memory whatever the number of pages. Records are parsed by their Content-Length, so a payload may hold anything.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.shared import shared_folder, small_batches

LEAST_REVISIT_BYTES = 100
BUNDLE_BYTES = 4 << 20
BUNDLES_PER_FILE = 4
OUT_BYTES = 8 << 20
END = b"\r\n\r\n"

RECORDS = "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, fields map<string,string>, payload_bytes bigint, payload_digest string"


def header_value(text: str) -> str:
    """A header's value holds no control characters: they and "%" are written as %XX."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", text)


def plain_value(text: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)) if int(m[1], 16) < 0x80 else m[0], text)


def urn(*parts: object) -> str:
    h = hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def record(kind: str, headers: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {header_value(v)}" for k, v in headers.items() if v is not None], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def capture_records(capture: int, page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> Iterator[bytes]:
    """The three records of a capture; ``first`` is the capture that holds an equal payload, if this is a revisit."""
    own = urn("response", capture)
    about = {"WARC-Record-ID": own, "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha256:{digest}"}
    yield record(
        "request",
        {"WARC-Record-ID": urn("request", capture), "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Target-URI": url, "WARC-Concurrent-To": own, "Content-Type": "application/http; msgtype=request"},
        b"GET / HTTP/1.1" + END,
    )
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is None:
        yield record("response", about | {"Content-Type": "application/http; msgtype=response"}, head + b"Content-Length: %d" % len(payload) + END + payload)
    else:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield record("revisit", about | {"WARC-Profile": profile, "WARC-Refers-To": urn("response", first), "Content-Type": "application/http; msgtype=response"}, head.rstrip() + END)
    fields = b"" if page_id is None else b"page_id: %d\r\n" % page_id
    yield record(
        "metadata",
        {"WARC-Record-ID": urn("metadata", capture), "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Concurrent-To": own, "Content-Type": "application/warc-fields"},
        fields,
    )


def write_archives(pages: DataFrame, path: str, least_revisit_bytes: int = LEAST_REVISIT_BYTES) -> None:
    """Write a capture for each row of ``pages`` (page_id, url, html) to gzip archives below ``path``.

    The payload is the html in UTF-8, nothing if it is missing. Of the rows with equal payloads of at least
    ``least_revisit_bytes`` bytes the one with the smallest page_id (missing ids last, then the first row) is a response and the others
    revisit it. Repeated rows are captures of their own. Other columns are not looked at.
    """
    small_batches(pages.sparkSession)
    # the number of a row: scans of one table deal out its rows alike
    base = pages.select(
        F.monotonically_increasing_id().alias("capture"),
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    large = base.select("capture", "page_id", "digest", F.octet_length("payload").alias("n")).where(F.col("n") >= least_revisit_bytes)
    place = F.struct(F.col("page_id").isNull().alias("missing"), "page_id", "capture")
    firsts = large.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", F.col("first.capture").alias("first"))
    revisits = large.select("capture", "digest").join(firsts, "digest").where("capture <> first").select("capture", "first")

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                for r in capture_records(*row):
                    held.append(r)
                    size += len(r)
                if size >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_pydict({"bundle": pa.array([END.join(held)], pa.binary())})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"bundle": pa.array([END.join(held)], pa.binary())})

    rows = base.join(revisits, "capture", "left").select("capture", "page_id", "url", "payload", "digest", "first")
    text = rows.mapInArrow(bundles, "bundle binary").select(F.col("bundle").cast("string"))
    text.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", BUNDLES_PER_FILE).text(path)


def inflated(data: bytes) -> bytes:
    """The plain bytes of one or many gzip members, or of a file that is not compressed."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        stream = zlib.decompressobj(31)
        out.append(stream.decompress(data))
        data = stream.unused_data
    return b"".join(out)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in small letters) and block of each record. Bytes between records are passed over; a record cut short ends the archive."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        stop = data.find(END, at)
        if stop < 0:
            return
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): plain_value(v.strip()) for k, _, v in (x.partition(":") for x in lines)}
        begin = stop + len(END)
        length = int(headers.get("content-length", "0") or 0)
        if begin + length > len(data):
            return
        yield headers, data[begin : begin + length]
        at = begin + length


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives below ``path``: see ``RECORDS``, and payload (binary) if asked for.

    payload_bytes and payload_digest (SHA-256 in hex) are those of a response's payload as read; a revisit has the digest its header states. fields are the lines
    of a metadata block. An archive is read whole, so it should be of bounded size as those of ``write_archives`` are.
    """
    small_batches(spark)
    schema = RECORDS + (", payload binary" if with_payload else "")

    def row(headers: dict[str, str], block: bytes) -> dict:
        kind = headers.get("warc-type")
        out = {"record_id": headers.get("warc-record-id"), "record_type": kind, "concurrent_to": headers.get("warc-concurrent-to"), "refers_to": headers.get("warc-refers-to"), "target_uri": headers.get("warc-target-uri")}
        if kind == "response":
            payload = block.partition(END)[2]
            out |= {"payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest(), "payload": payload}
        elif kind == "revisit":
            out["payload_digest"] = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
        elif kind == "metadata":
            out["fields"] = [(k.strip(), v.strip()) for k, s, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")) if s]
        return out

    kinds = {"payload_bytes": pa.int64(), "fields": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}
    names = [c.split()[0] for c in re.sub(r"<.*?>", "", schema).split(", ")]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({n: pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names})

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, block in parsed(inflated(content.as_py())):
                    rows.append(row(headers, block))
                    size += len(block) if with_payload else 200
                    if size >= OUT_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(records, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: record_id, record_type, target_uri, refers_to, payload_bytes, payload_digest (and payload), requests, metadata.

    Request and metadata records join the capture that they name in WARC-Concurrent-To; several of one kind all stay, in the order of
    their ids, and a capture without any has an empty list. Records that name no capture here are left out; so is a repeated record id.
    """
    heads = records.where("record_type IN ('response', 'revisit')").dropDuplicates(["record_id"])
    others = records.where("record_type IN ('request', 'metadata') AND concurrent_to IS NOT NULL").dropDuplicates(["record_id"])
    parts = others.groupBy(F.col("concurrent_to").alias("record_id")).agg(
        F.sort_array(F.collect_list(F.when(F.col("record_type") == "request", F.struct("record_id", "target_uri")))).alias("requests"),
        F.collect_list(F.when(F.col("record_type") == "metadata", F.struct("record_id", "fields"))).alias("metadata"),
    )
    payload = ["payload"] if "payload" in records.columns else []
    return heads.join(parts, "record_id", "left").select(
        "record_id",
        "record_type",
        "target_uri",
        "refers_to",
        "payload_bytes",
        "payload_digest",
        *payload,
        F.coalesce("requests", F.array().cast("array<struct<record_id:string,target_uri:string>>")).alias("requests"),
        F.coalesce("metadata", F.array().cast("array<struct<record_id:string,fields:map<string,string>>>")).alias("metadata"),
    )


def resolved(captures: DataFrame) -> DataFrame:
    """The captures with page_id from their metadata; a revisit gets payload_bytes and payload_digest of the response it refers to, and refers_to is its page_id."""
    own = captures.withColumn("page_id", F.expr("cast(element_at(metadata[0].fields, 'page_id') AS bigint)"))
    held = own.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")
    )
    return own.join(held, "refers_to", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("_digest", "payload_digest").alias("payload_digest"),
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("_page")).alias("refers_to"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return resolved(assemble(read_records(spark, path)))


OP6_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""
