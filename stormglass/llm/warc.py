"""WARC archives: pages written as segmented, chunked records, and their reassembly.

A record longer than a segment is written as a first segment and continuation records. Reading groups
the segments by the identifier of their first one, orders them by number, compares the length with the
total that the last one states, and decodes the chunked transfer framing of the HTTP message inside.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from stormglass.llm.scratch import Scratch

#: Bytes of a record's block before it is cut into segments, and of a chunk of the HTTP body.
SEGMENT_BYTES, CHUNK_BYTES = 16384, 4096
#: Records of an archive file. With SEGMENT_BYTES it bounds a file at 64 MB before compression.
RECORDS_PER_FILE = 4000

# The HTTP head of a stored page.
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

RECORD = (
    "record_id string, type string, page_id bigint, uri string, payload_digest string, refers_to string, "
    "segment int, origin string, total_length bigint, block binary"
)
_ARROW_RECORD = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()),
    ("payload_digest", pa.string()), ("refers_to", pa.string()), ("segment", pa.int32()),
    ("origin", pa.string()), ("total_length", pa.int64()), ("block", pa.binary()),
])
PAGE = (
    "record_id string, type string, page_id bigint, uri string, payload_digest string, refers_to string, "
    "complete boolean, payload binary"
)
_ARROW_PAGE = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()),
    ("payload_digest", pa.string()), ("refers_to", pa.string()), ("complete", pa.bool_()), ("payload", pa.binary()),
])


def _record_id(*parts: object) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, "\n".join(map(str, parts))).urn


def base32_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = (payload[i:i + size] for i in range(0, len(payload), size))
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, chunk extensions and trailers dropped; None if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        digits = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        try:
            size = int(digits, 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or body[at + size:at + size + 2] != b"\r\n":
            return None
        parts.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """Head and block. The two line ends after a record are the separator of the text writer."""
    clean = ((name, str(value).replace("\r", "%0D").replace("\n", "%0A")) for name, value in fields if value is not None)
    head = "".join(f"{name}: {value}\r\n" for name, value in clean)
    return b"WARC/1.1\r\n%bContent-Length: %d\r\n\r\n%b" % (head.encode(), len(block), block)


def page_records(page_id: int | None, uri: str | None, payload: bytes, digest: str, owner: int | None,
                 revisit: bool, segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of a page: a revisit, or a response in as many segments as it needs."""
    own = _record_id(page_id, digest)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{own}>"),
        ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Target-URI", uri), ("Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record([*fields, ("WARC-Profile", profile), ("WARC-Refers-To", f"<{_record_id(owner, digest)}>")], b"")
        return
    block = HTTP_HEAD + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record(fields, block)
        return
    count = -(-len(block) // segment_bytes)
    yield _record([*fields, ("WARC-Segment-Number", 1)], block[:segment_bytes])
    for k in range(1, count):
        yield _record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{_record_id(own, k + 1)}>"),
            ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Segment-Number", k + 1),
            ("WARC-Segment-Origin-ID", f"<{own}>"),
            ("WARC-Segment-Total-Length", len(block) if k + 1 == count else None),
        ], block[k * segment_bytes:(k + 1) * segment_bytes])


def write_pages(pages: DataFrame, folder: str, scratch: Scratch, least_bytes: int = 0,
                segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write pages (page_id, url, html) as gzip archives into a folder.

    Of pages with equal payloads of ``least_bytes`` or more, that with the largest page_id is a response and
    the others revisit it; rows that repeat it whole are responses under the same identifier. A null html is
    an empty payload; a null page_id never owns a payload unless no page of the group has a number, then all
    are responses. Other columns are ignored; an empty table writes an archive without records.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn("sha1", F.sha1("payload"))
    # Only payloads that occur twice need an owner. The table is read back, so that a payload with very
    # many copies is split by the join.
    owners = scratch.stage(
        rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha1")
        .agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("sha1").alias("owned"), "owner"), "owners")
    rows = rows.join(owners, F.col("sha1") == F.col("owned"), "left")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Few pages at a time: pages may be long, and each is in memory twice here.
            for start in range(0, batch.num_rows, 256):
                found = []
                for row in batch.slice(start, 256).to_pylist():
                    digest = base32_digest(bytes.fromhex(row["sha1"]))
                    revisit = row["owner"] is not None and row["owner"] != row["page_id"]
                    found += page_records(row["page_id"], row["url"], row["payload"], digest, row["owner"],
                                          revisit, segment_bytes)
                yield pa.RecordBatch.from_pydict({"record": pa.array(found, pa.binary())})

    built = rows.select("page_id", "url", "payload", "sha1", "owner").mapInArrow(build, "record binary")
    (built.select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
     .option("zlib.compress.level", "BEST_SPEED").text(folder))


def parse_archive(content: bytes) -> Iterator[dict]:
    """The records of an archive file, plain or gzip. A block cut short by the end of the file stays short."""
    plain = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=plain), 1 << 16) if content[:2] == b"\x1f\x8b" else plain
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        number = {k: int(fields[k]) if k in fields else None for k in (
            "page-id", "warc-segment-number", "warc-segment-total-length")}
        reference = {k: fields[k].strip("<>") if k in fields else None for k in (
            "warc-record-id", "warc-refers-to", "warc-segment-origin-id")}
        own, digest = reference["warc-record-id"], fields.get("warc-payload-digest")
        yield {
            "record_id": own, "type": fields.get("warc-type"), "page_id": number["page-id"],
            "uri": fields.get("warc-target-uri"), "payload_digest": digest and digest.removeprefix("sha1:"),
            "refers_to": reference["warc-refers-to"], "segment": number["warc-segment-number"],
            "origin": reference["warc-segment-origin-id"] or own,
            "total_length": number["warc-segment-total-length"], "block": stream.read(int(fields["content-length"])),
        }


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives in a folder, as they are stored. A file is read by one task."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                found, size = [], 0
                for record in parse_archive(content.as_py()):
                    found.append(record)
                    size += len(record["block"])
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(found, schema=_ARROW_RECORD)
                        found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, schema=_ARROW_RECORD)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(parse, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: (record fields, complete, block), segments put together.

    Only segments are shuffled, by the identifier of their first one. A record is complete if its numbers
    run from 1 without a gap, one segment states the total length, and the blocks have that length. If a record
    was written several times, equal segments repeat; as many whole records come back as first segments.
    Segments without their first one give a row of type continuation that is not complete.
    """
    names = ("record_id", "type", "page_id", "uri", "payload_digest", "refers_to")
    whole = records.where("segment IS NULL").select(*names, F.lit(True).alias("complete"), "block")
    first = F.min_by(F.struct(*names), "segment")
    parts = (
        records.where("segment IS NOT NULL").groupBy("origin")
        .agg(first.alias("head"), F.sum(F.when(F.col("segment") == 1, 1)).alias("copies"),
             F.max("total_length").alias("total"),
             F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("parts"))
        .withColumn("length", F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"])))
        .withColumn("complete", F.coalesce(
            (F.col("parts")["segment"] == F.sequence(F.lit(1), F.size("parts"))) & (F.col("length") == F.col("total")),
            F.lit(False)))
        .select("head.*", "complete", _joined(F.col("parts")["block"]).alias("block"),
                F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1)))).alias("copy"))
        .drop("copy")
    )
    return whole.unionByName(parts)


@F.pandas_udf(BinaryType())
def _joined(blocks):
    return blocks.map(lambda parts: b"".join(parts))


def decode(records: DataFrame) -> DataFrame:
    """Payloads of whole records. Broken records or framing give complete = false and a null payload."""

    def payload(row: dict) -> bytes | None:
        if not row["complete"] or row["type"] != "response":
            return None
        head, end, body = row["block"].partition(b"\r\n\r\n")
        if not end:
            return None
        return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                row["payload"] = payload(row)
                row["complete"] = row["complete"] and (row["type"] != "response" or row["payload"] is not None)
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_PAGE)

    return records.mapInArrow(run, PAGE)


def payload_figures(pages: DataFrame) -> DataFrame:
    """Length and digest of the payloads that decode() found."""

    @F.pandas_udf("string")
    def digest(payloads):
        return payloads.map(lambda p: None if p is None else base32_digest(hashlib.sha1(p).digest()))

    return pages.select("record_id", "type", "page_id", "uri", "refers_to", "complete",
                        F.col("payload_digest").alias("stated_digest"),
                        F.octet_length("payload").cast("long").alias("payload_bytes"),
                        digest("payload").alias("payload_digest"))


def resolve_revisits(figures: DataFrame, scratch: Scratch) -> DataFrame:
    """Figures of all records; revisits get those of the response they refer to, if it has the stated digest."""
    figures = scratch.stage(figures, "figures")
    # Staged, so that a response with very many revisits is split by the join.
    targets = scratch.stage(
        figures.where("type = 'response' AND complete").groupBy(F.col("record_id").alias("target"))
        .agg(F.max("page_id").alias("target_page"), F.max("payload_bytes").alias("target_bytes"),
             F.max("payload_digest").alias("target_digest")), "targets")
    scratch.drop("figures", "targets")
    revisits = (
        figures.where("type = 'revisit'")
        .join(targets, (F.col("refers_to") == F.col("target")) & (F.col("stated_digest") == F.col("target_digest")), "left")
        .select("page_id", "uri", F.col("target_bytes").alias("payload_bytes"),
                F.col("target_digest").alias("payload_digest"), F.col("type").alias("record_type"),
                F.col("target_page").alias("refers_to"), F.col("target").isNotNull().alias("complete")))
    responses = figures.where("type <> 'revisit'").select(
        "page_id", "uri", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"), "complete")
    return responses.unionByName(revisits)
