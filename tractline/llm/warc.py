"""Pages to WARC archives and back: segments, revisits and chunked framing.

A page becomes a response record whose block is an HTTP message with chunked framing. A block above the
segment size goes on in continuation records. A page whose payload another page already holds becomes a
revisit record. Reading parses every archive on its own, brings the segments of a record together by
their origin id and number, checks the total length and takes off the framing.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.llm.common import stored

#: Payloads of fewer bytes are written each time.
REVISIT_BYTES = 1000
#: Most bytes of a record's block, and most records of an archive: an archive fits in a reader's memory.
SEGMENT_BYTES, ARCHIVE_RECORDS = 16 * 1024, 4096
CHUNK_BYTES = 4096
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"
_BATCH_BYTES = 8 * 1024 * 1024
_NAMES = {
    "warc-type": "type", "warc-record-id": "record_id", "warc-target-uri": "url", "page-id": "page_id",
    "warc-payload-digest": "digest", "warc-refers-to": "refers_to", "warc-segment-number": "segment",
    "warc-segment-origin-id": "origin", "warc-segment-total-length": "total",
}
_PARSED = "type string, record_id string, url string, page_id string, digest string, refers_to string, segment int, origin string, total bigint, block binary"
_PAGES = "record_id string, page_id string, url string, type string, digest string, refers_to string, payload binary, whole boolean"


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Pieces of at most ``size`` bytes that do not end inside a UTF-8 character."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while at < end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        # Bytes that are no UTF-8 have no better place to be cut.
        end = end if end > at else min(at + size, len(data))
        yield data[at:end]
        at = end


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, repr(parts))}>"


def _record(headers: dict[str, object], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items() if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block


def records_of(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, segment: int) -> Iterator[bytes]:
    """The records of one page, without the blank lines that end a record."""
    url = " ".join(url.split()) if url is not None else None
    own = record_id(page_id, digest)
    about = {"WARC-Date": DATE, "WARC-Target-URI": url, "Page-Id": page_id, "Content-Type": "application/http; msgtype=response"}
    about["WARC-Payload-Digest"] = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        more = {"WARC-Profile": profile, "WARC-Refers-To": record_id(refers_to, digest)}
        yield _record({"WARC-Type": "revisit", "WARC-Record-ID": own, **about, **more}, http + b"\r\n")
        return
    chunks = b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in _cuts(payload, CHUNK_BYTES))
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunks + b"0\r\n\r\n"
    pieces = list(_cuts(block, segment))
    for number, piece in enumerate(pieces, 1):
        if number == 1:
            headers = {"WARC-Type": "response", "WARC-Record-ID": own, **about}
            headers["WARC-Segment-Number"] = 1 if len(pieces) > 1 else None
        else:
            headers = {"WARC-Type": "continuation", "WARC-Record-ID": record_id(page_id, digest, number), "WARC-Date": DATE}
            headers |= {"WARC-Segment-Origin-ID": own, "WARC-Segment-Number": number}
            headers["WARC-Segment-Total-Length"] = len(block) if number == len(pieces) else None
        yield _record(headers, piece)


def write_archives(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write ``page_id``, ``url`` and ``html`` of every row of ``pages`` as gzipped WARC archives in ``folder``.

    Of pages with equal payloads of 1000 bytes or more, the one with the largest ``page_id`` is the response
    and the others revisit it; a page without ``page_id`` is always a response. A null ``html`` is an empty
    payload. A row that repeats ``page_id`` and payload is archived once. Other columns are not read.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    light = stored(pages.select("page_id", "digest", F.octet_length("payload").alias("n")), "warc-light")
    long = light.filter(F.col("n") >= REVISIT_BYTES)
    most = long.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    most = stored(most.select("digest", "response"), "warc-responses")
    revisits = long.join(most, "digest").filter("page_id <> response").select("page_id", "digest", "response").distinct()
    revisits = stored(revisits, "warc-revisits")
    if not light.groupBy("page_id", "digest").count().filter("count > 1").isEmpty():
        pages = pages.dropDuplicates(["page_id", "digest"])
    rows = pages.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "response")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row in zip(*batch.columns, strict=True):
                for record in records_of(*(x.as_py() for x in row), segment_bytes):
                    out.append(record)
                    size += len(record)
                if size > _BATCH_BYTES:
                    yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])

    lines = rows.mapInArrow(records, "value binary").select(F.col("value").cast("string").alias("value"))
    # Two line ends close a record, so the text writer's separator makes valid archives.
    options = {"lineSep": _END.decode(), "compression": "gzip", "maxRecordsPerFile": ARCHIVE_RECORDS}
    lines.write.options(**options).text(folder)


def _unzipped(data: bytes) -> bytes:
    """The content of one or many gzip members; what is not gzipped stays, and so does what precedes a fault."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(data) + member.flush())
        except zlib.error:
            return b"".join(out)
        data = member.unused_data
    return b"".join(out) + data


def parse(data: bytes) -> Iterator[dict[str, object]]:
    """Every record of an archive: the header fields that matter and the block, as long as it says.

    A record without an end of its header or a usable length, or cut short, has a null block; the search goes
    on behind its header. Segment numbers and totals that are no numbers are null.
    """
    number = lambda x: int(x) if x and x.isascii() and x.isdigit() else None
    at = data.find(b"WARC/")
    while 0 <= at < len(data):
        end = data.find(_END, at)
        if end < 0:
            return
        fields = (line.partition(":") for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        fields = {k.strip().lower(): v.strip() for k, _, v in fields}
        start = end + len(_END)
        length = number(fields.get("content-length"))
        broken = length is None or start + length > len(data)
        row = {name: fields.get(key) for key, name in _NAMES.items()}
        row |= {k: number(row[k]) for k in ("segment", "total")}
        yield row | {"block": None if broken else data[start : start + length]}
        at = data.find(b"WARC/", start if broken else start + length)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in ``folder``, gzipped or not."""
    schema = pa.schema([(n, pa.string()) for n in ("type", "record_id", "url", "page_id", "digest", "refers_to")] + [("segment", pa.int32()), ("origin", pa.string()), ("total", pa.int64()), ("block", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out, size = [], 0
                for row in parse(_unzipped(content.as_py())):
                    out.append(row)
                    size += len(row["block"] or b"")
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                yield pa.RecordBatch.from_pylist(out, schema)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(scan, _PARSED)


def dechunk(message: bytes) -> bytes | None:
    """The body of an HTTP message, without chunked framing if it says that it has one; None if that is broken."""
    head, _, body = message.partition(_END)
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        digits = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", digits):
            return None
        size = int(digits, 16)
        if not size:
            return b"".join(out)
        if end + 2 + size > len(body):
            return None
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def read_pages(records: DataFrame) -> DataFrame:
    """Responses and revisits with their ``payload``; a revisit has none of its own.

    ``whole`` is false, and the payload null, where a record is broken or cut short, segments are missing, the
    length is not the stated total, the chunked framing is broken or the payload does not have the stated digest.
    """
    held = records.filter(F.col("type").isin("response", "revisit", "continuation"))
    alone = held.filter("segment IS NULL").withColumn("parts", F.array(F.struct(F.lit(1).alias("segment"), "block")))
    pieces = held.filter("segment IS NOT NULL").withColumn("key", F.coalesce("origin", "record_id"))
    names = ["record_id", "url", "page_id", "type", "digest", "refers_to"]
    first = [F.max(F.when(F.col("segment") == 1, F.col(n))).alias(n) for n in names]
    joined = pieces.groupBy("key").agg(
        *first, F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts")
    )
    columns = [*names, "total", "parts"]
    schema = pa.schema([(n, pa.string()) for n in ("record_id", "page_id", "url", "type", "digest", "refers_to")] + [("payload", pa.binary()), ("whole", pa.bool_())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row in batch.to_pylist():
                parts, total = row.pop("parts"), row.pop("total")
                message = b"".join(p["block"] or b"" for p in parts)
                row["payload"] = None
                row["whole"] = [p["segment"] for p in parts] == list(range(1, len(parts) + 1)) and total in (None, len(message))
                row["whole"] &= (len(parts) == 1 or total is not None) and all(p["block"] is not None for p in parts)
                if row["whole"] and row["type"] == "response":
                    payload = dechunk(message)
                    digest = payload is not None and "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    row["whole"] = payload is not None and row["digest"] in (None, digest)
                    row["payload"] = payload if row["whole"] else None
                    size += len(payload or b"")
                out.append(row)
                if size > _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, schema)

    return alone.select(columns).unionByName(joined.select(columns)).mapInArrow(decode, _PAGES)


def page_digests(pages: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per page read back: what its payload is and where it stands.

    ``payload_bytes`` and ``payload_digest`` (hex SHA-1) are of the full payload, for a revisit of the payload
    of the response it names; both are null where that is not whole. ``refers_to`` is that response's page.
    """
    light = pages.select(
        "record_id",
        F.col("page_id").cast(id_type).alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").alias("named"),
    )
    light = stored(light, "warc-read")
    responses = light.filter("record_type = 'response'")
    known = responses.select(F.col("record_id").alias("named"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest")
    again = light.filter("record_type = 'revisit'").select("page_id", "record_type", "named").join(known, "named", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast(id_type)).select(columns).unionByName(again.select(columns))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""
