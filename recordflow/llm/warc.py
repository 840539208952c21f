"""WARC archives: records are written in segments with chunked transfer framing, and put together again.

Archives are gzip files of Spark's text source, whose record separator ends each WARC record, so
writing and reading go through Spark's own committed writers and readers on any file system.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.llm.common import mapped, staged, table
from recordflow.plans.staging import StagingArea

VERSION = b"WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes of a block beyond which it goes on in continuation records, and of a chunk of its framing.
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10

#: Payloads of at least so many bytes are stored once; equal ones refer to the first.
REVISIT_BYTES = 0

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; a body that ends before its last chunk is an error."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunked body ends within a chunk size")
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk isn't as long as its size says")
        out.append(body[end + 2 : at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block, out of its transfer framing if it has one."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:.*\bchunked\s*$", head) else body


def header(fields: dict[str, object], length: int) -> bytes:
    """A record's head; control characters in values are percent-encoded, null values left out."""
    clean = {k: re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", str(v)) for k, v in fields.items() if v is not None}
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in clean.items()).encode() + f"Content-Length: {length}\r\n\r\n".encode()


def records(page_id: int | None, url: str | None, payload: bytes, row: int, original: int | None, segment: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of one page, each without the separator that ends it."""
    own = f"<urn:x-row:{row}>"
    fields = {"WARC-Type": "response", "WARC-Record-ID": own, "WARC-Date": "2020-01-01T00:00:00Z", "WARC-Target-URI": url}
    fields |= {"WARC-Payload-Digest": f"sha1:{digest(payload)}", "X-Payload-Length": len(payload), "X-Page-ID": page_id}
    fields["Content-Type"] = "application/http; msgtype=response"
    if original is not None:
        block = HTTP_HEAD + b"\r\n"
        yield header(fields | {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "X-Refers-To-Page": original}, len(block)) + block
        return
    block = HTTP_HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    if len(parts) == 1:
        yield header(fields, len(block)) + block
        return
    yield header(fields | {"WARC-Segment-Number": 1}, len(parts[0])) + parts[0]
    for i, part in enumerate(parts[1:], 2):
        more = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:x-row:{row}:{i}>", "WARC-Date": fields["WARC-Date"]}
        more |= {"WARC-Segment-Origin-ID": own, "WARC-Segment-Number": i}
        yield header(more | ({"WARC-Segment-Total-Length": len(block)} if i == len(parts) else {}), len(part)) + part


def write_warc(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, segment: int = SEGMENT_BYTES) -> None:
    """Write (page_id, url, html) as archives, one file per task.

    Of pages with equal payloads of ``revisit_bytes`` or more, those of the largest page_id are responses and the
    others revisits that refer to it. A null html is an empty payload; a null id is smaller
    than every other, and if all ids of a payload are null its pages are all responses. Repeated
    rows are records of their own; other columns aren't written.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.encode("html", "utf-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("key", F.when(F.octet_length("payload") >= revisit_bytes, F.sha2("payload", 256)))
    same = rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    # Only payloads that occur again; a hot one is a single row here and can be split on the other side.
    same = staged(same.where((F.col("n") > 1) & F.col("original").isNotNull()).select(F.col("key").alias("same"), "original"), "warc-equal")
    rows = rows.join(same, F.col("key") == F.col("same"), "left").withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("page_id", "url", "payload", "row", F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original")).alias("original"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made = list(records(row["page_id"], row["url"], row["payload"], row["row"], row["original"], segment))
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])

    made = mapped(rows, run, "record binary").select(F.col("record").cast("string").alias("value"))
    made.write.option("lineSep", END).option("compression", "gzip").text(path)


RECORD = "record_id string, type string, page_id bigint, url string, digest string, length bigint, refers_to bigint, origin string, segment int, total bigint, block binary"
_NAMES = [f.split()[0] for f in RECORD.split(", ")]
_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_SCHEMA = pa.schema([(n, _TYPES[f.split()[1]]) for n, f in zip(_NAMES, RECORD.split(", "), strict=True)])


def parsed(record: bytes) -> dict | None:
    """The fields of a record without its version line; null if it goes on beyond these bytes."""
    head, gap, block = record.partition(b"\r\n\r\n")
    fields = dict(re.findall(r"(?m)^([^:\r\n]+):[ \t]*([^\r\n]*)", head.decode("utf-8", "replace")))
    fields = {k.lower(): v for k, v in fields.items()}
    if not gap or len(block) < int(fields.get("content-length", 0)):
        return None
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "record_id": fields.get("warc-record-id"),
        "type": fields.get("warc-type"),
        "page_id": number("x-page-id"),
        "url": fields.get("warc-target-uri"),
        "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "length": number("x-payload-length"),
        "refers_to": number("x-refers-to-page"),
        "origin": fields.get("warc-segment-origin-id") or fields.get("warc-record-id"),
        "segment": number("warc-segment-number") or 1,
        "total": number("warc-segment-total-length"),
        "block": block[: int(fields.get("content-length", 0))],
    }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of gzip archives. A version line within a payload doesn't end a record: its length tells."""
    lines = spark.read.option("lineSep", VERSION.decode()).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held = None, None
        for batch in batches:
            found = []
            for name, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if name != file:
                    if held is not None:
                        raise ValueError(f"{file} ends within a record")
                    file = name
                if held is None and not value.strip():
                    continue  # what is before the first record
                held = value if held is None else held + VERSION + value
                if (record := parsed(held)) is not None:
                    found.append(record)
                    held = None
            yield pa.RecordBatch.from_pylist(found, _SCHEMA)
        if held is not None:
            raise ValueError(f"{file} ends within a record")

    return mapped(lines, run, RECORD)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits with their payloads: (page_id, url, type, refers_to, payload, payload_bytes, payload_digest, complete).

    Records of one origin are sorted by segment and streamed, so a task holds one payload at a
    time. ``complete`` is false where a segment is missing, the total length differs, the framing
    is broken or the digest isn't that of the payload; the payload is null then. Revisits have a
    null payload, and the size and digest that they state. A segment that occurs again is passed over.
    """
    parts = read_records(spark, path).where(F.col("type").isin("response", "revisit", "continuation"))
    parts = parts.repartition("origin").sortWithinPartitions("origin", "segment")
    out = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("complete", pa.bool_())]
    )

    def whole(first: dict, blocks: list[bytes], total: int | None, broken: bool) -> dict:
        row = {k: first[k] for k in ("page_id", "url", "type", "refers_to")} | {"payload": None, "payload_bytes": first["length"], "payload_digest": first["digest"]}
        if first["type"] == "revisit":
            return row | {"complete": True}
        block = b"".join(blocks)
        try:
            if broken or first["segment"] != 1 or (total is not None and total != len(block)) or (len(blocks) > 1 and total is None):
                raise ValueError("segments are missing")
            payload = payload_of(block)
            if first["digest"] and digest(payload) != first["digest"]:
                raise ValueError("the digest differs")
        except ValueError:
            return row | {"complete": False}
        return row | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest(payload), "complete": True}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, blocks, last, total, broken = None, [], 0, None, False
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if first is None or r["origin"] != first["origin"]:
                    if first is not None:
                        done.append(whole(first, blocks, total, broken))
                    first, blocks, last, total, broken = r, [r["block"]], r["segment"], r["total"], r["segment"] != 1
                elif r["segment"] > last:
                    broken = broken or r["segment"] != last + 1
                    blocks.append(r["block"])
                    last, total = r["segment"], r["total"] if r["total"] is not None else total
            yield pa.RecordBatch.from_pylist(done, out)
        if first is not None:
            yield pa.RecordBatch.from_pylist([whole(first, blocks, total, broken)], out)

    schema = "page_id bigint, url string, type string, refers_to bigint, payload binary, payload_bytes bigint, payload_digest string, complete boolean"
    return mapped(parts, run, schema)


def op6_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = StagingArea(spark).new_path("warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    rows = read_warc(spark, path)
    return rows.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to", "complete")
