"""WARC archives: writing captures, reading records, and assembling transactions.

Writing. A capture is a response (or a revisit of an equal payload) with its request and a metadata record, both
naming the response in WARC-Concurrent-To. Of equal payloads (same SHA-1 and size) the one with the largest id
is stored, the others become revisits under the identical-payload-digest profile; several rows with that id and
payload are all responses. Archives are gzip files: a task writes its rows, at most `FILE_CAPTURES` to a file.

Reading. Files are parsed record by record by their Content-Length, never by searching for marks in payloads. Of a
response, the bytes after the HTTP headers are hashed and counted again, so that a payload that was altered or cut in
the archive no longer agrees with its headers.

Assembly. Requests and metadata are brought to their response through the concurrent-to identifiers in either
direction (a metadata record also through its request), and every response or revisit becomes one nested row.
Of several requests or metadata records of a capture the one with the smallest record id is nested, and their
number is given. Records without a response are left out.

Defined cases. Null html: empty payload. Null url: no target header. Null id: counts as smaller than any id.
Repeated rows: a capture each. Line ends, marks or record headers inside payloads: plain data. Empty table:
empty result. Long payloads: one record each. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridcast.llm.tables import stage
from gridcast.session import scratch_path

FILE_CAPTURES = 5000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: `fields` are the headers without a column of their own. The last two are measured on a response's payload as it was
#: read, whatever its headers say; null for other records.
RECORD = "record_id string, type string, concurrent_to string, target_uri string, payload_digest string, refers_to string, " \
         "fields map<string,string>, block binary, measured_digest string, measured_bytes long"


# ---- writing

def _sha1(text: str | None) -> tuple[str, int]:
    raw = (text or "").encode()
    return base64.b32encode(hashlib.sha1(raw).digest()).decode(), len(raw)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [_sha1(t) for t in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([d for d, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())],
            names=[*b.schema.names, "digest", "bytes"])


def _record(kind: str, record_id, headers, content_type: str, block):
    """A record as a string column; its length counts bytes."""
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), record_id, F.lit(f"\r\nWARC-Date: {DATE}\r\n"), *headers,
             F.lit(f"Content-Type: {content_type}\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block]
    return F.concat(*lines)


def write_captures(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   minimum: int = 0) -> None:
    """Write a request, a response or revisit and a metadata record for every row. Payloads of fewer than
    `minimum` bytes are never revisits."""
    plain = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    kind = plain.schema["id"].dataType.simpleString()
    held = stage(plain.select("id", "html").mapInArrow(_digested, f"id {kind}, html string, digest string, bytes long")
                 .where(F.col("bytes") >= minimum).groupBy("digest", "bytes")
                 .agg(F.max("id").alias("held_by"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "payloads")
    rows = plain.mapInArrow(_digested, f"id {kind}, url string, html string, digest string, bytes long").join(
        held.select("digest", "bytes", "held_by").hint("merge"), ["digest", "bytes"], "left")
    rows = rows.withColumns({"html": F.coalesce("html", F.lit("")), "uuid": F.expr("uuid()")})
    own = F.concat(F.lit("<urn:uuid:"), "uuid", F.lit(">"))
    beside = {k: F.concat(F.lit(f"<urn:uuid:{n}"), F.substring("uuid", 2, 35), F.lit(">"))
              for k, n in (("request", "g"), ("metadata", "h"))}  # not hexadecimal: never an id of a response
    target = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", " "), F.lit("\r\n")), F.lit(""))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest", F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    with_http = "application/http; msgtype=response"
    revisits = F.col("held_by").isNotNull() & ~F.col("id").eqNullSafe(F.col("held_by"))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), own, F.lit("\r\n"))
    end = F.lit("\r\n\r\n")
    text = F.concat(
        _record("request", beside["request"], [target, concurrent], "application/http; msgtype=request",
                F.concat(F.lit("GET "), F.coalesce(F.regexp_replace("url", "[\r\n]", " "), F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n"))), end,
        F.when(revisits, _record("revisit", own, [target, digest, F.lit(f"WARC-Profile: {PROFILE}\r\n")], with_http, http))
        .otherwise(_record("response", own, [target, digest], with_http, F.concat(http, "html"))), end,
        _record("metadata", beside["metadata"], [target, concurrent], "application/warc-fields",
                F.concat(F.lit("pageId: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("\r\n"))))
    (rows.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_CAPTURES).text(path))


# ---- reading

def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an archive."""
    held, at = b"", 0  # bytes read, and how many of them are done with

    def need(size: int) -> bool:
        """Have `size` bytes from `at` on, if the archive has them."""
        nonlocal held, at
        if len(held) - at < size:
            parts = [held[at:]]
            have = len(parts[0])
            while have < size and (part := next(chunks, None)) is not None:
                parts.append(part)
                have += len(part)
            held, at = b"".join(parts), 0
        return len(held) >= at + size

    while True:
        while need(4) and held.startswith(b"\r\n\r\n", at):
            at += 4
        seen = 4
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not need(seen) and held.find(b"\r\n\r\n", at) < 0:
                if held[at:].strip():
                    raise ValueError("an archive ends inside a record")
                return
            seen = max(2 * seen, len(held) - at + 1)
        lines = held[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins with {lines[0][:40]!r}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        at, size = end + 4, int(headers["content-length"])
        if not need(size):
            raise ValueError("an archive ends inside a record")
        at += size
        yield headers, held[at - size:at]


def _unzipped(raw: pa.Buffer, step: int = 1 << 20) -> Iterator[bytes]:
    """The text of one or more gzip members, or of a file that isn't zipped."""
    view = memoryview(raw)
    if bytes(view[:2]) != b"\x1f\x8b":
        yield from (bytes(view[i:i + step]) for i in range(0, len(view), step))
        return
    zipped = zlib.decompressobj(31)
    for i in range(0, len(view), step):
        part = bytes(view[i:i + step])
        while part:
            yield zipped.decompress(part)
            part = zipped.unused_data
            if zipped.eof:
                zipped = zlib.decompressobj(31)


def _measured(kind: str | None, block: bytes) -> tuple[str | None, int | None]:
    """Digest and size of the payload of a response block: what follows its HTTP headers."""
    if kind != "response":
        return None, None
    end = block.find(b"\r\n\r\n")
    payload = memoryview(block)[end + 4 if end >= 0 else 0:]
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split(" ")[0] for f in RECORD.split(", ")]
    own = ["warc-record-id", "warc-type", "warc-concurrent-to", "warc-target-uri", "warc-payload-digest", "warc-refers-to"]
    kinds = [*[pa.string()] * 6, pa.map_(pa.string(), pa.string()), pa.binary(), pa.string(), pa.int64()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for b in batches:
        for r in range(b.num_rows):
            rows, held = [], 0
            for h, block in parse(_unzipped(b.column(0)[r].as_buffer())):
                rows.append((*[h.get(name) for name in own], [(k, v) for k, v in h.items() if k not in own], block,
                             *_measured(h.get("warc-type"), block)))
                held += len(block)
                if held > 4 << 20:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under `path`; a file is one task's work at most."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_records, RECORD)


# ---- assembly

def transactions(records: DataFrame) -> DataFrame:
    """One row per response or revisit: capture_id, response, request, metadata (structs of the record's columns),
    requests and metadata_records (their numbers)."""
    links = records.select("record_id", "type", "concurrent_to")
    main = links.where("type IN ('response', 'revisit')")
    side = links.where("type IN ('request', 'metadata')")

    # (side record, response) in either direction.
    points = side.where("concurrent_to IS NOT NULL").select(F.col("record_id").alias("side"), F.col("concurrent_to").alias("other"))
    back = main.where("concurrent_to IS NOT NULL").select(F.col("concurrent_to").alias("side"), F.col("record_id").alias("capture"))
    direct = points.join(main.select(F.col("record_id").alias("capture")).hint("merge"), F.col("other") == F.col("capture")).select("side", "capture")
    known = stage(direct.unionAll(back).groupBy("side").agg(F.min("capture").alias("capture")), "captures")
    through = points.join(known.select(F.col("side").alias("other"), "capture").hint("merge"), "other").select("side", "capture")
    known = stage(known.unionAll(through).groupBy("side").agg(F.min("capture").alias("capture")), "captures")

    def nested(kind: str, count: str) -> DataFrame:
        rows = records.where(F.col("type") == kind)
        found = rows.join(known.hint("merge"), rows.record_id == known.side).select("capture", F.struct(*[rows[c] for c in rows.columns]).alias("r"))
        # A map cannot be compared, so the smallest record is taken by its id.
        return found.groupBy("capture").agg(F.min_by("r", "r.record_id").alias(kind), F.count(F.lit(1)).alias(count))

    captures = records.where("type IN ('response', 'revisit')").select(
        F.col("record_id").alias("capture"), F.struct(*[F.col(c) for c in records.columns]).alias("response"))
    for kind, count in (("request", "requests"), ("metadata", "metadata_records")):
        captures = captures.join(nested(kind, count).hint("merge"), "capture", "left")
    return captures.select(F.col("capture").alias("capture_id"), "response", "request", "metadata",
                           F.coalesce("requests", F.lit(0)).alias("requests"),
                           F.coalesce("metadata_records", F.lit(0)).alias("metadata_records"))


def archive(pages: DataFrame, name: str = "archive") -> DataFrame:
    """Write the captures of `pages` to the shared scratch folder, read them back and assemble them."""
    spark, path = pages.sparkSession, scratch_path(pages.sparkSession, name)
    write_captures(pages, path)
    # Parsed once: the assembly reads the records several times. Payloads compress well.
    return transactions(stage(read_records(spark, path), "records", compression="zstd"))
