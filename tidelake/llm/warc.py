"""WARC archives written and read with Spark: revisits, segmented records, chunked HTTP bodies."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import arrow_map

SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 8 << 10
RECORDS_PER_FILE = 500
SEGMENT_ROWS = 64
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def whole_characters(data: bytes, most: int) -> Iterator[bytes]:
    """UTF-8 bytes in parts of at most ``most`` bytes that never cut a character."""
    at = 0
    while at < len(data):
        end = min(len(data), at + most)
        while end < len(data) and end > at + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in HTTP chunked transfer framing."""
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in whole_characters(payload, size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are passed over, damage raises ValueError."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without end")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = [line.split(b":", 1) for line in head.split(b"\r\n")[1:]]
    coding = {k.strip().lower(): v.strip().lower() for k, v in fields if v}.get(b"transfer-encoding")
    return unchunked(body) if coding == b"chunked" else body


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> str:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n{block.decode()}"


def _record_id(page_id, digest: str, alone: bool) -> str:
    """Of a record of its own: rows that repeat a page_id and payload differ in a random part."""
    own = f"urn:page:{'' if page_id is None else page_id}:{digest}"
    return f"<{own}>" if alone else f"<{own}:{uuid.uuid4()}>"


def _records_of(
    page_id, url: str | None, html: bytes, n: int, first, first_n, date: str, segment: int
) -> Iterator[str]:
    digest = digest32(html)
    own = _record_id(page_id, digest, n == 1)
    target = " ".join((url or "").split())
    common = [("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}")]
    page = [] if page_id is None else [("WARC-Page-ID", str(page_id))]
    if first is not None and first != page_id:
        refers = [("WARC-Refers-To-Page-ID", str(first)), ("WARC-Profile", PROFILE)]
        if first_n == 1:
            refers.append(("WARC-Refers-To", _record_id(first, digest, True)))
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, *page, *refers], b"")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(html)
    parts = list(whole_characters(block, segment))
    kind = ("Content-Type", "application/http; msgtype=response")
    for number, part in enumerate(parts, 1):
        fields = [("WARC-Type", "response" if number == 1 else "continuation")]
        fields.append(("WARC-Record-ID", own if number == 1 else f"{own[:-1]}:{number}>"))
        fields += [*common, *page, kind] if number == 1 else [*common[:2], *page]
        if len(parts) > 1:
            fields.append(("WARC-Segment-Number", str(number)))
        if number > 1:
            fields.append(("WARC-Segment-Origin-ID", own))
        if number > 1 and number == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(fields, part)


def _as_records(date: str, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "n", "first", "first_n")]
            for page_id, url, html, *role in zip(*columns):
                out += _records_of(page_id, url, (html or "").encode(), *role, date, segment)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    return run


def write_archives(
    pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", segment_bytes: int = SEGMENT_BYTES
) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) into gzipped archives under ``path``.

    Of rows with equal payloads the smallest page_id is the response and the others revisit it;
    rows that repeat a page_id and payload are alike. Each record has an id of its own and its page_id
    in ``WARC-Page-ID``, a NULL one being left out; a revisit names the page in
    ``WARC-Refers-To-Page-ID``, and the record too if only one has that page and payload. NULL html is an empty payload, a NULL url an
    empty target. Blocks over ``segment_bytes`` continue in further records. The record end is the
    line separator of Spark's text writer, so any file system Spark writes to will do. Other columns
    are ignored; an empty table writes no records.
    """
    pages = pages.select(F.col("page_id").cast("long"), F.col("url"), F.coalesce("html", F.lit("")).alias("html"))
    named = pages.select("page_id", F.sha1("html").alias("sha"))
    counts = named.groupBy("page_id", "sha").agg(F.count("*").alias("n"))
    first = counts.groupBy("sha").agg(F.min("page_id").alias("first"), F.min_by("n", "page_id").alias("first_n"))
    # Narrow rows meet on the payload, of which one may be a third of all; the pages meet on their id.
    roles = counts.join(first, "sha")
    same = pages.withColumn("sha", F.sha1("html")).alias("p").join(
        roles.alias("r"), F.expr("p.page_id <=> r.page_id and p.sha = r.sha")
    )
    rows = same.select("p.page_id", "p.url", "p.html", "r.n", "r.first", "r.first_n")
    records = arrow_map(rows, _as_records(date, segment_bytes), "value string")
    writer = records.write.option("lineSep", RECORD_END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def records_in(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}
        start, size = end + 4, int(fields["content-length"])
        if len(data) < start + size:
            raise ValueError("record cut short")
        yield fields, data[start : start + size]
        at = start + size + 4


def gunzipped(data: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while data:
        member = zlib.decompressobj(31)
        out += [member.decompress(data), member.flush()]
        data = member.unused_data
    return b"".join(out)


def _page(fields: dict[str, str], *names: str) -> int | None:
    """The page_id in the first of the fields there is; a record's id may be ``<urn:page:…>`` in older archives."""
    value = next((fields[n] for n in names if n in fields), "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value.removeprefix("-").isdecimal() else None


READ = "page_id long, uri string, record_type string, refers_to long, payload binary, payload_digest string, complete boolean"
_READ_KINDS = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.bool_()]
SEGMENT = "origin string, page_id long, uri string, digest string, segment int, total long, block binary"
_SEGMENT_KINDS = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]


def _batch(rows: list[tuple], schema: str, kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _read_row(page_id, uri, kind, refers_to, digest, block: bytes | None) -> tuple:
    """What a whole record says; a damaged one has no payload or is not complete."""
    payload, complete = None, block is not None
    if kind == "response" and complete:
        try:
            payload = payload_of(block)
            own = digest32(payload)
            complete, digest = digest in (None, own), own
        except ValueError:
            complete = False
    return page_id, uri, kind, refers_to, payload, digest, complete


def _parse(segmented: bool):
    """Whole records as they are read, or the parts of segmented ones."""
    schema, kinds = (SEGMENT, _SEGMENT_KINDS) if segmented else (READ, _READ_KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows, held = [], 0
                for fields, block in records_in(gunzipped(content) if content[:2] == b"\x1f\x8b" else content):
                    if ("warc-segment-number" in fields) != segmented:
                        continue
                    uri, digest = fields.get("warc-target-uri"), fields.get("warc-payload-digest", "")
                    digest = digest.removeprefix("sha1:") or None
                    page = _page(fields, "warc-page-id", "warc-segment-origin-id", "warc-record-id")
                    if segmented:
                        origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                        total = fields.get("warc-segment-total-length")
                        total = None if total is None else int(total)
                        rows.append((origin, page, uri, digest, int(fields["warc-segment-number"]), total, block))
                    else:
                        refers = _page(fields, "warc-refers-to-page-id", "warc-refers-to")
                        rows.append(_read_row(page, uri, fields["warc-type"], refers, digest, block))
                    held += len(block)
                    if held > 8 << 20:
                        yield _batch(rows, schema, kinds)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, schema, kinds)

    return run


def _reassemble(parts: dict[int, dict]) -> tuple:
    """One segmented record; without all numbers from 1, or with another total length, it stays incomplete."""
    first, last = parts.get(1), parts[max(parts)]
    block = None
    if first and sorted(parts) == list(range(1, len(parts) + 1)) and last["total"] is not None:
        block = b"".join(parts[k]["block"] for k in sorted(parts))
        block = block if len(block) == last["total"] else None
    known = first or last
    return _read_row(known.get("page_id"), known["uri"], "response", None, known["digest"], block)


def _records_of_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segmented records put together from segments that come in order of their origin."""
    parts: dict[int, dict] = {}
    origin = None
    for batch in batches:
        rows = []
        for segment in batch.to_pylist():
            if parts and segment["origin"] != origin:
                rows.append(_reassemble(parts))
                parts = {}
            origin = segment["origin"]
            parts[segment["segment"]] = segment
        if rows:
            yield _batch(rows, READ, _READ_KINDS)
    if parts:
        yield _batch([_reassemble(parts)], READ, _READ_KINDS)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, uri, record_type, refers_to, payload, payload_digest, complete) of the archives under ``path``.

    Continuation records are put together by origin and segment number; a record whose segments,
    total length, chunk framing or digest do not agree has ``complete`` false. Records of one file
    are read by one task, so writers bound the records of a file.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    # Spark takes one size of batches for all three; files are bounded by their bytes before it is reached.
    whole = arrow_map(files, _parse(False), READ, rows=SEGMENT_ROWS)
    parts = arrow_map(files, _parse(True), SEGMENT, rows=SEGMENT_ROWS)
    in_order = parts.repartition("origin").sortWithinPartitions("origin", "segment")
    return whole.unionByName(arrow_map(in_order, _records_of_segments, READ, rows=SEGMENT_ROWS))
