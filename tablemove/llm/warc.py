"""WARC archives: written by Spark's text writer, read back with segments put together again.

A payload that occurs more than once is stored with the smallest page; the other pages become
revisit records. Long blocks are split over continuation records, long payloads use chunked
transfer framing. All strings are cut between code points, so archives stay valid UTF-8.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemove.llm.common import in_arrow

#: Blocks above this many bytes are segmented, payloads above the second number are chunked.
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
#: Bounds the size of an archive, which one task holds when it reads.
RECORDS_PER_FILE = 2000
MIN_REVISIT_BYTES = 0

_DATE = "1970-01-01T00:00:00Z"
_END = b"\r\n\r\n"
_PARSED = (
    "record string, segment long, page_id long, record_type string, refers_to long, "
    "stated_bytes long, stated_digest string, total long, block binary, verified boolean"
)
_PAGES = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, verified boolean"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in pieces of at most ``size`` bytes that don't split a code point."""
    start = 0
    while start < len(data):
        end = min(start + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[start:end]
        start = end


def _http(payload: bytes) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if len(payload) <= CHUNK_BYTES:
        return head + b"Content-Length: %d\r\n\r\n%b" % (len(payload), payload)
    framed = b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in _cuts(payload, CHUNK_BYTES))
    return head + b"Transfer-Encoding: chunked\r\n\r\n" + framed + b"0\r\n\r\n"


def _record(fields: dict[str, object], block: bytes) -> str:
    """A record but for its last line end, which the writer adds."""
    lines = [f"{name}: {value}" for name, value in fields.items() if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return f"{head}\r\n\r\n{block.decode()}\r\n"


def _one_line(text: str | None) -> str | None:
    return None if text is None else "".join(f"%{ord(c):02X}" if c <= " " else c for c in text)


def records_of(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, unique: str) -> Iterator[str]:
    """The record of a page, and the continuation records that follow from its length."""
    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {unique}')}>"
    common = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": name,
        "WARC-Date": _DATE,
        "WARC-Target-URI": _one_line(url),
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "X-Page-ID": page_id,
        "X-Payload-Length": len(payload),
    }
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record(common | {"WARC-Profile": profile, "X-Refers-To-Page-ID": refers_to}, b"")
        return
    common["Content-Type"] = "application/http; msgtype=response"
    block = _http(payload)
    if len(block) <= SEGMENT_BYTES:
        yield _record(common, block)
        return
    segments = list(_cuts(block, SEGMENT_BYTES))
    yield _record(common | {"WARC-Segment-Number": 1}, segments[0])
    for number, segment in enumerate(segments[1:], 2):
        fields = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {number}')}>",
            "WARC-Date": _DATE,
            "WARC-Segment-Origin-ID": name,
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if number == len(segments) else None,
        }
        yield _record(fields, segment)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, row = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids, urls, pages, refers = (batch.column(i) for i in range(4))
        texts: list[str] = []
        size = 0
        for i in range(batch.num_rows):
            payload = (pages[i].as_py() or "").encode()
            row += 1
            for text in records_of(ids[i].as_py(), urls[i].as_py(), payload, refers[i].as_py(), f"{task} {row}"):
                texts.append(text)
                size += len(text)
            if size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])
                texts, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write the pages ``(page_id, url, html)`` as compressed archives below ``path``.

    Of pages with the same payload of at least ``min_revisit_bytes`` bytes, the smallest page
    is written as a response, the others as revisits of it; rows that repeat the smallest
    page are responses too. NULL payloads are empty. Pages without an id refer to the
    smallest id of their payload, or are responses if none of them has one.
    """
    given = pages.select("page_id", "url", "html")
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    known = given.select("page_id", digest.alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    first = (
        known.filter(F.col("size") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    joined = given.withColumn("digest", digest).join(first, "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    records = joined.select(F.col("page_id").cast("long"), "url", "html", refers.cast("long").alias("refers_to"))
    (
        in_arrow(records, _write, "value string")
        .write.option("lineSep", "\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of an uncompressed archive."""
    at = 0
    while at < len(archive):
        end = archive.index(_END, at)
        lines = archive[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + len(_END)
        at = start + int(fields["Content-Length"])
        yield fields, archive[start:at]
        if archive[at : at + 4] != _END:
            raise ValueError(f"record doesn't end at byte {at}")
        at += 4


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _PARSED.split(", ")]
    numbers = [pa.int64()] * 2
    kinds = [pa.string(), *numbers, pa.string(), *numbers, pa.string(), pa.int64(), pa.binary(), pa.bool_()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for fields, block in parse(gzip.decompress(content.as_py())):
                row = {
                    "record": fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]),
                    "segment": int(fields.get("WARC-Segment-Number", 1)),
                    "page_id": _number(fields.get("X-Page-ID")),
                    "record_type": fields["WARC-Type"],
                    "refers_to": _number(fields.get("X-Refers-To-Page-ID")),
                    "stated_bytes": _number(fields.get("X-Payload-Length")),
                    "stated_digest": fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
                    "total": _number(fields.get("WARC-Segment-Total-Length")),
                    "block": block,
                    "verified": None,
                }
                if "WARC-Segment-Number" not in fields:
                    # Whole as it is: only segments have to travel with their blocks.
                    page = _finish([row | {"total": len(block)}])
                    row |= {"stated_bytes": page["payload_bytes"], "stated_digest": page["payload_digest"]}
                    row |= {"block": None, "verified": page["verified"]}
                    block = b""
                rows.append(tuple(row[n] for n in names))
                size += len(block)
                if size > 8 << 20:
                    yield made(rows)
                    rows, size = [], 0
            yield made(rows)


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response, out of its chunked framing if it has one."""
    end = block.index(_END)
    head, body = block[:end].lower(), block[end + len(_END) :]
    if b"transfer-encoding: chunked" not in head:
        return body
    chunks, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(chunks)
        chunk = body[line + 2 : line + 2 + size]
        if len(chunk) != size:
            raise ValueError("a chunk is cut short")
        chunks.append(chunk)
        at = line + 2 + size + 2


def _finish(rows: list[dict]) -> dict:
    """The page of the segments of one record, in order."""
    head = rows[0]
    page = {"page_id": head["page_id"], "record_type": head["record_type"], "refers_to": head["refers_to"]}
    if head["verified"] is not None or head["record_type"] == "revisit":
        stated = {"payload_bytes": head["stated_bytes"], "payload_digest": head["stated_digest"]}
        return page | stated | {"verified": head["verified"] is not False}
    block = b"".join(r["block"] for r in rows)
    whole = [r["segment"] for r in rows] == list(range(1, len(rows) + 1)) and rows[-1]["total"] == len(block)
    try:
        payload = payload_of(block)
    except ValueError:
        return page | {"payload_bytes": None, "payload_digest": None, "verified": False}
    digest = base32_sha1(payload)
    return page | {
        "payload_bytes": len(payload),
        "payload_digest": digest,
        "verified": whole and digest == head["stated_digest"] and len(payload) == head["stated_bytes"],
    }


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by record and segment; only the segments of one record are held."""
    names = [c.split()[0] for c in _PAGES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]

    def made(pages: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([p[n] for p in pages], k) for n, k in zip(names, kinds, strict=True)], names
        )

    open_rows: list[dict] = []
    for batch in batches:
        pages = []
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            if open_rows and open_rows[0]["record"] != row["record"]:
                pages.append(_finish(open_rows))
                open_rows = []
            open_rows.append(row)
        yield made(pages)
    if open_rows:
        yield made([_finish(open_rows)])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page in the archives: the contract's columns and ``verified``.

    Continuation records are brought to their origin by a shuffle on its identifier, and put
    together in the order of their numbers; records that aren't segmented are read where they are. ``verified`` is false where a segment is missing,
    the total length or the digest differs, or the framing is broken; a broken frame gives
    no payload. The rows of one record are held together, as its payload is one value.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    segments = in_arrow(files, _parse, _PARSED)
    return in_arrow(segments.repartition("record").sortWithinPartitions("record", "segment"), _assemble, _PAGES)
