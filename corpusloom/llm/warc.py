"""WARC archives: writing pages, and reading records back whole.

Written blocks are HTTP responses in chunked transfer framing. A block longer than a segment goes on
in continuation records. On reading, continuations are grouped by the identifier of the record they
began with, put in the order of their segment numbers, checked against the total length that the last
one states, and only then is the chunked framing undone. Single records need no group and no shuffle.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import LARGE_JOIN, slices

LEAST_REVISIT_BYTES = 1000
SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 16 << 10
RECORDS_PER_FILE = 1000

# Lines of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CHUNKED = b"Transfer-Encoding: chunked\r\n"
END = "\r\n\r\n"

_RECORD = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string"


def framed(payload: bytes, chunk: int) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for start in range(0, len(payload), chunk):
        piece = payload[start : start + chunk]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unframed(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken or not closed."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size missing")
        digits = body[at:line].split(b";")[0].strip()
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("chunk size is not a number")
        size, at = int(digits, 16), line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut off")
        out.append(body[at : at + size])
        at += size + 2


def record_bytes(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record without the two line ends that close it."""
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields if value is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END.encode() + block


def _one_line(text: str | None) -> str | None:
    return None if text is None else "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def _records(segment: int, chunk: int, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of(row: dict) -> Iterator[bytes]:
        own = f"<{row['record_id']}>"
        common = [("WARC-Date", date), ("WARC-Target-URI", _one_line(row["url"])), ("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("Content-Type", HTTP_TYPE)]
        if row["refers_to"] is not None:
            first = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Refers-To", f"<{row['refers_to']}>"), ("WARC-Profile", PROFILE)]
            yield record_bytes(first + common, HTTP_HEAD + b"\r\n")
            return
        block = HTTP_HEAD + CHUNKED + b"\r\n" + framed((row["html"] or "").encode(), chunk)
        first = [("WARC-Type", "response"), ("WARC-Record-ID", own)]
        if len(block) <= segment:
            yield record_bytes(first + common, block)
            return
        starts = range(0, len(block), segment)
        yield record_bytes([*first, ("WARC-Segment-Number", "1"), *common], block[:segment])
        for number, start in enumerate(starts[1:], 2):
            total = str(len(block)) if start + segment >= len(block) else None
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{row['record_id']}:{number}>"), ("WARC-Segment-Origin-ID", own)]
            fields += [("WARC-Segment-Number", str(number)), ("WARC-Segment-Total-Length", total), ("WARC-Date", date)]
            yield record_bytes(fields, block[start : start + segment])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                records = [r for row in part.to_pylist() for r in of(row)]
                yield pa.record_batch([pa.array(records, pa.binary())], names=["record"])

    return run


def write_warc(pages: DataFrame, folder: str, least: int = LEAST_REVISIT_BYTES, segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per row of (page_id, url, html) to gzip files in ``folder``, payload the html in UTF-8.

    Of equal payloads of at least ``least`` bytes the one with the largest page_id is a response and
    the others are revisits that refer to it; if that page_id is repeated, or no row has one, each such
    row is a response. Smaller payloads are all responses. A null html is an empty payload, a null url
    is left out, and control characters and spaces in a url are percent-encoded. An empty table gives
    no records. Further columns are ignored.
    """
    if segment < 1 or chunk < 1:
        raise ValueError("segment and chunk must be positive")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= least
    groups = rows.where(large).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n")
    name = lambda page: F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), F.col("digest"))
    again = large & F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    placed = rows.join(groups.hint(LARGE_JOIN), "digest", "left")
    placed = placed.select(name(F.col("page_id")).alias("record_id"), F.when(again, name(F.col("top"))).alias("refers_to"), "url", "digest", F.when(~again, F.col("html")).alias("html"))
    records = placed.mapInArrow(_records(segment, chunk, date), "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The fields (names in lower case) and the block of each record."""
    at = 0
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.find(END.encode(), at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            fields[name.decode().strip().lower()] = value.decode().strip()
        start = end + 4
        size = int(fields["content-length"])
        if start + size > len(data):
            raise ValueError(f"the record at byte {at} is cut off")
        yield fields, data[start : start + size]
        at = start + size


def _payload(block: bytes) -> bytes:
    head, split, body = block.partition(b"\r\n\r\n")
    if not split:
        raise ValueError("no HTTP header")
    chunked = any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n")[1:])
    return unframed(body) if chunked else body


def _finished(block: bytes, record_type: str) -> tuple[bytes | None, str | None]:
    if record_type == "revisit":
        return None, None
    try:
        return _payload(block), None
    except ValueError as error:
        return None, str(error)


def _bare(value: str | None) -> str | None:
    return None if value is None else value.strip("<>")


def _inflated(data: bytes) -> tuple[bytes, str | None]:
    """The content of a plain or gzip file as far as it can be read, and what stopped it."""
    if data[:2] != b"\x1f\x8b":
        return data, None
    parts = []
    with gzip.GzipFile(fileobj=io.BytesIO(data)) as stream:
        try:
            while part := stream.read(1 << 20):
                parts.append(part)
        except (EOFError, OSError, zlib.error) as error:
            return b"".join(parts), f"damaged gzip file: {error}"
    return b"".join(parts), None


def _until_damage(data: bytes) -> Iterator[tuple[dict[str, str], bytes] | str]:
    """The records of a file; where it is damaged, at last what is wrong with it."""
    content, problem = _inflated(data)
    try:
        yield from parse_records(content)
    except (ValueError, KeyError) as error:
        problem = problem or f"damaged file: {error}"
    if problem:
        yield problem


def _parsed(segmented: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records that are whole, finished, or (``segmented``) parts of records."""
    names = ["record_id", "record_type", "target_uri", "refers_to", "payload_digest"]

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.string()) for c in zip(*(r[:5] for r in rows), strict=True)] or [pa.array([], pa.string())] * 5
        if segmented:
            columns += [pa.array([r[k] for r in rows], pa.int64()) for k in (5, 6)] + [pa.array([r[7] for r in rows], pa.binary())]
            return pa.record_batch(columns, names=[*names, "segment", "total", "block"])
        columns += [pa.array([r[5] for r in rows], pa.binary()), pa.array([r[6] for r in rows], pa.string())]
        return pa.record_batch(columns, names=[*names, "payload", "problem"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data = content.as_buffer().to_pybytes()
                rows, held = [], 0
                for found in _until_damage(data):
                    if isinstance(found, str):
                        if not segmented:
                            rows.append([None] * 6 + [f"{path}: {found}"])
                        continue
                    fields, block = found
                    number, kind = fields.get("warc-segment-number"), fields.get("warc-type")
                    if kind not in ("response", "revisit", "continuation") or (number is not None) != segmented:
                        continue
                    own = _bare(fields.get("warc-segment-origin-id", fields.get("warc-record-id")))
                    refers, digest = _bare(fields.get("warc-refers-to")), fields.get("warc-payload-digest")
                    row = [own, kind, fields.get("warc-target-uri"), refers, digest and digest.removeprefix("sha1:")]
                    total = fields.get("warc-segment-total-length")
                    row += [int(number), total and int(total), block] if segmented else _finished(block, kind)
                    rows.append(row)
                    held += len(block)
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    return run


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            parts: dict[int, list[dict]] = {}
            for part in row["parts"]:
                parts.setdefault(part["segment"], []).append(part)
            first = parts.get(1, [{}])[0]
            last = parts[max(parts)][0]
            block = b"".join(parts[k][0]["block"] for k in sorted(parts))
            if sorted(parts) != list(range(1, len(parts) + 1)):
                payload, problem = None, "a segment is missing"
            elif last["total"] != len(block):
                payload, problem = None, "the total length differs"
            else:
                payload, problem = _finished(block, first["record_type"])
            # equal records that were written more than once come back as often
            copies = max(1, min(map(len, parts.values())))
            values = [(row["record_id"], pa.string()), ("response", pa.string()), *((first.get(n), pa.string()) for n in ("target_uri", "refers_to", "payload_digest")), (payload, pa.binary()), (problem, pa.string())]
            names = ["record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload", "problem"]
            yield pa.record_batch([pa.array([v] * copies, t) for v, t in values], names=names)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The response and revisit records of all files in ``folder``, plain or gzip.

    Returns record_id, record_type, target_uri, refers_to, payload_digest (as stated), payload (null
    for a revisit) and problem: null, or what is wrong with a record (a segment missing, another total
    length, broken framing), whose payload is then null. Records of other types are passed over.
    Records written more than once come back as often. A file that is cut off or damaged gives its records
    up to there, and a row with nothing but a problem that names it.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    whole = files.mapInArrow(_parsed(False), f"{_RECORD}, payload binary, problem string")
    parts = files.mapInArrow(_parsed(True), f"{_RECORD}, segment long, total long, block binary")
    fields = ("segment", "total", "block", "record_type", "target_uri", "refers_to", "payload_digest")
    # a group is one record: as long as one payload
    grouped = parts.groupBy("record_id").agg(F.collect_list(F.struct(*fields)).alias("parts"))
    return whole.unionByName(grouped.mapInArrow(_reassembled, f"{_RECORD}, payload binary, problem string"))


def page_of(record_id: Column) -> Column:
    """The page_id in the name of a record that :func:`write_warc` wrote."""
    return F.split(record_id, ":")[2].try_cast("long")
