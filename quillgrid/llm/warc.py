"""Legacy ARC archives turned into WARC, and WARC archives written and read.

An ARC file opens with a ``filedesc:`` record that tells its version and the
fields of the header lines that follow; each record is one such line and as many
bytes as the line declares. From these come the WARC fields: an identifier that
is the same each time (a UUID of file, place and line), the time stamp in ISO
form, the type by what the block holds, and SHA-1 digests of block and payload.

Archives are handled one per row, each by one task; how large they grow is the
writer's choice. ``write_warc`` writes one archive per task through Spark's text
sink with the record end as line separator, and ``read_warc`` cuts the files by
declared lengths, so that payloads may hold anything.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quillgrid.llm.common import checkpointed

# Fields of the header lines by version, fixed values of the ARC format.
ARC_FIELDS = {
    "1": ["url", "ip", "date", "content_type", "length"],
    "2": ["url", "ip", "date", "content_type", "result_code", "checksum", "location", "offset", "filename", "length"],
}
WARC_VERSION = b"WARC/1.1"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "archive string, offset long, record_id string, record_type string, uri string, ip string, date string,"
    " content_type string, http string, payload binary, payload_digest string, block_digest string, payload_bytes long"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(digits: str) -> str:
    """A 14-digit ARC date as ISO 8601. Missing parts count as their first value, anything else as the epoch."""
    text = digits if digits.isdigit() else ""
    text = (text + "19700101000000"[len(text) :])[:14]
    try:
        return datetime.datetime.strptime(text, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def inflated(data: bytes) -> bytes:
    """The content, unpacked if it is gzip of one or many members."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        if not member.eof:
            raise ValueError("a gzip member ends too early")
        data = member.unused_data
    return b"".join(out) + data if out else data


def _cut_http(block: bytes) -> tuple[bytes, bytes] | None:
    """The head and the body of an HTTP response, None for other blocks."""
    if not block.startswith(b"HTTP/"):
        return None
    head, end, body = block.partition(b"\r\n\r\n")
    return (head + end, body) if end else None


def arc_records(name: str, data: bytes) -> Iterator[dict]:
    """The records of one ARC file as WARC records; ``filedesc`` becomes warcinfo."""
    place, fields = 0, ARC_FIELDS["1"]
    while place < len(data):
        if data[place : place + 1] in (b"\n", b"\r"):  # the separator of records
            place += 1
            continue
        end = data.find(b"\n", place)
        line = data[place : end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r")
        parts = line.split(" ")
        first = line.startswith("filedesc:")
        told = dict(zip(ARC_FIELDS["1"] if first and len(parts) == 5 else fields if not first else ARC_FIELDS["2"], parts))
        if end < 0 or not told.get("length", "").isdigit() or len(parts) != len(told):
            raise ValueError(f"{name}: no header line at byte {place}: {line[:100]}")
        length = int(told["length"])
        block = data[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ValueError(f"{name}: the record at byte {place} declares {length} bytes, {len(block)} are there")
        if first:
            version = block.decode("utf-8", "replace").split(" ")[0]
            if version not in ARC_FIELDS:
                raise ValueError(f"{name}: version {version}")
            fields = ARC_FIELDS[version]
        http = None if first else _cut_http(block)
        head, payload = http or (b"", block)
        yield {
            "archive": name, "offset": place,
            "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{place}#{line}')}>",
            "record_type": "warcinfo" if first else "response" if http else "resource",
            "uri": told["url"], "ip": told["ip"], "date": iso_date(told["date"]),
            "content_type": "application/http; msgtype=response" if http else told["content_type"],
            "http": head.decode("utf-8", "replace") if http else None, "payload": payload,
            "payload_digest": sha1_base32(payload), "block_digest": sha1_base32(block), "payload_bytes": len(payload),
        }
        place = end + 1 + length


def _records(archives: DataFrame, parse, columns: list[str] | None = None) -> DataFrame:
    """The records of archives, or of these only ``columns``, so that payloads that are
    not asked for stay in the task."""
    fields = T.StructType.fromDDL(RECORDS).fields
    schema = T.StructType([f for f in fields if columns is None or f.name in columns])
    kept = schema.fieldNames()
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                held, size = [], 0
                for record in parse(name or "", inflated(content.as_buffer().to_pybytes() if content.is_valid else b"")):
                    held.append({c: record[c] for c in kept})
                    size += len(record["payload"]) + 500 if "payload" in kept else 500
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow)

    return archives.mapInArrow(run, schema)


def convert_arc(
    archives: DataFrame, name_col: str = "path", content_col: str = "content", columns: list[str] | None = None
) -> DataFrame:
    """The WARC records of ARC archives, one archive per row, or only ``columns`` of them.

    Header lines are read by the version their file declares. A damaged line or
    a block shorter than declared stops the job; an empty or NULL archive has no
    records. A ``response`` keeps its HTTP head in ``http``, its body is the
    payload; other blocks are a ``resource``.
    """
    return _records(archives.select(F.col(name_col).alias("n"), F.col(content_col).alias("c")), arc_records, columns)


def pack_arc(pages: DataFrame, order_col: str, url_col: str, html_col: str, size: int = 4_000_000) -> DataFrame:
    """``(path, content)``: pages as ARC archives of about ``size`` bytes, in
    both versions by turns, as a crawler would have left them.

    Each page is an HTTP response whose head also tells ``order_col`` as
    ``X-Record``. NULL pages are empty, white space in addresses is encoded.
    """
    rows = pages.select(F.col(order_col).cast("string").alias("i"), F.col(url_col).alias("u"), F.col(html_col).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, filled = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                held.append((page or "", "%20".join((url or "").split()) or "about:blank", (html or "").encode()))
                filled += len(held[-1][2]) + 500
                if filled >= size:
                    yield _archive(task, number, held)
                    number, held, filled = number + 1, [], 0
        if held:
            yield _archive(task, number, held)

    return rows.mapInArrow(run, "path string, content binary")


def _archive(task: int, number: int, pages: list[tuple[str, str, bytes]]) -> pa.RecordBatch:
    version = "12"[number % 2]
    name = f"pages-{task:05d}-{number:05d}.arc"
    about = f"{version} 0 quillgrid\n{' '.join(ARC_FIELDS[version])}\n".encode()
    out = [f"filedesc://{name} 0.0.0.0 20200101000000 text/plain {len(about)}\n".encode(), about, b"\n"]
    for page, url, html in pages:
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\nX-Record: {page}\r\n\r\n".encode()
        length = len(head) + len(html)
        told = {
            "url": url, "ip": "0.0.0.0", "date": "20200101000000", "content_type": "text/html", "result_code": "200",
            "checksum": "-", "location": "-", "offset": str(sum(map(len, out))), "filename": name, "length": str(length),
        }
        out += [" ".join(told[f] for f in ARC_FIELDS[version]).encode() + b"\n", head, html, b"\n"]
    return pa.RecordBatch.from_pydict({"path": [name], "content": [b"".join(out)]})


def revisits(records: DataFrame, order_col: str, at_least: int = 0, narrow: DataFrame | None = None) -> DataFrame:
    """Add ``refers_to``: of records with equal payloads of at least ``at_least``
    bytes, all but the one with the smallest ``order_col`` refer to its record id.

    Payloads are compared by SHA-1 and length, as archives do. The first of each
    digest comes from a partial aggregate; what is joined to it is narrow, and
    hot digests are left to adaptive skew handling. Records without an order, or
    with the very order of the first, stay as they are.

    The narrow columns are written to the shared folder once, since they are read
    twice. ``narrow`` hands them in where they can be had without the payloads.
    """
    told = records if narrow is None else narrow
    narrow = checkpointed(told.select("record_id", order_col, "payload_digest", "payload_bytes").where(F.col("payload_bytes") >= at_least))
    firsts = narrow.groupBy("payload_digest", "payload_bytes").agg(
        F.min(order_col).alias("_first"), F.min_by("record_id", order_col).alias("refers_to")
    )
    verdicts = narrow.join(firsts, ["payload_digest", "payload_bytes"]).where(F.col(order_col) != F.col("_first"))
    return records.join(verdicts.select("record_id", "refers_to"), "record_id", "left")


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC archives below ``path``, one per task.

    A record id in ``refers_to`` makes a record a revisit that keeps its HTTP
    head and leaves the payload out. Payloads must be UTF-8, which is what
    Spark's text sink writes.
    """
    refers = F.col("refers_to") if "refers_to" in records.columns else F.lit(None).cast("string")
    body = F.when(refers.isNull(), F.coalesce(F.col("payload").cast("string"), F.lit(""))).otherwise(F.lit(""))
    block = F.concat(F.coalesce("http", F.lit("")), body)
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    head = F.concat(
        F.lit(WARC_VERSION.decode() + "\r\n"),
        _header("WARC-Type", F.when(refers.isNull(), F.col("record_type")).otherwise(F.lit("revisit"))),
        _header("WARC-Record-ID", F.col("record_id")), _header("WARC-Date", F.col("date")),
        _header("WARC-Target-URI", F.col("uri")), _header("WARC-IP-Address", F.nullif(F.col("ip"), F.lit("0.0.0.0"))),
        _header("WARC-Payload-Digest", digest),
        _header("WARC-Block-Digest", F.when(refers.isNull(), F.concat(F.lit("sha1:"), F.col("block_digest")))),
        _header("WARC-Refers-To", refers),
        _header("WARC-Profile", F.when(refers.isNotNull(), F.lit(REVISIT_PROFILE))),
        _header("Content-Type", F.col("content_type")),
        _header("Content-Length", F.octet_length(block).cast("string")),
    )
    text = records.select(F.concat(head, F.lit("\r\n"), block).alias("value"))
    text.write.option("lineSep", RECORD_END).option("compression", compression).text(path)


def warc_records(name: str, data: bytes) -> Iterator[dict]:
    """The records of one WARC file. A revisit tells its payload by digest and HTTP length."""
    place = 0
    while place < len(data):
        end = data.find(b"\r\n\r\n", place)
        lines = data[place:end].decode("utf-8", "replace").split("\r\n") if end >= 0 else [""]
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"{name}: no WARC record at byte {place}")
        told = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(told["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            raise ValueError(f"{name}: the record at byte {place} is cut off")
        http = _cut_http(block)
        head, payload = http or (b"", block)
        size = len(payload)
        if told["warc-type"] == "revisit":
            heads = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n"))
            size = int(next((v for k, _, v in heads if k.strip().lower() == "content-length"), size))
        elif "warc-block-digest" in told and told["warc-block-digest"] != "sha1:" + sha1_base32(block):
            raise ValueError(f"{name}: the block at byte {place} does not fit its digest")
        yield {
            "archive": name, "offset": place, "record_id": told.get("warc-record-id"), "record_type": told["warc-type"],
            "uri": told.get("warc-target-uri"), "ip": told.get("warc-ip-address"), "date": told.get("warc-date"),
            "content_type": told.get("content-type"), "http": head.decode("utf-8", "replace") if http else None,
            "payload": payload, "payload_digest": told.get("warc-payload-digest", "").removeprefix("sha1:") or sha1_base32(payload),
            "block_digest": told.get("warc-refers-to"), "payload_bytes": size,
        }
        place = end + 4 + length + 4


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The records of all WARC files below ``path``, or only ``columns`` of them; revisits
    name the record they refer to in ``refers_to``. Blocks are held against their digests."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    inner = None if columns is None else ["block_digest" if c == "refers_to" else c for c in columns]
    return _records(files, warc_records, inner).withColumnRenamed("block_digest", "refers_to")
