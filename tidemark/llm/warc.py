"""Legacy archives (ARC, versions 1 and 2) made into WARC, and WARC read back.

An ARC file begins with a version block whose third line names the fields of every header line; a
record is such a line, then as many bytes as its last field declares.  The converter synthesises
what WARC has and ARC lacks: record identifiers (of the file and the place in it, so no two are alike), ISO timestamps, types and digests.
The version block becomes a warcinfo record, a block without an HTTP head a resource.  Of responses
with equal payloads one stays a response, the others revisit it.  A header line without a length is passed over, and reading goes on at
the next line; a block shorter than declared is marked as truncated.

WARC files go out through Spark's text sink, whose line separator is the end of a WARC record, so
they are written by its committer to any file system; bytes that are no UTF-8 pass unchanged.  They
are read through the binary file source, a record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import new_path, written

#: Fixed values of the two formats.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = b"\r\n\r\n"
#: Bytes that one ARC file takes, records that one WARC file takes.
ARC_BYTES, WARC_RECORDS = 2_000_000, 10_000
_STAMP = "20250101000000"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(value: str | None) -> str:
    """As one word of a header line."""
    return re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value or "") or "-"


def arc_file(name: str, version: int, records: list[tuple[str | None, str, str, bytes]]) -> bytes:
    """An ARC file of (url, date, content type, block) records."""
    body = f"{version} 0 tidemark\n{FIELDS[version]}\n".encode()
    more = " 200 - - 0 " + name if version == 2 else ""
    out = [f"filedesc://{name} 0.0.0.0 {_STAMP} text/plain{more} {len(body)}\n".encode(), body, b"\n"]
    offset = sum(map(len, out))
    for url, date, kind, block in records:
        more = f" 200 {hashlib.md5(block).hexdigest()} - {offset} {name}" if version == 2 else ""
        head = f"{_field(url)} 0.0.0.0 {date} {kind}{more} {len(block)}\n".encode()
        out += [head, block, b"\n"]
        offset += len(head) + len(block) + 1
    return b"".join(out)


def arc_records(data: bytes) -> Iterator[dict]:
    """The records of an ARC file of either version, its version block among them (``info``)."""
    at, names, version = 0, None, 1
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            return
        place, words = at, data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if names and len(words) > len(names):  # older writers left spaces in the URL
            words = [" ".join(words[: len(words) - len(names) + 1]), *words[len(words) - len(names) + 1 :]]
        start = at = end + 1
        if not words[-1].isascii() or not words[-1].isdigit() or names and len(words) < len(names):
            continue  # no header line: what follows may be one
        length = int(words[-1])
        block = data[start : start + length]
        at = start + length
        more = {"block": block, "offset": place, "truncated": len(block) < length}
        if names is None:
            lines = block.decode("utf-8", "replace").split("\n")
            first = lines[0].split(" ")[0]
            version = int(first) if first in ("1", "2") else 1
            said = lines[1].split() if len(lines) > 1 else []
            names = said if {"URL", "Archive-date"} <= {*said} else FIELDS[version].split(" ")  # any other line describes no fields
            if words[0].startswith("filedesc:"):
                yield {"URL": words[0], "Archive-date": words[2] if len(words) > 2 else ""} | more | {"version": version, "info": True}
                continue
            if len(words) < len(names):
                continue
        yield dict(zip(names, words, strict=False)) | more | {"version": version, "info": False}


def _http(block: bytes) -> tuple[bytes, bytes]:
    """Head with its blank line, and payload."""
    cut = block.find(RECORD_END)
    if not block.startswith(b"HTTP/") or cut < 0:
        return b"", block
    return block[: cut + 4], block[cut + 4 :]


def _header(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)\r?$", head)
    return found[1].decode("utf-8", "replace") if found else None


def _iso(date: str) -> str:
    digits = (re.sub(r"\D", "", date) + "00000101000000"[min(14, len(re.sub(r"\D", "", date))) :])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:]}Z"


def _page_id(head: bytes) -> int | None:
    value = _header(head, b"X-Page-Id")
    return int(value) if value and re.fullmatch(r"-?\d+", value) else None


_CONVERTED = "kind string, record_id string, uri string, date string, page_id long, payload_bytes long, payload_digest string, fields string, truncated boolean, head binary, payload binary"
#: Fields of an ARC header line that a WARC record carries on, by the names that they get there.
_CARRIED = {"IP-address": "WARC-IP-Address", "Result-code": "X-ARC-Result-Code", "Checksum": "X-ARC-Checksum", "Location": "X-ARC-Location"}


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (*[pa.string()] * 4, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.binary(), pa.binary())
    names = [c.split(" ")[0] for c in _CONVERTED.split(", ")]
    for batch in batches:
        files = batch.column("path").to_pylist() if "path" in batch.schema.names else [None] * batch.num_rows
        for data, file in zip(batch.column("content").to_pylist(), files, strict=True):
            out: list[list] = [[] for _ in kinds]
            whole = hashlib.sha1(data or b"").hexdigest()
            for r in arc_records(data or b""):
                head, payload = (b"", r["block"]) if r["info"] else _http(r["block"])
                kind = "warcinfo" if r["info"] else "response" if head else "resource"
                fields = "\r\n".join(f"{name}: {r[field]}" for field, name in _CARRIED.items() if r.get(field) not in (None, "", "-", "0.0.0.0"))
                name = uuid.uuid5(uuid.NAMESPACE_URL, f"{file or ''} {whole} {r['offset']}")
                row = (kind, f"<urn:uuid:{name}>", r["URL"], _iso(r["Archive-date"]), _page_id(head), len(payload), base32_sha1(payload), fields, r["truncated"], head, payload)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def converted(arcs: DataFrame) -> DataFrame:
    """``content`` (whole ARC files), with ``path`` if it is there, to records with synthesised identifiers, timestamps and digests.

    A null or empty file has no records; files of the same content need paths for identifiers of their own.
    """
    return arcs.select(*(c for c in ("content", "path") if c in arcs.columns)).mapInArrow(_convert, _CONVERTED)


def with_types(records: DataFrame) -> DataFrame:
    """Adds ``record_type``, ``refers_to`` (page id) and ``refers_id``: of responses with equal payloads the one of the largest page id stays one.

    Records of other kinds keep theirs.
    Rows that repeat that page id are responses too; null page ids come last.  A payload of many records
    is a skewed join side, which is split; the payload bytes are not part of the aggregate.
    """
    rest = records.where("kind <> 'response'").select("*", F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_id"))
    records = records.where("kind = 'response'")
    last = records.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("_last"), F.max_by("record_id", F.coalesce("page_id", F.lit(-(1 << 63)))).alias("_last_id"))
    own = F.col("page_id").eqNullSafe(F.col("_last"))
    found = records.join(last, ["payload_digest", "payload_bytes"])
    found = found.select(*records.columns, F.when(own, "response").otherwise("revisit").alias("record_type"), F.when(~own, F.col("_last")).alias("refers_to"), F.when(~own, F.col("_last_id")).alias("refers_id"))
    return found.union(rest)


def _record(r: dict) -> bytes:
    revisit = r["record_type"] == "revisit"
    block = r["head"] if revisit else r["head"] + r["payload"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {r['record_type']}",
        f"WARC-Record-ID: {r['record_id']}",
        f"WARC-Date: {r['date']}",
        f"WARC-Target-URI: {r['uri']}",
        f"WARC-Payload-Digest: sha1:{r['payload_digest']}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: " + ("application/http;msgtype=response" if r["head"] else "text/plain" if r["record_type"] == "warcinfo" else "application/octet-stream"),
        *(r["fields"].split("\r\n") if r["fields"] else []),
        *(["WARC-Truncated: unspecified"] if r["truncated"] else []),
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {r['refers_id']}", f"X-Refers-To-Page-Id: {r['refers_to']}", f"X-Payload-Length: {r['payload_bytes']}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + RECORD_END + block


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            yield pa.RecordBatch.from_arrays([pa.array(map(_record, whole.slice(at, 256).to_pylist()), pa.binary())], ["record"])


def write_warc(records: DataFrame, path: str) -> None:
    """Records with types as gzipped WARC files under ``path``."""
    out = records.mapInArrow(_records, "record binary").select(F.col("record").cast("string"))
    out.write.option("lineSep", RECORD_END.decode()).option("compression", "gzip").option("maxRecordsPerFile", WARC_RECORDS).text(path)


def warc_records(chunks: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Head and block of each record of a WARC file that comes in pieces."""
    held, at = bytearray(), 0
    chunks = iter(chunks)

    def more() -> bool:
        nonlocal at
        piece = next(chunks, None)
        if piece is None:
            return False
        if at > len(held) // 2:  # what has been read goes now and then
            del held[:at]
            at = 0
        held.extend(piece)
        return True

    while True:
        while (cut := held.find(RECORD_END, at)) < 0:
            if not more():
                return
        head = bytes(held[at:cut])
        begin, size = cut + 4 - at, int(_header(head, b"Content-Length") or 0)
        while len(held) - at < begin + size + 4 and more():
            pass
        yield head, bytes(held[at + begin : at + begin + size])
        at += begin + size + 4


def _unzipped(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Decompressed pieces; members follow one another, and a file that is not gzipped comes as it is."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data:
        unzip = zlib.decompressobj(31)
        while not unzip.eof and data:
            yield unzip.decompress(data, size)
            data = unzip.unconsumed_tail
        data = unzip.unused_data


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, uri string, date string"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
    names = [c.split(" ")[0] for c in _READ.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            out: list[list] = [[] for _ in kinds]
            for head, block in warc_records(_unzipped(batch.column("content")[i].as_py())):
                kind, (http, payload) = _header(head, b"WARC-Type"), _http(block)
                if kind != "revisit":
                    size, digest, refers = len(payload), base32_sha1(payload), None
                else:
                    size, digest = int(_header(head, b"X-Payload-Length") or 0), (_header(head, b"WARC-Payload-Digest") or "").rpartition(":")[2]
                    refers = _header(head, b"X-Refers-To-Page-Id")
                    refers = int(refers) if refers and refers != "None" else None
                row = (_page_id(http), size, digest, kind, refers, *(_header(head, n) for n in (b"WARC-Record-ID", b"WARC-Target-URI", b"WARC-Date")))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the WARC files under ``path``; digests of all but revisits are taken anew from the payload."""
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.select("content").mapInArrow(_read, _READ)


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as ARC files, versions by turns; a file's name has the number of its partition."""
    turn, part = 0, TaskContext.get().partitionId()

    def file(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([arc_file(f"{part}-{turn}.arc", 1 + turn % 2, held)], pa.binary())], ["content"])

    for batch in batches:
        held, size = [], 0
        for start in range(0, batch.num_rows, 128):
            some = batch.slice(start, 128)
            for page, url, html in zip(*(some.column(c).to_pylist() for c in ("page_id", "url")), some.column("html").cast(pa.binary()).to_pylist(), strict=True):
                body = html or b""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page is None else page}\r\nContent-Length: {len(body)}\r\n\r\n"
                held.append((url, _STAMP, "text/html", head.encode() + body))
                size += len(body)
                if size >= ARC_BYTES:
                    yield file(held)
                    held, size, turn = [], 0, turn + 1
        if held:
            yield file(held)
            turn += 1


def pages_as_arc(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html)`` rows as ARC files in ``content``; a null html is an empty payload, a null url is written as ``-``."""
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(_archives, "content binary")


def convert(arcs: DataFrame, path: str) -> None:
    """ARC files (rows of ``content``) to WARC files under ``path``."""
    write_warc(with_types(written(converted(arcs), "records")), path)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Pages through ARC files, the converter and WARC files, and read back: a row for each record.

    Empty tables give no rows; nulls in any column are written as empty; repeated rows stay; other columns are not read.
    """
    path = new_path(pages.sparkSession, "warc")
    convert(pages_as_arc(pages), path)
    return read_warc(pages.sparkSession, path).where("record_type in ('response', 'revisit')")
