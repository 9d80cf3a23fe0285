"""Legacy archives to WARC: ARC files are parsed by version and declared length, WARC records are synthesised.

* ``write_arc`` writes pages as ARC files: a version block, then records ``header line, content``. Spark's text writer
  does it, with a line feed between rows, so files commit with their task on any file system.
* ``read_arc`` parses ARC files. The version block's number selects the fields of the header lines (five in version 1, ten
  in version 2); the last field is the length of the content, which is taken as declared, whatever it holds.
  Concatenated archives may change the version on the way.
* ``convert`` gives each ARC record its WARC identity: a name-based UUID, the ISO date, digests in base 32, a type.
  Of equal payloads the record with the largest page id is the response; the others become revisits of it, without
  payload. Equality is decided on (digest, length) in a small index; payloads are shuffled once, to their type.
* ``write_warc`` and ``read_warc`` write and parse the result; the writer's row separator is the blank line that ends
  each WARC record. Reading recomputes the digest of every payload that is there.

A file is closed at ``FILE_BYTES`` of records (or one record, if that is longer) and at ``RECORDS`` records; a row of the writer is a
whole file, and one task parses it. A WARC file begins with a ``warcinfo`` record, as an ARC file does with its version block.

Edge cases: a null html is the empty payload, a null url becomes ``about:blank``, white space in a url is
percent-encoded; a record without page id keeps null and is the smallest among equals; equal page ids with equal
payloads: one of them is the response. Repeated rows are records of their own. An archive that contradicts its
lengths raises an error that names file and offset. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectora.llm import common
from sectora.session import scratch_path

RECORDS, FILE_BYTES = 2000, 16_000_000
#: Of gzip's levels: pages get 4 % larger than at level 6, in a third of its time.
LEVEL = "FOUR"

# The record definitions of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_FIRST, ARC_DATE, WARC_DATE = datetime(2001, 1, 1), "%Y%m%d%H%M%S", "%Y-%m-%dT%H:%M:%SZ"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc-record")
HTTP_END = b"\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- ARC -----------------------------------------------------------------------------------------------------------


def _version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n".encode()
    middle = "text/plain" if version == 1 else "text/plain 200 - - 0 " + name
    return f"filedesc://{name} 0.0.0.0 {ARC_FIRST.strftime(ARC_DATE)} {middle} {len(body)}\n".encode() + body


def _arc_record(version: int, page_id: int | None, url: str | None, html: bytes) -> bytes:
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(html)
    content = status + (b"" if page_id is None else b"\r\nX-Page-Id: %d" % page_id) + HTTP_END + html
    address = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "about:blank"
    date = (ARC_FIRST + timedelta(seconds=(page_id or 0) % 600_000_000)).strftime(ARC_DATE)
    middle = "text/html" if version == 1 else f"text/html 200 {digest(html)} - 0 -"
    return f"{address} 0.0.0.0 {date} {middle} {len(content)}\n".encode() + content


def write_arc(pages: DataFrame, path: str, records: int = RECORDS, file_bytes: int = FILE_BYTES) -> None:
    """Write (page_id, url, html) as ARC files; odd partitions in version 1, even ones in version 2."""
    common.ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version = 2 - part % 2

        def rows() -> Iterator[bytes]:
            for batch in batches:
                for page_id, html, url in zip(batch.column(0), common.byte_texts(batch.column(1)), batch.column(2), strict=True):
                    yield _arc_record(version, page_id.as_py(), url.as_py(), html)

        return _as_files(rows(), lambda n: _version_block(version, f"part-{part}-{n}.arc"), b"\n", records, file_bytes)

    rows = pages.select(F.col("page_id").cast("long"), "html", "url").mapInArrow(run, "record binary")
    _write(rows, path, "\n")


def _as_files(records: Iterator[bytes], begin, separator: bytes, most: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows that are whole files: ``begin(number)`` and records, up to ``most_bytes`` or ``most`` records."""
    held, size, n = [], 0, 0
    for record in records:
        if held and (size + len(record) > most_bytes or len(held) > most):
            yield pa.RecordBatch.from_arrays([pa.array([separator.join(held)], pa.binary())], ["record"])
            held, size, n = [], 0, n + 1
        if not held:
            held.append(begin(n))
        held.append(record)
        size += len(record)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([separator.join(held)], pa.binary())], ["record"])


def _write(rows: DataFrame, path: str, separator: str) -> None:
    """One file a row; bytes are written as they are, with the separator at the end."""
    text = rows.select(F.col("record").cast("string"))
    text.write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", LEVEL).option("maxRecordsPerFile", 1).text(path)


def parse_arc(data: bytes, name: str) -> Iterator[tuple[int, list[str], bytes]]:
    """(offset, header fields, content) of each record of an ARC file."""
    at, version = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)]
        fields = line.decode("utf-8", "replace").split(" ")
        is_block = line.startswith(b"filedesc://")
        expected = None if is_block or version is None else len(ARC_FIELDS[version].split())
        if end < 0 or not fields[-1].isdigit() or (not is_block and len(fields) != expected):
            raise ValueError(f"{name}: no ARC header at {at}: {line[:80]!r}")
        start, length = end + 1, int(fields[-1])
        content = data[start : start + length]
        if len(content) < length or data[start + length : start + length + 1] != b"\n":
            raise ValueError(f"{name}: the record at {at} doesn't end after its {length} bytes")
        if is_block:
            version = int(content.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"{name}: ARC version {version} at {at}")
        else:
            yield at, fields, content
        at = start + length + 1


def _http(content: bytes) -> tuple[bytes, bytes, int | None, int | None]:
    """(header block, payload, page id, declared length) of an HTTP response."""
    head, end, payload = content.partition(HTTP_END)
    if not end:
        head, payload = b"", content
    values = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        values[k.strip().lower()] = v.strip()
    page, size = values.get(b"x-page-id"), values.get(b"content-length")
    return head + end, payload, int(page) if page is not None else None, int(size) if size is not None else None


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1), strict=True):
            data = content.as_py()
            yield name.as_py(), gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``most`` bytes of binary values."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """``record_id, page_id, uri, date, ip, payload_bytes, digest``, with ``content`` (HTTP response) if ``payloads``."""
    schema = "record_id string, page_id long, uri string, date string, ip string, payload_bytes long, digest string" + ", content binary" * payloads
    common.ship(spark)

    def rows(batches):
        for name, data in _opened(batches):
            file = name.rsplit("/", 1)[-1]
            for at, fields, content in parse_arc(data, name):
                _, payload, page, _ = _http(content)
                uri, ip, date = fields[:3]
                when = datetime.strptime(date, ARC_DATE).strftime(WARC_DATE)
                identity = uuid.uuid5(NAMESPACE, f"{file}:{at}:{uri}:{date}")
                row = (f"urn:uuid:{identity}", page, uri, when, ip, len(payload), digest(payload))
                yield (*row, content) if payloads else row

    kinds = [("record_id", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("date", pa.string()), ("ip", pa.string()), ("payload_bytes", pa.int64()), ("digest", pa.string())]
    arrow = pa.schema(kinds + [("content", pa.binary())] * payloads)
    return _files(spark, path).mapInArrow(lambda b: _batched(rows(b), arrow), schema)


# -- WARC ----------------------------------------------------------------------------------------------------------


def convert(spark: SparkSession, arc: str, least_bytes: int = 0) -> DataFrame:
    """ARC records with ``refers_to, refers_uri, refers_date``: the response that a revisit refers to, else null."""
    index = common.written(read_arc(spark, arc, payloads=False), "arc-index")
    # nulls first: a record without page id is no response if another has one
    order = F.struct(F.coalesce(F.col("page_id"), F.lit(-(2**63))), F.col("record_id"))
    first = index.where(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes").agg(
        F.max_by(F.struct("record_id", "uri", "date"), order).alias("r"), F.count("*").alias("n")
    ).where("n > 1").select("digest", "payload_bytes", F.col("r.record_id").alias("refers_to"), F.col("r.uri").alias("refers_uri"), F.col("r.date").alias("refers_date"))
    revisits = index.join(first, ["digest", "payload_bytes"]).where("record_id <> refers_to").select("record_id", "refers_to", "refers_uri", "refers_date")
    return read_arc(spark, arc).join(revisits, "record_id", "left")


def _warc_record(row: dict) -> bytes:
    revisit = row["refers_to"] is not None
    head, payload, _, _ = _http(row["content"])
    block = head if revisit else row["content"]
    lines = [
        "WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{row['record_id']}>", f"WARC-Date: {row['date']}",
        f"WARC-Target-URI: {row['uri']}", f"WARC-IP-Address: {row['ip']}", f"WARC-Payload-Digest: sha1:{row['digest']}", f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{row['refers_to']}>", f"WARC-Refers-To-Target-URI: {row['refers_uri']}", f"WARC-Refers-To-Date: {row['refers_date']}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + HTTP_END + block


def write_warc(records: DataFrame, path: str, most: int = RECORDS, file_bytes: int = FILE_BYTES) -> None:
    """Write converted records as WARC files."""
    common.ship(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        return _as_files((_warc_record(row) for batch in batches for row in _rows(batch)), lambda n: _info_record(f"part-{part}-{n}.warc"), HTTP_END, most, file_bytes)

    _write(records.mapInArrow(run, "record binary"), path, "\r\n\r\n")


def _info_record(name: str) -> bytes:
    block = b"format: WARC File Format 1.0\r\ndescription: converted from ARC\r\n"
    lines = [
        "WARC/1.0", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMESPACE, name)}>", f"WARC-Date: {ARC_FIRST.strftime(WARC_DATE)}",
        f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + HTTP_END + block


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def parse_warc(data: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.find(HTTP_END, at)
        lines = data[at : max(end, at)].decode("utf-8", "replace").split("\r\n")
        header = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = header.get("content-length", "")
        if not lines[0].startswith("WARC/") or not length.isdigit():
            raise ValueError(f"{name}: no WARC header at {at}: {data[at : at + 80]!r}")
        start, stop = end + 4, end + 4 + int(length)
        if data[stop : stop + 4] != HTTP_END:
            raise ValueError(f"{name}: the record at {at} doesn't end after its {length} bytes")
        yield header, data[start:stop]
        at = stop + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, page_id, uri, date, record_type, payload_bytes, payload_digest, refers_id`` of every record.

    A revisit's length and digest are its headers', a response's those of its payload.
    """
    common.ship(spark)
    names = ["record_id", "page_id", "uri", "date", "record_type", "payload_bytes", "payload_digest", "refers_id"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    arrow = pa.schema(list(zip(names, kinds, strict=True)))

    def rows(batches):
        for name, data in _opened(batches):
            for header, block in parse_warc(data, name):
                if header["warc-type"] == "warcinfo":
                    continue
                _, payload, page, size = _http(block)
                told = header["warc-payload-digest"].removeprefix("sha1:")
                kind, refers = header["warc-type"], header.get("warc-refers-to", "").strip("<>") or None
                own = (size, told) if kind == "revisit" else (len(payload), digest(payload))
                if own[1] != told:
                    raise ValueError(f"{name}: {header['warc-record-id']} has another payload than its digest says")
                yield header["warc-record-id"].strip("<>"), page, header["warc-target-uri"], header["warc-date"], kind, *own, refers

    schema = "record_id string, page_id long, uri string, date string, record_type string, payload_bytes long, payload_digest string, refers_id string"
    return _files(spark, path).mapInArrow(lambda b: _batched(rows(b), arrow), schema)


def round_trip(pages: DataFrame, least_bytes: int = 0, records: int = RECORDS) -> DataFrame:
    """Pages through ARC files and WARC files: ``page_id, payload_bytes, payload_digest, record_type, refers_to, uri, date``."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, records)
    write_warc(convert(spark, arc, least_bytes), warc, records)
    found = common.written(read_warc(spark, warc), "warc-records")
    # a response that many revisits refer to is one row on its side of this join
    named = found.where("record_type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    # responses refer to nothing and don't take part
    rest = found.where("refers_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    return found.where("refers_id is not null").join(named, "refers_id", "left").unionByName(rest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "date")
