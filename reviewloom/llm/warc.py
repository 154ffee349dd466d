"""Crawl archives (WARC 1.1, one gzip member per record) and indexed reads of them.

Writing yields an index with the offset, length, address and digest of every record.
Reading takes index rows, sorts them by place, joins neighbours to one byte range, and
parses only the records asked for.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.llm import files
from reviewloom.shipping import ship
from reviewloom.staging import fresh_path, settle

ARCHIVE = 256 << 20  # bytes after which a task begins a new archive
SHARE = 256 << 20  # most bytes of records that a reading task is dealt, on average
RANGE, GAP = 8 << 20, 64 << 10  # most bytes of one read; most unused bytes between two records
DATE = "2025-01-01T00:00:00Z"

# Fixed value: the digits of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

INDEX = "page_id long, path string, offset long, length long, url string, payload_digest string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a binary column in base32, by 20 bits at a time."""
    digits = []
    for group in range(8):
        value = F.conv(F.substring(F.sha1(payload), 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            digits.append(F.substring(F.lit(BASE32), F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*digits)


def payloads(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, payload (UTF-8, null: empty) and its digest."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    return rows.withColumn("payload_digest", base32_sha1(F.col("payload")))


def revisits(records: DataFrame, least: int = 0) -> DataFrame:
    """Records whose payload another record carries: (page_id, payload_digest, refers_to).

    Of equal payloads of at least ``least`` bytes, the largest page_id carries it. Only
    ids and digests are shuffled, and copies are counted before.
    """
    slim = settle(records.select("page_id", "payload_digest", F.octet_length("payload").alias("bytes")), "digests")
    slim = slim.where((F.col("bytes") >= least) & F.col("page_id").isNotNull())
    carrier = slim.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("first"))
    carrier = carrier.where("refers_to != first").drop("first")
    return slim.join(carrier, "payload_digest").where("page_id != refers_to").select("page_id", "payload_digest", "refers_to").distinct()


def _urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record; a revisit holds the answer's head, which still tells the payload's length."""
    head = [b"WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}".encode()]
    head.append(f"WARC-Record-ID: {_urn(page_id, digest)}".encode())
    if url is not None:  # characters that would end the line are written as escapes
        safe = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url.encode())
        head.append(b"WARC-Target-URI: " + safe)
    head += [f"WARC-Date: {date}".encode(), f"WARC-Payload-Digest: sha1:{digest}".encode()]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}".encode())
    if refers_to is not None:
        head += [
            b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_urn(refers_to, digest)}".encode(),
            f"Refers-To-Page-ID: {refers_to}".encode(),
        ]
    answer = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = answer + (payload if refers_to is None else b"")
    head += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def _writer(folder: str, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, offset, serial = None, "", 0, 0
        for batch in batches:
            places = []
            for row in zip(*(batch.column(i) for i in range(5))):
                page_id, url, payload, digest, refers_to = (v.as_py() for v in row)
                if out is None or offset >= ARCHIVE:
                    if out is not None:
                        out.close()
                    path, out = files.create(folder, f"pages-{TaskContext.get().partitionId():06d}-{serial:04d}.warc.gz")
                    offset, serial = 0, serial + 1
                raw = _record(page_id, url, payload, digest, refers_to, date)
                out.write(raw)
                places.append((path, offset, len(raw)))
                offset += len(raw)
            paths, offsets, lengths = zip(*places) if places else ((), (), ())
            columns = [batch.column(0), pa.array(paths, pa.string()), pa.array(offsets, pa.int64())]
            columns += [pa.array(lengths, pa.int64()), batch.column(1), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in INDEX.split(", ")])
        if out is not None:
            out.close()

    return write


def write_archives(pages: DataFrame, folder: str, least: int = 0, date: str = DATE) -> DataFrame:
    """Write a record per page below ``folder``; returns the index of what was written.

    A task that runs twice writes to another file; the index names only the files of the
    attempt that counted.
    """
    ship(pages.sparkSession)
    records = payloads(pages)
    copies = revisits(records, least).withColumnRenamed("page_id", "copy_id").withColumnRenamed("payload_digest", "copy_digest")
    same = (F.col("page_id") == F.col("copy_id")) & (F.col("payload_digest") == F.col("copy_digest"))
    rows = records.join(settle(copies, "revisits"), same, "left")
    rows = rows.select("page_id", "url", "payload", "payload_digest", "refers_to")
    return settle(rows.mapInArrow(_writer(folder, date), INDEX), "index")


def _ranges(places: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """Neighbouring records as one range: path, offset, length, numbers of the records."""
    now: tuple[str, int, int, list[int]] | None = None
    for number, (path, offset, length) in enumerate(places):
        if now and path == now[0] and 0 <= offset - now[1] - now[2] <= GAP and offset + length - now[1] <= RANGE:
            now = (path, now[1], offset + length - now[1], [*now[3], number])
        else:
            if now:
                yield now
            now = (path, offset, length, [number])
    if now:
        yield now


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Header fields, payload, and the payload's length as the answer's head tells it."""
    plain = zlib.decompress(raw, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"Content-Length"])]
    answer, _, payload = block.partition(b"\r\n\r\n")
    told = int(re.search(rb"Content-Length: (\d+)", answer)[1])
    return {k.decode(): v.decode() for k, v in fields.items()}, payload, told


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, names = files.Reader(), [c.split()[0] for c in RECORD.split(", ")]
    schema = pa.schema(
        list(zip(names, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())))
    )
    for batch in batches:
        places = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
        for path, offset, length, numbers in _ranges(places):
            raw, rows = reader.read(path, offset, length), []
            for number in numbers:
                at = places[number][1] - offset
                fields, payload, told = parse_record(raw[at : at + places[number][2]])
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"record at {path}:{places[number][1]} is damaged: its digest differs")
                page, refers = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                rows.append(
                    (page and int(page), fields.get("WARC-Target-URI"), told, digest, kind, refers and int(refers), payload)
                )
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)


def read_records(index: DataFrame) -> DataFrame:
    """The records of (a selection of) the index, read by joined byte ranges."""
    placed, spark = index.select("path", "offset", "length"), index.sparkSession
    total = placed.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARE))
    placed = placed.repartitionByRange(tasks, "path", "offset")
    return placed.sortWithinPartitions("path", "offset").mapInArrow(_read, RECORD)


def archive_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages to archives and read them back: one row per input row.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, url. A null
    html is an empty payload and a null url has no address line. Pages without an id are
    responses and never referred to; rows that repeat the largest id of a payload are all
    responses. Other columns are ignored; an empty table gives an empty result.
    """
    index = write_archives(pages, fresh_path(pages.sparkSession, "archives"), least)
    return read_records(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )
