"""WARC archives whose records are compressed one by one with a dictionary of their own.

Each archive begins with a skippable frame that holds the dictionary, trained from the
archive's own records; every record is a Zstandard frame of its own after it, so any of
them can be read alone.  Records of equal payload point to one of them by revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tracewell.plans.workspace import stage_path

from .common import map_batches, stage, table

# The magic number of the frame that holds the dictionary, and the profile of revisits.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payload bytes after which an archive is closed, dictionary size, and sampled bytes per dictionary byte.
ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 32 << 10
SAMPLES_PER_BYTE = 64
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"

WRITTEN = "archive string, records bigint, bytes bigint"
READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def target_uri(url: str | None, page_id: int | None) -> str:
    """The address, with what would break a header line escaped."""
    if not url:
        return f"urn:page:{page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target_uri(url, page_id)}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", f"Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from a bounded part of the records, spread over them; None where they are too few."""
    size = sum(map(len, records))
    step = max(1, -(-size // (DICTIONARY_BYTES * SAMPLES_PER_BYTE)))
    samples = [r[: DICTIONARY_BYTES] for r in records[::step]]
    if len(samples) < 8 or size < 8 * 1024:
        return None
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, size // 8), samples, k=256, d=8)
    except zstandard.ZstdError:  # the samples have nothing in common
        return None


def archive_bytes(records: list[bytes]) -> bytes:
    dictionary = train_dictionary(records)
    out = []
    if dictionary is not None:
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    out += [compressor.compress(r) for r in records]
    return b"".join(out)


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive, decompressed one by one."""
    at, dictionary = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        raw = data[8 : 8 + size]
        if raw[:4] == zstandard.FRAME_HEADER:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        one, parts, step = decompressor.decompressobj(), [], 16 << 10
        while not one.eof:
            if at >= len(data):
                raise ValueError("the archive ends within a record")
            chunk = data[at : at + step]
            parts.append(one.decompress(chunk))
            at += len(chunk)
            step = min(2 * step, 1 << 20)
        at -= len(one.unused_data)
        yield b"".join(parts)


def parse_record(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != int(fields["Payload-Length"])):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} doesn't match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("Page-Id"), "url": fields["WARC-Target-URI"], "payload_bytes": int(fields["Payload-Length"]), "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": number("Refers-To-Page"), "payload": None if revisit else payload,
    }


def _save(folder: str, name: str, data: bytes) -> str:
    target, path = _store(folder)
    target.create_dir(path, recursive=True)
    with target.open_output_stream(f"{path}/{name}.part", compression=None) as out:
        out.write(data)
    target.move(f"{path}/{name}.part", f"{path}/{name}")
    return f"{folder}/{name}"


def _store(place: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(place) if "://" in place or place.startswith("file:") else (pyarrow.fs.LocalFileSystem(), place)


def _writer(folder: str):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        stem, made, records, size, done = f"part-{context.partitionId():05d}-{context.taskAttemptId()}", 0, [], 0, []

        def close() -> None:
            nonlocal made, records, size
            data = archive_bytes(records)
            done.append((_save(folder, f"{stem}-{made:05d}.warc.zst", data), len(records), len(data)))
            made, records, size = made + 1, [], 0

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                records.append(build_record(row[0], row[1], row[2] or b"", row[3]))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    close()
        if records:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["archive", "records", "bytes"])

    return write


def _reader(with_payload: bool):
    columns = [c.split(" ")[0] for c in READ.split(", ")]
    types = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split(" ")[1]] for c in READ.split(", ")]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                source, path = _store(archive)
                with source.open_input_stream(path, compression=None) as f:
                    data = f.read()
                rows, size = [], 0
                for record in frames(data):
                    rows.append(parse_record(record))
                    size += len(record)
                    if not with_payload:
                        rows[-1]["payload"] = None
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(columns, types, strict=True)], columns)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(columns, types, strict=True)], columns)

    return read


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (html in UTF-8, empty where null) and refers_to.

    Of records with equal payloads of ``least_bytes`` or more, the one with the smallest page_id is
    stored, the others refer to it.  A page without an id is never referred to, and is stored itself
    where no page with an id has its payload; rows that repeat the smallest id are stored as well.
    Equal payloads are told by SHA-1 and length.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    # Only payloads of several pages take part; a hot payload is one row per task here, and the join splits it.
    firsts = (
        rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first IS NOT NULL").select("digest", "bytes", "first")
    )
    joined = rows.join(firsts, ["digest", "bytes"], "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html); return archive, records and bytes.

    The archives listed are those of the tasks that were counted in: what a lost or repeated task left
    behind in the folder isn't listed.  An empty table writes no archive.
    """
    return stage(map_batches(with_revisits(pages, least_bytes), _writer(folder), WRITTEN), "archives")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives listed; each stored payload is checked against its digest."""
    tasks = max(1, min(archives.count(), 1 << 14))
    return map_batches(archives.select("archive").repartition(tasks), _reader(with_payload), READ)


def query(spark, sf_dir):
    folder = stage_path(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(archives, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex
), b AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || bits[5 * i + 1 : 5 * i + 5])::INT, 1), '' ORDER BY i) AS digest
  FROM (SELECT hex, list_aggregate(list_transform(string_split(hex, ''), lambda c: lpad(bin(('0x' || c)::INT), 4, '0')), 'string_agg', '') AS bits FROM f), range(32) r(i)
  GROUP BY hex
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (hex) JOIN b USING (hex)
"""
