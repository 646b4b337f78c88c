"""WARC archives: write, normalise and read back.

``write_archives`` turns pages into archives as crawlers often leave them: a
whole file is one gzip stream, of which no record can be read alone.
``normalise_archives`` inflates each such stream once, in pieces of bounded
size, and writes every record as a gzip member of its own, with a sidecar index
of offsets.  ``read_records`` follows the index and inflates single members.

Payloads that occur more than once are stored once: the record of the largest
page_id holds them, and the others are revisit records that refer to it.

Files lie below one folder that driver and executors share.  Names are given by
the driver, a task writes under a name of its own attempt and renames at the
end, so a task that runs again leaves one whole file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.store import materialise, new_folder

#: Payload bytes after which a task begins another archive, and bytes inflated at a time.
FILE_BYTES = 64 << 20
PIECE = 1 << 20
#: Revisits (rows of about 100 bytes) that are sent to every task; beyond, pages are joined to them by payload.
SMALL_ROWS = 500_000
GZIP = 31  # window bits that make zlib read and write gzip
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None, ordinal: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit with HTTP headers alone."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_ID}{'' if page is None else page}:{ordinal}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:  # percent-encoded: a header is one line
        head.append("WARC-Target-URI: " + "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in uri))
    if revisit:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class _Archive:
    """A file written under the attempt's name and renamed when whole."""

    def __init__(self, uri: str):
        self.system, self.path = _open(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.system.open_output_stream(self.part, compression=None)
        self.bytes = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> None:
        self.out.close()
        self.system.move(self.part, self.path)


def _write_task(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"{task.partitionId():06d}"
        done: list[tuple[str, int]] = []
        archive = packer = None
        raw = count = rows = 0

        def finish() -> None:
            nonlocal archive
            if archive is not None:
                archive.write(packer.flush())
                archive.close()
                done.append((uri, count))
                archive = None

        for batch in batches:
            for r in range(batch.num_rows):
                if archive is None:
                    uri = f"{folder}/raw-{name}-{len(done):04d}.warc.gz"
                    archive, packer, raw, count = _Archive(uri), zlib.compressobj(6, zlib.DEFLATED, GZIP), 0, 0
                html = batch.column("html")[r].as_py()
                payload = b"" if html is None else html.encode()
                data = record(
                    batch.column("page_id")[r].as_py(),
                    batch.column("url")[r].as_py(),
                    payload,
                    payload_digest(payload),
                    batch.column("refers_to")[r].as_py(),
                    f"{name}-{rows}",
                )
                for lo in range(0, len(data), PIECE):
                    archive.write(packer.compress(data[lo : lo + PIECE]))
                raw, count, rows = raw + len(data), count + 1, rows + 1
                if raw >= FILE_BYTES:
                    finish()
        finish()
        yield pa.RecordBatch.from_pydict({"uri": [d[0] for d in done], "records": [d[1] for d in done]}, schema=pa.schema([("uri", pa.string()), ("records", pa.int64())]))

    return run


def resolve_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, refers_to: the page that holds an equal payload, null for the one that is stored.

    Of equal payloads the largest page_id is stored.  Null page_ids are below
    all others; where several rows of a payload share the largest page_id, all
    of them are stored.
    """
    digest = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    own = pages.select("page_id", "url", "html", digest.alias("digest"))
    last = (
        own.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 AND last IS NOT NULL").select("digest", "last")
    )
    # only payloads that occur again are looked at, as narrow rows
    narrow = own.select("page_id", "digest").join(last, "digest").where(~F.col("page_id").eqNullSafe(F.col("last")))
    refers = materialise(
        narrow.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), F.col("last").alias("refers_to")).distinct(),
        "warc-revisits",
    )
    if refers.count() <= SMALL_ROWS:  # else a shuffle join, whose hot payloads Spark splits
        refers = F.broadcast(refers)
    return own.join(refers, (F.col("digest") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_page")), "left").select(
        "page_id", "url", "html", "refers_to"
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html, refers_to) as whole-stream gzip archives; (uri, records) of each."""
    return materialise(pages.mapInArrow(_write_task(folder), "uri string, records long"), "warc-raw")


def _records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record of a gzip file, whatever its members."""
    inflate, held, ended = zlib.decompressobj(GZIP), bytearray(), False
    compressed = b""

    def more() -> bool:
        nonlocal inflate, compressed, ended
        while not ended:
            if not compressed:
                compressed = stream.read(PIECE)
                if not compressed:
                    ended = True
                    return False
            if inflate.eof:
                inflate = zlib.decompressobj(GZIP)
            got = inflate.decompress(compressed, PIECE)
            compressed = inflate.unconsumed_tail or inflate.unused_data
            if got:
                held.extend(got)
                return True
        return False

    while True:
        while (at := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the archive ends within a record's header")
                return
        headers = {}
        for line in bytes(held[:at]).decode().split("\r\n")[1:]:
            key, _, value = line.partition(":")
            headers[key.strip().lower()] = value.strip()
        size = at + 4 + int(headers["content-length"]) + 4
        while len(held) < size:
            if not more():
                raise ValueError("the archive ends within a record")
        yield headers, bytes(held[:size])
        del held[:size]


def _normalise_task(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                system, path = _open(uri)
                target = f"{folder}/{path.rpartition('/')[2].replace('raw-', 'records-')}"
                archive = _Archive(target)
                index = _Archive(f"{target}.index.jsonl")
                entries = []
                with system.open_input_stream(path, compression=None) as stream:
                    for headers, data in _records(stream):
                        packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
                        member = packer.compress(data) + packer.flush()
                        entry = {"uri": target, "offset": archive.bytes, "length": len(member), "record_id": headers["warc-record-id"], "record_type": headers["warc-type"]}
                        archive.write(member)
                        index.write(json.dumps(entry).encode() + b"\n")
                        entries.append(entry)
                archive.close()
                index.close()
                yield pa.RecordBatch.from_pylist(
                    entries,
                    schema=pa.schema([("uri", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string())]),
                )

    return run


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite whole-stream archives (column uri) with a member for each record.

    Writes ``<name>.warc.gz`` and the sidecar ``<name>.warc.gz.index.jsonl``
    into ``folder`` and returns the index: uri, offset, length, record_id,
    record_type, one row a record.  One archive is one task's work at a time.
    """
    tasks = max(1, archives.count())
    return materialise(
        archives.select("uri")
        .repartitionByRange(tasks, "uri")
        .mapInArrow(_normalise_task(folder), "uri string, offset long, length long, record_id string, record_type string"),
        "warc-index",
    )


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
    opened: tuple[str, pa.NativeFile] | None = None
    for batch in batches:
        out = []
        for entry in batch.to_pylist():
            if opened is None or opened[0] != entry["uri"]:
                if opened:
                    opened[1].close()
                system, path = _open(entry["uri"])
                opened = (entry["uri"], system.open_input_file(path))
            opened[1].seek(entry["offset"])
            data = zlib.decompress(opened[1].read(entry["length"]), GZIP)
            head, _, rest = data.partition(b"\r\n\r\n")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
            http, _, payload = rest[: int(headers["content-length"])].partition(b"\r\n\r\n")
            stated = headers["warc-payload-digest"].removeprefix("sha1:")
            size = int(next(x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")))
            if headers["warc-type"] == "response" and (len(payload) != size or payload_digest(payload) != stated):
                raise ValueError(f"{headers['warc-record-id']} does not hold the payload it states")
            page = headers["warc-record-id"][len(_ID) + 1 : -1].partition(":")[0]
            refers = headers.get("warc-refers-to")
            out.append(
                {
                    "page_id": int(page) if page else None,
                    "payload_bytes": size,
                    "payload_digest": stated,
                    "record_type": headers["warc-type"],
                    "refers_to": int(refers[len(_ID) + 1 : -1]) if refers else None,
                    "url": headers.get("warc-target-uri"),
                }
            )
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if opened:
        opened[1].close()


def read_records(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of every record of an index.

    Each record is inflated alone.  A response's payload is checked against its
    stated size and digest; a revisit states both of the payload it refers to.
    """
    tasks = max(1, index.select("uri").distinct().count())
    placed = index.repartitionByRange(tasks, "uri").sortWithinPartitions("uri", "offset")
    return placed.mapInArrow(_read_task, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def warc_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html), normalise, read back; one row a page.

    Null html: an empty payload.  Null page_id: a record without an id in its
    name, referring to the largest page_id of its payload, if any.  Null url: no
    target header.  Repeated rows are records each.  Empty table: empty result.
    Extra columns are not looked at.
    """
    folder = new_folder(spark, "warc")
    raw = write_archives(resolve_revisits(pages.select("page_id", "url", "html")), f"{folder}/raw")
    return read_records(normalise_archives(raw, f"{folder}/records")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = " || ".join(
    f"substr('{_ALPHABET}', 1 + ((CAST('0x' || substr(h, {1 + 5 * g}, 5) AS INTEGER) >> {s}) & 31), 1)" for g in range(8) for s in (15, 10, 5, 0)
)
ORACLE_WARC = f"""
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p
)
SELECT page_id, payload_bytes, {_DIGITS} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM m
"""
