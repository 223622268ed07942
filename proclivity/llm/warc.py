"""WARC archives: write, normalise to one gzip member a record, read back.

A writer that compresses a whole file as one gzip stream leaves an archive
that can't be read at an offset. The normaliser inflates such a stream once,
writes each record as a member of its own, and a sidecar with the members'
offsets. Reading then seeks to each member. Only one record is in memory at a
time; archives are closed at a size, so tasks stay even.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from proclivity.llm.common import schema, scratch, staged

#: An archive is closed when its records have this many bytes uncompressed.
ARCHIVE_BYTES = 64 << 20
LEVEL = 4
BLOCK = 1 << 18

MANIFEST = schema("archive string, n_records long")
INDEXED = schema("archive string, sidecar string, n_records long")
RECORDS = schema(
    "page_id long, payload_bytes long, payload_digest string,"
    "record_type string, refers_to long, url string"
)
#: Rows of a batch that the reader returns.
ROWS = 1000


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder's URI, or a plain path."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(row: dict) -> bytes:
    """One record: a response with its payload, or a revisit without it."""
    page_id, revisit = row["page_id"], row["record_type"] == "revisit"
    payload = row["payload"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Target-URI": None
        if row["url"] is None
        else quote(row["url"], safe="%/:?#[]@!$&'()*+,;=~-._"),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "X-Page-Id": page_id,
        "X-Refers-To-Page": row["refers_to"],
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if revisit:
        head["WARC-Profile"] = (
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
    lines = [f"{k}: {v}\r\n" for k, v in head.items() if v is not None]
    return (
        b"WARC/1.1\r\n"
        + "".join(lines).encode()
        + b"\r\n"
        + block
        + b"\r\n\r\n"
    )


def with_record_types(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Adds payload, record_type and refers_to.

    Of pages with equal payloads of at least `min_bytes`, those with the
    largest page_id are responses (repeated rows tie), the others revisits. A
    null html is an empty payload. A page without a page_id is a response
    only if no page with that payload has one.
    """
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("_sha1", F.sha1("payload"))
    # collapsed in each task first, so many copies are one row a task; the
    # join's other side is split by adaptive execution where it is skewed
    last = rows.groupBy("_sha1").agg(F.max("page_id").alias("_last"))
    revisit = (F.octet_length("payload") >= min_bytes) & ~F.col(
        "page_id"
    ).eqNullSafe(F.col("_last"))
    return rows.join(last, "_sha1").select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_last")).alias("refers_to"),
    )


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write records as monolithic gzip archives; a row for each archive.

    Names hold the task attempt, so a repeated or speculative task never
    touches the files of another; only what the result lists counts.
    """
    arrow = to_arrow_schema(MANIFEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        where, root = _opened(folder)
        where.create_dir(root, recursive=True)
        sink = None
        turn = count = size = 0
        done: list[tuple[str, int]] = []

        def close() -> None:
            sink.write(packer.flush())
            sink.close()
            done.append((name, count))

        for batch in batches:
            for i in range(batch.num_rows):
                row = {
                    k: batch.column(k)[i].as_py() for k in batch.schema.names
                }
                if sink is None:
                    turn, count, size = turn + 1, 0, 0
                    name = (
                        f"{context.partitionId():06d}-"
                        f"{context.taskAttemptId()}-{turn:04d}.warc.gz"
                    )
                    sink = where.open_output_stream(
                        posixpath.join(root, name), compression=None
                    )
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                record = record_bytes(row)
                sink.write(packer.compress(record))
                count, size = count + 1, size + len(record)
                if size >= ARCHIVE_BYTES:
                    close()
                    sink = None
        if sink is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f"{folder}/{name}" for name, _ in done], pa.string()),
                pa.array([n for _, n in done], pa.int64()),
            ],
            schema=arrow,
        )

    return rows.mapInArrow(run, MANIFEST)


def inflated(source: pa.NativeFile) -> Iterator[bytes]:
    """Blocks of a gzip stream of one or more members."""
    inflater = zlib.decompressobj(31)
    data = source.read(BLOCK)
    while data:
        block = inflater.decompress(data, BLOCK)
        if block:
            yield block
        data = inflater.unconsumed_tail
        if inflater.eof:
            data = inflater.unused_data
            inflater = zlib.decompressobj(31)
        data = data or source.read(BLOCK)
    if rest := inflater.flush():
        yield rest


def records_in(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, cut by their Content-Length."""
    held = bytearray()
    need = None
    for block in blocks:
        held += block
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = bytes(held[:end]).decode()
                need = end + 8 + int(headers_of(head)["content-length"])
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("archive ends inside a record")


def headers_of(head: str) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, v in pairs}


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrite archives with a gzip member a record, and index them.

    `<archive>.members.gz` has the members, `<archive>.members.idx` a line
    `offset length` for each. Returns a row for each archive.
    """
    arrow = to_arrow_schema(INDEXED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            out: list[tuple[str, str, int]] = []
            for archive in batch.column("archive").to_pylist():
                where, path = _opened(archive)
                members = f"{path}.{attempt}.members.gz"
                lines, at = [], 0
                with (
                    where.open_input_stream(path, compression=None) as source,
                    where.open_output_stream(
                        members, compression=None
                    ) as sink,
                ):
                    for record in records_in(inflated(source)):
                        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = packer.compress(record) + packer.flush()
                        sink.write(member)
                        lines.append(f"{at} {len(member)}\n")
                        at += len(member)
                with where.open_output_stream(
                    f"{path}.{attempt}.members.idx", compression=None
                ) as sink:
                    sink.write("".join(lines).encode())
                base = f"{archive}.{attempt}.members"
                out.append((f"{base}.gz", f"{base}.idx", len(lines)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[i] for x in out], f.type)
                    for i, f in enumerate(arrow)
                ],
                schema=arrow,
            )

    return archives.mapInArrow(run, INDEXED)


def parsed(record: bytes) -> tuple:
    """A record's row; fails if its payload doesn't match its digest."""
    end = record.index(b"\r\n\r\n")
    head = headers_of(record[:end].decode())
    block = record[end + 4 : -4]
    http_end = block.index(b"\r\n\r\n")
    http = headers_of(block[:http_end].decode())
    size, payload = int(http["content-length"]), block[http_end + 4 :]
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if head["warc-type"] == "response" and (
        len(payload) != size or digest_of(payload) != digest
    ):
        raise ValueError(f"payload of {head['warc-record-id']} is damaged")
    page, refers = head.get("x-page-id"), head.get("x-refers-to-page")
    return (
        None if page is None else int(page),
        size,
        digest,
        head["warc-type"],
        None if refers is None else int(refers),
        head.get("warc-target-uri"),
    )


def read_archives(indexed: DataFrame) -> DataFrame:
    """Every record of normalised archives, each read at its offset."""
    arrow = to_arrow_schema(RECORDS)

    def rows_of(archive: str, sidecar: str) -> Iterator[tuple]:
        where, path = _opened(archive)
        with where.open_input_stream(
            _opened(sidecar)[1], compression=None
        ) as lines:
            places = [tuple(map(int, x.split())) for x in lines.read().split(b"\n") if x]
        with where.open_input_file(path) as source:
            for at, n in places:
                source.seek(at)
                yield parsed(zlib.decompress(source.read(n), 31))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[i] for r in rows], f.type)
                for i, f in enumerate(arrow)
            ],
            schema=arrow,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for one in batch.select(["archive", "sidecar"]).to_pylist():
                for row in rows_of(**one):
                    rows.append(row)
                    if len(rows) >= ROWS:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    return indexed.mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write a record per page, normalise the archives, and read them back.

    One row per row of `pages`: page_id, payload_bytes, payload_digest,
    record_type, refers_to, url. See with_record_types for nulls, ties and
    repeated rows; an empty table gives no archive and no row.
    """
    folder = scratch(pages.sparkSession, "warc")
    made = staged(
        write_archives(with_record_types(pages, min_bytes), folder), "archives"
    )
    n = max(1, made.count())
    # one archive a task
    dealt = made.repartitionByRange(n, "archive")
    indexed = staged(normalise(dealt), "indexed")
    return read_archives(indexed.repartitionByRange(n, "archive"))
