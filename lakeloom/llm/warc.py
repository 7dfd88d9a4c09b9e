"""Web archives: a deterministic sharded WARC writer and its reader.

Records are range-sorted by page; a task writes its range to files that it rolls by compressed
size. Pages of equal payload become one response and revisits that refer to it; which of them
answers is found on digests alone and then travels through the same range sort as the pages, so
page bodies are shuffled once. A file is written under a temporary name and renamed; what counts
is in the manifest, so files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import col, read_whole, scratch_path, settle, task_names, write_once

#: compressed bytes after which a task begins its next file
FILE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, without the name of the algorithm."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record_id(page_id: int | None, digest: str, repeat: int = 0) -> str:
    name = f"{page_id}/{digest}/{repeat}".encode()
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name).digest()[:16], version=5)}>"


def _header(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n"


def _member(content: bytes) -> bytes:
    """One gzip member; it has no time in it, so equal records give equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def _line(text: str | None) -> str | None:
    """A value that stays on its header line."""
    return None if text is None else re.sub(r"[\r\n]+", " ", text).strip()


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, response: int | None, repeat: int, date: str
) -> bytes:
    """One record; ``response`` is the page it refers to (with ``repeat``, possibly its own)."""
    revisit = repeat > 0 or response is not None
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode("ascii")
    block = http if revisit else http + payload
    target = page_id if response is None else response
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest, repeat)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _line(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Page-ID", page_id),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _record_id(target, digest)),
            ("Refers-To-Page-ID", target),
        ]
    fields.append(("Content-Type", "application/http;msgtype=response"))
    return _header(fields, block) + block + b"\r\n\r\n"


def _info(name: str, date: str) -> bytes:
    block = b"software: lakeloom\r\nformat: WARC File Format 1.1\r\n"
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", _record_id(None, name)),
        ("WARC-Date", date),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
    ]
    return _header(fields, block) + block + b"\r\n\r\n"


def _payload(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _referrals(pages: DataFrame, revisit_bytes: int) -> DataFrame:
    """(page_id, mark, digest, response) of the pages that refer to another page; mark is the payload's SHA-1 in hex."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [_payload(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([hashlib.sha1(p).hexdigest() for p in payloads], pa.string()),
                    pa.array([payload_digest(p) for p in payloads], pa.string()),
                    pa.array([len(p) for p in payloads], pa.int64()),
                ],
                names=["page_id", "mark", "digest", "size"],
            )

    seen = settle(
        pages.select("page_id", "html")
        .mapInArrow(digested, "page_id long, mark string, digest string, size long")
        .filter(F.col("size") >= revisit_bytes)
        .select("page_id", "mark", "digest"),
        "digests",
    )
    shared = seen.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("pages"))
    # a page without an id is smaller than any other
    return (
        seen.join(shared.filter("pages > 1 and response is not null"), "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("response")))
        .select("page_id", "mark", "digest", "response")
        .distinct()
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row; return the manifest (file, records, bytes), which is written last, into the folder.

    Null html is an empty payload. Payloads shorter than ``revisit_bytes`` are always written in
    full. Of equal ones, the largest page_id answers and the rest refer to it; a page without an
    id is smaller than any; of rows that repeat page and payload the first answers and the
    others refer to that page itself. An empty table writes no file.
    """
    kept = pages.select(
        col(page_id).cast("long").alias("page_id"),
        col(url).cast("string").alias("url"),
        col(html).cast("string").alias("html"),
    )
    none = F.lit(None)
    mark = F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("mark")
    records = kept.select("page_id", mark, F.lit(1).alias("kind"), "url", "html", none.cast("long").alias("response"))
    referrals = _referrals(kept, revisit_bytes).select(
        "page_id", "mark", F.lit(0).alias("kind"), none.cast("string").alias("url"), F.col("digest").alias("html"), "response"
    )
    ordered = (
        records.union(referrals)
        .repartitionByRange("page_id", "mark")
        .sortWithinPartitions("page_id", "mark", "kind", "url")
        .select("page_id", "mark", "kind", "url", "html", "response")
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, attempt = task_names()
        parts: list[bytes] = []
        rows: list[tuple] = []
        size = records = 0
        page: object = ()
        refers: int | None = None
        repeat = 0

        def name() -> str:
            return f"pages-{partition:06d}-{len(rows):06d}.warc.gz"

        def flush() -> None:
            nonlocal size, records
            content = _member(_info(name(), date)) + b"".join(parts)
            write_once(folder, name(), content, attempt)
            rows.append((name(), records, len(content)))
            parts.clear()
            size = records = 0

        for batch in batches:
            for one, mark, kind, link, text, response in zip(*(c.to_pylist() for c in batch.columns)):
                if (one, mark) != page:  # what a page says of one payload
                    page, refers, repeat = (one, mark), None, 0
                if kind == 0:
                    refers = response
                    continue
                payload = _payload(text)
                digest = payload_digest(payload)
                if len(payload) < revisit_bytes:
                    member = record(one, link, payload, digest, None, 0, date)
                else:
                    member = record(one, link, payload, digest, refers, repeat, date)
                repeat += 1
                parts.append(_member(member))
                size += len(parts[-1])
                records += 1
                if size >= file_bytes:
                    flush()
        if records:
            flush()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "records", "bytes"])

    # the last step: a folder counts once its manifest is there
    ordered.mapInArrow(written, "file string, records long, bytes long").write.mode("overwrite").parquet(
        f"{folder}/manifest"
    )
    return pages.sparkSession.read.schema("file string, records long, bytes long").parquet(f"{folder}/manifest")


#: bytes of an archive that are handed to the decompressor at a time
STEP = 1 << 16


def _members(content: bytes) -> Iterator[bytes]:
    """Each gzip member unpacked; what follows a member is looked at where it lies, not copied."""
    at, whole = 0, memoryview(content)
    while at < len(whole):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            some = whole[at : at + STEP]
            if not some:
                raise ValueError("the last record is cut off")
            parts.append(unpacker.decompress(some))
            at += len(some) - len(unpacker.unused_data)
        yield b"".join(parts)


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an archive, one gzip member at a time."""
    for text in _members(content):
        head, _, rest = text.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        block = rest[: int(fields["Content-Length"])]
        if rest[len(block) :] != b"\r\n\r\n":
            raise ValueError(f"record {fields['WARC-Record-ID']} is cut off")
        yield fields, block


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to of each record.

    html is null for revisits. The digest of every payload is worked out again and must agree.
    """
    # an explicit number, as files are short rows that would else be put into one task
    tasks = max(1, min(manifest.count(), int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    files = manifest.select("file").repartition(tasks)
    names = ["page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows: list[tuple] = []
                held = 0
                for fields, block in records_of(read_whole(folder, file)):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    html = None
                    if fields["WARC-Type"] == "response":
                        if payload_digest(payload) != digest:
                            raise ValueError(f"record {fields['WARC-Record-ID']} has other content than its digest")
                        html = payload.decode("utf-8", "surrogatepass")
                    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    ids = [int(v) if (v := fields.get(k)) else None for k in ("Page-ID", "Refers-To-Page-ID")]
                    rows.append(
                        (ids[0], fields.get("WARC-Target-URI"), html, length, digest, fields["WARC-Type"], ids[1])
                    )
                    held += len(payload)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = (
        "page_id long, url string, html string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )
    return files.mapInArrow(read, schema)


def round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write archives of all pages and return what the archives say of each."""
    folder = folder or scratch_path(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, folder, **options), folder)
