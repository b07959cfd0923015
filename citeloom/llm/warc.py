"""WARC archives whose records are compressed one by one with a dictionary of their own."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import chain, count

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.sources.staged import new_stage_path

# Fixed values of the two formats.
DICTIONARY_FRAME = b"\x5d\x2a\x4d\x18"
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Equal payloads of at least this many bytes are stored once.
REVISIT_BYTES = 1_000
#: Leading records from which an archive's dictionary is built, their bytes at most, and its size.
DICTIONARY_RECORDS, DICTIONARY_SAMPLE, DICTIONARY_BYTES = 512, 4 << 20, 64 << 10
LEVEL = 6
#: An archive that has reached this many bytes is followed by another.
ARCHIVE_BYTES = 128 << 20
_PAGES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_PAGES, f'page:{page}:{digest}')}>"


def format_record(
    page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One record. A revisit of page ``refers_to`` keeps its HTTP head, without the body."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head + payload if refers_to is None else head
    # A line break in a URL would end the field.
    target = "".join(c for c in (url or "") if c not in "\r\n")
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page, digest)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {'' if page is None else page}",
    ]
    if refers_to is not None:
        fields += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary trained on records, or none where they are too few or too alike."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r[: 64 << 10] for r in records])
    except zstandard.ZstdError:
        return None


def archive_frames(records: Iterator[bytes], limit: int | None = None) -> Iterator[bytes]:
    """The leading dictionary frame, then a frame per record.

    The dictionary comes from the first records, so an archive of any length is
    written without holding more than those. With ``limit`` the archive ends
    with the record that reaches so many bytes, once it has the first ones; the
    records that follow stay in the iterator.
    """
    first, room = [], DICTIONARY_SAMPLE
    for record in records:
        first.append(record)
        room -= len(record)
        if room <= 0 or len(first) >= DICTIONARY_RECORDS:
            break
    if not first:
        return
    trained = build_dictionary(first)
    raw = trained.as_bytes() if trained else b""
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(raw) if raw else b""
    leading = DICTIONARY_FRAME + struct.pack("<I", len(packed)) + packed
    yield leading
    size = len(leading)
    writer = zstandard.ZstdCompressor(level=LEVEL, **({"dict_data": trained} if trained else {}))
    for n, record in enumerate(chain(first, records), 1):
        frame = writer.compress(record)
        yield frame
        size += len(frame)
        if limit is not None and size >= limit and n >= len(first):
            return


def read_frames(data: bytes) -> Iterator[bytes]:
    """The decompressed records of one archive; other skippable frames are passed over."""
    at, dictionary = 0, None
    view = memoryview(data)
    while at < len(data):
        magic = data[at : at + 4]
        if len(magic) == 4 and magic[0] >> 4 == 5 and magic[1:] == DICTIONARY_FRAME[1:]:
            size = struct.unpack_from("<I", data, at + 4)[0]
            if at == 0 and magic == DICTIONARY_FRAME and size:
                raw = zstandard.ZstdDecompressor().decompress(view[8 : 8 + size])
                dictionary = zstandard.ZstdCompressionDict(raw)
            at += 8 + size
            continue
        reader = zstandard.ZstdDecompressor(**({"dict_data": dictionary} if dictionary else {}))
        parts, record = [], reader.decompressobj()
        step = 1 << 16
        while not record.eof:
            if at >= len(data):
                raise ValueError("the archive ends inside a record")
            parts.append(record.decompress(view[at : at + step]))
            at += step
        at = min(at, len(data)) - len(record.unused_data)
        yield b"".join(parts)


def parse_record(record: bytes) -> dict:
    """Fields of one record; the digest of a stored payload is checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    stored = fields["WARC-Type"] == "response"
    if stored and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    page, refers = fields.get("X-Page-ID", ""), fields.get("X-Refers-To-Page-ID")
    return {
        "page_id": int(page) if page else None,
        "url": fields.get("WARC-Target-URI", ""),
        "record_type": fields["WARC-Type"],
        "payload_bytes": int(sizes["Content-Length"]),
        "payload_digest": digest,
        "refers_to": int(refers) if refers else None,
        "payload": payload if stored else None,
    }


def _write_task(limit: int):
    """Frames of one archive after another, each with its number in the task and its place."""

    def numbered(records: Iterator[bytes]) -> Iterator[tuple[int, int, bytes]]:
        for archive in count():
            place = -1
            for place, frame in enumerate(archive_frames(records, limit)):
                yield archive, place, frame
            if place < 0:
                return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for cells in zip(*batch.columns, strict=True):
                    page, url, html, digest, main = (c.as_py() for c in cells)
                    yield format_record(page, url, html or b"", digest, None if main == page else main)

        def flush() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()), strict=True)],
                ["archive", "place", "frame"],
            )

        rows, size = [], 0
        for row in numbered(records()):
            rows.append(row)
            size += len(row[2])
            if size >= 1 << 20:
                yield flush()
                rows, size = [], 0
        if rows:
            yield flush()

    return run


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write dictionary-compressed archives below ``path``, at least one per partition.

    An archive that reaches ``archive_bytes`` is closed and the next one gets a
    dictionary of its own, so no file outgrows what one task can read; a record,
    which is never cut, may pass that. Of equal payloads of ``REVISIT_BYTES`` or more, the record with the largest
    id is a response and the others are revisits of it; only digests and ids
    are grouped, and smaller pages are archived where they are read. Frames go through Spark's text writer, whose line end is set to
    an empty skippable frame, so any file system that Spark knows can hold the
    archives. Null payloads are empty; a null id sorts below all others and is
    never referred to; rows that repeat the largest id are responses each.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).cast("binary").alias("html"),
    ).withColumn("digest", F.sha1(F.coalesce("html", F.lit("").cast("binary"))))
    groups = (
        rows.where(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("main"), F.count("*").alias("members"))
        .where(F.col("members") > 1)
        .select("digest", "main")
    )
    large = F.coalesce(F.octet_length("html") >= REVISIT_BYTES, F.lit(False))
    named = (
        rows.where(large)
        .join(groups, "digest", "left")
        .select("page_id", "url", "html", "digest", "main")
        .union(rows.where(~large).select("page_id", "url", "html", "digest", F.lit(None).cast("long")))
    )
    frames = named.mapInArrow(_write_task(archive_bytes), "archive int, place long, frame binary")
    (
        frames.sortWithinPartitions("archive", "place")
        .select("archive", F.col("frame").cast("string"))
        .write.partitionBy("archive")
        .option("lineSep", EMPTY_FRAME)
        .text(path)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, payload included (null for revisits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0):
                rows, size = [], 0
                for record in read_frames(cell.as_py()):
                    rows.append(parse_record(record))
                    size += len(record)
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(
        run,
        "page_id long, url string, record_type string, payload_bytes long,"
        " payload_digest string, refers_to long, payload binary",
    )


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as archives in the shared folder and read every record back.

    An empty table gives no rows; very long pages are records like any other;
    other columns are ignored.
    """
    path = new_stage_path(pages.sparkSession, "archives")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
