"""WARC archives as seekable Zstandard bundles.

Each task writes its records to bundles in a shared folder.  Records are
grouped into independent frames; a footer in the seekable format (a skippable
frame with the compressed and the plain size of every frame) lets a reader go
to a frame without reading those before it.  The index maps record
identifiers to bundle, frame and place within the frame's plain bytes.

Of records with equal payloads, that with the largest id is a response and
holds the payload; the others are revisits that refer to it.  Equal payloads
are found by digest: counts are pre-aggregated, and only digests that repeat
are joined back to the records.

A task that is run again writes bundles under new names; the index names the
bundles of the attempts that succeeded, so others are never read.

Edge cases: a null payload is empty.  Of equal payloads, rows that share the
largest id are all responses; rows with a null id revisit the largest id, and
are responses if all ids are null.  Null urls are written as empty.  A very
long page makes a frame of its own, longer than others.  Other columns of the
input are not looked at.  An empty table gives an empty index and result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import slices, small_batches
from tierline.session import scratch_path
from tierline.sources.sinks import stage_table

#: Plain bytes from which on a frame is closed, and bytes written from which
#: on a bundle is.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: Reading back: frames that stay together, and bytes of records a task.
READ_FRAMES = 16
READ_BYTES = 64 << 20

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

INDEX = "page_id {id}, bundle string, frame int, offset bigint, length bigint"
RECORD = "page_id {id}, payload_bytes bigint, payload_digest string, record_type string, refers_to {id}, url string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, revisits: bool, refers_to: int | None) -> bytes:
    """One WARC record; a revisit states its payload's size and digest only."""
    body = b"" if revisits else payload
    target = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisits else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Payload-Length: {len(payload)}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisits else []),
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields, body and end of the record at a place."""
    stop = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:stop].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    begin = stop + 4
    end = begin + int(fields["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record without its end")
    return fields, data[begin:end], end + 4


class Bundle:
    """Writes one bundle; ``add`` returns a record's frame, offset, length."""

    def __init__(self, out: io.IOBase, frame_bytes: int | None = None):
        self.out = out
        self.frame_bytes = frame_bytes or FRAME_BYTES
        self.buffer: list[bytes] = []
        self.held = 0
        self.frames: list[tuple[int, int]] = []
        self.written = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        if self.held >= self.frame_bytes:
            self.end_frame()
        place = (len(self.frames), self.held, len(data))
        self.buffer.append(data)
        self.held += len(data)
        return place

    def end_frame(self) -> None:
        if self.held:
            packed = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(self.buffer))
            self.out.write(packed)
            self.frames.append((len(packed), self.held))
            self.written += len(packed)
            self.buffer, self.held = [], 0

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class Reader:
    """Random access to the frames of a bundle."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{uri}: no seek table")
        self.file.seek(size - 9 - 8 * n)
        sizes = struct.iter_unpack("<II", self.file.read(8 * n))
        self.places, at = [], 0
        for packed, plain in sizes:
            self.places.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.places[number]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def read_record(bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """Header fields and body of one indexed record."""
    reader = Reader(bundle)
    try:
        return parse_record(reader.frame(frame), offset)[:2]
    finally:
        reader.close()


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write a record per row to bundles in ``folder`` (shared storage) and
    return the index.  Payloads under ``least_bytes`` are all responses."""
    small_batches(pages.sparkSession)
    id_type = pages.schema[id_col].dataType.simpleString()
    own = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    big = own.where(F.octet_length("html") >= least_bytes)
    repeats = big.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1")
    repeats = stage_table(repeats.select("digest", "response"), "repeats")
    told = own.join(repeats, "digest", "left").select("page_id", "url", "html", "response")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        bundle, name = None, ""
        for batch in batches:
            for part in slices(batch, "html"):
                rows: list[tuple] = []
                for page_id, url, page, response in zip(*(part.column(c).to_pylist() for c in part.schema.names), strict=True):
                    if bundle is None:
                        name = f"{uuid.uuid4().hex}.warc.zst"
                        fs.create_dir(base, recursive=True)
                        bundle = Bundle(fs.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                    payload = page.encode()
                    revisits = response is not None and response != page_id and len(payload) >= least_bytes
                    place = bundle.add(record(page_id, url, payload, revisits, response))
                    rows.append((page_id, f"{folder}/{name}", *place))
                    if bundle.written >= bundle_bytes:
                        bundle.close()
                        bundle = None
                types = [part.schema.field("page_id").type, pa.string(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    ["page_id", "bundle", "frame", "offset", "length"],
                )
        if bundle is not None:
            bundle.close()

    return stage_table(told.mapInArrow(write, INDEX.format(id=id_type)), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """Every indexed record, read back from its place: by bundle, frame (found
    through the seek table) and offset.  Digests of responses are checked
    against their payloads, lengths against the index.

    Runs of ``READ_FRAMES`` frames are dealt out to a task per ``READ_BYTES``
    of records (a number of its own, which adaptive execution does not bring
    down: the index is small, what it names is not); in a task every frame is
    read once."""
    id_type = index.schema["page_id"].dataType.simpleString()
    number = index.schema["page_id"].dataType.typeName() not in ("string",)
    kind = pa.int64() if number else pa.string()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, bundle, frame, data = None, None, None, b""
        for batch in batches:
            rows: list[tuple] = []
            for uri, number_of, offset, length in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length")), strict=True):
                if uri != bundle:
                    if reader:
                        reader.close()
                    reader, bundle, frame = Reader(uri), uri, None
                if number_of != frame:
                    frame, data = number_of, reader.frame(number_of)
                fields, body, end = parse_record(data, offset)
                own, refers = (fields.get(k, "<urn:page:>")[10:-1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if end - offset != length or (fields["WARC-Type"] == "response" and payload_digest(body) != digest):
                    raise ValueError(f"{uri}: damaged record {own}")
                own, refers = ((int(x) if number else x) if x else None for x in (own, refers))
                rows.append((own, int(fields["WARC-Payload-Length"]), digest, fields["WARC-Type"], refers, fields["WARC-Target-URI"]))
            if rows:
                types = [kind, pa.int64(), pa.string(), pa.string(), kind, pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"],
                )
        if reader:
            reader.close()

    held = index.agg(F.sum("length").alias("n")).first()["n"] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-held // READ_BYTES))
    places = index.select("bundle", "frame", "offset", "length").repartition(
        tasks, "bundle", F.floor(F.col("frame") / READ_FRAMES)
    )
    out_type = "bigint" if number else "string"
    found = places.sortWithinPartitions("bundle", "frame", "offset").mapInArrow(read, RECORD.format(id=out_type))
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive(pages: DataFrame, **columns: str) -> DataFrame:
    """Write ``pages`` to a new folder below the shared checkpoint folder and
    read the records back."""
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder:
        folder = f"file://{folder}"
    return read_archives(write_archives(pages, folder, **columns))
