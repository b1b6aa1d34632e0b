"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent frames, each of some whole records, and a footer:
the seek table of the public seekable format, a skippable frame with the compressed
and plain size and the checksum of each frame. The index maps a record to its bundle,
its frame, and its place in the plain frame, so one record costs one frame.

Every task writes its own bundles, named after the task's attempt. Only the index rows
of attempts that succeeded are kept, so a lost executor leaves at most an unnamed file.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import new_path, split_join, stored, take

#: Fixed values of the seekable format: skippable frame, seek table, checksum flag.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: Fixed values of the record format.
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, bundle string, frame int, offset long, length long, record_type string"
#: Payloads of one digest that a task takes when digests are joined by shuffle.
COPIES = 20_000


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path)


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _of_urn(text: str) -> int | None:
    number = text.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One response or, if refers_to names another page, one revisit without payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(page_id))]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(("WARC-Target-URI", safe))
    head += [("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _urn(refers_to))]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields; raises if it is cut short or its payload has another digest."""
    at = data.index(b"\r\n\r\n")
    version, *lines = data[:at].split(b"\r\n")
    head = dict(x.decode().split(": ", 1) for x in lines)
    block = data[at + 4 : at + 4 + int(head["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    response = head["WARC-Type"] == "response"
    if version != VERSION or not data.endswith(b"\r\n\r\n") or len(data) != at + 8 + len(block):
        raise ValueError("not a whole record")
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("the payload does not match its digest")
    return {
        "page_id": _of_urn(head["WARC-Record-ID"]),
        "url": head.get("WARC-Target-URI"),
        "payload": payload if response else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": None if response else _of_urn(head["WARC-Refers-To"]),
    }


class Bundle:
    """Writes frames to a stream and the seek table after them."""

    def __init__(self, stream, level: int):
        self.stream, self.packer, self.frames = stream, zstandard.ZstdCompressor(level=level), []

    def add(self, plain: bytes) -> int:
        packed = self.packer.compress(plain)
        self.stream.write(packed)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        return len(self.frames) - 1

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *x) for x in self.frames)
        body += struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.stream.close()


def seek_table(file) -> list[tuple[int, int, int, int]]:
    """(place, packed size, plain size, checksum) of each frame, from a bundle's footer."""
    size = file.size()
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE or flags != CHECKSUMS:
        raise ValueError("not a seekable bundle")
    file.seek(size - 9 - 12 * n)
    rows = list(struct.iter_unpack("<III", file.read(12 * n)))
    places, at = [], 0
    for row in rows:
        places.append((at, *row))
        at += row[0]
    return places


def read_frame(file, row: tuple[int, int, int, int]) -> bytes:
    place, packed, plain, checksum = row
    file.seek(place)
    data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=max(plain, 1))
    if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
        raise ValueError("a damaged frame")
    return data


def write(
    pages: DataFrame,
    path: str | None = None,
    frame_bytes: int = 1 << 20,
    bundle_bytes: int = 1 << 30,
    min_bytes: int = 1000,
    level: int = 3,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html); returns the index.

    A null html is an empty payload; null urls have no target header. Of equal payloads
    of min_bytes at least, the row with the largest page_id is a response and all others
    revisit it; rows that repeat that page_id are responses too, and a group without any
    page_id has responses only. Shorter payloads are all responses. The returned frame
    writes the archives when it runs: store it before using it twice.
    """
    path = path or new_path(pages.sparkSession, "warc")
    rows = take(pages, "page_id", "url", "html").select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= min_bytes
    copies = rows.where(large).groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
    copies = stored(copies.where("n > 1 and holder is not null"), "warc-copies")
    # Payloads move only if there are too many repeated digests to be broadcast.
    joined = split_join(rows, copies, ["digest"], ["page_id", "url"], "left", most=COPIES).select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, folder = open_store(path)
        store.create_dir(folder, recursive=True)
        bundle, held, size, place, made, done = None, [], 0, 0, 0, []

        def flush() -> None:
            nonlocal bundle, held, size, place, made, name
            if bundle is None:
                name = f"bundle-{context.partitionId():06d}-{context.taskAttemptId()}-{made}.warc.zst"
                bundle, place, made = Bundle(store.open_output_stream(f"{folder}/{name}", compression=None), level), 0, made + 1
            frame = bundle.add(b"".join(x for _, x, _ in held))
            offset = 0
            for page_id, data, kind in held:
                done.append((page_id, f"{path}/{name}", frame, offset, len(data), kind))
                offset += len(data)
            place += bundle.frames[-1][0]
            held, size = [], 0
            if place >= bundle_bytes:
                bundle.close()
                bundle = None

        name = ""
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = record(page_id, url, payload, digest, refers_to, date)
                if held and size + len(data) > frame_bytes:
                    flush()
                held.append((page_id, data, "response" if refers_to is None else "revisit"))
                size += len(data)
            if len(done) >= 4096:
                yield _index(done)
                done.clear()
        if held:
            flush()
        if bundle is not None:
            bundle.close()
        if done:
            yield _index(done)

    return joined.mapInArrow(run, INDEX)


def _index(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    names = ["page_id", "bundle", "frame", "offset", "length", "record_type"]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def read(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that index rows name, read from their frames and checked.

    Returns page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if
    asked for, payload (null in a revisit). A damaged bundle raises an error.
    """
    types = {
        "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
        "record_type": pa.string(), "refers_to": pa.int64(),
    } | ({"payload": pa.binary()} if payload else {})
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", payload binary" if payload else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, table, frame, data = None, None, [], -1, b""
        out, size = [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in types.items()], names=list(types))

        for batch in batches:
            for bundle, number, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bundle != name:
                    if file is not None:
                        file.close()
                    store, place = open_store(bundle)
                    name, file, frame = bundle, store.open_input_file(place), -1
                    table = seek_table(file)
                if number != frame:
                    frame, data = number, read_frame(file, table[number])
                out.append(parse(data[offset : offset + length]))
                size += length
                if size > 8 << 20:
                    yield batch_of()
                    out, size = [], 0
        if file is not None:
            file.close()
        if out:
            yield batch_of()

    order = ["bundle", "frame", "offset"]
    placed = take(index, *order, "length")
    return placed.repartition("bundle", "frame").sortWithinPartitions(*order).mapInArrow(run, schema)
