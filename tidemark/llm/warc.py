"""WARC archives in seekable Zstandard bundles (operator 8).

A bundle is a run of independent Zstandard frames, each holding whole WARC
records, then two skippable frames: the record index and the seek table of the
Zstandard seekable format.  Any Zstandard reader decompresses the bundle to a
plain WARC file; a reader that knows the index fetches one record by reading
one frame.

Records are WARC/1.1.  Payloads that occur more than once are stored once: the
record with the largest page id is the response, the others are revisits that
name it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, fresh_name, open_fs, released, scratch_path, shuffle_width, sliced, text_of

SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record")
MANIFEST = "path string, n_records bigint, n_frames bigint"
RECORDS = "record_id string, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit keeps the HTTP header, with the payload's length, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def read_record(data: memoryview, at: int) -> tuple[dict[str, str], bytes, bytes, int]:
    """Header fields, HTTP header, payload and the end of the record that begins at ``at``."""
    raw = bytes(data[at : at + 65_536])
    stop = raw.find(b"\r\n\r\n")
    while stop < 0 and at + len(raw) < len(data):
        raw = bytes(data[at : at + 2 * len(raw)])
        stop = raw.find(b"\r\n\r\n")
    lines = raw[:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    begin, size = at + stop + 4, int(fields["Content-Length"])
    block = bytes(data[begin : begin + size])
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload, begin + size + 4


class Bundle:
    """Writes one bundle frame by frame; memory holds one frame and the index."""

    def __init__(self, folder: str):
        import zstandard

        system, path = open_fs(folder)
        system.create_dir(path, recursive=True)
        name = fresh_name("pages", ".warc.zst")
        self.uri = f"{folder.rstrip('/')}/{name}"
        self.out = system.open_output_stream(f"{path.rstrip('/')}/{name}", compression=None)
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frame, self.filled, self.frames, self.written = [], 0, [], 0
        self.index: list[tuple[str, int, int, int]] = []  # record id, frame, offset in the frame, length

    def add(self, rid: str, record: bytes) -> None:
        if self.filled and self.filled + len(record) > FRAME_BYTES:
            self.end_frame()
        self.index.append((rid, len(self.frames), self.filled, len(record)))
        self.frame.append(record)
        self.filled += len(record)

    def end_frame(self) -> None:
        raw = b"".join(self.frame)
        packed = self.press.compress(raw)
        self.out.write(packed)
        self.written += len(packed)
        self.frames.append((len(packed), len(raw)))
        self.frame, self.filled = [], 0

    def close(self) -> tuple[str, int, int]:
        if self.frame:
            self.end_frame()
        index = self.press.compress(json.dumps(self.index).encode())
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        # The index is a frame of the seek table too, of no decompressed bytes.
        entries = [*self.frames, (len(index) + 8, 0)]
        table = b"".join(struct.pack("<II", *e) for e in entries)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + 9) + table + struct.pack("<IBI", len(entries), 0, SEEKABLE_MAGIC))
        self.out.close()
        return self.uri, len(self.index), len(self.frames)


class Reader:
    """Reads a bundle by its seek table."""

    def __init__(self, path: str):
        import zstandard

        system, name = open_fs(path)
        self.source = system.open_input_file(name)
        self.open = zstandard.ZstdDecompressor()
        size = self.source.size()
        count, _, magic = struct.unpack("<IBI", self.source.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        raw = self.source.read_at(8 * count, size - 9 - 8 * count)
        entries = [struct.unpack_from("<II", raw, 8 * k) for k in range(count)]
        self.frames, at = [], 0
        for packed, plain in entries:
            self.frames.append((at, packed, plain))
            at += packed
        self.where = self.frames.pop()

    def frame(self, k: int) -> memoryview:
        at, packed, plain = self.frames[k]
        data = self.open.decompress(self.source.read_at(packed, at), max_output_size=plain)
        if len(data) != plain:
            raise ValueError("frame length differs from the seek table")
        return memoryview(data)

    def index(self) -> dict[str, tuple[int, int, int]]:
        """Record id to frame, offset in the frame, length."""
        at, packed, _ = self.where
        return {rid: (k, o, n) for rid, k, o, n in json.loads(self.open.decompress(self.source.read_at(packed - 8, at + 8)))}

    def get(self, rid: str) -> tuple[dict[str, str], bytes]:
        k, offset, _ = self.index()[rid]
        fields, _, payload, _ = read_record(self.frame(k), offset)
        return fields, payload

    def records(self) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
        for k in range(len(self.frames)):
            data, at = self.frame(k), 0
            while at < len(data):
                fields, http, payload, at = read_record(data, at)
                yield fields, http, payload

    def close(self) -> None:
        self.source.close()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """One record for each row of ``pages`` (page_id, url, html) in bundles below ``folder``; returns the durable list of bundles.

    Null html is an empty payload, a null url gives a record without target,
    a null page id counts as the smallest.  Rows that share payload and largest
    id are all responses.  Other columns are ignored.  A retried task writes
    under a new name; only complete bundles are listed.
    """
    rows = pages.select("page_id", "url", text_of("html").alias("html")).withColumn("__sha1", F.sha1("html"))
    # Payloads that occur twice: combined before the shuffle, so a payload of many pages is one row a task.  Written, so
    # that both sides of the join are plain shuffles and the pages of one payload can be split over tasks.
    held = cut(rows.groupBy("__sha1").agg(F.max("page_id").alias("__holder"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n"))
    rows = rows.join(held, "__sha1", "left")
    rows = rows.select("page_id", "url", "html", "__holder", (F.col("__holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__holder"))).alias("__revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, done = None, []
        for run in sliced(batches, "html", 8 << 20):
            for page, url, html, holder, revisit in zip(*(run.column(i).to_pylist() for i in range(5))):
                bundle = bundle or Bundle(folder)
                payload = html.encode()
                digest = digest_of(payload)
                bundle.add(record_id(page, digest), make_record(page, url, payload, digest, holder, revisit))
                if bundle.written > BUNDLE_BYTES:
                    done.append(bundle.close())
                    bundle = None
        if bundle:
            done.append(bundle.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "n_records", "n_frames"])

    return cut(rows.mapInArrow(released(write), MANIFEST))


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the listed bundles as ``RECORDS``; a response's payload must have the digest its header states."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in RECORDS.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for listed in batches:
            for path in listed.column(0).to_pylist():
                reader, rows, held = Reader(path), [], 0
                for fields, http, payload in reader.records():
                    revisit = fields["WARC-Type"] == "revisit"
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    if not revisit and (len(payload) != length or digest_of(payload) != digest):
                        raise ValueError(f"{path}: {fields['WARC-Record-ID']} is damaged")
                    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                    rows.append(
                        (fields["WARC-Record-ID"], None if page is None else int(page), fields.get("WARC-Target-URI"), length, digest,
                         fields["WARC-Type"], None if refers is None else int(refers), payload if with_payload and not revisit else None)
                    )
                    held += len(payload)
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)
                reader.close()

    return manifest.select("path").repartition(shuffle_width(manifest.sparkSession), "path").mapInArrow(released(read), RECORDS)


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages, read the archives back, and list their records."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), with_payload=False)


ORACLE_SQL = """
SELECT page_id, octet_length(encode(h)) AS payload_bytes, d AS payload_digest,
  CASE WHEN n > 1 AND page_id IS DISTINCT FROM holder AND holder IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n > 1 AND page_id IS DISTINCT FROM holder AND holder IS NOT NULL THEN holder END AS refers_to
FROM (
  SELECT page_id, h, d, max(page_id) OVER (PARTITION BY d) AS holder, count(*) OVER (PARTITION BY d) AS n
  FROM (
    SELECT page_id, h, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + list_reduce(list_transform(range(5), lambda k: CASE substr(b, 1 + 5 * i + k, 1) WHEN '1' THEN 1 ELSE 0 END), lambda x, y: 2 * x + y), 1)), '') AS d
    FROM (
      SELECT page_id, h, array_to_string(list_transform(range(40), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
        1 + 4 * (strpos('0123456789abcdef', substr(sha1(h), 1 + i, 1)) - 1), 4)), '') AS b
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))))
"""
