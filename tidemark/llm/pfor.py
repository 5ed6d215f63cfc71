"""Token-ID files of patched frame-of-reference blocks (operator 9).

A file holds the ids of whole documents in order.  Ids are cut into blocks of
``BLOCK``; a block stores its minimum, the differences packed at the width
that covers ``percentile`` of them, and an exception list with the positions
and high parts of the rest.  The footer indexes where every block and every
document starts, so a reader fetches any document without the rest.

Layout (little-endian): ``TPF1`` | blocks | block starts u64[] | document ids
i64[] | id-is-null u8[] | document lengths u64[] | footer (n_blocks, n_docs,
n_ids, block size: u64 each) | ``TPF1``.
Block: minimum u32 | width u8 | 0 u8 | exceptions u16 | packed bits |
positions u16[] | high parts u32[].
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, fresh_name, open_fs, ordered_layout, prefix_sum, released, scratch_path, shuffle_width, sliced, text_of
from .tokens import WordEncoder, spread

MAGIC = b"TPF1"
BLOCK = 512
HEAD = 8
END_ID = 1
MANIFEST = "part int, seq int, path string, n_docs bigint, n_ids bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def encode_blocks(values: np.ndarray, percentile: float = 0.9) -> list[bytes]:
    """``values`` (uint32, a multiple of ``BLOCK``) as encoded blocks."""
    rows = values.reshape(-1, BLOCK)
    low = rows.min(axis=1)
    gaps = rows - low[:, None]
    need = np.frexp(gaps.astype(np.float64))[1].astype(np.uint8)  # bits of each difference
    width = np.partition(need, int(np.ceil(percentile * BLOCK)) - 1, axis=1)[:, int(np.ceil(percentile * BLOCK)) - 1]
    packed: list[bytes] = [b""] * len(rows)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        for part in np.array_split(at, max(1, len(at) // 512)):
            bits = ((gaps[part][:, :, None] >> np.arange(w, dtype=np.uint32)) & 1).astype(np.uint8)
            for i, line in zip(part, np.packbits(bits.reshape(len(part), -1), axis=1, bitorder="little")):
                packed[i] = line.tobytes()
    over = need > width[:, None]
    count = over.sum(axis=1)
    where = np.nonzero(over)[1].astype("<u2")
    high = (gaps[over] >> np.repeat(width, count).astype(np.uint32)).astype("<u4")
    ends = np.cumsum(count)
    out = []
    for i in range(len(rows)):
        a, b = ends[i] - count[i], ends[i]
        out.append(struct.pack("<IBBH", low[i], width[i], 0, count[i]) + packed[i] + where[a:b].tobytes() + high[a:b].tobytes())
    return out


def decode_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``data`` (uint8)."""
    head = data[starts[:, None] + np.arange(HEAD)].copy()
    low = head[:, :4].copy().view("<u4")[:, 0]
    width = head[:, 4]
    count = head[:, 6:8].copy().view("<u2")[:, 0].astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        if w:
            for part in np.array_split(at, max(1, len(at) // 512)):
                raw = data[starts[part][:, None] + HEAD + np.arange(BLOCK * int(w) // 8)]
                bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(part), BLOCK, int(w))
                total = np.zeros((len(part), BLOCK), np.uint32)
                for bit in range(int(w)):
                    total |= bits[:, :, bit].astype(np.uint32) << np.uint32(bit)
                out[part] = total
    after = starts + HEAD + BLOCK * width.astype(np.int64) // 8
    if count.sum():
        row = np.repeat(np.arange(len(starts)), count)
        where = data[spread(after, 2 * count)].view("<u2").astype(np.int64)
        high = data[spread(after + 2 * count, 4 * count)].view("<u4").astype(np.uint32)
        out[row, where] |= high << width[row].astype(np.uint32)
    return (out + low[:, None]).ravel()


class TokenFile:
    """Writes one file, block by block."""

    def __init__(self, folder: str, part: int, seq: int):
        system, path = open_fs(folder)
        system.create_dir(path, recursive=True)
        name = fresh_name(f"ids-{part:06d}-{seq:04d}", ".tpf")
        self.uri, self.part, self.seq = f"{folder.rstrip('/')}/{name}", part, seq
        self.out = system.open_output_stream(f"{path.rstrip('/')}/{name}", compression=None)
        self.out.write(MAGIC)
        self.at, self.starts, self.rest = len(MAGIC), [], np.empty(0, np.uint32)
        self.docs: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.n_ids = self.n_docs = 0

    def _blocks(self, values: np.ndarray) -> None:
        for k in range(0, len(values), 4096 * BLOCK):
            for block in encode_blocks(values[k : k + 4096 * BLOCK]):
                self.starts.append(self.at)
                self.at += len(block)
                self.out.write(block)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.sizes.append(sizes)
        self.n_ids += len(ids)
        self.n_docs += len(sizes)
        values = np.concatenate([self.rest, ids.astype(np.uint32)])
        whole = len(values) // BLOCK * BLOCK
        self._blocks(values[:whole])
        self.rest = values[whole:].copy()

    def close(self) -> tuple:
        if len(self.rest):
            self._blocks(np.pad(self.rest, (0, BLOCK - len(self.rest)), mode="edge"))
        docs = pa.concat_arrays(self.docs) if self.docs else pa.array([], pa.int64())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        self.out.write(docs.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes())
        self.out.write((np.concatenate(self.sizes) if self.sizes else np.empty(0)).astype("<u8").tobytes())
        self.out.write(struct.pack("<4Q", len(self.starts), self.n_docs, self.n_ids, BLOCK) + MAGIC)
        self.out.close()
        return self.part, self.seq, self.uri, self.n_docs, self.n_ids


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, partitions: int | None = None, max_ids: int = 1 << 26) -> DataFrame:
    """Writes the ids of ``docs`` (doc_id, text) in ascending doc_id order; returns the list of files.

    Null texts are empty; null ids come first; equal ids keep an arbitrary
    order among themselves.  Other columns are ignored.  The returned manifest
    (``MANIFEST``) is durable and names complete files only: a retried task
    writes under a new name.  ``max_ids`` closes a file, not the stream.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, file, done = TaskContext.get().partitionId(), 0, None, []
        coder = WordEncoder.get(vocabulary)
        for run in sliced(batches, "text", 4 << 20):
            ids, sizes, _, _ = coder.encode(run.column(1), end_id)
            file = file or TokenFile(folder, part, seq)
            file.add(run.column(0), ids, sizes)
            if file.n_ids >= max_ids:
                done.append(file.close())
                file, seq = None, seq + 1
        if file:
            done.append(file.close())
        coder.forget()
        if done:
            names = ["part", "seq", "path", "n_docs", "n_ids"]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    rows = ordered_layout(docs.select("doc_id", text_of().alias("text")), F.col("doc_id").asc_nulls_first(), partitions=partitions)
    return cut(rows.mapInArrow(released(write), MANIFEST))


def file_parts(path: str, step: int = 1 << 21) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Document ids, lengths and ids of one file, in runs of about ``step`` ids, found by the block index."""
    system, name = open_fs(path)
    size = system.get_file_info(name).size
    with system.open_input_file(name) as source:
        tail = source.read_at(36, size - 36)
        if tail[-4:] != MAGIC or source.read_at(4, 0) != MAGIC:
            raise ValueError(f"{path} is no complete token file")
        n_blocks, n_docs, n_ids, block = struct.unpack("<4Q", tail[:32])
        if block != BLOCK:
            raise ValueError(f"{path} has blocks of {block} ids")
        index = size - 36 - 8 * n_blocks - 17 * n_docs
        raw = source.read_at(8 * n_blocks + 17 * n_docs, index)
        starts = np.append(np.frombuffer(raw, "<u8", n_blocks).astype(np.int64), index)
        docs = np.frombuffer(raw, "<i8", n_docs, 8 * n_blocks)
        nulls = np.frombuffer(raw, np.uint8, n_docs, 8 * n_blocks + 8 * n_docs).astype(bool)
        lengths = np.frombuffer(raw, "<u8", n_docs, 8 * n_blocks + 9 * n_docs).astype(np.int64)
        ends = np.cumsum(lengths)
        first = 0
        while first < n_docs:
            begin = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, begin + step, side="right")))
            stop = int(ends[last - 1])
            a, b = begin // BLOCK, -(-stop // BLOCK)
            data = np.frombuffer(source.read_at(int(starts[b] - starts[a]), int(starts[a])), np.uint8)
            ids = decode_blocks(data, starts[a:b] - starts[a])[begin - a * BLOCK : stop - a * BLOCK]
            yield pa.array(docs[first:last], mask=nulls[first:last]), lengths[first:last], ids
            first = last


def read_ids(manifest: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every document of the listed files: ``ROWS`` with the ids as little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before; it is a running sum over
    the manifest, which has one row a file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(*(batch.column(i).to_pylist() for i in range(2))):
                for docs, lengths, ids in file_parts(path):
                    offsets = np.concatenate([[0], np.cumsum(lengths)])
                    blob = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                    yield pa.RecordBatch.from_arrays([docs, pa.array(before + offsets[:-1]), pa.array(lengths), blob], names=["doc_id", "start", "n_tokens", "ids"])
                    before += int(offsets[-1])

    files = prefix_sum(manifest, [("part", "asc"), ("seq", "asc")], {"n_ids": "upto"}, partitions=1)
    files = files.select("path", (F.col("upto") - F.col("n_ids")).alias("before"))
    return files.repartition(partitions or shuffle_width(manifest.sparkSession), "path").mapInArrow(released(read), ROWS)


def digest(docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write, read back, and say where every document lies in the whole stream and what its ids' checksum is."""
    folder = folder or scratch_path(docs.sparkSession, "token-ids")
    rows = read_ids(write_ids(docs, folder, vocabulary, end_id))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
