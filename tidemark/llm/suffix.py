"""Exact removal of repeated passages by a logarithmic family of suffix arrays (operator 6).

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
earlier: in a document with a smaller id, or before it in the same one.

Suffixes are thinned to anchors first: of the ``GRAM``-byte grams inside each
window of ``LENGTH`` bytes, the one with the smallest hash is its anchor, so
equal windows have equal anchors at equal places.  Consecutive windows with
one anchor are a run.  Runs are dealt to tasks by their anchor's gram, so any
two equal windows meet.

A task takes its entries in document order, batch by batch.  Each new batch
gets a sorted array of its suffixes, which is merged against the sorted
arrays of the existing levels to find what occurred before; its new entries
become a level, and levels of equal size class merge (``IndexFamily``).  The
first family holds whole runs and settles those that occur as a whole.  A
second one holds the 100-byte suffixes of the runs that share an anchor but
not all their text.

Grams that a sample finds in very many different runs (a line of 40 bytes in
a third of all documents) would put all these runs into one task.  Their
windows are dealt one by one, by the window's own hash; results are the same.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import released, shuffle_width, sliced, text_of
from .tokens import spread

LENGTH, GRAM = 100, 32
#: Bytes of text that are hashed at once.
CHUNK = 1 << 20
#: Entries of a new batch.
BATCH = 1 << 16
#: Rows drawn to find crowded grams, and different runs there that make one crowded.
SAMPLE_ROWS, CROWDED = 4_096, 16
NO_ID = -(1 << 63)
RUN, WINDOW, MARK, PART = 0, 1, 2, 3


class IndexFamily:
    """Sorted arrays of distinct keys (numpy ``S``); a level is at least twice as long as the next."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key occurred before, in earlier batches or earlier in this one; the new ones are kept."""
        order = np.argsort(keys, kind="stable")  # the batch's suffix array
        sorted_keys = keys[order]
        first = np.append(True, sorted_keys[1:] != sorted_keys[:-1])
        fresh = sorted_keys[first]
        known = np.zeros(len(fresh), bool)
        for level in self.levels:
            known |= merge_scan(level, fresh)
        seen = np.ones(len(keys), bool)
        seen[order[first]] = known
        fresh = fresh[~known]
        if len(fresh):
            self.levels.append(fresh)
            while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
                a, b = self.levels.pop(), self.levels.pop()
                self.levels.append(np.insert(b, np.searchsorted(b, a), a))
        return seen

    def all(self) -> np.ndarray:
        while len(self.levels) > 1:
            a, b = self.levels.pop(), self.levels.pop()
            self.levels.append(np.insert(b, np.searchsorted(b, a), a))
        return self.levels[0] if self.levels else np.empty(0, "S16")


def merge_scan(level: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the sorted ``keys`` the sorted ``level`` has."""
    at = np.searchsorted(level, keys)
    inside = at < len(level)
    out = np.zeros(len(keys), bool)
    out[inside] = level[at[inside]] == keys[inside]
    return out


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each position on."""
    with np.errstate(over="ignore"):
        power, n, h = np.uint64(0x9E3779B97F4A7C15), 1, data.astype(np.uint64) + np.uint64(1)
        while n < GRAM:
            h = h[:-n] * power + h[n:]
            power, n = power * power, 2 * n
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
    return h


def find_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Piece, first window, number of windows and gram of the runs in the pieces ``data[starts:ends]``."""
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    grams = gram_hashes(data)
    low = np.uint64((1 << 23) - 1)
    # Smallest hash wins, the last of equal ones: the low bits count down.
    best = (grams & ~low) | (low - (np.arange(len(grams), dtype=np.uint64) & low))
    span, width = 1, LENGTH - GRAM + 1
    while 2 * span <= width:
        best, span = np.minimum(best[:-span], best[span:]), 2 * span
    if span < width:
        best = np.minimum(best[: span - width], best[width - span :])
    anchor = (low - (best & low)).astype(np.int64)
    sizes = np.maximum(ends - starts - LENGTH + 1, 0)  # windows inside each piece
    window = spread(starts, sizes)
    piece = np.repeat(np.arange(len(starts)), sizes)
    own = anchor[window]
    first = np.append(True, (own[1:] != own[:-1]) | (piece[1:] != piece[:-1])) if len(own) else np.empty(0, bool)
    begin = np.flatnonzero(first)
    count = np.diff(np.append(begin, len(own)))
    return piece[begin], window[begin], count, grams[own[begin]]


class Rows:
    """Entries of one task, as columns: document (k, d), first window, windows, key halves and kind."""

    NAMES = ("k", "d", "at", "n", "kind", "g", "h")
    KINDS = ("<i8", "<i8", "<u4", "u1", "u1", "<u8", "<u8")

    @staticmethod
    def pack(columns: dict[str, np.ndarray]) -> bytes:
        return struct.pack("<I", len(columns["k"])) + b"".join(np.ascontiguousarray(columns[c], t).tobytes() for c, t in zip(Rows.NAMES, Rows.KINDS))

    @staticmethod
    def unpack(blob: bytes) -> dict[str, np.ndarray]:
        (n,), at, out = struct.unpack_from("<I", blob), 4, {}
        for c, t in zip(Rows.NAMES, Rows.KINDS):
            out[c] = np.frombuffer(blob, t, n, at)
            at += n * np.dtype(t).itemsize
        return out

    @staticmethod
    def joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
        return {c: np.concatenate([p[c] for p in parts]) for c in Rows.NAMES}

    @staticmethod
    def taken(rows: dict[str, np.ndarray], index: np.ndarray) -> dict[str, np.ndarray]:
        return {c: v[index] for c, v in rows.items()}


def runs_of(batch: pa.RecordBatch, crowded: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    """Entries of a batch (k, d, text), chunk by chunk; windows of crowded grams are entries of their own."""
    from xxhash import xxh3_64_intdigest, xxh64_intdigest

    texts = batch.column(2).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    k, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    # Long documents are cut into pieces that overlap by one window less a byte.
    doc, starts, ends = [], [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for s in range(a, max(b - LENGTH + 1, a + 1), CHUNK):
            doc.append(i)
            starts.append(s)
            ends.append(min(b, s + CHUNK + LENGTH - 1))
    doc, starts, ends = np.array(doc, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)
    first = 0
    while first < len(doc):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK, side="right")))
        base, own = int(starts[first]), slice(first, last)
        part = data[base : int(ends[own].max())]
        piece, window, count, gram = find_runs(part, starts[own] - base, ends[own] - base)
        view = memoryview(np.ascontiguousarray(part))
        row = doc[own][piece]
        at = base + window - offsets[row]
        many = np.isin(gram, crowded) if len(crowded) else np.zeros(len(gram), bool)
        few = ~many
        h = np.fromiter((xxh3_64_intdigest(view[s:e]) for s, e in zip(window[few].tolist(), (window + count + LENGTH - 1)[few].tolist())), np.uint64, int(few.sum()))
        rows = [{"k": k[row[few]], "d": d[row[few]], "at": at[few], "n": count[few], "kind": np.full(len(h), RUN), "g": gram[few], "h": h}]
        if many.any():
            each = spread(window[many], count[many])
            line = np.repeat(row[many], count[many])
            g = np.fromiter((xxh3_64_intdigest(view[s : s + LENGTH]) for s in each.tolist()), np.uint64, len(each))
            h = np.fromiter((xxh64_intdigest(view[s : s + LENGTH]) for s in each.tolist()), np.uint64, len(each))
            rows.append({"k": k[line], "d": d[line], "at": base + each - offsets[line], "n": np.ones(len(each)), "kind": np.full(len(each), WINDOW), "g": g, "h": h})
        yield Rows.joined(rows)
        first = last


def combined(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Equal entries before the shuffle: the earliest stays, the others become marks that only pass through."""
    order = np.argsort(rows["g"], kind="stable")
    g = rows["g"][order]
    again = np.append(False, g[1:] == g[:-1])
    again |= np.append(again[1:], False)
    some = order[again]
    if not len(some):
        return rows
    sub = Rows.taken(rows, some)
    by = np.lexsort((sub["at"], sub["d"], sub["k"], sub["h"], sub["g"]))
    sub, some = Rows.taken(sub, by), some[by]
    same = np.append(False, (sub["g"][1:] == sub["g"][:-1]) & (sub["h"][1:] == sub["h"][:-1]) & (sub["n"][1:] == sub["n"][:-1]))
    twin = same & np.append(False, (sub["k"][1:] == sub["k"][:-1]) & (sub["d"][1:] == sub["d"][:-1]) & (sub["at"][1:] == sub["at"][:-1]))
    kind = rows["kind"].copy()
    kind[some[same]] = MARK
    keep = np.ones(len(kind), bool)
    keep[some[twin]] = False  # a row that repeats id and text is the same document
    return Rows.taken(rows | {"kind": kind}, keep)


def key_bytes(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.column_stack([g, h]).astype(">u8")).view("S16")[:, 0]


def document_order(rows: dict[str, np.ndarray]) -> np.ndarray:
    return np.lexsort((rows["at"], rows["d"], rows["k"]))


def settled(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Marks for entries that occurred before as a whole, and ``PART`` rows for runs that share a gram with another run."""
    marks = rows["kind"] == MARK
    entries = Rows.taken(rows, ~marks)
    entries = Rows.taken(entries, document_order(entries))
    same = np.ones(len(entries["k"]), bool)
    for c in ("k", "d", "at", "g", "h"):
        same &= np.append(False, entries[c][1:] == entries[c][:-1]) if len(same) else same
    entries = Rows.taken(entries, ~same)
    keys, family = key_bytes(entries["g"], entries["h"]), IndexFamily()
    seen = np.concatenate([family.add(keys[b : b + BATCH]) for b in range(0, len(keys), BATCH)]) if len(keys) else np.empty(0, bool)
    # Grams of several different runs, from the sorted family.
    whole = family.all().view("S8").reshape(-1, 2)[:, 0] if len(keys) else np.empty(0, "S8")
    shared = np.unique(whole[1:][whole[1:] == whole[:-1]]) if len(whole) else whole
    part = ~seen & (entries["kind"] == RUN) & np.isin(np.ascontiguousarray(entries["g"].astype(">u8")).view("S8"), shared)
    kind = np.where(seen, MARK, np.where(part, PART, RUN)).astype(np.uint8)
    return Rows.joined([Rows.taken(rows, marks), Rows.taken(entries | {"kind": kind}, kind != RUN)])


def repeated_windows(rows: list[tuple[int, int, int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
    """(k, d, first window, windows) of the windows that occur earlier in ``rows`` (k, d, first window, windows, text)."""
    rows = sorted(rows, key=lambda r: r[:3])
    family, begin = IndexFamily(), 0
    while begin < len(rows):
        end, total = begin, 0
        while end < len(rows) and total < BATCH // 2:
            total += rows[end][3]
            end += 1
        some = rows[begin:end]
        data = np.frombuffer(b"".join(r[4] for r in some), np.uint8)
        sizes = np.array([r[3] for r in some], np.int64)
        lengths = sizes + LENGTH - 1
        starts = spread(np.cumsum(lengths) - lengths, sizes)
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, LENGTH)[starts]).view(f"S{LENGTH}")[:, 0]
        seen = family.add(windows)
        owner = np.repeat(np.arange(len(some)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hit = np.flatnonzero(seen)
        if len(hit):
            cut = np.flatnonzero((np.diff(hit) > 1) | (np.diff(owner[hit]) > 0))
            for a, b in zip(np.append(0, cut + 1).tolist(), np.append(cut, len(hit) - 1).tolist()):
                k, d, at, _, _ = some[owner[hit[a]]]
                yield k, d, at + int(place[hit[a]]), b - a + 1
        begin = end


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """All rows of one bucket at a time; input is sorted by its first column, the bucket."""
    held, now = [], None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[0] != now:
                if held:
                    yield now, held
                held, now = [], row[0]
            held.append(row[1:])
    if held:
        yield now, held


def _batch(names: str, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def _span(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    return at.astype(np.int64) << 8 | n.astype(np.int64)


def documents_of(docs: DataFrame) -> DataFrame:
    """k, d, text: a document is its id (null below all others), its text's hash, and its text."""
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("k"), F.xxhash64(text_of()).alias("d"), text_of().alias("text"))


def crowded_grams(rows: DataFrame, count: int, sample_rows: int = SAMPLE_ROWS, crowded: int = CROWDED) -> np.ndarray:
    """Grams in at least ``crowded`` different runs of a sample; at most a few for each hundred rows of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", CHUNK):
            for found in runs_of(part, np.empty(0, np.uint64)):
                yield _batch("g h", [found["g"].view(np.int64), found["h"].view(np.int64)])

    drawn = rows.sample(min(1.0, sample_rows / max(count, 1)), seed=3).mapInArrow(released(run), "g bigint, h bigint")
    many = drawn.groupBy("g").agg(F.approx_count_distinct("h").alias("n")).filter(F.col("n") >= crowded)
    return np.sort(np.array([r["g"] for r in many.select("g").collect()], np.int64).view(np.uint64))


def removals(docs: DataFrame, crowded: int = CROWDED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents (k, d, text), dealt by (k, d); what the first family found of each; what the second found.

    Repeated windows are spans: first window << 8 | number of windows.  The
    documents are read by two joins; both read the same shuffle.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    plain = documents_of(docs)
    crowd = crowded_grams(plain, docs.count(), crowded=crowded)

    def collect_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def dealt() -> Iterator[pa.RecordBatch]:
            rows = combined(Rows.joined(held))
            bucket = (rows["g"] % np.uint64(8 * width)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.append(True, np.diff(bucket[order]) > 0))
            parts = np.split(order, edges[1:])
            yield _batch("bucket blob", [bucket[order][edges], [Rows.pack(Rows.taken(rows, p)) for p in parts]])

        for part in sliced(batches, "text", CHUNK):
            for rows in runs_of(part, crowd):
                held.append(rows)
                size += len(rows["k"])
                if size >= 1 << 18:
                    yield from dealt()
                    held, size = [], 0
        if size:
            yield from dealt()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in by_bucket(batches):
            rows = settled(Rows.joined([Rows.unpack(b) for (b,) in blobs]))
            for a in range(0, len(rows["k"]), 1 << 16):
                s = Rows.taken(rows, slice(a, a + (1 << 16)))
                gram = np.where(s["kind"] == PART, s["g"].view(np.int64), 0)
                yield _batch("k d span gram part", [s["k"], s["d"], _span(s["at"], s["n"]), gram, s["kind"] == PART])

    runs = plain.mapInArrow(released(collect_runs), "bucket bigint, blob binary").repartition(width, "bucket").sortWithinPartitions("bucket")
    first = runs.mapInArrow(released(settle), "k bigint, d bigint, span bigint, gram bigint, part boolean")
    entry = F.struct("span", "gram", "part")
    found = first.groupBy("k", "d").agg(F.collect_list(entry).alias("found"))
    dealt = plain.repartition(width, "k", "d")

    def cut_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", 8 << 20):
            texts = part.column(2).cast(pa.binary()).to_pylist()
            out = []
            for k, d, text, spans in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, part.column(3).to_pylist()):
                for entry in spans:
                    if entry["part"]:
                        at, n, gram = entry["span"] >> 8, entry["span"] & 255, entry["gram"]
                        out.append((gram, k, d, entry["span"], text[at : at + n + LENGTH - 1]))
            if out:
                yield _batch("gram k d span text", list(zip(*out)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            hits = list(repeated_windows([(k, d, span >> 8, span & 255, text) for k, d, span, text in set(rows)]))
            if hits:
                k, d, at, n = (np.array(c, np.int64) for c in zip(*hits))
                yield _batch("k d span", [k, d, _span(at, n)])

    parts = dealt.join(found, ["k", "d"]).select("k", "d", "text", "found").mapInArrow(released(cut_parts), "gram bigint, k bigint, d bigint, span bigint, text binary")
    buckets = parts.select(F.pmod("gram", F.lit(8 * width)).alias("bucket"), "k", "d", "span", "text")
    second = buckets.repartition(4 * width, "bucket").sortWithinPartitions("bucket").mapInArrow(released(compare), "k bigint, d bigint, span bigint")
    more = second.groupBy("k", "d").agg(F.collect_list("span").alias("more"))
    return dealt, found, more


def covered(size: int, spans: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of removed bytes."""
    if not spans:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    packed = np.sort(np.array(spans, np.int64))
    start = packed >> 8
    end = start + (packed & 255) + LENGTH - 1
    reach = np.maximum.accumulate(end)
    first = np.append(True, start[1:] > reach[:-1])
    begin = np.flatnonzero(first)
    return start[begin], reach[np.append(begin[1:], len(start)) - 1]


def deduplicated(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """doc_id, text_hash, n_bytes, n_removed, n_spans, kept_sha256, kept (binary) and spans (starts, ends) of every document.

    Texts are their UTF-8 bytes, null is empty.  Null ids come before all
    others; texts that share an id are ordered by their hash; rows that agree
    in id and text are one document, and each of them has its result.  No rows
    give no rows; other columns are ignored.
    """
    dealt, found, more = removals(docs, crowded)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", 8 << 20):
            out = []
            texts = part.column(2).cast(pa.binary()).to_pylist()
            for k, d, text, one, two in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, part.column(3).to_pylist(), part.column(4).to_pylist()):
                spans = (one or []) + (two or [])
                starts, ends = covered(len(text), spans)
                kept = b"".join(text[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(text)]))
                out.append((None if k == NO_ID else k, d, len(text), len(text) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept, starts.tolist(), ends.tolist()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names="doc_id text_hash n_bytes n_removed n_spans kept_sha256 kept starts ends".split())

    marks: Column = F.transform(F.filter("found", lambda e: ~e["part"]), lambda e: e["span"])
    rows = dealt.join(found, ["k", "d"], "left").join(more, ["k", "d"], "left").select("k", "d", "text", marks.alias("one"), "more")
    schema = "doc_id bigint, text_hash bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, starts array<bigint>, ends array<bigint>"
    return rows.mapInArrow(released(apply), schema)


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of their texts; all other columns stay as they are.

    A character that is cut in the middle goes as a whole.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.decode("utf-8", "ignore") for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["__id", "__hash", "__text"])

    # One text for each id and text hash; unchanged documents keep theirs.
    changed = deduplicated(docs).filter("n_removed > 0").select("doc_id", "text_hash", "kept").mapInArrow(released(decode), "__id bigint, __hash bigint, __text string")
    changed = changed.dropDuplicates(["__id", "__hash"])
    own = docs.withColumn("__own", F.xxhash64(text_of()))
    rows = own.join(changed, own["doc_id"].eqNullSafe(changed["__id"]) & (own["__own"] == changed["__hash"]), "left")
    return rows.select(*[F.coalesce("__text", "text").alias("text") if c == "text" else F.col(c) for c in docs.columns])
