"""Order-preserving packing by dynamic programming (operator 2).

The documents' ids form one stream in doc_id order.  A sequence is a window of
at most ``capacity`` ids; the windows follow one another and leave nothing
out.  Windows end at document ends (free), sentence ends or, where neither is
near, word ends, at growing truncation penalties.  The cheapest set of cuts

    best[j] = penalty[j] + min over i of best[i] + capacity - (pos[j] - pos[i])

takes ``best[i] + pos[i]`` from a sliding window, so a monotone queue finds
all minima in linear time.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ordered_layout, released, sliced, text_of
from .tokens import WordEncoder

CAPACITY = 4096
END_ID = 2
#: Truncation penalties, in padding ids that a cut there is worth.
SENTENCE_PENALTY, WORD_PENALTY = 12.0, 48.0
#: Word ends become cuts where sentences are longer than this many ids.
WORD_GRID = 48
#: Ids that one dynamic programme covers; its last window is left to the next one.
HORIZON = 1 << 21
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, padded_length bigint"


def best_cuts(positions: np.ndarray, penalties: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """Indices into ``positions`` (increasing, first 0, gaps <= capacity) where the cheapest windows end."""
    pos, pen = positions.tolist(), penalties.tolist()
    n = len(pos)
    back = [0] * n
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # (best + pos, pos, index): increasing cost
    for j in range(1, n):
        p = pos[j]
        while queue[0][1] < p - capacity:
            queue.popleft()
        cost, _, i = queue[0]
        back[j] = i
        value = pen[j] + cost + capacity  # best[j] + pos[j]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, p, j))
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def candidates(word_ends: np.ndarray, sentence: np.ndarray, doc_ends: np.ndarray, begin: int, end: int, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions from ``begin`` to ``end`` with their penalties; no gap exceeds ``capacity``."""
    penalty = np.where(sentence, SENTENCE_PENALTY, np.inf)
    # Word ends that are the last in their grid cell; they matter where no sentence ends nearby.
    cell = word_ends // WORD_GRID
    grid = np.append(cell[1:] != cell[:-1], True) if len(cell) else np.empty(0, bool)
    penalty = np.where(grid, np.minimum(penalty, WORD_PENALTY), penalty)
    keep = np.isfinite(penalty)
    pos = np.concatenate([[begin, end], word_ends[keep], doc_ends])
    pen = np.concatenate([[0.0, 0.0], penalty[keep], np.zeros(len(doc_ends))])
    inside = (pos >= begin) & (pos <= end)
    pos, pen = pos[inside], pen[inside]
    order = np.lexsort((pen, pos))
    pos, pen = pos[order], pen[order]
    first = np.append(True, pos[1:] != pos[:-1])
    pos, pen = pos[first], pen[first]
    wide = np.flatnonzero(np.diff(pos) > capacity)  # a single word longer than a window
    if len(wide):
        extra = np.concatenate([np.arange(pos[k] + capacity, pos[k + 1], capacity) for k in wide])
        pos, pen = np.concatenate([pos, extra]), np.concatenate([pen, np.full(len(extra), WORD_PENALTY)])
        order = np.argsort(pos, kind="stable")
        pos, pen = pos[order], pen[order]
    return pos, pen


def padded(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """A sequence is padded to ``capacity`` unless its length is a power of two."""
    return np.where((lengths & (lengths - 1)) == 0, lengths, capacity)


class Packer:
    """Packs one partition's stream with bounded memory."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, horizon: int = HORIZON):
        self.capacity, self.horizon, self.sequence = capacity, horizon, first_sequence
        self.begin = 0  # stream position of the first id not yet written
        self.ids = np.empty(0, np.uint32)
        self.doc_ids = pa.array([], pa.int64())
        self.doc_starts = np.empty(0, np.int64)
        self.doc_ends = np.empty(0, np.int64)
        self.word_ends = np.empty(0, np.int64)
        self.sentence = np.empty(0, bool)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray, word_ends: np.ndarray, sentence: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = self.begin + len(self.ids)
        ends = at + np.cumsum(sizes)
        self.ids = np.concatenate([self.ids, ids])
        self.doc_ids = pa.concat_arrays([self.doc_ids, doc_ids])
        self.doc_starts = np.concatenate([self.doc_starts, ends - sizes])
        self.doc_ends = np.concatenate([self.doc_ends, ends])
        self.word_ends = np.concatenate([self.word_ends, at + word_ends])
        self.sentence = np.concatenate([self.sentence, sentence])
        if len(self.ids) >= self.horizon:
            yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[pa.RecordBatch]:
        end = self.begin + len(self.ids)
        if end == self.begin:
            return
        pos, pen = candidates(self.word_ends, self.sentence, self.doc_ends, self.begin, end, self.capacity)
        cuts = pos[best_cuts(pos - self.begin, pen, self.capacity)]
        if not last:
            cuts = cuts[:-1]
        if not len(cuts):
            return
        stop = int(cuts[-1])
        # Pieces: the windows cut at document borders.
        inner = self.doc_starts[(self.doc_starts > self.begin) & (self.doc_starts < stop)]
        edges = np.unique(np.concatenate([[self.begin], cuts, inner]))
        starts, ends = edges[:-1], edges[1:]
        doc = np.searchsorted(self.doc_ends, starts, side="right")
        window_starts = np.concatenate([[self.begin], cuts[:-1]])
        window = np.searchsorted(cuts, starts, side="right")
        lengths = ends - starts
        whole = (cuts - window_starts)[window]
        for a in range(0, len(starts), 4096):
            s = slice(a, a + 4096)
            offsets = np.concatenate([[0], np.cumsum(lengths[s])])
            chunk = np.ascontiguousarray(self.ids[starts[s][0] - self.begin : ends[s][-1] - self.begin], "<u4")
            blob = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(chunk)])
            yield pa.RecordBatch.from_arrays(
                [
                    self.doc_ids.take(pa.array(doc[s])),
                    pa.array(starts[s] - self.doc_starts[doc[s]]),
                    pa.array(lengths[s]),
                    blob,
                    pa.array((self.doc_ends - self.doc_starts)[doc[s]]),
                    pa.array(self.sequence + window[s]),
                    pa.array(starts[s] - window_starts[window[s]]),
                    pa.array(padded(whole[s], self.capacity)),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length"],
            )
        self.sequence += len(cuts)
        self.ids = self.ids[stop - self.begin :].copy()
        open_docs = self.doc_ends > stop
        self.doc_ids = self.doc_ids.filter(pa.array(open_docs))
        self.doc_starts, self.doc_ends = self.doc_starts[open_docs], self.doc_ends[open_docs]
        later = self.word_ends > stop
        self.word_ends, self.sentence = self.word_ends[later], self.sentence[later]
        self.begin = stop


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, partitions: int | None = None, horizon: int = HORIZON) -> DataFrame:
    """Pieces (``PIECES``) of ``docs`` (doc_id, text) in sequences of at most ``capacity`` ids.

    Null texts are empty and give their end id alone; null ids come first;
    rows that repeat an id are packed one after the other; no rows give no
    pieces.  Other columns are ignored.  Sequence ids are unique and grow with
    the order; each of the range partitions ends its last sequence early.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(TaskContext.get().partitionId() << 33, capacity, horizon)
        coder = WordEncoder.get(vocabulary)
        for part in sliced(batches, "text", 4 << 20):
            yield from packer.add(part.column(0), *coder.encode(part.column(1), end_id))
        yield from packer.flush(last=True)
        coder.forget()

    rows = ordered_layout(docs.select("doc_id", text_of().alias("text")), F.col("doc_id").asc_nulls_first(), partitions=partitions)
    return rows.mapInArrow(released(run), PIECES)
