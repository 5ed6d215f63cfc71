"""SimHash near-duplicates by a Gray-order hierarchical index (operator 4).

Equal fingerprints are one entry.  Two entries within ``bits`` (3) differing
bits agree in at least one of ``bits + 1`` bands of the 64, so entries are
dealt by (band, value) and each group is searched on its own.  A group that
is still too large is dealt again by bands of its other bits, which keeps the
search exact.

Inside a task the entries of a group are sorted by Gray rank, which puts
words of few differences next to each other.  Runs of ``FAN`` become nodes
whose pattern is the bits that all members share; nodes become higher nodes
the same way, and a lower node only adds the bits its parent has not settled.
A pair of nodes is followed down with the differences counted so far; it is
dropped as soon as they exceed ``bits``, with all pairs below it, and linked
as a whole as soon as the open bits cannot exceed them any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut, released, shuffle_width, sliced, text_of
from .components import connected_components

BITS = 3
WORDS = 3
FAN = 8
#: Entries of one group that a task searches; larger groups are dealt again.
GROUP_LIMIT = 1 << 20
#: Node pairs that are unfolded at once.
STEP = 4_000


def fingerprint(text: bytes, n: int = WORDS) -> int:
    """64-bit SimHash: a bit is 1 if over half of the shingles' hashes have it; no words give 0."""
    import xxhash

    words = text.lower().split()  # bytes: only A-Z are folded, only ASCII white space splits
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= n:
        hashes = [digest(joined, 42)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - n + 1].tolist()
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[n - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    flat = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for k in range(0, len(flat), 1 << 16):
        counts += np.unpackbits(flat[k : k + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """doc_id, text_hash, other_hash (together the text's identity) and fingerprint (bigint) of every row of ``docs`` (doc_id, text); null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", 8 << 20):
            texts = part.column(3).cast(pa.binary())
            prints = np.fromiter((fingerprint(t.as_py(), n) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(prints)], names=["doc_id", "text_hash", "other_hash", "fingerprint"])

    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), F.xxhash64(F.lit(23), text_of()).alias("other_hash"), text_of().alias("text"))
    return rows.mapInArrow(released(run), "doc_id bigint, text_hash bigint, other_hash bigint, fingerprint bigint")


def gray_rank(words: np.ndarray) -> np.ndarray:
    """Place of each code word in the reflected Gray order."""
    out = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def _runs(groups: np.ndarray, fan: int) -> np.ndarray:
    """Where runs of at most ``fan`` members of one group begin; ``groups`` is sorted."""
    first = np.append(True, groups[1:] != groups[:-1])
    begin = np.flatnonzero(first)
    place = np.arange(len(groups)) - np.repeat(begin, np.diff(np.append(begin, len(groups))))
    return np.flatnonzero(place % fan == 0)


class Forest:
    """Union-find over entries, vectorised."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        up = self.parent[x]
        while True:
            higher = self.parent[up]
            if (higher == up).all():
                self.parent[x] = up
                return up
            up = higher

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            if not len(a):
                return
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))


def search(groups: np.ndarray, words: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, in each group, all words within ``bits`` differing bits of each other: (word, root word).

    ``groups`` need not be sorted; words are distinct inside a group.
    """
    order = np.lexsort((gray_rank(words), groups))
    groups, words = groups[order], words[order]
    full = ~np.uint64(0)
    # Levels, leaves first: pattern, shared bits, first entry, group, and first child of each node.
    levels = [(words, np.full(len(words), full), groups, None)]
    while True:
        pattern, shared, owner, _ = levels[-1]
        if (owner[1:] != owner[:-1]).all():
            break
        starts = _runs(owner, FAN)
        both, any_ = np.bitwise_and.reduceat(pattern & shared, starts), np.bitwise_or.reduceat(pattern & shared, starts)
        common = np.bitwise_and.reduceat(shared, starts) & ~(both ^ any_)
        levels.append((both & common, common, owner[starts], np.append(starts, len(pattern))))
    forest = Forest(len(words))
    # First and last entry below each node.
    spans = [(np.arange(len(words)), np.arange(1, len(words) + 1))]
    for _, _, _, child in levels[1:]:
        low, high = spans[-1]
        spans.append((low[child[:-1]], high[child[1:] - 1]))

    top = len(levels) - 1
    node = np.arange(len(levels[top][0]))
    node = node[spans[top][1] - spans[top][0] > 1]  # groups of one entry have no pairs
    zero = np.zeros(len(node), np.int64)
    work = [(top, node, node, zero, np.zeros(len(node), np.uint64))]
    while work:
        level, u, v, differ, settled = work.pop()
        if len(u) > STEP:
            work += [(level, u[k : k + STEP], v[k : k + STEP], differ[k : k + STEP], settled[k : k + STEP]) for k in range(0, len(u), STEP)]
            continue
        pattern, shared, _, child = levels[level]
        new = shared[u] & shared[v] & ~settled
        differ = differ + np.bitwise_count((pattern[u] ^ pattern[v]) & new)
        settled = settled | new
        near = differ <= bits
        u, v, differ, settled = u[near], v[near], differ[near], settled[near]
        low, high = spans[level]
        sure = differ + np.bitwise_count(~settled) <= bits
        if sure.any():
            a, b = u[sure], v[sure]
            forest.unite(low[a], low[b])
            same = a[a == b]
            sizes = high[same] - low[same]
            inner = np.repeat(low[same], sizes - 1) + _counting(sizes - 1)
            forest.unite(inner, inner + 1)
            u, v, differ, settled = u[~sure], v[~sure], differ[~sure], settled[~sure]
        if level == 0 or not len(u):
            continue
        n_u, n_v = child[u + 1] - child[u], child[v + 1] - child[v]
        pair = np.repeat(np.arange(len(u)), n_u * n_v)
        at = _counting(n_u * n_v)
        a, b = child[u][pair] + at // n_v[pair], child[v][pair] + at % n_v[pair]
        keep = (u[pair] != v[pair]) | (a <= b)
        if level == 1:
            keep &= a != b
        pair, a, b = pair[keep], a[keep], b[keep]
        work.append((level - 1, a, b, differ[pair], settled[pair]))
    root = forest.roots(np.arange(len(words)))
    moved = root != np.arange(len(words))
    return words[moved], words[root[moved]]


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n in ``sizes``, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def band_masks(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` cut into ``parts`` masks of about equal size."""
    places = [k for k in range(64) if free >> k & 1]
    return [sum(1 << k for k in places[len(places) * i // parts : len(places) * (i + 1) // parts]) for i in range(parts)]


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def _split(mask: Column, masks: list[int], parts: int) -> Column:
    """The masks that follow ``mask``: with the bits of one band of its free bits added."""
    out = None
    for m in masks:
        free = ~m & ((1 << 64) - 1)
        more = F.array(*[F.lit(_signed(m | band)).cast("bigint") for band in band_masks(free, parts)])
        out = F.when(mask == F.lit(_signed(m)).cast("bigint"), more) if out is None else out.when(mask == F.lit(_signed(m)).cast("bigint"), more)
    return out


def dealt(entries: DataFrame, bits: int = BITS, limit: int = GROUP_LIMIT, rounds: int = 3) -> DataFrame:
    """mask, word, so that any two words within ``bits`` bits meet in a group of equal mask and equal ``word & mask``.

    Groups above ``limit`` are dealt again by their free bits, ``rounds`` times at most.
    """
    parts, masks = bits + 1, [0]
    rows = entries.select(F.lit(0).cast("bigint").alias("mask"), "word")
    done = None
    for k in range(rounds + 1):
        rows = rows.select(F.explode(_split(F.col("mask"), masks, parts)).alias("mask"), "word")
        masks = [m | band for m in masks for band in band_masks(~m & ((1 << 64) - 1), parts)]
        if k == rounds:
            break
        rows = rows.withColumn("value", F.col("word").bitwiseAND(F.col("mask")))
        # At most (rows / limit) groups are that large.
        large = cut(rows.groupBy("mask", "value").count().filter(F.col("count") > limit).select("mask", "value", F.lit(True).alias("large")))
        if large.isEmpty():
            break
        rows = rows.join(F.broadcast(large), ["mask", "value"], "left")
        small = rows.filter("large is null").select("mask", "word")
        done = small if done is None else done.unionAll(small)
        rows = rows.filter("large").select("mask", "word")
    rows = rows.select("mask", "word")
    return rows if done is None else done.unionAll(rows)


def links(entries: DataFrame, bits: int = BITS, limit: int = GROUP_LIMIT) -> DataFrame:
    """a, b: edges that connect all distinct words of ``entries`` (word) within ``bits`` bits of each other, few per word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(mask: np.ndarray, value: np.ndarray, word: np.ndarray) -> pa.RecordBatch:
            group = np.cumsum(np.append(False, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])))
            a, b = search(group, word.view(np.uint64), bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            held.append([batch.column(i).to_numpy() for i in range(3)])
            size += batch.num_rows
            if size < 1 << 18:
                continue
            mask, value, word = (np.concatenate(c) for c in zip(*held))
            cutoff = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
            if not len(cutoff):
                held, size = [[mask, value, word]], len(mask)
                continue
            end = cutoff[-1] + 1  # the last group may go on in the next batch
            yield found(mask[:end], value[:end], word[:end])
            held, size = [[mask[end:], value[end:], word[end:]]], len(mask) - end
        if size:
            yield found(*(np.concatenate(c) for c in zip(*held)))

    rows = dealt(entries, bits, limit).select("mask", F.col("word").bitwiseAND(F.col("mask")).alias("value"), "word")
    rows = rows.repartition(shuffle_width(entries.sparkSession), "mask", "value").sortWithinPartitions("mask", "value")
    return rows.mapInArrow(released(run), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, bits: int = BITS, n: int = WORDS, limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, text_hash, other_hash, fingerprint, component (a fingerprint, bigint like it) and component_id of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links of at most ``bits``
    differing bits reach, the row's own included; null where all reached ids
    are null.  Null and empty texts have fingerprint 0 and link like any
    other; equal rows share everything; no rows give no rows.  Other columns
    are ignored.
    """
    rows = cut(fingerprints(docs, n))
    entries = cut(rows.groupBy(F.col("fingerprint").alias("word")).agg(F.min("doc_id").alias("low")))
    roots = connected_components(links(entries, bits, limit))
    linked = entries.join(roots, entries.word == roots.node).select("word", "low", "root")
    linked = cut(linked)
    lows = cut(linked.groupBy("root").agg(F.min("low").alias("component_low")))
    inner = linked.join(lows, "root").select(F.col("word").alias("linked"), "root", "component_low")
    alone = F.col("linked").isNull()
    classes = entries.join(inner, entries.word == inner.linked, "left").select(
        "word", F.coalesce("root", "word").alias("component"), F.when(alone, F.col("low")).otherwise(F.col("component_low")).alias("component_id")
    )
    # Written, like the tables above, so that both sides of a join are plain shuffles and a key of many rows can be split.
    classes = cut(classes)
    return rows.join(classes, rows.fingerprint == classes.word).drop("word")


def as_hex(word: Column) -> Column:
    return F.lower(F.lpad(F.hex(word), 16, "0"))


def deduplicate(docs: DataFrame, bits: int = BITS, n: int = WORDS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the smallest doc_id (null last), then text hash; all columns stay."""
    found = near_duplicates(docs, bits, n)
    # A minimum, combined before the shuffle, picks the row of each class; classes are never sorted.
    key = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    best = found.groupBy("component").agg(F.min(key).alias("best")).select("best.doc_id", "best.text_hash").distinct()
    own = docs.withColumn("__hash", F.xxhash64(text_of()))
    best = best.select(F.col("doc_id").alias("__best"), F.col("text_hash").alias("__best_hash"))
    kept = own.join(best, own["doc_id"].eqNullSafe(best["__best"]) & (own["__hash"] == best["__best_hash"]), "left_semi")
    # Equal rows share id and hash; one of them stays.
    again = kept.groupBy("doc_id", "__hash").count().filter("count > 1").limit(1)
    if again.isEmpty():
        return kept.drop("__hash")
    first = Window.partitionBy("doc_id", "__hash").orderBy(F.lit(0))
    return kept.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n", "__hash")
