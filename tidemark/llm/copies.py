"""Near copies by five-word shingles, for the pipeline (operator 4's query has rules of its own).

Two texts are near copies where their sets of five-word shingles have a
similarity (common over all) of ``SHARE`` or more.  ``BANDS`` keys of ``ROWS``
MinHash values each bring texts together: a pair of similarity 0.8 shares no
key in 2 cases of 10,000, one of 0.85 in 2 of a million.  What keys bring
together is compared on the sets themselves, which are written once for the
texts that share a key.  A task compares a family, the texts that chains of
shared keys connect; a family of more than ``PART`` texts is compared key by
key instead, two parts of a key's texts at a time.  A task returns one row for
each text, the one it is linked to, never pairs.  It skips pairs that are
connected already, so a dense group costs few comparisons for each text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import simhash
from .common import cut, released, scratch_path, shuffle_width, sliced, text_of
from .components import connected_components

WORDS = 5
#: Rows of 24 bytes (two text hashes and a number) that a task may hold to pick documents; more meet the texts in a shuffle.
HELD = 1 << 20
#: Similarity of near copies, as a fraction.
SHARE = (4, 5)
BANDS, ROWS = 28, 6
#: Bands whose keys are compared first; the others then have few unconnected texts left.
FIRST_BANDS = 7
#: Texts, and shingles, that a task compares at once.
PART, PART_SHINGLES = 2048, 1 << 22
_RNG = np.random.default_rng(7)
_FACTORS, _ADDED = (_RNG.integers(0, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32) for _ in range(2))
_FACTORS |= np.uint32(1)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
_SEED = 23


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: bytes, n: int = WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of all ``n``-word shingles, increasing; a shorter text is one shingle, no words give none."""
    from xxhash import xxh64_intdigest

    words = text.split()  # bytes: only ASCII white space splits
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    if not len(h):
        return h
    size = min(n, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = out * _STEP + h[k : k + len(out)]
    return np.unique(_mixed(out))


def keys(hashes: np.ndarray) -> np.ndarray:
    """The keys of a document by which near copies meet."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(BANDS * ROWS, ~np.uint32(0))
    for k in range(0, len(short), 1024):
        low = np.minimum(low, (_FACTORS[:, None] * short[None, k : k + 1024] + _ADDED[:, None]).min(axis=1))
    out = np.arange(BANDS, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T:
        out = _mixed(out * _STEP + row)
    return out


def connected(sets: np.ndarray, ends: np.ndarray, root: np.ndarray, part: np.ndarray | None = None) -> np.ndarray:
    """Class of each set: sets of equal ``root`` are one class, and near copies join theirs.

    ``sets`` holds the sets one after the other, up to ``ends``.  With
    ``part``, only sets of different parts are compared.  A set that is
    compared meets all sets of other classes at once.  Of two classes that
    stay apart all sets of at least one have been compared, so no link is
    missed; the sets of the last open class need no comparison.
    """
    n = len(ends)
    starts = np.concatenate([[0], ends[:-1]])
    size = ends - starts
    kinds, ids = np.unique(sets, return_inverse=True)
    _, label = np.unique(root, return_inverse=True)
    flag, open_ = np.zeros(len(kinds), np.int32), np.ones(n, bool)
    while True:
        left = np.bincount(label[open_], minlength=n)
        classes = np.flatnonzero(left)
        if len(classes) < 2:
            return label
        x = np.flatnonzero(open_ & (label == classes[left[classes].argmin()]))[0]
        open_[x] = False
        other = label != label[x]
        if part is not None:
            other &= part != part[x]
        other &= (size * SHARE[1] >= size[x] * SHARE[0]) & (size[x] * SHARE[1] >= size * SHARE[0])
        if not other.any():
            continue
        own = ids[starts[x] : ends[x]]
        flag[own] = 1
        both = np.add.reduceat(flag[ids], starts)
        flag[own] = 0
        near = other & (both * SHARE[1] >= (size + size[x] - both) * SHARE[0])
        if near.any():
            label[np.isin(label, label[near])] = label[x]


def _light(hashes: DataFrame) -> DataFrame:
    """``hashes``, sent to the tasks where they are few, so that the texts they pick are not shuffled."""
    return F.broadcast(hashes) if hashes.count() <= HELD else hashes


def _named(docs: DataFrame) -> DataFrame:
    """text and its 128-bit identity h1, h2 of ``docs``."""
    return docs.select(*identity(), text_of().alias("text"))


def identity():
    return F.xxhash64(text_of()).alias("h1"), F.xxhash64(F.lit(_SEED), text_of()).alias("h2")


def _members(docs: DataFrame) -> DataFrame:
    """band, key, h1, h2: the keys of every text that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", 4 << 20):
            texts = part.column(2).cast(pa.binary())
            found = [(i, keys(h)) for i, t in enumerate(texts) if len(h := shingles(t.as_py()))]
            if found:
                at = pa.array(np.repeat([i for i, _ in found], BANDS))
                band = pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(found)))
                key = pa.array(np.concatenate([k for _, k in found]).view(np.int64))
                yield pa.RecordBatch.from_arrays([band, key, part.column(0).take(at), part.column(1).take(at)], names=["band", "key", "h1", "h2"])

    return _named(docs).mapInArrow(released(run), "band int, key bigint, h1 bigint, h2 bigint")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """entry, hashes, size: the shingles of the texts of ``nodes`` (entry, h1, h2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", 4 << 20):
            found = [shingles(t.as_py()).view(np.int64) for t in part.column(1).cast(pa.binary())]
            flat = pa.LargeListArray.from_arrays(np.cumsum([0, *map(len, found)]), np.concatenate(found)).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), flat], names=["entry", "hashes"])

    rows = _named(docs).join(_light(nodes), ["h1", "h2"]).select("entry", "text").mapInArrow(released(run), "entry bigint, hashes array<bigint>")
    return rows.groupBy("entry").agg(F.first("hashes").alias("hashes")).withColumn("size", F.size("hashes"))


def _compare(key: tuple, group: pa.Table) -> pa.Table:
    """For ``applyInArrow``: one part of a key's texts, or two, as a, b: each text with the text that stands for its class."""
    group = group.combine_chunks()
    entry, root, part = (group.column(c).to_numpy() for c in ("entry", "root", "part"))
    lists = group.column("hashes").combine_chunks()
    label = connected(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy()), root, part if key[1] != key[2] else None)
    _, first, place = np.unique(label, return_index=True, return_inverse=True)
    stands = entry[first][place]
    moved = stands != entry
    return pa.table({"a": pa.array(entry[moved]), "b": pa.array(stands[moved])})


def _stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table and read again.

    A checkpoint keeps what the optimizer has inferred about its columns, and
    rounds of joins on joins would multiply that; a table does not.
    """
    path = scratch_path(df.sparkSession, "near-copies")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _compared(placed: DataFrame, sets: DataFrame, across: bool, width: int) -> DataFrame:
    """a, b: links among the texts of each key of ``placed`` (key, entry, root, parts, part): inside each part, or ``across`` two parts."""
    if across:
        rows = placed.filter("parts > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter("other != part")
    else:
        rows = placed.withColumn("other", F.col("part"))
    rows = rows.select("key", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"), "part", "entry", "root")
    rows = rows.join(sets.select("entry", "hashes"), "entry").repartition(width, "key", "first", "second")
    return _stored(rows.groupBy("key", "first", "second").applyInArrow(_compare, "a bigint, b bigint"))


def _open(placed: DataFrame, roots: DataFrame | None, sizes: DataFrame, part: int) -> DataFrame:
    """key, entry, root, parts, part of the keys of ``placed`` (key, entry) whose texts are not all connected; of keys with the same texts one."""
    rows = placed.join(sizes, "entry")
    rows = rows.withColumn("root", F.col("entry")) if roots is None else rows.join(roots.withColumnRenamed("node", "entry"), "entry", "left")
    rows = _stored(rows.select("key", "entry", F.coalesce("root", "entry").alias("root"), "size"))
    mark = F.xxhash64("entry")
    groups = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 24)).alias("s"),
    )
    groups = groups.filter("low != high").groupBy("n", "x", "s").agg(F.min("key").alias("key"), F.first("total").alias("total"))
    parts = F.greatest(F.ceil(F.col("n") / part), F.ceil(F.col("total") / PART_SHINGLES)).cast("int")
    groups = _stored(groups.select("key", parts.alias("parts")))
    return _stored(rows.join(groups, "key").select("key", "entry", "root", "parts", F.pmod(F.xxhash64("entry", F.lit(5)), F.col("parts")).cast("int").alias("part")))


def links(docs: DataFrame, part: int = PART) -> DataFrame:
    """h1, h2, root: the texts that near copies of ``docs`` connect with others, equal root where connected."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    members = cut(_members(docs))
    name = F.struct("h1", "h2")
    ends = members.groupBy("key").agg(F.min(name).alias("low"), F.max(name).alias("high")).filter("low != high").select("key")
    shared = cut(members.join(cut(ends), "key").distinct())
    nodes = cut(shared.select("h1", "h2").distinct().withColumn("entry", F.monotonically_increasing_id()))
    sets = cut(_sets(docs, nodes))
    sizes = _stored(sets.select("entry", "size"))
    placed = _stored(shared.join(nodes, ["h1", "h2"]).select("band", "key", "entry"))
    # Texts that chains of shared keys connect are a family; a family of moderate size is compared as one, so its sets travel once.
    lows = _stored(placed.groupBy("key").agg(F.min("entry").alias("low")))
    chains = _stored(placed.join(lows, "key").filter("entry != low").select(F.col("entry").alias("a"), F.col("low").alias("b")).distinct())
    families = connected_components(chains).select(F.col("node").alias("entry"), F.col("root").alias("family"))
    families = _stored(families.join(sizes, "entry"))
    totals = families.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))
    small = (F.col("n") <= part) & (F.col("total") <= PART_SHINGLES)
    families = _stored(families.join(totals, "family").select("entry", "family", small.alias("small")))
    one, none = F.col("family").alias("key"), F.lit(0).alias("part")
    stars = _compared(families.filter("small").select(one, "entry", F.col("entry").alias("root"), F.lit(1).alias("parts"), none), sets, False, width)
    roots = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = roots.unionAll(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    large = families.filter("not small").select("entry")
    if not large.isEmpty():
        roots = roots.unionAll(_by_keys(_stored(placed.join(large, "entry")), sets, sizes, part, width))
    return nodes.join(roots, nodes["entry"] == roots["node"]).select("h1", "h2", "root")


def _by_keys(placed: DataFrame, sets: DataFrame, sizes: DataFrame, part: int, width: int) -> DataFrame:
    """node, root: classes of the texts of ``placed`` (band, key, entry), compared key by key."""
    edges, roots = [], None
    for bands in (f"band < {FIRST_BANDS}", f"band >= {FIRST_BANDS}"):
        batch = placed.filter(bands).select("key", "entry")
        rows = _open(batch, roots, sizes, part)
        edges.append(_compared(rows, sets, False, width))
        roots = _stored(connected_components(reduce(DataFrame.unionAll, edges)))
        if not rows.filter("parts > 1").isEmpty():
            rows = _open(rows.select("key", "entry"), roots, sizes, part)
            edges.append(_compared(rows, sets, True, width))
            roots = _stored(connected_components(reduce(DataFrame.unionAll, edges)))
    return roots


def deduplicate(docs: DataFrame, part: int = PART) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the smallest doc_id (null last), then text hash; all columns stay.

    Documents are connected where their SimHash fingerprints link (operator
    4's rule: three-word shingles, three bits) or their five-word similarity
    is 0.8 or more.  Null and empty texts have equal fingerprints and are one
    group; equal rows are one group; no rows give no rows.
    """
    rows = simhash.near_duplicates(docs)
    near = links(docs, part)
    # Classes of fingerprints that a group of near copies touches become one.
    named = cut(rows.join(near, (rows["text_hash"] == near["h1"]) & (rows["other_hash"] == near["h2"])).select("root", "component").distinct())
    lows = cut(named.groupBy("root").agg(F.min("component").alias("low")))
    tops = connected_components(_stored(named.join(lows, "root").select(F.col("component").alias("a"), F.col("low").alias("b"))))
    tops = tops.select(F.col("node").alias("__node"), F.col("root").alias("__top"))
    groups = rows.join(tops, rows["component"] == tops["__node"], "left").withColumn("group", F.coalesce("__top", "component"))
    # A minimum, combined before the shuffle, picks the row of each group; groups are never sorted.
    key = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", "other_hash")
    best = cut(groups.groupBy("group").agg(F.min(key).alias("best")).select("best.doc_id", "best.text_hash", "best.other_hash").distinct())
    best = best.toDF("__best", "__h1", "__h2")
    one, two = identity()
    own = docs.withColumn("__one", one).withColumn("__two", two)
    kept = own.join(best, own["doc_id"].eqNullSafe(best["__best"]) & (own["__one"] == best["__h1"]) & (own["__two"] == best["__h2"]), "left_semi")
    # Equal rows share id and hashes; one of them stays.
    if own.groupBy("doc_id", "__one", "__two").count().filter("count > 1").isEmpty():
        return kept.drop("__one", "__two")
    first = Window.partitionBy("doc_id", "__one", "__two").orderBy(F.lit(0))
    return kept.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n", "__one", "__two")
