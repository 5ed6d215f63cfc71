"""Near-duplicate embeddings by collision-counting projections (operator 11).

Vectors are sorted along ``PROJECTIONS`` orthogonal lines.  On each line a
query collides with what lies within a window centred at it.  Two vectors of
the wanted cosine are at most ``sqrt(2 - 2 * cosine)`` apart, and along a line
the difference is about normal, so the number of collisions of such a pair has
a known distribution; the count that a pair must pass is its quantile of
``MISSED``.  Pairs that pass are verified by their cosine in double precision.

Only pairs that can meet in a block are counted.  A group (equal label and
length) of more than ``WHOLE * BLOCK`` vectors is dealt into blocks by the sides of
further random lines through a block's mean, again and again until blocks are
small, in as many independent tables as the same ``MISSED`` asks for; a pair
that meets in several tables counts in the first.  A large block whose vectors
are too close together to be halved without tearing pairs apart stays whole
and is compared part by part, all parts with all, each two parts in a task of
their own.  A task returns one row for each vector: its number of links and a
root that it is linked to, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, released, shuffle_width
from .components import connected_components
from .simhash import Forest

COSINE = 0.98
PROJECTIONS = 32
#: Half of a window, in standard deviations of a wanted pair's difference along a line.
WINDOW = 2.0
#: Share of pairs at the threshold that the count may miss, and that the tables may.
MISSED = 1e-5
#: Vectors of a block that one task compares.
BLOCK = 2048
#: Groups of at most so many blocks are compared whole, part by part: dealing them into several tables would cost more.
WHOLE = 8
#: Mean squared distance from a block's mean (unit vectors: 1 at most) below which a block is not halved.
SPREAD = 0.3
SEED = 11


def tail_below(m: int, p: float, limit: float) -> int:
    """The largest count that at least ``1 - limit`` of Binomial(m, p) reach."""
    below = 0.0
    for count in range(m + 1):
        below += math.comb(m, count) * p**count * (1 - p) ** (m - count)
        if below > limit:
            return count
    return m


def lines(dim: int, m: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """``m`` unit directions as columns, orthogonal as far as ``dim`` allows."""
    rng = np.random.default_rng([seed, dim])
    found: list[np.ndarray] = []
    while sum(q.shape[1] for q in found) < m:
        found.append(np.linalg.qr(rng.normal(size=(dim, dim)))[0])
    return np.concatenate(found, axis=1)[:, :m]


def calibrated(dim: int, cosine: float = COSINE, m: int = PROJECTIONS, window: float = WINDOW, missed: float = MISSED) -> tuple[float, int]:
    """Half width of a window and the collisions that a pair must have.

    Fewer than 8 entries make differences far from normal: there the window is
    the distance itself, which no pair within it can leave.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * cosine)) * (1 + 1e-6) + 1e-6  # what rounding of the projections can add
    if dim < 8:
        return reach, m
    return reach * window / math.sqrt(dim), tail_below(m, math.erf(window / math.sqrt(2)), missed)


def tables_for(n: int, block: int, cosine: float = COSINE, missed: float = MISSED) -> int:
    """Independent tables that leave a pair at the threshold apart in all of them with a chance of ``missed`` at most."""
    if n <= block:
        return 1
    halvings = math.ceil(math.log2(n / block)) + 1
    together = (1 - math.acos(min(1.0, cosine)) / math.pi / math.sqrt(SPREAD)) ** halvings
    return max(1, math.ceil(math.log(missed) / math.log(1 - together)))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision, scaled first so that no square overflows or vanishes."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _bits(rows: np.ndarray, table: int, depth: int, count: int) -> np.ndarray:
    """On which side of ``count`` lines, those of ``table`` after ``depth`` others, each of ``rows`` lies."""
    out = np.zeros(len(rows), np.int64)
    for k in range(count):
        out = out * 2 + (rows @ np.random.default_rng([SEED, table, depth + k, rows.shape[1]]).normal(size=rows.shape[1]) > 0)
    return out


def linked(
    left: np.ndarray, right: np.ndarray | None, earlier_left: np.ndarray, earlier_right: np.ndarray, cosine: float = COSINE, step: int = 512, missed: float = MISSED
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into ``left`` and ``right``) of unit rows of cosine ``cosine`` or more that no earlier table has; ``right`` None: pairs inside ``left``, each once.

    ``earlier_*`` holds the blocks of each row in the tables before this one.
    The right rows are sorted along each line, so a query's window is a run of
    that order; its members each count one collision with the query.
    """
    inner = right is None
    if inner:
        right, earlier_right = left, earlier_left
    half, need = calibrated(left.shape[1], cosine, missed=missed)
    directions = lines(left.shape[1])
    a, b = left @ directions, right @ directions
    orders = [np.argsort(b[:, line], kind="stable") for line in range(PROJECTIONS)]
    lows = [np.searchsorted(b[order, line], a[:, line] - half) for line, order in enumerate(orders)]
    highs = [np.searchsorted(b[order, line], a[:, line] + half, side="right") for line, order in enumerate(orders)]
    for k in range(0, len(left), step):
        counts = np.zeros((min(step, len(left) - k), len(right)), np.uint8)
        for order, low, high in zip(orders, lows, highs):
            for row, x, y in zip(counts, low[k : k + step].tolist(), high[k : k + step].tolist()):
                row[order[x:y]] += 1
        i, j = np.nonzero(counts >= need)
        i = i + k
        if inner:
            once = i < j
            i, j = i[once], j[once]
        for s in range(0, len(i), 1 << 16):
            p, q = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
            near = np.einsum("ij,ij->i", left[p], right[q]) >= cosine
            if earlier_left.shape[1]:
                near &= ~(earlier_left[p] == earlier_right[q]).any(axis=1)
            yield p[near], q[near]


def _compare(cosine: float, missed: float):
    """For ``applyInArrow``: one part of a block, or two, as entry, root, links."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        table, first, second = key[0].as_py(), key[2].as_py(), key[3].as_py()
        group = group.combine_chunks()
        entry, weight, part = (group.column(c).to_numpy() for c in ("entry", "weight", "part"))
        rows = unit(matrix(group.column("v").combine_chunks()))
        blocks = matrix(group.column("blocks").combine_chunks())[:, :table]
        forest, links = Forest(len(entry)), np.zeros(len(entry), np.int64)
        if first == second:
            pairs = linked(rows, None, blocks, blocks, cosine, missed=missed)
            own = other = np.arange(len(entry))
        else:
            own, other = np.flatnonzero(part == first), np.flatnonzero(part == second)
            pairs = linked(rows[own], rows[other], blocks[own], blocks[other], cosine, missed=missed) if len(own) and len(other) else iter(())
        for p, q in pairs:
            p, q = own[p], other[q]
            np.add.at(links, p, weight[q])
            np.add.at(links, q, weight[p])
            forest.unite(p, q)
        roots = entry[forest.roots(np.arange(len(entry)))]
        return pa.table({"entry": pa.array(entry), "root": pa.array(roots), "links": pa.array(links)})

    return run


def _means(rows: DataFrame) -> DataFrame:
    """block, mean, spread of the vectors of ``rows`` (block, v); partial sums are made in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column(0).to_numpy()
            dims = batch.column(1).value_lengths().to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                keys, place = np.unique(block[at], return_inverse=True)
                sums = np.zeros((len(keys), dim))
                np.add.at(sums, place, unit(matrix(batch.column(1).take(pa.array(at)))))
                names = {"block": np.repeat(keys, dim), "at": np.tile(np.arange(dim, dtype=np.int32), len(keys)), "sum": sums.ravel()}
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in names.values()], list(names))

    sums = rows.select("block", "v").mapInArrow(released(run), "block bigint, at int, sum double").groupBy("block", "at").agg(F.sum("sum").alias("sum"))
    sizes = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    whole = sums.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "sum"))).alias("s")).join(sizes, "block")
    mean = F.transform("s", lambda x: x["sum"] / F.col("n"))
    whole = whole.select("block", "n", mean.alias("mean"))
    return whole.withColumn("spread", 1 - F.aggregate("mean", F.lit(0.0), lambda t, x: t + x * x))


def _halved(rows: DataFrame) -> DataFrame:
    """table, entry, block, depth of ``rows`` (table, entry, block, depth, bits, v, mean) with the block split by ``bits`` more lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table, depth, bits = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("table", "depth", "bits"))
            v, mean = batch.column(batch.schema.get_field_index("v")), batch.column(batch.schema.get_field_index("mean"))
            dims = v.value_lengths().to_numpy()
            side = np.zeros(batch.num_rows, np.int64)
            for t, d, b, dim in np.unique(np.column_stack([table, depth, bits, dims]), axis=0).tolist():
                at = np.flatnonzero((table == t) & (depth == d) & (bits == b) & (dims == dim))
                take = pa.array(at)
                side[at] = _bits(unit(matrix(v.take(take))) - matrix(mean.take(take)), t, d, b)
            names = ["table", "entry", "block", "depth"]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names[:3]] + [pa.array((depth + bits).astype(np.int32)), pa.array(side)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "side"])

    out = rows.mapInArrow(released(run), "table int, entry bigint, block bigint, depth int, side bigint")
    return out.select("table", "entry", F.xxhash64("block", "depth", "side").alias("block"), "depth")


def dealt(entries: DataFrame, block: int = BLOCK, cosine: float = COSINE, missed: float = MISSED, whole: int = WHOLE) -> DataFrame:
    """table, entry, block: ``entries`` (entry, label, v) in each table of their group, blocks of at most ``block`` where they can be split.

    Groups of at most ``whole * block`` are one table and one block.
    """
    group = F.xxhash64("label", F.size("v"))
    groups = cut(entries.withColumn("group", group).groupBy("group").agg(F.count(F.lit(1)).alias("n")))
    most = groups.agg(F.max("n").alias("n")).first()["n"] or 0
    steps = [block << k for k in range(max(0, math.ceil(math.log2(max(1, most) / block))) + 1)]
    tables = F.lit(1)
    for size in steps[1:]:
        tables = F.when(F.col("n") > max(size // 2, whole * block), tables_for(size, block, cosine, missed)).otherwise(tables)
    own = entries.select("entry", group.alias("group")).join(groups.select("group", "n", tables.alias("tables")), "group")
    rows = own.select(F.explode(F.sequence(F.lit(0), F.col("tables") - 1)).alias("table"), "entry", "group", "n")
    rows = cut(rows.select("table", "entry", F.xxhash64("group", "table").alias("block"), F.lit(0).alias("depth"), (F.col("n") <= whole * block).alias("small")))
    done, vectors = [rows.filter("small").select("table", "entry", "block")], entries.select("entry", "v")
    rows = rows.filter("not small").drop("small")
    while True:
        sizes = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block).select("block")
        sizes = cut(sizes)
        if sizes.isEmpty():
            return _all([*done, rows.select("table", "entry", "block")])
        large = cut(rows.join(sizes, "block").join(vectors, "entry"))
        means = cut(_means(large))
        bits = F.greatest(F.lit(1), F.least(F.lit(8), F.ceil(F.log2(F.col("n") / block)))).cast("int")
        split = means.filter(F.col("spread") >= SPREAD).select("block", "mean", bits.alias("bits"))
        done += [rows.join(sizes, "block", "left_anti").select("table", "entry", "block"), large.join(split, "block", "left_anti").select("table", "entry", "block")]
        rows = cut(_halved(large.join(split, "block").select("table", "entry", "block", "depth", "bits", "v", "mean")))


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return cut(out)


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """id, label, v, k1, k2 (a 128-bit identity of label and vector, null where the vector links with nothing) of every row."""
    v = F.col(vector_column)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    fine = F.coalesce(F.col(label_column).isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda c: c != 0), F.lit(False))
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.when(fine, v).alias("v"))
    key = lambda seed: F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(seed), "label", F.size("v"), "v"))
    return rows.select("id", "label", "v", key(1).alias("k1"), key(2).alias("k2"))


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    block: int = BLOCK,
    missed: float = MISSED,
    whole: int = WHOLE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``.

    Rows link where labels are equal and not null, vectors have the same
    length and their cosine is ``cosine`` or more.  Vectors that are null,
    empty or zero or hold null or non-finite entries, and rows of null label,
    link with nothing.  Rows of equal label and vector are one entry of that
    weight and link with each other; so do rows that repeat an id.
    component_id is the smallest id reached (a null id only where all are
    null), ``kept`` is true where it is the row's own, false for a null id.
    No rows give no rows.  Other columns are ignored.
    """
    rows = usable(vectors, id_column, vector_column, label_column)
    entries = rows.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.min("id").alias("low"), F.count(F.lit(1)).alias("weight")
    )
    entries = cut(entries.withColumn("entry", F.monotonically_increasing_id()))
    places = dealt(entries, block, cosine, missed, whole)
    # The blocks of an entry in all tables (a fixed few), by which a pair is counted in its first common one.
    blocks = cut(places.groupBy("entry").agg(F.sort_array(F.collect_list(F.struct("table", "block")))["block"].alias("blocks")))
    sizes = cut(places.groupBy("table", "block").agg(F.count(F.lit(1)).alias("n")))
    # Blocks that stay large are compared part by part: an entry goes to all pairs of parts that hold its own.
    parts = F.ceil(F.col("n") / (2 * block)).cast("int")
    placed = places.join(sizes, ["table", "block"]).withColumn("part", F.pmod(F.xxhash64("entry"), parts).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    placed = placed.select("table", "block", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"), "part", "entry")
    whole = placed.join(entries.select("entry", "v", "weight"), "entry").join(blocks, "entry")
    whole = whole.repartition(shuffle_width(vectors.sparkSession), "table", "block", "first", "second")
    found = whole.groupBy("table", "block", "first", "second").applyInArrow(_compare(cosine, missed), "entry bigint, root bigint, links bigint")
    found = cut(found)
    roots = connected_components(found.filter("entry != root").select(F.col("entry").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("entry").agg(F.sum("links").alias("links"))
    placed = cut(entries.select("entry", "k1", "k2", "low", "weight").join(links, "entry").join(roots.withColumnRenamed("node", "entry"), "entry", "left"))
    lows = cut(placed.filter("root is not null").groupBy("root").agg(F.min("low").alias("component_low")))
    classes = placed.join(lows, "root", "left").select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), (F.col("links") + F.col("weight") - 1).alias("__links"), F.coalesce("component_low", "low").alias("__low")
    )
    classes = cut(classes)
    own = cut(rows.select("id", "k1", "k2"))
    joined = own.join(classes, (own["k1"] == classes["__k1"]) & (own["k2"] == classes["__k2"]), "left")
    component = F.when(F.col("k1").isNull(), F.col("id")).otherwise(F.col("__low"))
    return joined.select(
        F.col("id").alias(id_column), F.coalesce("__links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


ORACLE_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: c::DOUBLE) AS v FROM embeddings),
fine AS (
  SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS size FROM e
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(v, lambda c: c <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.98),
reached AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reached r JOIN pairs p ON r.b = p.a),
lows AS (SELECT a, min(b) AS low FROM reached GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.low, e.vec_id)) AS component_id, e.vec_id <= coalesce(l.low, e.vec_id) AS kept
FROM e LEFT JOIN degrees d ON e.vec_id = d.a LEFT JOIN lows l ON e.vec_id = l.a
"""
