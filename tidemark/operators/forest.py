"""Deep random forests: large nodes are split by counts that Spark adds up over all rows, small ones are finished where their rows meet.

Each row decides by its own hash how often it is in a tree's bootstrap.  A
node of more than ``whole`` drawn rows is split by the sums of all tasks; once
a node is smaller, its drawn rows and the rows to score below it go to one
task, which grows the rest of that tree and keeps only the scores.  The trees
themselves, whose nodes grow with the rows, are never gathered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut, shuffle_width

#: Nodes of at most so many drawn rows are finished in one task; thresholds a feature has at most, and one.
WHOLE, BINS = 200_000, 32
#: Chances that a row is drawn at most 0, 1, 2, ... times: the Poisson law of a bootstrap of as many rows as there are.
_DRAWN = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
_PACKED = "i long, h long, codes binary, y byte"
_DEALT = "tree int, node int, salt long, codes binary, y binary, drawn binary, held binary, ids binary"
_COUNTED = "tree int, node int, feature int, bin int, n0 long, n1 long"


def thresholds(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Rising thresholds of each feature: its values where they are few, else quantiles."""
    values = [F.col(f).cast("double") for f in features]
    kinds = df.agg(*[F.approx_count_distinct(v).alias(f"k{k}") for k, v in enumerate(values)]).first()
    steps = [i / bins for i in range(1, bins)]
    found = df.agg(*[(F.collect_set(v) if kinds[k] < bins else F.percentile_approx(v, steps, 10_000)).alias(f"t{k}") for k, v in enumerate(values)]).first()
    return [np.unique(np.array(t or [], dtype=float)) for t in found]


def _codes(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def drawn(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row (by its hash) is in the bootstrap of ``tree``."""
    z = h.view(np.uint64) ^ np.random.default_rng([seed, tree]).integers(0, 2**63, dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(_DRAWN, ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53, side="right")


def candidates(seed: int, tree: int, node: int, nodes: int, features: int) -> np.ndarray:
    """Nodes x features that may split them: the root of their number, drawn for each node."""
    take = math.ceil(math.sqrt(features))
    return np.random.default_rng([seed, tree, node]).random((nodes, features)).argsort(axis=1)[:, :take]


class Top:
    """The upper nodes of one tree: feature (-1: none yet), last bin that goes left, children, rows drawn per class."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.depth, self.drawn, self.open = [-1], [0], [0], [0], [0], [None], [True]

    def split(self, node: int, feature: int, last: int, sides: list[tuple[int, int]]) -> None:
        self.feature[node], self.bin[node], self.left[node], self.right[node] = feature, last, len(self.feature), len(self.feature) + 1
        for side in sides:
            for part, value in zip((self.feature, self.bin, self.left, self.right, self.depth, self.drawn, self.open), (-1, 0, 0, 0, self.depth[node] + 1, side, True)):
                part.append(value)

    def place(self, codes: np.ndarray) -> np.ndarray:
        feature, last, left, right = (np.array(p) for p in (self.feature, self.bin, self.left, self.right))
        at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while len(rows := rows[feature[at[rows]] >= 0]):
            node = at[rows]
            at[rows] = np.where(codes[rows, feature[node]] <= last[node], left[node], right[node])
        return at


def finish(codes: np.ndarray, y: np.ndarray, times: np.ndarray, held: np.ndarray, weights: tuple[float, float], levels: int, least: int, rng_key: tuple[int, int, int]) -> np.ndarray:
    """Scores of ``held`` by the subtree grown on the drawn rows: at most ``levels`` deep, ``least`` drawn rows in a leaf, all nodes of a level at once."""
    out, below = np.zeros(len(held)), np.arange(len(held))
    node, at, nodes, features = np.zeros(len(codes), np.int64), np.zeros(len(held), np.int64), 1, codes.shape[1]
    width = int(codes.max(initial=0)) + 1
    for level in range(levels + 1):
        ones = np.bincount(node, times * y, nodes)
        zeros = np.bincount(node, times, nodes) - ones
        a, b = weights[0] * zeros, weights[1] * ones
        value = b / np.maximum(a + b, 1e-300)
        best, feature, last = np.zeros(nodes), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        if level < levels:
            able = (zeros > 0) & (ones > 0) & (zeros + ones >= 2 * least)
            offered = candidates(rng_key[0], rng_key[1], rng_key[2] * 64 + level, nodes, features)
            rows = np.flatnonzero(able[node])
            mine, n, class1 = node[rows], times[rows], y[rows] == 1
            for j in range(offered.shape[1]):
                key = mine * width + codes[rows, offered[mine, j]]
                l0 = np.bincount(key, n * ~class1, nodes * width).reshape(nodes, width).cumsum(axis=1)
                l1 = np.bincount(key, n * class1, nodes * width).reshape(nodes, width).cumsum(axis=1)
                r0, r1 = zeros[:, None] - l0, ones[:, None] - l1
                la, lb, ra, rb = weights[0] * l0, weights[1] * l1, weights[0] * r0, weights[1] * r1
                # What the Gini impurity, times the weight, falls by.
                fall = 2 * (a * b / np.maximum(a + b, 1e-300))[:, None] - 2 * la * lb / np.maximum(la + lb, 1e-300) - 2 * ra * rb / np.maximum(ra + rb, 1e-300)
                fall = np.where((l0 + l1 >= least) & (r0 + r1 >= least), fall, 0)
                place = fall.argmax(axis=1)
                most = fall[np.arange(nodes), place]
                better = able & (most > best + 1e-9)
                best[better], feature[better], last[better] = most[better], offered[better, j], place[better]
        splits = best > 0
        ends = ~splits[at]
        out[below[ends]] = value[at[ends]]
        below, at = below[~ends], at[~ends]
        if not len(below):
            break
        first = np.cumsum(splits) * 2 - 2
        at = first[at] + (held[below, feature[at]] > last[at])
        kept = splits[node]
        codes, y, times, node = codes[kept], y[kept], times[kept], node[kept]
        node = first[node] + (codes[np.arange(len(node)), feature[node]] > last[node])
        nodes = 2 * int(splits.sum())
    return out


def _grow_tops(packed: DataFrame, features: int, width: int, trees: int, weights: tuple[float, float], levels: int, least: int, seed: int, whole: int, counts: tuple[int, int]) -> list[Top]:
    """Split every node of more than ``whole`` drawn rows; a pass over the rows counts a level of all trees, one row a node comes back."""
    tops = [Top() for _ in range(trees)]
    if sum(counts) * 1.05 <= whole:
        return tops
    spark = packed.sparkSession
    wide = [(t, 0) for t in range(trees)]
    while wide:
        shared = spark.sparkContext.broadcast((tops, sorted(wide)))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tops, wide = shared.value
            offered = np.array([candidates(seed, t, k, 1, features)[0] for t, k in wide])
            sums = np.zeros((2, *offered.shape, width), np.int64)
            slots = {t: np.full(len(tops[t].feature), -1) for t, _ in wide}
            for place, (t, k) in enumerate(wide):
                slots[t][k] = place
            for batch in batches:
                y = batch.column("y").to_numpy(zero_copy_only=False)
                codes, h = _codes(batch.column("codes"), features)[y >= 0], batch.column("h").to_numpy()[y >= 0]
                y = y[y >= 0]
                for t, slot_of in slots.items():
                    slot, times = slot_of[tops[t].place(codes)], drawn(h, t, seed)
                    rows = np.flatnonzero((slot >= 0) & (times > 0))
                    for j in range(offered.shape[1]):
                        np.add.at(sums, (y[rows], slot[rows], j, codes[rows, offered[slot[rows], j]]), times[rows])
            place, j, b = np.nonzero(sums.sum(axis=0))
            keys = np.array(wide).reshape(-1, 2)[place]
            found = [keys[:, 0].astype(np.int32), keys[:, 1].astype(np.int32), offered[place, j].astype(np.int32), b.astype(np.int32), sums[0, place, j, b], sums[1, place, j, b]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["tree", "node", "feature", "bin", "n0", "n1"])

        cells = packed.mapInArrow(count, _COUNTED).groupBy("tree", "node", "feature", "bin").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        whole_node = Window.partitionBy("tree", "node", "feature")
        upto = whole_node.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sides = cells.select("*", *[F.sum(c).over(w).alias(f"{s}{c}") for s, w in (("l", upto), ("a", whole_node)) for c in ("n0", "n1")])

        def impurity(zeros, ones):
            a, b = weights[0] * zeros, weights[1] * ones
            return F.coalesce(F.try_divide(2 * a * b, a + b), F.lit(0.0))

        l0, l1, a0, a1 = (F.col(c) for c in ("ln0", "ln1", "an0", "an1"))
        fall = F.when((l0 + l1 >= least) & (a0 + a1 - l0 - l1 >= least), impurity(a0, a1) - impurity(l0, l1) - impurity(a0 - l0, a1 - l1)).otherwise(F.lit(0.0))
        entry = F.struct(fall.alias("fall"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "ln0", "ln1", "an0", "an1")
        best = {(r["tree"], r["node"]): r["s"] for r in sides.groupBy("tree", "node").agg(F.max(entry).alias("s")).collect()}
        shared.unpersist()
        following = []
        for t, k in wide:
            s, top = best.get((t, k)), tops[t]
            if s is None:
                continue
            top.drawn[k] = (s["an0"], s["an1"])
            if s["an0"] + s["an1"] <= whole:
                continue
            top.open[k] = False
            if s["fall"] <= 1e-9:
                continue
            pairs = [(s["ln0"], s["ln1"]), (s["an0"] - s["ln0"], s["an1"] - s["ln1"])]
            top.split(k, -s["f"], -s["b"], pairs)
            for child, pair in zip((top.left[k], top.right[k]), pairs):
                if sum(pair) > whole:
                    if top.depth[child] < levels and min(pair) > 0:
                        following.append((t, child))
                    else:
                        top.open[child] = False
        wide = following
    return tops


def forest_scores(
    seen: DataFrame, held: DataFrame, features: list[str], label: str, row_id: str, numTrees: int, maxDepth: int, minInstancesPerNode: int, seed: int, out: str = "score", whole: int = WHOLE
) -> DataFrame:
    """``held`` with the mean, over all trees, of the balanced share of class 1 in its leaf; trees are grown on ``seen``.

    Labels are 0 and 1.  Gini impurity, the root of the number of features
    tried at each node, nulls and NaN above all thresholds.
    """
    counts = {r[0]: r[1] for r in seen.groupBy(label).count().collect()}
    if set(counts) - {0, 1}:
        raise ValueError("labels are 0 and 1")
    per_class = (counts.get(0, 0), counts.get(1, 0))
    n = sum(per_class)
    weights = tuple(n / (2 * c) if c else 0.0 for c in per_class)
    edges, d = thresholds(seen, features), len(features)
    held = cut(held.withColumn("__i", F.monotonically_increasing_id()))
    values = [F.col(f).cast("double").alias(f"__f{k}") for k, f in enumerate(features)]
    both = seen.select(F.lit(-1).cast("long").alias("i"), F.xxhash64(row_id).alias("h"), F.col(label).cast("byte").alias("y"), *values)
    both = both.unionByName(held.select(F.col("__i").alias("i"), F.lit(0).cast("long").alias("h"), F.lit(-1).cast("byte").alias("y"), *values))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [batch.column(f"__f{k}").to_numpy(zero_copy_only=False) for k in range(d)]
            codes = np.column_stack([np.searchsorted(e, np.where(np.isnan(v), np.inf, v), side="left") for e, v in zip(edges, x)]).astype(np.uint8)
            at = np.arange(len(codes) + 1, dtype=np.int32) * d
            packed = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("h"), packed, batch.column("y")], names=["i", "h", "codes", "y"])

    packed = cut(both.mapInArrow(pack, _PACKED))
    tops = _grow_tops(packed, d, max(len(e) for e in edges) + 1, numTrees, weights, maxDepth, minInstancesPerNode, seed, whole, per_class)
    shared = held.sparkSession.sparkContext.broadcast(tops)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _DEALT.split(", ")]
        for batch in batches:
            codes, y = _codes(batch.column("codes"), d), batch.column("y").to_numpy(zero_copy_only=False)
            ids, h, seen_row = batch.column("i").to_numpy(), batch.column("h").to_numpy(), y >= 0
            rows = []
            for t, top in enumerate(shared.value):
                times = np.where(seen_row, drawn(h, t, seed), 0)
                at = top.place(codes)
                for node in np.unique(at):
                    here = at == node
                    mine = here & (times > 0) if top.open[node] else np.zeros(len(at), bool)
                    judged = here & ~seen_row
                    salt = 0 if top.open[node] else int(ids[judged][0]) if judged.any() else 0
                    if mine.any() or judged.any():
                        rows.append((t, int(node), salt, codes[mine].tobytes(), y[mine].tobytes(), times[mine].astype(np.uint8).tobytes(), codes[judged].tobytes(), ids[judged].tobytes()))
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    def grow(key, group):
        t, node = key[0].as_py(), key[1].as_py()
        top = shared.value[t]
        joined = {c: b"".join(group.column(c).to_pylist()) for c in ("codes", "y", "drawn", "held", "ids")}
        codes, rows = (np.frombuffer(joined[c], np.uint8).reshape(-1, d) for c in ("codes", "held"))
        ids = np.frombuffer(joined["ids"], np.int64)
        if top.open[node]:
            y, times = np.frombuffer(joined["y"], np.int8), np.frombuffer(joined["drawn"], np.uint8).astype(float)
            p = finish(codes, y, times, rows, weights, maxDepth - top.depth[node], minInstancesPerNode, (seed, t, node + 1))
        else:
            a, b = (w * c for w, c in zip(weights, top.drawn[node]))
            p = np.full(len(ids), b / (a + b))
        return pa.table({"__i": ids, "p": p})

    leaves = sum(f < 0 for top in tops for f in top.feature)
    dealt = packed.mapInArrow(deal, _DEALT).repartition(max(shuffle_width(held.sparkSession), leaves), "tree", "node", "salt")
    votes = dealt.groupBy("tree", "node", "salt").applyInArrow(grow, "__i long, p double")
    means = votes.groupBy("__i").agg((F.sum("p") / numTrees).alias(out))
    return held.join(means, "__i", "left").drop("__i")
