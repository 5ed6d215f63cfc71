"""Deep forests: the same trees whether nodes are split by counts of all tasks or inside one."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import forest as fr

SETTINGS = {"numTrees": 4, "maxDepth": 8, "minInstancesPerNode": 5, "seed": 42}


def _naive(x, y, times, held, levels, least):
    """One feature, one node at a time."""
    size, ones = times.sum(), (times * y).sum()
    share = ones / size
    best = (1e-9, None)
    for c in np.unique(x)[:-1] if levels else []:
        left = x <= c
        n, p = times[left].sum(), (times * y)[left].sum()
        if min(n, size - n) >= least:
            fall = 2 * ones * (size - ones) / size - 2 * p * (n - p) / n - 2 * (ones - p) * (size - n - ones + p) / (size - n)
            best = max(best, (fall, c), key=lambda e: e[0])
    if best[1] is None:
        return np.full(len(held), share)
    out, c = np.empty(len(held)), best[1]
    for side in (lambda v: v <= c, lambda v: v > c):
        out[side(held)] = _naive(x[side(x)], y[side(x)], times[side(x)], held[side(held)], levels - 1, least)
    return out


def test_finish_is_the_tree_grown_node_by_node():
    rng = np.random.default_rng(1)
    x, times = rng.integers(0, 32, 400).astype(np.uint8), rng.integers(1, 4, 400)
    y = (rng.random(400) < 0.2 + 0.6 * ((x // 5) % 2)).astype(np.int8)
    held = np.arange(32, dtype=np.uint8)
    got = fr.finish(x[:, None], y, times.astype(float), held[:, None], (1.0, 1.0), 4, 5, (42, 0, 1))
    assert np.allclose(got, _naive(x, y, times, held, 4, 5))


def test_large_nodes_split_over_all_tasks_are_the_same_nodes(spark):
    rows = spark.range(3000).select("id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0).alias("x")).withColumn("y", (F.pmod(F.floor(F.col("x") / 13), F.lit(2)) == 1).cast("int"))
    rows = rows.withColumn("y", F.when(F.col("id") % 9 == 0, 1 - F.col("y")).otherwise(F.col("y"))).repartition(5)
    seen, held = rows.filter("id % 5 > 0"), rows.filter("id % 5 = 0")
    whole, parts = ({r["id"]: r["score"] for r in fr.forest_scores(seen, held, ["x"], "y", "id", whole=w, **SETTINGS).collect()} for w in (10**9, 600))
    assert len(whole) == 600 and whole.keys() == parts.keys()
    assert max(abs(whole[k] - parts[k]) for k in whole) < 1e-9
    clear = [(r["y"], whole[r["id"]]) for r in held.filter("id % 9 > 0").collect()]
    assert sum((s >= 0.5) == (y == 1) for y, s in clear) > 0.9 * len(clear)  # a threshold is a quantile, so cells of a 32nd straddle the seven edges


def test_nodes_that_cannot_be_split_and_tables_without_rows(spark):
    rows = spark.createDataFrame([(i, 1.0, i % 2) for i in range(400)], "id long, x double, y int")
    out = fr.forest_scores(rows, rows, ["x"], "y", "id", whole=100, **SETTINGS).collect()
    assert len(out) == 400 and all(abs(r["score"] - 0.5) < 0.2 for r in out)
    assert fr.forest_scores(rows, rows.limit(0), ["x"], "y", "id", **SETTINGS).count() == 0
    one = spark.createDataFrame([(1, float("nan"), 0), (2, None, 0)], "id long, x double, y int")
    assert {r["score"] for r in fr.forest_scores(one, one, ["x"], "y", "id", **SETTINGS).collect()} == {0.0}
