"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut

#: Edges of one task; few edges are kept in few partitions, whose files would else outweigh them.
TASK_EDGES = 1 << 17


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of the component) for every node of ``edges`` (a, b: bigint).

    Alternating star operations: neighbours hang themselves on the smallest
    node they see until every node hangs on its root.  A node of many edges is
    only ever the key of a minimum (combined before the shuffle) and of a join
    of written tables, which adaptive execution splits; no neighbour list is
    built.  Checkpoints cut each round's lineage.
    """
    links = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    # No table of a round has more than twice the first edges; coalescing to more partitions than there are changes nothing.
    parts = max(1, -(-2 * links.count() // TASK_EDGES))
    state = None
    while True:
        # Large star: larger neighbours of u move to the smallest of u and its neighbours.
        around = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(parts))
        large = around.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours move to the smallest of these.
        large = cut(large.coalesce(parts))
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts))
        moved = large.join(least, "u")
        small = moved.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        links = cut(small.distinct().coalesce(parts))
        now = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("v", "u").bitwiseAND(F.lit((1 << 40) - 1))).alias("s")).first()
        if state == tuple(now):
            break
        state = tuple(now)
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
