"""Shards along a Hilbert curve over several metadata dimensions (operator 10).

Source, language and size are quantised to ``2**bits`` cells each.  A row's
place on the Hilbert curve through these cells, then its size and id, is its
sort key; runs of equal length cut from that order are the shards.  Cells near
each other on the curve are near in every dimension, so a filter on any of
them reads few shards.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import prefix_sum, text_of

SHARDS = 40
BITS = 4


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of the rows of ``axes``, coordinates ``0 .. 2**bits - 1`` (Skilling's transposition)."""
    x = [axes[:, i].astype(np.int64) for i in range(axes.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            on = (x[i] >> bit & 1).astype(bool)
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap if i else x[i]
            x[0] = x[0] ^ np.where(on, low, swap if i else 0)
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    out = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | ((v ^ turn) >> bit & 1)
    return out


def borders(docs: DataFrame, columns: dict[str, Column], cells: int) -> dict[str, list]:
    """For each column at most ``cells - 1`` increasing values that cut all its values into runs of about equal length.

    With n values in order, these are the ones at places n * k // cells that
    are above the least; nulls do not count.  Exact: equal values collapse in
    one scan, and their counts are summed in order over range partitions.
    """
    names = list(columns)
    kinds = dict(docs.select(*[c.alias(name) for name, c in columns.items()]).dtypes)
    slots = {kind: f"__{kind}" for kind in dict.fromkeys(kinds.values())}
    entries = [
        F.struct(F.lit(i).alias("__axis"), *[(columns[name] if kinds[name] == kind else F.lit(None).cast(kind)).alias(slot) for kind, slot in slots.items()])
        for i, name in enumerate(names)
    ]
    values = docs.select(F.inline(F.array(*entries))).filter(reduce(lambda x, y: x | y, [F.col(c).isNotNull() for c in slots.values()]))
    counts = values.groupBy("__axis", *slots.values()).agg(F.count(F.lit(1)).alias("__n"))
    running = prefix_sum(counts, [(c, "asc") for c in slots.values()], {"__n": "__upto"}, by=("__axis",), totals={"__n": "__total"})

    def places(upto: Column) -> Column:
        """How many of the places are before ``upto``."""
        return F.least(F.lit(cells - 1), F.floor((upto * cells + F.col("__total") - 1) / F.col("__total")) - 1)

    first = F.col("__upto") - F.col("__n")
    picked = running.filter((first > 0) & (places(F.col("__upto")) > F.greatest(places(first), F.lit(0)))).collect()
    return {name: sorted(r[slots[kinds[name]]] for r in picked if r["__axis"] == i) for i, name in enumerate(names)}


def cell_of(column: Column, edges: list) -> Column:
    """How many borders are at most the value; null is in the first cell."""
    out = F.lit(0)
    for edge in edges:
        out = out + F.when(column >= F.lit(edge), 1).otherwise(0)
    return out


def assign(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, hilbert, shard and slot of every row of ``docs`` (doc_id, text, source, lang).

    Law ``rows``: shard sizes differ by one row at most, the longer ones
    first.  Null texts are empty, null source or language is the first cell,
    equal rows take neighbouring slots, no rows give no rows.  Other columns
    are ignored.  Cell borders come from the values of all rows.  A cell may
    hold any share of the rows: the order inside it is cut like any other.
    """
    rows = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 16).cast("bigint").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
    )
    axes = [cell_of(F.col(name), edges) for name, edges in borders(rows, {c: F.col(c) for c in ("source", "lang", "size")}, 1 << bits).items()]
    names = ["__a0", "__a1", "__a2"]
    keyed = rows.withColumns(dict(zip(names, axes)))
    keyed = keyed.join(F.broadcast(curve(docs.sparkSession, names, bits)), names).drop(*names, "source", "lang")
    keyed = keyed.withColumn("__one", F.lit(1).cast("bigint"))
    order = [("hilbert", "asc"), ("size", "asc"), ("doc_id", "asc"), ("text_crc32", "asc")]
    ranked = prefix_sum(keyed, order, {"__one": "__upto"}, totals={"__one": "__total"})
    place, base, longer = F.col("__upto") - 1, F.floor(F.col("__total") / shards), F.col("__total") % shards
    edge = longer * (base + 1)
    ranked = ranked.withColumn("__place", place).withColumn("__base", base).withColumn("__edge", edge)
    in_long = F.col("__place") < F.col("__edge")
    short = F.greatest(F.col("__base"), F.lit(1))
    shard = F.when(in_long, F.floor(F.col("__place") / (F.col("__base") + 1))).otherwise(longer + F.floor((F.col("__place") - F.col("__edge")) / short))
    slot = F.when(in_long, F.col("__place") % (F.col("__base") + 1)).otherwise((F.col("__place") - F.col("__edge")) % short)
    return ranked.select("doc_id", "size", "text_crc32", "hilbert", shard.cast("int").alias("shard"), slot.cast("bigint").alias("slot"))


def curve(spark: SparkSession, names: list[str], bits: int) -> DataFrame:
    """One row for each of the ``2**(3 * bits)`` cells with its place on the curve: a table of fixed size."""
    axes = np.stack(np.meshgrid(*[np.arange(1 << bits)] * len(names), indexing="ij"), axis=-1).reshape(-1, len(names))
    rows = np.column_stack([axes, hilbert_index(axes, bits)]).tolist()
    return spark.createDataFrame(rows, ", ".join(f"{n} int" for n in [*names, "hilbert"]))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """The documents as Parquet, one folder a shard, sorted by slot; ``assigned`` must have one row for each doc_id."""
    placed = docs.join(assigned.select("doc_id", "shard", "slot"), "doc_id")
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
