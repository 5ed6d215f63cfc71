"""Mixing sources to target weights by weighted fair queueing (operator 1).

Every source's documents are shuffled and queued.  A document's virtual finish
time is the words its source has sent when it ends, divided by the source's
target; a source whose target exceeds its size queues its documents again, up
to ``max_passes`` times.  All queues are merged by one global range sort on
finish time and cut where the total budget is spent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, prefix_sum, text_of, word_count

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
SEED = 20_261


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """source, source_size, target of ``sizes`` (source, source_size); one row a source.

    Sources in code point order, null last, take the weights in turn and share
    the sum of all sizes.  No target exceeds ``max_passes`` times its source's
    size; the excess goes to the others by weight until none is above.  A
    source is at its limit if all sources with a smaller limit per weight are
    and what they leave would still lift it over its own, so running sums in
    that order settle all targets at once.
    """
    one = sizes.select("source", "source_size", F.col("source").isNull().alias("__last"), F.lit(1).cast("bigint").alias("__one"))
    order = [("__last", "asc"), ("source", "asc")]
    ranked = prefix_sum(one, order, {"__one": "__rank"}, totals={"source_size": "__budget"})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("__rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("__weight", weight.cast("bigint")).withColumn("__cap", F.col("source_size") * max_passes)
    ranked = ranked.withColumn("__ratio", F.col("__cap") / F.col("__weight"))
    run = prefix_sum(ranked, [("__ratio", "asc"), ("__rank", "asc")], {"__cap": "__caps", "__weight": "__upto"}, totals={"__weight": "__weights"})
    left = F.col("__budget") - (F.col("__caps") - F.col("__cap"))
    open_weight = F.col("__weights") - (F.col("__upto") - F.col("__weight"))
    level = (left / open_weight).cast("double")  # what a unit of weight gets if all before this one are at their limits
    run = cut(run.withColumn("__level", level).withColumn("__full", F.col("__ratio") <= level))
    # The first source under its limit sets the level for all that are: one number.
    first = run.filter(~F.col("__full")).agg(F.min(F.struct("__ratio", "__rank", "__level"))["__level"].alias("level")).first()
    share = F.col("__weight") * F.lit(first["level"] if first else None).cast("double")
    target = F.when(F.col("__full"), F.col("__cap").cast("double")).otherwise(share)
    return run.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES, seed: int = SEED) -> DataFrame:
    """What the mix takes of every row of ``docs`` (doc_id, source, text).

    Returns doc_id, source, size, source_size, target, taken, passes and
    ``text_hash`` (to join texts by where ids repeat), one row for each input
    row.  ``taken`` counts words, repeats included; the last document of the
    mix is taken in part.  The shuffle is a hash of id and text, so reruns
    agree.  Null texts have size 0 and take nothing; null sources are one
    source; rows that agree in everything are queued one after the other; no
    rows give no rows.  Other columns are ignored.
    """
    rows = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        (word_count(text_of()) if size is None else size).alias("size"),
        F.xxhash64(text_of()).alias("text_hash"),
    )
    rows = rows.withColumn("__shuffle", F.xxhash64("doc_id", "text_hash", F.lit(seed)))
    rows = cut(rows.withColumn("__row", F.monotonically_increasing_id()))
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, max_passes).withColumnRenamed("source", "__source")
    queued = prefix_sum(rows, [("__shuffle", "asc"), ("doc_id", "asc"), ("text_hash", "asc"), ("__row", "asc")], {"size": "__sent"}, by=("source",))
    queued = queued.join(targets, queued.source.eqNullSafe(targets["__source"])).drop("__source")
    passes = F.greatest(F.ceil(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))), F.lit(1)).cast("int")
    copies = queued.withColumn("__pass", F.explode(F.sequence(F.lit(0), F.least(passes, F.lit(max_passes)) - 1)))
    finish = F.when(F.col("target") > 0, (F.col("__pass") * F.col("source_size") + F.col("__sent")) / F.col("target")).otherwise(F.lit(0.0))
    copies = copies.withColumn("__finish", finish)
    merged = prefix_sum(copies, [("__finish", "asc"), ("__shuffle", "asc"), ("__pass", "asc"), ("__row", "asc")], {"size": "__spent"})
    budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("budget")).first()["budget"]
    took = F.greatest(F.least(F.col("size"), F.lit(budget) - F.col("__spent") + F.col("size")), F.lit(0).cast("bigint"))
    return (
        merged.withColumn("__took", took)
        .groupBy("__row")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target", "text_hash")],
            F.sum("__took").alias("taken"),
            F.count_if(F.col("__took") > 0).alias("passes"),
        )
        .drop("__row")
    )
