"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def hot_keys(df: DataFrame, key: str, share: float = 0.02) -> DataFrame:
    """__hot: the keys that hold more than ``share`` of the rows, at most 1 / share of them, as part of the plan."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    return counts.filter(F.col(key).isNotNull() & (F.col("__n") > total * share)).select(F.col(key).alias("__hot"))


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", share: float = 0.02, salts: int = 64) -> DataFrame:
    """Equi join of a large, possibly skewed side with a side of unique keys.

    Rows of hot keys are dealt over ``salts`` sub-keys by their own hash; only
    the matching rows of the other side (a few) are copied.  All other keys
    keep a single sub-key.  Nothing runs while the plan is built: the hot
    keys, at most 1 / share, are found and sent to the tasks when it runs.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError("only joins that keep or filter the left side can be spread")
    hot = F.broadcast(hot_keys(left, key, share))
    others = [c for c in left.columns if c != key]
    deal = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int") if others else F.lit(0)
    is_hot: Column = F.col("__hot").isNotNull()
    dealt = left.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__salt", F.when(is_hot, deal).otherwise(0)).drop("__hot")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = right.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    return dealt.join(copied, [key, "__salt"], how).drop("__salt")
