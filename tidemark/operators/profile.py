"""Column profiles as long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import numeric_columns, text_columns
from .ordered import quantiles

# The reported percentiles.
PERCENTILES = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


def unpivot_numeric(df: DataFrame, columns: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, feature, value) rows without NULL and NaN: a narrow step."""
    names = columns or numeric_columns(df.schema, keep)
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in names])
    long = doubles.unpivot(list(keep), names, "feature", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def describe_long(
    df: DataFrame, columns: list[str] | None = None, by: tuple[str, ...] = (), population: bool = False, method: str = "exact"
) -> DataFrame:
    """mean, std, min, max, percentiles and size per numeric column."""
    long = unpivot_numeric(df, columns, by)
    keys = (*by, "feature")
    spread = F.stddev_pop("value") if population else F.stddev_samp("value")
    basic = long.groupBy(*keys).agg(
        F.avg("value").alias("mean"), spread.alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("sample_size")
    )
    return basic.join(quantiles(long, "value", PERCENTILES, keys, method), list(keys))


def value_counts_long(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, value, n) for text columns."""
    names = columns or text_columns(df.schema)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "feature", "value")
    return long.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def missing_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, missing_rate, n_rows): one pass over all columns."""
    names = columns or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names])
    long = wide.unpivot(["__n"], names, "column", "missing_rate")
    return long.select("column", F.coalesce("missing_rate", F.lit(0.0)).alias("missing_rate"), F.col("__n").alias("n_rows"))


def drift_baseline(df: DataFrame, version: str, score: str | None = None, method: str = "exact") -> DataFrame:
    """Baseline rows per feature: statistics for numeric columns, counts for text columns, population spread for the score."""
    rest = df.drop(score) if score else df
    numeric = describe_long(rest, method=method).withColumn("kind", F.lit("numeric"))
    if score:
        scored = describe_long(df.select(score), population=True, method=method).withColumn("kind", F.lit("score"))
        numeric = numeric.unionByName(scored)
    names = text_columns(rest.schema)
    if names:
        counts = value_counts_long(rest, names).withColumnRenamed("n", "sample_size").withColumn("kind", F.lit("category"))
        numeric = numeric.unionByName(counts, allowMissingColumns=True)
    else:
        numeric = numeric.withColumn("value", F.lit(None).cast("string"))
    return numeric.withColumn("baseline_version", F.lit(version))
