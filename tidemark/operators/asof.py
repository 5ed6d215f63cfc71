"""Point-in-time (as-of) join and the leakage check."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.temporal import time_bucket

_B, _E, _T, _KIND, _TIE, _PAY, _LAB, _FAR = "__bucket", "__e", "__t", "__kind", "__tie", "__pay", "__lab", "__far"


def asof_join(
    labels: DataFrame,
    features: DataFrame,
    entity: str,
    label_time: str,
    feature_time: str,
    feature_cols: list[str],
    tie: str | None = None,
    how: str = "inner",
    bucket: timedelta = timedelta(days=1),
    labels_unique: bool = False,
    feature_time_as: str | None = None,
) -> DataFrame:
    """For each (entity, label time) the latest feature row strictly before it.

    Both inputs go through one shuffle on (entity, time bucket) instead of
    entity alone, so a hot entity spreads over its buckets.  What a bucket
    needs from earlier ones arrives as one seed row per (entity, bucket),
    built from a map-side-combined maximum.  Equal times never match; features
    at one time are ordered by ``tie``.
    """
    stamp = feature_time_as or feature_time
    payload = F.struct(F.col(feature_time).alias(stamp), *[F.col(c) for c in feature_cols])
    tie_col = F.col(tie) if tie else F.lit(0)
    rest = [c for c in labels.columns if c not in (entity, label_time)]

    lab = labels.select(entity, label_time, F.struct(*([F.col(c) for c in rest] or [F.lit(1).alias("__x")])).alias(_LAB))
    if not labels_unique:
        lab = lab.groupBy(entity, label_time).agg(F.max(_LAB).alias(_LAB))
    lab = lab.select(
        F.col(entity).alias(_E), F.col(label_time).alias(_T), F.lit(0).alias(_KIND), _LAB,
        time_bucket(label_time, bucket).alias(_B),
    )
    feat = features.filter(F.col(feature_time).isNotNull()).select(
        F.col(entity).alias(_E), F.col(feature_time).alias(_T), F.lit(1).alias(_KIND), payload.alias(_PAY),
        tie_col.alias(_TIE), time_bucket(feature_time, bucket).alias(_B),
    )
    rows = lab.unionByName(feat, allowMissingColumns=True)

    newest = rows.groupBy(_E, _B).agg(
        F.max_by(F.when(F.col(_KIND) == 1, F.col(_PAY)), F.when(F.col(_KIND) == 1, F.struct(_T, _TIE))).alias(_PAY),
        F.max(F.col(_KIND) == 0).alias("__wanted"),
    )
    # One row per (entity, bucket): the per-entity order is bounded by the number of buckets.
    before = Window.partitionBy(_E).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    seeds = (
        newest.withColumn(_PAY, F.last(_PAY, ignorenulls=True).over(before))
        .filter(F.col("__wanted") & F.col(_PAY).isNotNull())
        .select(_E, _B, F.lit(-1).alias(_KIND), _PAY)
    )
    everything = rows.unionByName(seeds, allowMissingColumns=True)
    upto = (
        Window.partitionBy(_E, _B)
        .orderBy((F.col(_KIND) >= 0).asc(), F.col(_T).asc_nulls_first(), F.col(_KIND), F.col(_TIE))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = everything.withColumn(_PAY, F.last(_PAY, ignorenulls=True).over(upto)).filter(F.col(_KIND) == 0)
    if how == "inner":
        found = found.filter(F.col(_PAY).isNotNull())
    return found.select(
        F.col(_E).alias(entity),
        F.col(_T).alias(label_time),
        *[F.col(f"{_LAB}.{c}").alias(c) for c in rest],
        F.col(f"{_PAY}.{stamp}").alias(stamp),
        *[F.col(f"{_PAY}.{c}").alias(c) for c in feature_cols],
    )


def leaking_rows(df: DataFrame, feature_time: str, label_time: str) -> DataFrame:
    """Rows whose feature time is not before the label time; a missing column is not a violation."""
    if feature_time not in df.columns or label_time not in df.columns:
        return df.limit(0)
    return df.filter(F.col(feature_time) >= F.col(label_time))


def leakage_report(df: DataFrame, feature_time: str, label_time: str) -> DataFrame:
    bad = F.count_if(F.col(feature_time) >= F.col(label_time))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), bad.alias("violations"), (bad == 0).alias("passed"))


def assert_no_leakage(df: DataFrame, feature_time: str, label_time: str) -> DataFrame:
    """Strict form: the job fails on the first leaking row."""
    ok: Column = F.coalesce(F.col(feature_time) < F.col(label_time), F.lit(True))
    return df.filter(F.assert_true(ok, F.lit("feature time is not before label time")).isNull())
