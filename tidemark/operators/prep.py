"""Column preparation for wide model tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import numeric_columns, text_columns
from ..session import cut
from .ordered import ranked
from .skew import spread_join


def keep_ids(df: DataFrame, column: str, ids: list | DataFrame | None) -> DataFrame:
    """Membership filter; an empty list means no filter.  A long list is passed as a one-column table."""
    if ids is None or (isinstance(ids, list) and not ids):
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_semi")
    return df.filter(F.col(column).isin(ids))


def drop_sparse(df: DataFrame, keep: tuple[str, ...] = (), max_missing: float = 0.95) -> DataFrame:
    """Drop columns whose NULL share is strictly above the limit (one pass, one row read back)."""
    names = [c for c in df.columns if c not in keep]
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names]).first()
    return df.drop(*[c for c in names if (shares[c] or 0.0) > max_missing])


def drop_constant(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop columns with at most one distinct value; min = max is exact and needs no distinct."""
    names = [c for c in df.columns if c not in keep]
    ends = df.agg(*[F.min(c).eqNullSafe(F.max(c)).alias(c) for c in names]).first()
    return df.drop(*[c for c in names if ends[c]])


def fill_missing(df: DataFrame, value: float = -999, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.fillna(value, numeric_columns(df.schema, keep))


def encode_labels(df: DataFrame, columns: list[str] | None = None, keep: tuple[str, ...] = (), broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Text -> dense integer codes in alphabetical order, missing -> -1.

    One pass collects the distinct values of all columns, ranked per column
    across partitions.  Codes of a column go to the tasks where their values
    take up at most ``broadcast_bytes``, so the wide table is not shuffled;
    larger ones are joined by value, with the rows of a very frequent value
    dealt over several tasks.
    """
    names = columns or text_columns(df.schema, keep)
    if not names:
        return df
    long = df.select(*names).unpivot([], names, "__c", "__v").filter(F.col("__v").isNotNull()).distinct()
    codes = cut(ranked(long, [("__v", "asc")], by=("__c",), rank="__code"))
    sizes = {r["__c"]: r["n"] for r in codes.groupBy("__c").agg(F.sum(F.octet_length("__v") + 32).alias("n")).collect()}
    out = df
    for c in names:
        own = codes.filter(F.col("__c") == c).select(F.col("__v").alias(c), (F.col("__code") - 1).alias("__code"))
        joined = out.join(F.broadcast(own), c, "left") if sizes.get(c, 0) <= broadcast_bytes else spread_join(out, own, c)
        out = joined.withColumn(c, F.coalesce("__code", F.lit(-1)).cast("bigint")).drop("__code")
    return out.select(*df.columns)


def align_columns(df: DataFrame, columns: list[str], keep: tuple[str, ...] = (), absent: float = -999) -> DataFrame:
    """The model's columns in order; absent or missing inputs become the constant."""

    def pick(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(float(absent))) if c in df.columns else F.lit(float(absent))

    return df.select(*keep, *[pick(c).alias(c) for c in columns])


def amount_or_zero(df: DataFrame, candidates: tuple[str, ...] = ("amount_usd", "TransactionAmt", "amount")) -> Column:
    """First present, non-missing amount, else 0."""
    return F.coalesce(*[F.col(c).cast("double") for c in candidates if c in df.columns], F.lit(0.0))


def prepare_wide(df: DataFrame, keep: tuple[str, ...], fill: float = -999, max_missing: float = 0.95, numeric_only: bool = False) -> DataFrame:
    """Sparse columns out, text encoded (or dropped), constant fill, constant columns out."""
    out = drop_sparse(df, keep, max_missing)
    if numeric_only:
        out = out.select(*[c for c in out.columns if c in keep or c in numeric_columns(out.schema)])
    else:
        out = encode_labels(out, keep=keep)
    return drop_constant(fill_missing(out, fill, keep), keep)
