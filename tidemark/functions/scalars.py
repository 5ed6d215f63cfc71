"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .temporal import col


def finite(c: str | Column) -> Column:
    """NaN is a missing value everywhere in this library."""
    return F.when(~F.isnan(col(c)), col(c))


def ratio(num: Column, den: Column, otherwise: float | None = None) -> Column:
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return q if otherwise is None else F.coalesce(q, F.lit(otherwise))


def flagged(labels: list[tuple[Column, str]]) -> Column:
    """Array of the labels whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in labels]))


def ordinal(c: str | Column, levels: dict[str, int], default: int) -> Column:
    chain = F.lit(default)
    for name, code in levels.items():
        chain = F.when(col(c).cast("string") == name, F.lit(code)).otherwise(chain)
    return chain


def split_words(c: str | Column) -> Column:
    """Whitespace tokens, case kept, Unicode whitespace included."""
    return F.filter(F.split(col(c), r"(?U)\s+"), lambda w: w != "")


def strip_space(c: str | Column) -> Column:
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def numeric_columns(schema: T.StructType, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(schema: T.StructType, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def stable_id(*parts: str | Column) -> Column:
    """Deterministic replacement for random identifiers."""
    return F.md5(F.concat_ws("\u001f", *[col(p).cast("string") for p in parts]))
