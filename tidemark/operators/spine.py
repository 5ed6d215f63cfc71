"""As-of spines and rolling time splits, attached by a generator rather than a join."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.temporal import Moment, active_at, as_of_array, col, moment, span


def reaches(ts: str, a: Column, lookback: timedelta | None, closed: str) -> Column:
    """Whether the look-back before as-of ``a`` holds the row."""
    upper = F.col(ts) <= a if closed == "both" else F.col(ts) < a
    return upper if lookback is None else upper & (F.col(ts) >= a - span(lookback))


def per_as_of(df: DataFrame, as_ofs: list[Moment], wanted: Callable[[Column], Column], as_of: str = "as_of_time") -> DataFrame:
    """One copy of each row per as-of that ``wanted`` holds for; rows that none wants go first, at the scan or before a join where they can."""
    some = reduce(lambda x, y: x | y, [wanted(moment(a)) for a in as_ofs], F.lit(False))
    return df.filter(some).withColumn(as_of, F.explode(as_of_array(as_ofs))).filter(wanted(F.col(as_of)))


def attach_as_of(
    df: DataFrame, ts: str, as_ofs: list[Moment], lookback: timedelta | None, closed: str = "left", as_of: str = "as_of_time"
) -> DataFrame:
    """One copy of each row per as-of whose look-back contains it."""

    def wanted(a: Column) -> Column:
        return reaches(ts, a, lookback, closed)

    if len(as_ofs) == 1:
        only = moment(as_ofs[0])
        return df.filter(wanted(only)).withColumn(as_of, only)
    return per_as_of(df, as_ofs, wanted, as_of)


def active_rows(df: DataFrame, start: str, end: str, as_ofs: list[Moment], as_of: str = "as_of_time") -> DataFrame:
    """One copy of each interval row per as-of at which it is active."""
    return per_as_of(df, as_ofs, lambda a: active_at(start, end, a), as_of)


def at_risk(subs: DataFrame, entity: str, start: str, end: str, as_ofs: list[Moment], as_of: str = "as_of_time") -> DataFrame:
    """Distinct (entity, as_of) with an active interval."""
    return active_rows(subs.select(entity, start, end), start, end, as_ofs, as_of).select(entity, as_of).distinct()


def rolling_splits(
    start: datetime,
    end: datetime,
    train_months: int = 9,
    val_months: int = 1,
    test_months: int = 1,
    step_months: int = 1,
    n_splits: int = 3,
) -> list[dict]:
    """Train/val/test ranges in 30-day months; stops once a test range passes ``end``."""
    month = timedelta(days=30)
    out = []
    for i in range(n_splits):
        t0 = start + i * step_months * month
        t1 = t0 + train_months * month
        t2 = t1 + val_months * month
        t3 = t2 + test_months * month
        if t3 > end:
            break
        parts = (("train", t0, t1), ("val", t1, t2), ("test", t2, t3))
        out += [{"split_id": i + 1, "part": p, "starts": a, "ends": b} for p, a, b in parts]
    return out


def rolling_windows(start: datetime, end: datetime, window_months: int = 1, step_months: int = 1) -> list[dict]:
    """Backtest windows in 30-day months."""
    month, out, t = timedelta(days=30), [], start
    while t < end and t + window_months * month <= end:
        out.append({"split_id": len(out) + 1, "part": "window", "starts": t, "ends": t + window_months * month})
        t += step_months * month
    return out


def time_bounds(df: DataFrame, ts: str) -> tuple[datetime, datetime]:
    """First and last time of a table: the only two values read back."""
    row = df.agg(F.min(ts), F.max(ts)).first()
    return row[0], row[1]


def assign_splits(df: DataFrame, ts: str, splits: list[dict]) -> DataFrame:
    """One copy of each row per (split, part) whose half-open range holds it."""
    entries = F.array(
        *[
            F.struct(
                F.lit(s["split_id"]).alias("split_id"),
                F.lit(s["part"]).alias("part"),
                moment(s["starts"]).alias("starts"),
                moment(s["ends"]).alias("ends"),
            )
            for s in splits
        ]
    )
    hits = F.filter(entries, lambda s: (col(ts) >= s["starts"]) & (col(ts) < s["ends"]))
    return df.withColumn("__s", F.explode(hits)).select("*", "__s.split_id", "__s.part", "__s.starts", "__s.ends").drop("__s")
