"""Time predicates. Every boundary is explicit; time is always an argument."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

Moment = datetime | date | str | Column


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(value: Moment) -> Column:
    """A ``timestamp_ntz`` expression from a datetime, an ISO text or a column."""
    if isinstance(value, Column):
        return value
    text = value if isinstance(value, str) else value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat()
    return F.lit(text).cast("timestamp_ntz")


def span(d: timedelta) -> Column:
    """A day-time interval; a month is never a calendar month here."""
    micros = d.days * 86_400_000_000 + d.seconds * 1_000_000 + d.microseconds
    return F.expr(f"INTERVAL '{micros // 1_000_000}.{micros % 1_000_000:06d}' SECOND")


def lenient_time(c: str | Column) -> Column:
    """Unparsable or empty text becomes NULL instead of failing the job."""
    return F.try_to_timestamp(F.nullif(F.trim(col(c)), F.lit(""))).cast("timestamp_ntz")


def iso_utc(c: str | Column) -> Column:
    """ISO text, trailing ``Z`` read as UTC."""
    return F.try_to_timestamp(F.regexp_replace(col(c), "[zZ]$", "+00:00"))


def looking_back(ts: str | Column, as_of: Moment, width: timedelta | None, closed: str = "left") -> Column:
    """``closed='left'`` is ``[as_of-w, as_of)``; ``'both'`` is ``[as_of-w, as_of]``."""
    t, a = col(ts), moment(as_of)
    upper = t <= a if closed == "both" else t < a
    return upper if width is None else (t >= a - span(width)) & upper


def looking_ahead(ts: str | Column, as_of: Moment, width: timedelta) -> Column:
    """``(as_of, as_of+w]``."""
    t, a = col(ts), moment(as_of)
    return (t > a) & (t <= a + span(width))


def active_at(start: str | Column, end: str | Column, as_of: Moment) -> Column:
    s, e, a = col(start), col(end), moment(as_of)
    return (s <= a) & (e.isNull() | (e > a))


def overlaps(start: str | Column, end: str | Column, as_of: Moment, width: timedelta) -> Column:
    s, e, a = col(start), col(end), moment(as_of)
    return (s < a + span(width)) & (e.isNull() | (e > a))


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970 read off the wall clock, independent of the session zone."""
    t = col(ts)
    seconds = F.unix_date(F.to_date(t)) * F.lit(86_400) + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds.cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")


def whole_days(earlier: Column, later: Column) -> Column:
    """Elapsed whole days, floored."""
    return F.floor((epoch_micros(later) - epoch_micros(earlier)) / F.lit(86_400_000_000)).cast("bigint")


def time_bucket(ts: str | Column, width: timedelta) -> Column:
    """Epoch-aligned bucket number."""
    return F.floor(epoch_micros(ts) / F.lit(int(width.total_seconds() * 1_000_000))).cast("bigint")


def overlap_days(start: str | Column, end: str | Column, lower: Moment, upper: Moment) -> Column:
    """Whole days of ``[start, end)`` inside ``[lower, upper)``; no overlap is NULL."""
    lo = F.greatest(col(start), moment(lower))
    hi = F.least(F.coalesce(col(end), moment(upper)), moment(upper))
    return F.when(hi > lo, whole_days(lo, hi))


def as_of_array(as_ofs: list[Moment]) -> Column:
    return F.array(*[moment(a) for a in as_ofs])
