"""Declarative feature compiler: every feature of a source in one grouped pass."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.temporal import Moment, looking_back, span, time_bucket, whole_days
from .ordered import union_all
from .spine import as_of_array, attach_as_of, reaches

DAY = timedelta(days=1)


@dataclass(frozen=True)
class Feature:
    """One aggregate over one look-back window.

    ``aggregation`` is count, count_distinct, active_days (different calendar
    days with a value, windows of up to 62 days), sum, mean, max, min, any,
    changed, latest, recency, slope (last week minus first week over four), weekly_mean
    or regr_slope (least squares over the weeks of the window).
    """

    name: str
    aggregation: str
    window: timedelta | None = None
    column: str | None = None
    where: Column | None = None
    closed: str = "left"
    default: Any = 0

    def predicate(self, ts: str, as_of: Column) -> Column:
        inside = looking_back(ts, as_of, self.window, self.closed)
        return inside if self.where is None else inside & F.coalesce(self.where, F.lit(False))

    def compile(self, ts: str, as_of: Column, tie: str | None) -> Column:
        hit = self.predicate(ts, as_of)
        value = F.col(self.column) if self.column else F.lit(1)
        inside = F.when(hit, value)
        kind = self.aggregation
        if kind == "count":
            return F.count(inside).alias(self.name)
        if kind == "count_distinct":
            return F.count_distinct(inside).alias(self.name)
        if kind == "changed":
            return F.coalesce(F.min(inside) < F.max(inside), F.lit(False)).cast("int").alias(self.name)
        if kind == "active_days":
            return _marked(hit & value.isNotNull(), F.datediff(as_of, F.col(ts)), self.window.days).alias(self.name)
        if kind == "any":
            flag = hit if self.column is None else hit & F.coalesce(value.cast("boolean"), F.lit(False))
            return F.coalesce(F.max(flag.cast("int")), F.lit(0)).alias(self.name)
        if kind == "latest":
            order = F.struct(F.col(ts), *([F.col(tie)] if tie else []))
            picked = F.max_by(value, F.when(hit, order))
            return (picked if self.default is None else F.coalesce(picked, F.lit(self.default))).alias(self.name)
        if kind == "recency":
            last = F.max(F.when(hit, F.col(ts)))
            return F.coalesce(whole_days(last, as_of), F.lit(999)).alias(self.name)
        if kind in ("slope", "regr_slope", "weekly_mean"):
            return self._trend(ts, as_of, hit).alias(self.name)
        simple = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}[kind](inside)
        return (simple if self.default is None else F.coalesce(simple, F.lit(self.default))).alias(self.name)

    @property
    def missing(self) -> Any:
        """What an entity without any row in the window has."""
        if self.aggregation in ("count", "count_distinct", "active_days", "changed", "any"):
            return 0
        return 0.0 if self.aggregation in ("slope", "regr_slope", "weekly_mean") else self.default

    def summary(self, ts: str, tie: str | None) -> Column:
        """Time and value of the last row; maxima of summaries are summaries."""
        order = [F.col(ts).alias("t"), *([F.col(tie).alias("tie")] if tie else [])]
        last = F.struct(*order, (F.col(self.column) if self.column else F.lit(1)).alias("v"))
        return F.max(last if self.where is None else F.when(F.coalesce(self.where, F.lit(False)), last))

    def shown(self, as_of: Column) -> Column:
        """The feature of a summary."""
        if self.aggregation == "recency":
            return F.coalesce(whole_days(F.col(f"{self.name}.t"), as_of), F.lit(999))
        value = F.col(f"{self.name}.v")
        return value if self.default is None else F.coalesce(value, F.lit(self.default))

    def _trend(self, ts: str, as_of: Column, hit: Column) -> Column:
        total = F.count(F.when(hit, 1))
        if self.aggregation == "weekly_mean":
            weeks = _marked(hit, time_bucket(as_of, 7 * DAY) - time_bucket(ts, 7 * DAY), self.window.days // 7 + 1)
            return F.coalesce(F.try_divide(total.cast("double"), weeks), F.lit(0.0))
        n = self.window.days // 7
        if self.aggregation == "slope":
            first = F.count(F.when(hit & (F.col(ts) < as_of - span(self.window) + span(7 * DAY)), 1))
            last = F.count(F.when(hit & (F.col(ts) >= as_of - span(7 * DAY)), 1))
            return F.when(total >= 2, (last - first) / F.lit(float(n))).otherwise(F.lit(0.0))
        # Least squares of weekly counts on week number, weeks without events counting as zero.
        middle, spread = (n - 1) / 2, sum((i - (n - 1) / 2) ** 2 for i in range(n))
        start = as_of - span(self.window)
        terms = F.lit(0.0)
        for i in range(n):
            week = hit & (F.col(ts) >= start + span(7 * i * DAY))
            if i < n - 1:
                week = week & (F.col(ts) < start + span(7 * (i + 1) * DAY))
            terms = terms + F.count(F.when(week, 1)) * F.lit((i - middle) / spread)
        return terms


def _marked(hit: Column, place: Column, most: int) -> Column:
    """How many different places (0 to ``most``) the hits have: a bit each in one number, so nothing distinct is kept apart."""
    if most > 62:
        raise ValueError("a longer window needs count_distinct")
    return F.coalesce(F.bit_count(F.bit_or(F.when(hit, F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))))), F.lit(0)).cast("bigint")


def build_features(
    df: DataFrame,
    entity: str | list[str],
    ts: str,
    as_ofs: list[Moment],
    features: list[Feature],
    tie: str | None = None,
    as_of: str = "as_of_time",
) -> DataFrame:
    """All ``features`` of one source in one scan: one row per (entity, as_of) with any row in reach.

    Most features are conditional aggregates over one copy of each row per
    as-of whose look-back holds it.  Recency and latest values without a
    window copy no history: a row goes once to its slot between as-ofs, and
    only the reduced (entity, slot) rows go to the later as-ofs.
    """
    keys = [entity] if isinstance(entity, str) else list(entity)
    open_ = [f for f in features if f.window is None and f.aggregation in ("recency", "latest")]
    bounded = [f for f in features if f not in open_]
    windows = [f.window for f in bounded]
    reach = None if any(w is None for w in windows) else max(windows, default=None)
    closed = "both" if any(f.closed == "both" for f in bounded) else "left"
    if not open_:
        rows = attach_as_of(df, ts, as_ofs, reach, closed, as_of)
        return rows.groupBy(*keys, as_of).agg(*[f.compile(ts, F.col(as_of), tie) for f in bounded])

    moments = F.array_sort(as_of_array(as_ofs))

    def entry(at: Column, slot: str | None) -> Column:
        return F.struct(at.alias("at"), F.lit(slot).cast("string").alias("slot"))

    entries = []
    if bounded:
        entries.append(F.transform(F.filter(moments, lambda a: reaches(ts, a, reach, closed)), lambda a: entry(a, None)))
    for side in dict.fromkeys(f.closed for f in open_):
        entries.append(F.transform(F.slice(F.filter(moments, lambda a: reaches(ts, a, None, side)), 1, 1), lambda a: entry(a, side)))
    dealt = df.select("*", F.inline(F.concat(*entries)).alias(as_of, "__slot"))
    columns = [F.when(F.col("__slot").isNull(), f.compile(ts, F.col(as_of), tie)).alias(f.name) for f in bounded]
    columns += [F.when(F.col("__slot") == f.closed, f.summary(ts, tie)).alias(f.name) for f in open_]
    reduced = dealt.groupBy(*keys, as_of, "__slot").agg(*columns)
    onward = F.when(F.col("__slot").isNull(), F.array(F.col(as_of))).otherwise(F.filter(moments, lambda a: a >= F.col(as_of)))
    names = [f.name for f in features]
    last = reduced.select(*keys, *names, F.explode(onward).alias(as_of)).groupBy(*keys, as_of).agg(*[F.max(n).alias(n) for n in names])
    shown = {f.name: f.shown(F.col(as_of)) for f in open_}
    out = last.select(*keys, as_of, *[shown.get(n, F.col(n)).alias(n) for n in names])
    return out.fillna({f.name: f.missing for f in bounded if f.missing is not None})


def merge_groups(frames: list[DataFrame], keys: list[str], fill: dict[str, Any] | None = None) -> DataFrame:
    """N-way full outer join of feature groups as one union and one aggregation.

    Chained outer joins re-shuffle at every step; here each group ships its
    rows once and a key present in any group survives.
    """
    names = [c for f in frames for c in f.columns if c not in keys]
    merged = union_all(frames).groupBy(*keys).agg(*[F.max(c).alias(c) for c in names])
    return merged.fillna(fill) if fill else merged


def add_metadata(df: DataFrame, version: str, event_time: Column | str) -> DataFrame:
    at = F.col(event_time) if isinstance(event_time, str) else event_time
    return df.withColumns({"feature_set_version": F.lit(version), "event_time": at})


def from_spec(spec: dict, source: str, bindings: dict[str, dict], closed: str = "left") -> list[Feature]:
    """Features of one source from a parsed declarative spec.

    ``spec['features']`` entries carry name, source, window_days/window_hours
    and aggregation; ``bindings`` says which column and filter each one reads.
    """
    out = []
    for entry in spec["features"]:
        if entry["source"] != source or entry["name"] not in bindings:
            continue
        width = timedelta(days=entry.get("window_days") or 0, hours=entry.get("window_hours") or 0)
        bound = bindings[entry["name"]]
        out.append(
            Feature(
                entry["name"],
                bound.get("aggregation", entry["aggregation"]),
                width if width else None,
                bound.get("column"),
                bound.get("where"),
                closed,
                bound.get("default", None if entry["aggregation"] == "latest" else 0),
            )
        )
    return out


# Feature groups of an event-log subscription business -----------------------------------------

def _usage() -> list[Feature]:
    return [
        Feature("active_days_30d", "active_days", 30 * DAY),
        Feature("sessions_7d", "count", 7 * DAY, where=F.col("event_type") == "session_start"),
        Feature("core_feature_cnt_14d", "count_distinct", 14 * DAY, "feature_name", F.col("event_type") == "feature_use"),
    ]


def _trend(slope: str = "weekly_mean") -> list[Feature]:
    return [Feature("usage_slope_4w", slope, 28 * DAY), Feature("recency_days", "recency")]


def _failures() -> list[Feature]:
    return [Feature("payment_fail_30d", "count", 30 * DAY, where=F.col("status") == "failed")]


def _revenue() -> list[Feature]:
    return [Feature("avg_revenue_90d", "mean", 90 * DAY, "amount", F.col("status") == "success", default=None)]


def _price_changes() -> list[Feature]:
    return [
        Feature("price_change_flag", "changed", 90 * DAY, "price"),
        Feature("discount_used_90d", "any", 90 * DAY, where=F.col("coupon_code").isNotNull()),
    ]


def _plan() -> list[Feature]:
    return [Feature("plan_tier", "latest", None, "plan", default=None)]


def usage_group(events: DataFrame, entity: str, as_ofs: list[Moment]) -> DataFrame:
    """events: entity, event_time, event_type, feature_name."""
    return build_features(events, entity, "event_time", as_ofs, _usage())


def payment_group(payments: DataFrame, subscriptions: DataFrame, entity: str, as_ofs: list[Moment]) -> DataFrame:
    """payments: entity, event_time, status; subscriptions: entity, event_time, price, coupon_code."""
    failed = build_features(payments, entity, "event_time", as_ofs, _failures())
    changed = build_features(subscriptions, entity, "event_time", as_ofs, _price_changes())
    out = merge_groups([failed, changed], [entity, "as_of_time"])
    return out.fillna(0, ["payment_fail_30d", "price_change_flag", "discount_used_90d"])


def support_group(tickets: DataFrame, entity: str, as_ofs: list[Moment], urgent: tuple[str, ...] = ("high", "critical")) -> DataFrame:
    """tickets: entity, created_at, severity, resolution_time_hours."""
    return build_features(
        tickets, entity, "created_at", as_ofs,
        [
            Feature("tickets_30d", "count", 30 * DAY),
            Feature("avg_resolution_hours_90d", "mean", 90 * DAY, "resolution_time_hours", default=0.0),
            Feature("high_sev_ticket_30d", "count", 30 * DAY, where=F.col("severity").isin(*urgent)),
        ],
    )


def trend_group(events: DataFrame, entity: str, as_ofs: list[Moment], slope: str = "weekly_mean") -> DataFrame:
    return build_features(events, entity, "event_time", as_ofs, _trend(slope))


def value_group(payments: DataFrame, subscriptions: DataFrame, entity: str, as_ofs: list[Moment], tie: str | None = None) -> DataFrame:
    paid = build_features(payments, entity, "event_time", as_ofs, _revenue())
    plan = build_features(subscriptions, entity, "event_time", as_ofs, _plan(), tie=tie)
    return merge_groups([paid, plan], [entity, "as_of_time"])


def event_log_features(
    events: DataFrame,
    payments: DataFrame,
    subscriptions: DataFrame,
    tickets: DataFrame,
    entity: str,
    as_ofs: list[Moment],
    version: str = "fs_churn_v1",
    entities: list | None = None,
    tie: str | None = None,
) -> DataFrame:
    """All groups on one row per (entity, as_of)."""
    if entities:
        events, payments, subscriptions, tickets = [
            d.filter(F.col(entity).isin(entities)) for d in (events, payments, subscriptions, tickets)
        ]
    # One compile per source: all its features share a scan.
    groups = [
        build_features(events, entity, "event_time", as_ofs, _usage() + _trend()),
        build_features(payments, entity, "event_time", as_ofs, _failures() + _revenue()),
        build_features(subscriptions, entity, "event_time", as_ofs, _price_changes() + _plan(), tie=tie),
        support_group(tickets, entity, as_ofs),
    ]
    merged = merge_groups(groups, [entity, "as_of_time"])
    numeric = [f.name for f in merged.schema if f.name not in (entity, "as_of_time", "plan_tier", "recency_days")]
    merged = merged.fillna(0, numeric).fillna(999, ["recency_days"])
    return add_metadata(merged, version, "as_of_time")
