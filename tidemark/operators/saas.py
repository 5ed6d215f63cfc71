"""Account-level labels and the 13-feature matrix of a subscription business."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import ordinal
from ..functions.temporal import (
    Moment, active_at, looking_ahead, moment, overlap_days, overlaps, span, whole_days,
)
from .features import Feature, build_features, merge_groups
from .spine import active_rows, at_risk, attach_as_of, per_as_of

DAY = timedelta(days=1)

# The model's features, in order.
FEATURES = [
    "active_days_30d", "sessions_7d", "core_feature_cnt_14d", "payment_fail_30d", "price_change_flag", "discount_used_90d", "tickets_30d",
    "avg_resolution_hours_90d", "high_sev_ticket_30d", "usage_slope_4w", "recency_days", "avg_revenue_90d", "plan_tier",
]

# Plan codes.
PLAN_CODES = {"Basic": 0, "Pro": 1, "Enterprise": 2}


def prorated(days: Column, billing: Column, mrr: Column, arr: Column) -> Column:
    """Revenue of ``days``: annual contracts over 365 days, all others monthly over 30."""
    d = days.cast("double")
    yearly = F.coalesce(arr, F.lit(0)).cast("double") * (d / 365)
    monthly = F.coalesce(mrr, F.lit(0)).cast("double") * (d / 30)
    return F.when(F.coalesce(billing, F.lit("monthly")) == "annual", yearly).otherwise(monthly)


def churn_labels(churn_events: DataFrame, subs: DataFrame, as_ofs: list[Moment], horizon: timedelta = 30 * DAY) -> DataFrame:
    """Accounts active at as_of; 1 when a churn event or a subscription end falls in (as_of, as_of+h]."""
    spine = at_risk(subs, "account_id", "start_date", "end_date", as_ofs).withColumn("churn", F.lit(0))

    def ending(df: DataFrame, at: str) -> DataFrame:
        hits = per_as_of(df.select("account_id", at), as_ofs, lambda a: looking_ahead(at, a, horizon))
        return hits.select("account_id", "as_of_time").withColumn("churn", F.lit(1))

    ends = ending(churn_events, "churn_date").unionByName(ending(subs, "end_date"))
    # Spine rows and endings meet in one aggregation; endings of accounts not at risk fall away.
    both = spine.withColumn("__risk", F.lit(1)).unionByName(ends.withColumn("__risk", F.lit(0)))
    out = both.groupBy("account_id", "as_of_time").agg(F.max("churn").alias("churn"), F.max("__risk").alias("__risk"))
    return out.filter("__risk = 1").drop("__risk")


def ltv_labels(subs: DataFrame, as_ofs: list[Moment], horizon: timedelta = 90 * DAY) -> DataFrame:
    """Prorated revenue in (as_of, as_of+h] of accounts active at as_of, 0 when none."""
    rows = per_as_of(subs, as_ofs, lambda a: overlaps("start_date", "end_date", a, horizon))
    a = F.col("as_of_time")
    days = overlap_days("start_date", "end_date", a, a + span(horizon))
    revenue = prorated(F.coalesce(days, F.lit(0)), F.col("billing_frequency"), F.col("mrr_amount"), F.col("arr_amount"))
    out = rows.groupBy("account_id", "as_of_time").agg(
        F.coalesce(F.sum(revenue), F.lit(0.0)).alias("ltv_90d"),
        # An interval active at as_of always overlaps the horizon, so one pass decides both.
        F.max((F.col("start_date") <= a).cast("int")).alias("__risk"),
    )
    return out.filter("__risk = 1").drop("__risk")


def saas_features(
    accounts: DataFrame, subs: DataFrame, usage: DataFrame, tickets: DataFrame, as_ofs: list[Moment], tie: str = "subscription_id"
) -> DataFrame:
    """One row per (account at risk, as_of) with the 13 model features."""
    keys = ["account_id", "as_of_time"]
    groups = [_usage(subs, usage, as_ofs), _contracts(subs, as_ofs, tie), _support(tickets, as_ofs)]
    merged = merge_groups(groups, keys).filter("__risk = 1").drop("__risk")
    counts = [
        "active_days_30d", "sessions_7d", "core_feature_cnt_14d", "price_change_flag", "tickets_30d",
        "avg_resolution_hours_90d", "high_sev_ticket_30d", "usage_slope_4w", "avg_revenue_90d",
    ]
    merged = merged.fillna(0, counts).fillna(999, ["recency_days"])
    # An account at risk always has a contract; the account table only backs a contract without a plan.
    backup = accounts.select("account_id", ordinal("plan_tier", PLAN_CODES, 0).alias("__account_plan"))
    merged = merged.join(backup, "account_id", "left")
    plan = F.coalesce("plan_tier", "__account_plan", F.lit(0))
    made = {"payment_fail_30d": F.lit(0), "discount_used_90d": F.lit(0), "plan_tier": plan}
    return merged.select(*keys, *[made.get(c, F.col(c)).alias(c) for c in FEATURES])


def _usage(subs: DataFrame, usage: DataFrame, as_ofs: list[Moment]) -> DataFrame:
    """Usage of the subscriptions active at as_of, closed look-backs."""
    # Repeated uses in reach of an as-of collapse before anything else moves, so a busy subscription is small.
    recent = attach_as_of(usage, "usage_date", as_ofs, 30 * DAY, "both")
    recent = recent.groupBy("subscription_id", "usage_date", "feature_name", "as_of_time").agg(F.count(F.lit(1)).alias("n"))
    last = usage.groupBy("subscription_id").agg(
        F.array(
            *[
                F.struct(moment(a).alias("as_of_time"), F.max(F.when(F.col("usage_date") <= moment(a), F.col("usage_date"))).alias("usage_date"))
                for a in as_ofs
            ]
        ).alias("__last")
    )
    last = last.select("subscription_id", F.inline("__last")).filter(F.col("usage_date").isNotNull())
    rows = recent.unionByName(last.withColumn("n", F.lit(0)), allowMissingColumns=True)
    owners = active_rows(
        subs.select("subscription_id", "account_id", "start_date", "end_date"), "start_date", "end_date", as_ofs
    ).select("subscription_id", "account_id", "as_of_time").distinct()
    joined = rows.join(owners, ["subscription_id", "as_of_time"])
    a, t, n = F.col("as_of_time"), F.col("usage_date"), F.col("n")

    def inside(days: int) -> Column:
        return (t >= a - span(days * DAY)) & (n > 0)

    total = F.sum(F.when(inside(28), n).otherwise(0))
    first = F.sum(F.when(inside(28) & (t < a - span(21 * DAY)), n).otherwise(0))
    final = F.sum(F.when(inside(7), n).otherwise(0))
    return joined.groupBy("account_id", "as_of_time").agg(
        F.count_distinct(F.when(inside(30), F.to_date(t))).alias("active_days_30d"),
        final.alias("sessions_7d"),
        F.count_distinct(F.when(inside(14), F.col("feature_name"))).alias("core_feature_cnt_14d"),
        F.when(total >= 2, (final - first) / F.lit(4.0)).otherwise(F.lit(0.0)).alias("usage_slope_4w"),
        whole_days(F.max(t), a).alias("recency_days"),
    )


def _contracts(subs: DataFrame, as_ofs: list[Moment], tie: str) -> DataFrame:
    """Contract features and, from the same rows, whether the account is at risk (``__risk``)."""
    rows = per_as_of(subs, as_ofs, lambda a: F.col("start_date") <= a)
    a = F.col("as_of_time")
    ninety = span(90 * DAY)
    fresh = F.col("start_date") >= a - ninety
    changed = F.coalesce(F.col("upgrade_flag"), F.lit(False)) | F.coalesce(F.col("downgrade_flag"), F.lit(False))
    days = F.coalesce(overlap_days("start_date", "end_date", a - ninety, a), F.lit(0))
    revenue = prorated(days, F.col("billing_frequency"), F.col("mrr_amount"), F.col("arr_amount"))
    return rows.groupBy("account_id", "as_of_time").agg(
        F.max((fresh & changed).cast("int")).alias("price_change_flag"),
        (F.sum(revenue) / 90).alias("avg_revenue_90d"),
        F.max_by(F.when(F.col("plan_tier").isNotNull(), ordinal("plan_tier", PLAN_CODES, 0)), F.struct("start_date", tie)).alias("plan_tier"),
        F.max(active_at("start_date", "end_date", a).cast("int")).alias("__risk"),
    )


def _support(tickets: DataFrame, as_ofs: list[Moment]) -> DataFrame:
    return build_features(
        tickets, "account_id", "submitted_at", as_ofs,
        [
            Feature("tickets_30d", "count", 30 * DAY, closed="both"),
            Feature("avg_resolution_hours_90d", "mean", 90 * DAY, "resolution_time_hours", closed="both", default=0.0),
            Feature("high_sev_ticket_30d", "count", 30 * DAY, where=F.col("priority").isin("high", "urgent"), closed="both"),
        ],
    )
