"""Queries over sources, feature groups, labels, as-of joins and splits."""

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions.temporal import moment
from ..operators import asof, features as ft, saas, spine
from ..operators.ordered import latest_per_key
from ..plans import churn as churn_plan
from .registry import query
from .views import Tables

DAY = timedelta(days=1)
EVENT_AS_OF = "2024-01-31 00:00:00"
EVENT_AS_OFS = ["2024-01-16 00:00:00", "2024-01-31 00:00:00"]
SAAS_AS_OFS = ["1998-07-01 00:00:00", "1999-07-01 00:00:00", "2000-07-01 00:00:00"]


def in_window(ts: str, as_of: str, days: int, closed: str = "left") -> str:
    upper = "<=" if closed == "both" else "<"
    return f"({ts} >= {as_of} - INTERVAL {days} DAY AND {ts} {upper} {as_of})"


def as_of_values(values: list[str]) -> str:
    rows = ", ".join(f"(TIMESTAMP '{v}')" for v in values)
    return f"(VALUES {rows}) s(as_of_time)"


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    "user_velocity", "transactions_v",
    f"""SELECT user_id, s.as_of_time,
      count(*) FILTER (event_time >= s.as_of_time - INTERVAL 1 HOUR) AS transaction_count_1h,
      count(*) FILTER (event_time >= s.as_of_time - INTERVAL 24 HOUR) AS transaction_count_24h,
      count(*) FILTER (event_time >= s.as_of_time - INTERVAL 7 DAY) AS transaction_count_7d,
      round(coalesce(sum(amount) FILTER (event_time >= s.as_of_time - INTERVAL 24 HOUR), 0), 6) AS total_amount_24h,
      round(coalesce(avg(amount) FILTER (event_time >= s.as_of_time - INTERVAL 7 DAY), 0), 6) AS avg_amount_7d,
      max(amount) AS max_amount_30d
    FROM transactions_v, {as_of_values(EVENT_AS_OFS)}
    WHERE {in_window('event_time', 's.as_of_time', 30)} GROUP BY ALL""",
)
def user_velocity(t: Tables) -> DataFrame:
    from ..operators.fraud import velocity_group

    return rounded(velocity_group(t.transactions_v, "user_id", EVENT_AS_OFS), "total_amount_24h", "avg_amount_7d")


@query(
    "usage_features", "behavior_v",
    f"""SELECT user_id, s.as_of_time, count(DISTINCT CAST(event_time AS DATE)) AS active_days_30d,
      count(*) FILTER (event_type = 'session_start' AND event_time >= s.as_of_time - INTERVAL 7 DAY) AS sessions_7d,
      count(DISTINCT feature_name) FILTER (event_type = 'feature_use' AND event_time >= s.as_of_time - INTERVAL 14 DAY) AS core_feature_cnt_14d
    FROM behavior_v, {as_of_values(EVENT_AS_OFS)} WHERE {in_window('event_time', 's.as_of_time', 30)} GROUP BY ALL""",
)
def usage_features(t: Tables) -> DataFrame:
    return ft.usage_group(t.behavior_v, "user_id", EVENT_AS_OFS)


@query(
    "payment_features", "payments_v plan_log_v",
    f"""WITH a AS (SELECT user_id, as_of_time, count(*) FILTER (status = 'failed') AS payment_fail_30d
        FROM payments_v, {as_of_values(EVENT_AS_OFS)} WHERE {in_window('event_time', 'as_of_time', 30)} GROUP BY ALL),
      b AS (SELECT user_id, as_of_time, CASE WHEN count(DISTINCT price) > 1 THEN 1 ELSE 0 END AS price_change_flag,
        CASE WHEN count(coupon_code) > 0 THEN 1 ELSE 0 END AS discount_used_90d
        FROM plan_log_v, {as_of_values(EVENT_AS_OFS)} WHERE {in_window('event_time', 'as_of_time', 90)} GROUP BY ALL)
      SELECT user_id, as_of_time, coalesce(payment_fail_30d, 0) AS payment_fail_30d, coalesce(price_change_flag, 0) AS price_change_flag,
        coalesce(discount_used_90d, 0) AS discount_used_90d FROM a FULL JOIN b USING (user_id, as_of_time)""",
)
def payment_features(t: Tables) -> DataFrame:
    return ft.payment_group(t.payments_v, t.plan_log_v, "user_id", EVENT_AS_OFS)


@query(
    "support_features", "event_tickets_v",
    f"""SELECT user_id, as_of_time, count(*) FILTER (created_at >= as_of_time - INTERVAL 30 DAY) AS tickets_30d,
      round(coalesce(avg(resolution_time_hours), 0), 6) AS avg_resolution_hours_90d,
      count(*) FILTER (created_at >= as_of_time - INTERVAL 30 DAY AND severity IN ('high', 'critical')) AS high_sev_ticket_30d
    FROM event_tickets_v, {as_of_values(EVENT_AS_OFS)} WHERE {in_window('created_at', 'as_of_time', 90)} GROUP BY ALL""",
)
def support_features(t: Tables) -> DataFrame:
    return rounded(ft.support_group(t.event_tickets_v, "user_id", EVENT_AS_OFS), "avg_resolution_hours_90d")


@query(
    "trend_features", "behavior_v",
    f"""SELECT user_id, as_of_time,
      round(coalesce(count(*) FILTER (event_time >= as_of_time - INTERVAL 28 DAY) * 1e0
        / nullif(count(DISTINCT floor(epoch(event_time) / 604800)) FILTER (event_time >= as_of_time - INTERVAL 28 DAY), 0), 0), 6) AS usage_slope_4w,
      CAST(floor((epoch(as_of_time) - epoch(max(event_time))) / 86400) AS BIGINT) AS recency_days,
      round(CASE WHEN count(*) FILTER (event_time >= as_of_time - INTERVAL 28 DAY) >= 2
        THEN (count(*) FILTER (event_time >= as_of_time - INTERVAL 7 DAY)
            - count(*) FILTER (event_time >= as_of_time - INTERVAL 28 DAY AND event_time < as_of_time - INTERVAL 21 DAY)) / 4e0 ELSE 0e0 END, 6) AS two_ended,
      round((-1.5e0 * count(*) FILTER (event_time >= as_of_time - INTERVAL 28 DAY AND event_time < as_of_time - INTERVAL 21 DAY)
        - 0.5e0 * count(*) FILTER (event_time >= as_of_time - INTERVAL 21 DAY AND event_time < as_of_time - INTERVAL 14 DAY)
        + 0.5e0 * count(*) FILTER (event_time >= as_of_time - INTERVAL 14 DAY AND event_time < as_of_time - INTERVAL 7 DAY)
        + 1.5e0 * count(*) FILTER (event_time >= as_of_time - INTERVAL 7 DAY)) / 5, 6) AS least_squares
    FROM behavior_v, {as_of_values(EVENT_AS_OFS)} WHERE event_time < as_of_time GROUP BY 1, 2""",
)
def trend_features(t: Tables) -> DataFrame:
    features = [
        ft.Feature("usage_slope_4w", "weekly_mean", 28 * DAY),
        ft.Feature("recency_days", "recency"),
        ft.Feature("two_ended", "slope", 28 * DAY),
        ft.Feature("least_squares", "regr_slope", 28 * DAY),
    ]
    out = ft.build_features(t.behavior_v, "user_id", "event_time", EVENT_AS_OFS, features)
    return rounded(out, "usage_slope_4w", "two_ended", "least_squares")


@query(
    "value_features", "payments_v plan_log_v",
    f"""WITH a AS (SELECT user_id, as_of_time, avg(amount) FILTER (status = 'success') AS avg_revenue_90d
        FROM payments_v, {as_of_values(EVENT_AS_OFS)} WHERE {in_window('event_time', 'as_of_time', 90)} GROUP BY ALL),
      b AS (SELECT user_id, as_of_time, arg_max(plan, (event_time, event_id)) AS plan_tier
        FROM plan_log_v, {as_of_values(EVENT_AS_OFS)} WHERE event_time < as_of_time GROUP BY ALL)
      SELECT user_id, as_of_time, round(avg_revenue_90d, 6) AS avg_revenue_90d, plan_tier FROM a FULL JOIN b USING (user_id, as_of_time)""",
)
def value_features(t: Tables) -> DataFrame:
    return rounded(ft.value_group(t.payments_v, t.plan_log_v, "user_id", EVENT_AS_OFS, tie="event_id"), "avg_revenue_90d")


@query(
    "event_log_features", "behavior_v payments_v plan_log_v event_tickets_v",
    f"""WITH spine AS (SELECT DISTINCT user_id, as_of_time FROM behavior_v, {as_of_values(EVENT_AS_OFS)} WHERE event_time < as_of_time),
      u AS (SELECT user_id, as_of_time, count(DISTINCT CAST(event_time AS DATE)) FILTER (event_time >= as_of_time - INTERVAL 30 DAY) AS active_days_30d,
        count(*) FILTER (event_type = 'session_start' AND event_time >= as_of_time - INTERVAL 7 DAY) AS sessions_7d,
        count(DISTINCT feature_name) FILTER (event_type = 'feature_use' AND event_time >= as_of_time - INTERVAL 14 DAY) AS core_feature_cnt_14d,
        coalesce(count(*) FILTER (event_time >= as_of_time - INTERVAL 28 DAY) * 1e0
          / nullif(count(DISTINCT floor(epoch(event_time) / 604800)) FILTER (event_time >= as_of_time - INTERVAL 28 DAY), 0), 0) AS usage_slope_4w,
        CAST(floor((epoch(as_of_time) - epoch(max(event_time))) / 86400) AS BIGINT) AS recency_days
        FROM behavior_v JOIN spine USING (user_id) WHERE event_time < as_of_time GROUP BY 1, 2),
      p AS (SELECT user_id, as_of_time, count(*) FILTER (status = 'failed' AND event_time >= as_of_time - INTERVAL 30 DAY) AS payment_fail_30d,
        avg(amount) FILTER (status = 'success' AND event_time >= as_of_time - INTERVAL 90 DAY) AS avg_revenue_90d
        FROM payments_v JOIN spine USING (user_id) WHERE event_time < as_of_time GROUP BY ALL),
      l AS (SELECT user_id, as_of_time, CASE WHEN count(DISTINCT price) FILTER (event_time >= as_of_time - INTERVAL 90 DAY) > 1 THEN 1 ELSE 0 END AS price_change_flag,
        CASE WHEN count(coupon_code) FILTER (event_time >= as_of_time - INTERVAL 90 DAY) > 0 THEN 1 ELSE 0 END AS discount_used_90d,
        arg_max(plan, (event_time, event_id)) AS plan_tier FROM plan_log_v JOIN spine USING (user_id) WHERE event_time < as_of_time GROUP BY ALL),
      s AS (SELECT user_id, as_of_time, count(*) FILTER (created_at >= as_of_time - INTERVAL 30 DAY) AS tickets_30d,
        avg(resolution_time_hours) FILTER (created_at >= as_of_time - INTERVAL 90 DAY) AS avg_resolution_hours_90d,
        count(*) FILTER (created_at >= as_of_time - INTERVAL 30 DAY AND severity IN ('high', 'critical')) AS high_sev_ticket_30d
        FROM event_tickets_v JOIN spine USING (user_id) WHERE created_at < as_of_time GROUP BY ALL)
      SELECT user_id, as_of_time, active_days_30d, sessions_7d, core_feature_cnt_14d, payment_fail_30d, price_change_flag, discount_used_90d,
        coalesce(tickets_30d, 0) AS tickets_30d, round(coalesce(avg_resolution_hours_90d, 0), 6) AS avg_resolution_hours_90d,
        coalesce(high_sev_ticket_30d, 0) AS high_sev_ticket_30d, round(usage_slope_4w, 6) AS usage_slope_4w, recency_days,
        round(coalesce(avg_revenue_90d, 0), 6) AS avg_revenue_90d, plan_tier, 'fs_churn_v1' AS feature_set_version, as_of_time AS event_time
      FROM u JOIN p USING (user_id, as_of_time) JOIN l USING (user_id, as_of_time) LEFT JOIN s USING (user_id, as_of_time)""",
)
def event_log_features(t: Tables) -> DataFrame:
    out = ft.event_log_features(
        t.behavior_v, t.payments_v, t.plan_log_v, t.event_tickets_v, "user_id", EVENT_AS_OFS, tie="event_id"
    )
    return rounded(out, "avg_resolution_hours_90d", "usage_slope_4w", "avg_revenue_90d")


@query(
    "churn_labels", "churn_events_v subscriptions_v",
    f"""WITH s AS (SELECT * FROM {as_of_values(SAAS_AS_OFS)}),
      spine AS (SELECT DISTINCT account_id, as_of_time FROM subscriptions_v, s WHERE start_date <= as_of_time AND (end_date IS NULL OR end_date > as_of_time)),
      gone AS (SELECT account_id, as_of_time FROM churn_events_v, s WHERE churn_date > as_of_time AND churn_date <= as_of_time + INTERVAL 30 DAY
        UNION SELECT account_id, as_of_time FROM subscriptions_v, s WHERE end_date > as_of_time AND end_date <= as_of_time + INTERVAL 30 DAY)
      SELECT account_id, as_of_time, CASE WHEN EXISTS (SELECT 1 FROM gone g WHERE g.account_id = spine.account_id AND g.as_of_time = spine.as_of_time) THEN 1 ELSE 0 END AS churn FROM spine""",
)
def churn_labels(t: Tables) -> DataFrame:
    return saas.churn_labels(t.churn_events_v, t.subscriptions_v, SAAS_AS_OFS)


_REVENUE = """CASE WHEN {hi} > {lo} THEN CASE WHEN coalesce(billing_frequency, 'monthly') = 'annual'
  THEN arr_amount * floor((epoch({hi}) - epoch({lo})) / 86400) / 365 ELSE mrr_amount * floor((epoch({hi}) - epoch({lo})) / 86400) / 30 END ELSE 0 END"""


@query(
    "ltv_labels", "subscriptions_v",
    f"""WITH s AS (SELECT * FROM {as_of_values(SAAS_AS_OFS)}),
      spine AS (SELECT DISTINCT account_id, as_of_time FROM subscriptions_v, s WHERE start_date <= as_of_time AND (end_date IS NULL OR end_date > as_of_time)),
      rev AS (SELECT account_id, as_of_time, sum({_REVENUE.format(hi="least(coalesce(end_date, as_of_time + INTERVAL 90 DAY), as_of_time + INTERVAL 90 DAY)", lo="greatest(start_date, as_of_time)")}) AS r
        FROM subscriptions_v, s WHERE start_date < as_of_time + INTERVAL 90 DAY AND (end_date IS NULL OR end_date > as_of_time) GROUP BY ALL)
      SELECT account_id, as_of_time, round(coalesce(r, 0), 6) AS ltv_90d FROM spine LEFT JOIN rev USING (account_id, as_of_time)""",
)
def ltv_labels(t: Tables) -> DataFrame:
    return rounded(saas.ltv_labels(t.subscriptions_v, SAAS_AS_OFS), "ltv_90d")


FEATURES_SQL = f"""WITH s AS (SELECT * FROM {as_of_values(SAAS_AS_OFS)}),
      act AS (SELECT subscription_id, account_id, as_of_time FROM subscriptions_v, s WHERE start_date <= as_of_time AND (end_date IS NULL OR end_date > as_of_time)),
      spine AS (SELECT DISTINCT account_id, as_of_time FROM act),
      u AS (SELECT account_id, as_of_time,
        count(DISTINCT usage_date) FILTER (usage_date >= as_of_time - INTERVAL 30 DAY) AS active_days_30d,
        count(*) FILTER (usage_date >= as_of_time - INTERVAL 7 DAY) AS sessions_7d,
        count(DISTINCT feature_name) FILTER (usage_date >= as_of_time - INTERVAL 14 DAY) AS core_feature_cnt_14d,
        CASE WHEN count(*) FILTER (usage_date >= as_of_time - INTERVAL 28 DAY) >= 2 THEN
          (count(*) FILTER (usage_date >= as_of_time - INTERVAL 7 DAY) - count(*) FILTER (usage_date >= as_of_time - INTERVAL 28 DAY AND usage_date < as_of_time - INTERVAL 21 DAY)) / 4e0 ELSE 0e0 END AS usage_slope_4w,
        CAST(floor((epoch(as_of_time) - epoch(max(usage_date))) / 86400) AS BIGINT) AS recency_days
        FROM act JOIN feature_usage_v USING (subscription_id) WHERE usage_date <= as_of_time GROUP BY 1, 2),
      c AS (SELECT account_id, as_of_time,
        max(CASE WHEN start_date >= as_of_time - INTERVAL 90 DAY AND (upgrade_flag OR downgrade_flag) THEN 1 ELSE 0 END) AS price_change_flag,
        sum({_REVENUE.format(hi="least(coalesce(end_date, as_of_time), as_of_time)", lo="greatest(start_date, as_of_time - INTERVAL 90 DAY)")}) / 90 AS avg_revenue_90d
        FROM subscriptions_v, s WHERE start_date <= as_of_time GROUP BY ALL),
      pl AS (SELECT account_id, as_of_time, plan_tier FROM subscriptions_v, s WHERE start_date <= as_of_time
        QUALIFY row_number() OVER (PARTITION BY account_id, as_of_time ORDER BY start_date DESC, subscription_id DESC) = 1),
      k AS (SELECT account_id, as_of_time, count(*) FILTER (submitted_at >= as_of_time - INTERVAL 30 DAY) AS tickets_30d,
        avg(resolution_time_hours) AS avg_resolution_hours_90d,
        count(*) FILTER (submitted_at >= as_of_time - INTERVAL 30 DAY AND priority IN ('high', 'urgent')) AS high_sev_ticket_30d
        FROM support_tickets_v, s WHERE submitted_at >= as_of_time - INTERVAL 90 DAY AND submitted_at <= as_of_time GROUP BY ALL)
      SELECT account_id, as_of_time, coalesce(active_days_30d, 0) AS active_days_30d, coalesce(sessions_7d, 0) AS sessions_7d,
        coalesce(core_feature_cnt_14d, 0) AS core_feature_cnt_14d, 0 AS payment_fail_30d, price_change_flag, 0 AS discount_used_90d,
        coalesce(tickets_30d, 0) AS tickets_30d, round(coalesce(avg_resolution_hours_90d, 0), 6) AS avg_resolution_hours_90d,
        coalesce(high_sev_ticket_30d, 0) AS high_sev_ticket_30d, coalesce(usage_slope_4w, 0) AS usage_slope_4w,
        coalesce(recency_days, 999) AS recency_days, round(avg_revenue_90d, 6) AS avg_revenue_90d,
        CASE coalesce(pl.plan_tier, a.plan_tier) WHEN 'Pro' THEN 1 WHEN 'Enterprise' THEN 2 ELSE 0 END AS plan_tier
      FROM spine LEFT JOIN u USING (account_id, as_of_time) LEFT JOIN c USING (account_id, as_of_time)
      LEFT JOIN pl USING (account_id, as_of_time) LEFT JOIN k USING (account_id, as_of_time) LEFT JOIN accounts_v a USING (account_id)"""


@query("saas_features", "accounts_v subscriptions_v feature_usage_v support_tickets_v", FEATURES_SQL)
def saas_features(t: Tables) -> DataFrame:
    out = saas.saas_features(t.accounts_v, t.subscriptions_v, t.feature_usage_v, t.support_tickets_v, SAAS_AS_OFS)
    return rounded(out, "avg_resolution_hours_90d", "avg_revenue_90d")


TRAINING_SQL = f"""WITH s AS (SELECT * FROM {as_of_values(SAAS_AS_OFS)}),
      act AS (SELECT * FROM subscriptions_v, s WHERE start_date <= as_of_time AND (end_date IS NULL OR end_date > as_of_time)),
      gone AS (SELECT account_id, as_of_time FROM churn_events_v, s WHERE churn_date > as_of_time AND churn_date <= as_of_time + INTERVAL 30 DAY
        UNION SELECT account_id, as_of_time FROM subscriptions_v, s WHERE end_date > as_of_time AND end_date <= as_of_time + INTERVAL 30 DAY),
      rev AS (SELECT account_id, as_of_time, sum({_REVENUE.format(hi="least(coalesce(end_date, as_of_time + INTERVAL 90 DAY), as_of_time + INTERVAL 90 DAY)", lo="greatest(start_date, as_of_time)")}) AS r
        FROM subscriptions_v, s WHERE start_date < as_of_time + INTERVAL 90 DAY AND (end_date IS NULL OR end_date > as_of_time) GROUP BY ALL)
      SELECT DISTINCT act.account_id, act.as_of_time, CASE WHEN gone.account_id IS NULL THEN 0 ELSE 1 END AS churn, round(r, 6) AS ltv_90d
      FROM act LEFT JOIN gone USING (account_id, as_of_time) JOIN rev USING (account_id, as_of_time)"""


@query("training_set", "churn_events_v subscriptions_v", TRAINING_SQL)
def training_set(t: Tables) -> DataFrame:
    keys = ["account_id", "as_of_time"]
    churn = saas.churn_labels(t.churn_events_v, t.subscriptions_v, SAAS_AS_OFS)
    ltv = rounded(saas.ltv_labels(t.subscriptions_v, SAAS_AS_OFS), "ltv_90d")
    return churn.join(ltv, keys)


@query(
    "training_table", "accounts_v subscriptions_v feature_usage_v support_tickets_v churn_events_v",
    f"WITH lab AS ({TRAINING_SQL}), feat AS ({FEATURES_SQL}) SELECT * FROM lab JOIN feat USING (account_id, as_of_time)",
)
def training_table(t: Tables) -> DataFrame:
    """Labels with all features, as models read them."""
    tables = {
        "accounts": t.accounts_v, "subscriptions": t.subscriptions_v, "feature_usage": t.feature_usage_v,
        "support_tickets": t.support_tickets_v, "churn_events": t.churn_events_v,
    }
    return rounded(churn_plan.training_table(tables, SAAS_AS_OFS), "ltv_90d", "avg_resolution_hours_90d", "avg_revenue_90d")


@query(
    "latest_snapshot", "profile_snapshots_v",
    """SELECT user_id, snapshot_time, event_id, kyc_status FROM profile_snapshots_v WHERE snapshot_time <= TIMESTAMP '2024-01-20 00:00:00'
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY snapshot_time DESC, event_id DESC) = 1""",
)
def latest_snapshot(t: Tables) -> DataFrame:
    seen = t.profile_snapshots_v.filter(F.col("snapshot_time") <= moment("2024-01-20 00:00:00"))
    return latest_per_key(seen.select("user_id", "snapshot_time", "event_id", "kyc_status"), ["user_id"], ["snapshot_time", "event_id"])


@query(
    "asof_join", "transactions_v profile_snapshots_v",
    """SELECT l.user_id, l.event_time AS label_time, l.transaction_id, f.snapshot_time, f.event_id, f.kyc_status
       FROM (SELECT * FROM transactions_v QUALIFY row_number() OVER (PARTITION BY user_id, event_time ORDER BY transaction_id DESC) = 1) l
       JOIN profile_snapshots_v f ON f.user_id = l.user_id AND f.snapshot_time < l.event_time
       QUALIFY row_number() OVER (PARTITION BY l.user_id, l.event_time ORDER BY f.snapshot_time DESC, f.event_id DESC) = 1""",
)
def asof_join(t: Tables) -> DataFrame:
    labels = t.transactions_v.select("user_id", F.col("event_time").alias("label_time"), "transaction_id")
    return asof.asof_join(
        labels, t.profile_snapshots_v, "user_id", "label_time", "snapshot_time", ["event_id", "kyc_status"], tie="event_id"
    )


@query(
    "asof_join_left", "orders",
    """SELECT l.o_custkey, l.o_orderdate, l.o_orderkey, f.o_orderdate AS prior_date, f.o_totalprice AS prior_price
       FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1) l
       LEFT JOIN orders f ON f.o_custkey = l.o_custkey AND f.o_orderdate < l.o_orderdate
       QUALIFY row_number() OVER (PARTITION BY l.o_custkey, l.o_orderdate ORDER BY f.o_orderdate DESC NULLS LAST, f.o_orderkey DESC) = 1""",
)
def asof_join_left(t: Tables) -> DataFrame:
    feats = t.orders.select("o_custkey", F.col("o_orderdate").alias("prior_date"), F.col("o_totalprice").alias("prior_price"), F.col("o_orderkey").alias("k"))
    labels = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return asof.asof_join(
        labels, feats, "o_custkey", "o_orderdate", "prior_date", ["prior_price"], tie="k", how="left", bucket=30 * DAY
    )


@query(
    "leakage_check", "events",
    """SELECT count(*) AS n_rows, count(*) FILTER (f.ts >= l.ts) AS violations, count(*) FILTER (f.ts >= l.ts) = 0 AS passed
       FROM (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'signup' GROUP BY 1) f
       JOIN (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'purchase' GROUP BY 1) l USING (user_id)""",
)
def leakage_check(t: Tables) -> DataFrame:
    feats = t.events.filter("event_type = 'signup'").groupBy("user_id").agg(F.max("ts").alias("feature_time"))
    labels = t.events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("label_time"))
    return asof.leakage_report(feats.join(labels, "user_id"), "feature_time", "label_time")


@query(
    "rolling_splits", "orders",
    """WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
       r AS (SELECT i + 1 AS split_id, part, s + to_days(CAST(30 * i + a AS INTEGER)) AS starts, s + to_days(CAST(30 * i + z AS INTEGER)) AS ends FROM b,
         (SELECT unnest(range(12)) AS i) g, (VALUES ('train', 0, 270), ('val', 270, 300), ('test', 300, 330)) p(part, a, z)
         WHERE s + to_days(CAST(30 * i + 330 AS INTEGER)) <= e)
       SELECT CAST(split_id AS INTEGER) AS split_id, part, starts, ends, count(*) AS n, round(avg(o_totalprice), 6) AS mean_price
       FROM r JOIN orders ON o_orderdate >= starts AND o_orderdate < ends GROUP BY ALL""",
)
def rolling_splits(t: Tables) -> DataFrame:
    start, end = spine.time_bounds(t.orders, "o_orderdate")
    rows = spine.assign_splits(t.orders, "o_orderdate", spine.rolling_splits(start, end, n_splits=12))
    out = rows.groupBy("split_id", "part", "starts", "ends").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean_price"))
    return rounded(out, "mean_price")


#: A declarative spec over transactions: sums, counts, latest values and flags with windows in hours and days.
_SPEC = {
    "features": [
        {"name": "count_6h", "source": "transactions", "window_hours": 6, "aggregation": "count"},
        {"name": "devices_7d", "source": "transactions", "window_days": 7, "aggregation": "count_distinct"},
        {"name": "amount_14d", "source": "transactions", "window_days": 14, "aggregation": "sum"},
        {"name": "largest_30d", "source": "transactions", "window_days": 30, "aggregation": "max"},
        {"name": "mean_30d", "source": "transactions", "window_days": 30, "aggregation": "mean"},
        {"name": "crypto_30d", "source": "transactions", "window_days": 30, "aggregation": "any"},
        {"name": "last_device", "source": "transactions", "window_days": 30, "aggregation": "latest"},
        {"name": "elsewhere", "source": "profiles", "window_days": 30, "aggregation": "count"},
    ]
}


@query(
    "spec_features", "transactions_v",
    f"""SELECT user_id, s.as_of_time, count(*) FILTER (event_time >= s.as_of_time - INTERVAL 6 HOUR) AS count_6h,
      count(DISTINCT device_id) FILTER (event_time >= s.as_of_time - INTERVAL 7 DAY) AS devices_7d,
      round(coalesce(sum(amount) FILTER (event_time >= s.as_of_time - INTERVAL 14 DAY), 0), 6) AS amount_14d, max(amount) AS largest_30d, round(avg(amount), 9) AS mean_30d,
      CAST(coalesce(bool_or(payment_method = 'crypto'), FALSE) AS INTEGER) AS crypto_30d, arg_max(device_id, (event_time, transaction_id)) AS last_device
    FROM transactions_v, {as_of_values(EVENT_AS_OFS)} WHERE {in_window('event_time', 's.as_of_time', 30)} GROUP BY ALL""",
)
def spec_features(t: Tables) -> DataFrame:
    """Features compiled from a parsed spec; entries of other sources are left out."""
    bindings = {
        "count_6h": {}, "devices_7d": {"column": "device_id"}, "amount_14d": {"column": "amount"}, "largest_30d": {"column": "amount"}, "mean_30d": {"column": "amount"},
        "crypto_30d": {"where": F.col("payment_method") == "crypto"}, "last_device": {"column": "device_id"}, "elsewhere": {},
    }
    rows = ft.build_features(t.transactions_v, "user_id", "event_time", EVENT_AS_OFS, ft.from_spec(_SPEC, "transactions", bindings), tie="transaction_id")
    return rounded(rounded(rows, "amount_14d"), "mean_30d", digits=9)
