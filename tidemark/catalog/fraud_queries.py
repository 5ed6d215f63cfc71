"""Queries over transaction, device and risk features and the rule policy."""

from datetime import timedelta

from pyspark.sql import DataFrame

from ..operators import fraud, policy
from .feature_queries import EVENT_AS_OF, EVENT_AS_OFS, as_of_values, in_window, rounded
from .registry import query
from .views import Tables

HOUR = timedelta(hours=1)


@query(
    "risk_features", "risk_signals_v",
    f"""SELECT user_id, as_of_time, count(*) FILTER (signal_type = 'chargeback') AS chargeback_count_90d,
      count(*) FILTER (signal_type = 'fraud_flag') AS fraud_flag_count_90d,
      coalesce(max(signal_value) FILTER (signal_type = 'velocity_alert'), 0) AS velocity_risk_score,
      coalesce(max(signal_value) FILTER (signal_type = 'device_alert'), 0) AS device_risk_score
    FROM risk_signals_v, {as_of_values(EVENT_AS_OFS)} WHERE {in_window('event_time', 'as_of_time', 90)} GROUP BY ALL""",
)
def risk_features(t: Tables) -> DataFrame:
    return fraud.risk_group(t.risk_signals_v, "user_id", EVENT_AS_OFS)


_DEVICE_AS_OF = "2024-01-30 00:00:00"
_DAY = f"event_time >= TIMESTAMP '{_DEVICE_AS_OF}' - INTERVAL 1 DAY AND event_time < TIMESTAMP '{_DEVICE_AS_OF}'"


@query(
    "device_features", "transactions_v",
    f"""WITH seen AS (SELECT device_id, min(event_time) AS first_seen FROM transactions_v WHERE event_time < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1)
      SELECT t.transaction_id, t.device_id, coalesce(first_seen >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 90 DAY, TRUE) AS is_new_device
      FROM transactions_v t LEFT JOIN seen USING (device_id)""",
)
def device_features(t: Tables) -> DataFrame:
    spine = t.transactions_v.select("transaction_id", "device_id")
    return fraud.new_device_flags(spine, t.transactions_v, "2024-01-20 00:00:00").select("transaction_id", "device_id", "is_new_device")


@query(
    "fraud_features", "transactions_v risk_signals_v profile_snapshots_v",
    f"""WITH x AS (SELECT * FROM transactions_v WHERE event_time < TIMESTAMP '{_DEVICE_AS_OF}'),
      v AS (SELECT user_id, count(*) FILTER (event_time >= TIMESTAMP '{_DEVICE_AS_OF}' - INTERVAL 1 HOUR) AS transaction_count_1h,
        count(*) FILTER (event_time >= TIMESTAMP '{_DEVICE_AS_OF}' - INTERVAL 24 HOUR) AS transaction_count_24h,
        count(*) FILTER (event_time >= TIMESTAMP '{_DEVICE_AS_OF}' - INTERVAL 7 DAY) AS transaction_count_7d,
        coalesce(sum(amount) FILTER (event_time >= TIMESTAMP '{_DEVICE_AS_OF}' - INTERVAL 24 HOUR), 0) AS total_amount_24h,
        coalesce(avg(amount) FILTER (event_time >= TIMESTAMP '{_DEVICE_AS_OF}' - INTERVAL 7 DAY), 0) AS avg_amount_7d,
        coalesce(max(amount) FILTER (event_time >= TIMESTAMP '{_DEVICE_AS_OF}' - INTERVAL 30 DAY), 0) AS max_amount_30d,
        count(DISTINCT ip_address_country) FILTER ({_DAY}) > 1 AS country_change_flag_24h FROM x GROUP BY 1),
      r AS (SELECT user_id, count(*) FILTER (signal_type = 'chargeback') AS chargeback_count_90d, count(*) FILTER (signal_type = 'fraud_flag') AS fraud_flag_count_90d,
        max(signal_value) FILTER (signal_type = 'velocity_alert') AS velocity_risk_score, max(signal_value) FILTER (signal_type = 'device_alert') AS device_risk_score
        FROM risk_signals_v WHERE event_time < TIMESTAMP '{_DEVICE_AS_OF}' AND event_time >= TIMESTAMP '{_DEVICE_AS_OF}' - INTERVAL 90 DAY GROUP BY 1),
      d AS (SELECT device_id, min(event_time) AS f FROM x GROUP BY 1),
      p AS (SELECT * FROM profile_snapshots_v WHERE snapshot_time <= TIMESTAMP '{_DEVICE_AS_OF}'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY snapshot_time DESC, event_id DESC) = 1)
      SELECT x.transaction_id, x.user_id, x.amount, x.amount_usd, x.currency, x.device_id, x.ip_address_country,
        d.f >= TIMESTAMP '{_DEVICE_AS_OF}' - INTERVAL 90 DAY AS is_new_device,
        v.transaction_count_1h, v.transaction_count_24h, v.transaction_count_7d, round(v.total_amount_24h, 6) AS total_amount_24h,
        round(v.avg_amount_7d, 6) AS avg_amount_7d, v.max_amount_30d, v.country_change_flag_24h,
        coalesce(chargeback_count_90d, 0) AS chargeback_count_90d, coalesce(fraud_flag_count_90d, 0) AS fraud_flag_count_90d,
        coalesce(velocity_risk_score, 0) AS velocity_risk_score, coalesce(device_risk_score, 0) AS device_risk_score,
        coalesce(account_age_days, 0) AS account_age_days, kyc_status, account_status, 'fs_fraud_v1' AS feature_set_version,
        TIMESTAMP '{_DEVICE_AS_OF}' AS event_time
      FROM x JOIN v USING (user_id) JOIN d USING (device_id) LEFT JOIN r USING (user_id) LEFT JOIN p USING (user_id) WHERE {_DAY.replace('event_time', 'x.event_time')}""",
)
def fraud_features(t: Tables) -> DataFrame:
    keep = ["amount", "amount_usd", "currency", "device_id", "ip_address_country"]
    out = fraud.fraud_features(
        t.transactions_v, t.transactions_v, t.risk_signals_v, t.profile_snapshots_v, _DEVICE_AS_OF, keep, profile_tie="event_id"
    )
    return rounded(out, "total_amount_24h", "avg_amount_7d")


@query(
    "velocity_per_event", "events",
    """SELECT event_id, user_id,
      count(*) OVER h AS count_1h, round(coalesce(sum(value) OVER h, 0), 6) AS sum_1h, max(value) OVER h AS max_1h,
      count(*) OVER d AS count_24h, round(coalesce(sum(value) OVER d, 0), 6) AS sum_24h, max(value) OVER d AS max_24h,
      count(*) OVER w AS count_7d, round(coalesce(sum(value) OVER w, 0), 6) AS sum_7d, max(value) OVER w AS max_7d
    FROM events WINDOW h AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING),
      d AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING),
      w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 604800000000 PRECEDING AND 1 PRECEDING)""",
)
def velocity_per_event(t: Tables) -> DataFrame:
    windows = {"1h": HOUR, "24h": 24 * HOUR, "7d": 168 * HOUR}
    out = fraud.velocity_per_event(t.events, "user_id", "ts", "value", "event_id", windows)
    return rounded(out, "sum_1h", "sum_24h", "sum_7d")


@query(
    "mature_labels", "fraud_labels_v",
    """SELECT * FROM fraud_labels_v WHERE label_time >= event_time + INTERVAL 7 DAY AND label_time <= TIMESTAMP '2024-01-31 00:00:00'""",
)
def mature_labels(t: Tables) -> DataFrame:
    return fraud.mature_labels(t.fraud_labels_v, EVENT_AS_OF)


_RULES_SQL = """CASE WHEN risk_score >= 0.9 THEN 'high_risk_reject'
  WHEN risk_score >= 0.7 AND amount_usd >= 10000 THEN 'high_amount_manual_review'
  WHEN risk_score >= 0.6 AND is_new_device THEN 'new_device_manual_review'
  WHEN risk_score >= 0.6 AND country_change_flag_24h THEN 'country_change_manual_review'
  WHEN risk_score >= 0.5 THEN 'medium_risk_manual_review' WHEN risk_score < 0.5 THEN 'low_risk_approve' END"""
_DECIDED = f"""decided AS (SELECT *, {_RULES_SQL} AS rule_applied FROM txn_scored_v),
  d2 AS (SELECT *, CASE WHEN rule_applied = 'high_risk_reject' THEN 'REJECT' WHEN rule_applied = 'low_risk_approve' THEN 'APPROVE' ELSE 'MANUAL_REVIEW' END AS decision FROM decided)"""


@query(
    "rule_policy", "txn_scored_v",
    f"WITH {_DECIDED} SELECT transaction_id, risk_score, amount_usd, decision, rule_applied AS reason, rule_applied FROM d2",
)
def rule_policy(t: Tables) -> DataFrame:
    out = policy.apply_rules(t.txn_scored_v, policy.DEFAULT_RULES)
    return out.select("transaction_id", "risk_score", "amount_usd", "decision", "reason", "rule_applied")


@query(
    "decision_rates", "txn_scored_v",
    f"""WITH {_DECIDED} SELECT round(avg(CASE WHEN decision = 'APPROVE' THEN 1e0 ELSE 0e0 END), 6) AS approval_rate,
      round(avg(CASE WHEN decision = 'REJECT' THEN 1e0 ELSE 0e0 END), 6) AS rejection_rate,
      round(avg(CASE WHEN decision = 'MANUAL_REVIEW' THEN 1e0 ELSE 0e0 END), 6) AS manual_review_rate, count(*) AS total FROM d2""",
)
def decision_rates(t: Tables) -> DataFrame:
    out = policy.decision_rates(policy.apply_rules(t.txn_scored_v, policy.DEFAULT_RULES))
    return rounded(out, "approval_rate", "rejection_rate", "manual_review_rate")


@query(
    "policy_metrics", "txn_scored_v",
    f"""WITH {_DECIDED} SELECT round(avg(CASE WHEN decision = 'APPROVE' THEN 1e0 ELSE 0e0 END), 6) AS approval_rate,
      round(avg(CASE WHEN decision = 'REJECT' THEN 1e0 ELSE 0e0 END), 6) AS rejection_rate,
      round(avg(CASE WHEN decision = 'MANUAL_REVIEW' THEN 1e0 ELSE 0e0 END), 6) AS manual_review_rate, count(*) AS total,
      round(avg(is_fraud) FILTER (decision = 'APPROVE'), 6) AS false_positive_rate,
      round(avg(1 - is_fraud) FILTER (decision = 'REJECT'), 6) AS false_negative_rate,
      round(count(*) FILTER (decision = 'REJECT' AND is_fraud = 0) * 1e0 / count(*) FILTER (is_fraud = 0), 6) AS legit_rejected_rate,
      round(count(*) FILTER (decision = 'APPROVE' AND is_fraud = 1) * 1e0 / count(*) FILTER (is_fraud = 1), 6) AS fraud_approved_rate FROM d2""",
)
def policy_metrics(t: Tables) -> DataFrame:
    out = policy.policy_metrics(policy.apply_rules(t.txn_scored_v, policy.DEFAULT_RULES), "is_fraud")
    return rounded(out, *[c for c in out.columns if c != "total"])


@query(
    "threshold_sweep", "txn_scored_v",
    """WITH th AS (SELECT i, i / 99e0 AS threshold FROM range(100) r(i))
      SELECT round(threshold, 6) AS threshold, round(avg(CASE WHEN risk_score < least(threshold, 0.9) THEN 1e0 ELSE 0e0 END), 6) AS approve_rate,
      round(avg(CASE WHEN risk_score >= greatest(threshold, 0.9) THEN 1e0 ELSE 0e0 END), 6) AS reject_rate,
      round(avg(CASE WHEN risk_score >= least(threshold, 0.9) AND risk_score < greatest(threshold, 0.9) THEN 1e0 ELSE 0e0 END), 6) AS manual_review_rate
      FROM txn_scored_v, th GROUP BY th.threshold""",
)
def threshold_sweep(t: Tables) -> DataFrame:
    out = policy.threshold_sweep(t.txn_scored_v, "risk_score")
    return rounded(out, "threshold", "approve_rate", "reject_rate", "manual_review_rate")


@query(
    "fraud_reasons", "txn_scored_v",
    """SELECT transaction_id, list_filter([CASE WHEN risk_score >= 0.9 THEN 'HIGH_RISK_SCORE' WHEN risk_score >= 0.7 THEN 'MEDIUM_RISK_SCORE' END,
      CASE WHEN is_new_device THEN 'NEW_DEVICE' END, CASE WHEN country_change_flag_24h THEN 'COUNTRY_CHANGE' END,
      CASE WHEN amount_usd > 10000 THEN 'HIGH_AMOUNT' END], lambda x: x IS NOT NULL) AS reason_codes FROM txn_scored_v""",
)
def fraud_reasons(t: Tables) -> DataFrame:
    return t.txn_scored_v.select("transaction_id", policy.fraud_reason_codes(t.txn_scored_v.columns).alias("reason_codes"))
