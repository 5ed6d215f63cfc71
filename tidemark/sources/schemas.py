"""Explicit source schemas."""

from __future__ import annotations

# Dates arrive as text and are parsed leniently after the read.
SAAS = {
    "accounts": "account_id string, account_name string, industry string, country string, signup_date string, referral_source string, "
    "plan_tier string, seats int, is_trial boolean, churn_flag boolean",
    "subscriptions": "subscription_id string, account_id string, start_date string, end_date string, plan_tier string, seats int, mrr_amount double, "
    "arr_amount double, is_trial boolean, upgrade_flag boolean, downgrade_flag boolean, churn_flag boolean, billing_frequency string, auto_renew_flag boolean",
    "feature_usage": "usage_id string, subscription_id string, usage_date string, feature_name string, usage_count int, usage_duration_secs int, "
    "error_count int, is_beta_feature boolean",
    "support_tickets": "ticket_id string, account_id string, submitted_at string, closed_at string, resolution_time_hours double, priority string, "
    "first_response_time_minutes int, satisfaction_score int, escalation_flag boolean",
    "churn_events": "churn_event_id string, account_id string, churn_date string, reason_code string, refund_amount_usd double, "
    "preceding_upgrade_flag boolean, preceding_downgrade_flag boolean, is_reactivation boolean, feedback_text string",
}
SAAS_TIMES = {
    "accounts": ["signup_date"],
    "subscriptions": ["start_date", "end_date"],
    "feature_usage": ["usage_date"],
    "support_tickets": ["submitted_at", "closed_at"],
    "churn_events": ["churn_date"],
}

TRANSACTIONS = (
    "transaction_id string, event_time timestamp_ntz, processing_time timestamp_ntz, amount double, amount_usd double, currency string, "
    "payment_method string, merchant_category string, user_id string, device_id string, ip_address string, ip_address_country string"
)
BEHAVIOR = (
    "user_id string, transaction_id string, event_time timestamp_ntz, amount double, currency string, payment_method string, "
    "device_id string, ip_address_country string"
)
RISK_SIGNALS = (
    "transaction_id string, user_id string, event_time timestamp_ntz, signal_type string, signal_value double, metadata map<string,string>"
)
PROFILES = (
    "user_id string, account_created_at timestamp_ntz, account_age_days int, kyc_status string, account_status string, "
    "last_updated timestamp_ntz, snapshot_time timestamp_ntz"
)
FRAUD_LABELS = "transaction_id string, as_of_time timestamp_ntz, fraud_label int, label_time timestamp_ntz, investigation_days int"

EVAL_SET = "query string, gold_answer string, gold_evidence array<struct<chunk_id:string,page:string>>"
CHUNKS = "chunk_id string, content string, source_id string, page int, section string, created_at string, hash string"

ONLINE = (
    "domain string, entity_key string, feature_set_version string, features string, event_time timestamp_ntz, "
    "materialized_at timestamp_ntz, ttl_seconds bigint"
)
AUDIT = (
    "request_id string, domain string, model_name string, model_version string, feature_set_version string, feature_snapshot_hash string, "
    "entity_key string, latency_ms int, predictions string, decision string, warnings array<string>, trace_id string, created_at timestamp_ntz"
)
FEEDBACK = "request_id string, rating int, reason string, notes string, created_at timestamp_ntz"
