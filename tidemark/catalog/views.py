"""Fixture views that give the library's schemas real rows.

One template serves both engines: ``{name}`` is a DataFrame in Spark and a
plain table or CTE name in the comparison SQL.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

VIEWS = {
    "accounts_v": """SELECT c_custkey AS account_id, c_mktsegment AS industry,
        CASE c_nationkey % 3 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Pro' ELSE 'Enterprise' END AS plan_tier FROM {customer}""",
    "subscriptions_v": """SELECT o_orderkey AS subscription_id, o_custkey AS account_id, o_orderdate AS start_date,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate + (30 + o_orderkey % 400) * INTERVAL '1' DAY END AS end_date,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Enterprise' WHEN '2-HIGH' THEN 'Pro' WHEN '3-MEDIUM' THEN NULL ELSE 'Basic' END AS plan_tier,
        o_totalprice / 1e3 AS mrr_amount, o_totalprice * 12 / 1e3 AS arr_amount,
        CASE WHEN o_orderstatus = 'F' THEN 'annual' WHEN o_orderstatus = 'O' THEN 'monthly' ELSE NULL END AS billing_frequency,
        o_orderpriority = '1-URGENT' AS upgrade_flag, o_orderpriority = '5-LOW' AS downgrade_flag FROM {orders}""",
    "feature_usage_v": """SELECT l_orderkey AS subscription_id, l_shipdate AS usage_date,
        concat('feature_', cast(l_partkey % 40 AS string)) AS feature_name, l_linenumber AS usage_count FROM {lineitem}""",
    "churn_events_v": """SELECT o_custkey AS account_id, o_orderdate + INTERVAL '45' DAY AS churn_date
        FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED'""",
    "support_tickets_v": """SELECT l_orderkey * 10 + l_linenumber AS ticket_id, o_custkey AS account_id, l_shipdate AS submitted_at,
        CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS resolution_time_hours,
        CASE l_linenumber % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'urgent' END AS priority
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "behavior_v": """SELECT event_id, user_id, ts AS event_time,
        CASE event_type WHEN 'view' THEN 'session_start' WHEN 'click' THEN 'feature_use' ELSE event_type END AS event_type,
        props AS feature_name FROM {events}""",
    "payments_v": """SELECT event_id, user_id, ts AS event_time, value AS amount,
        CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success' ELSE 'pending' END AS status FROM {events}""",
    "plan_log_v": """SELECT event_id, user_id, ts AS event_time, CASE WHEN event_type = 'signup' THEN 20e0 ELSE 10e0 END AS price,
        CASE WHEN event_type = 'click' AND value > 50 THEN 'SAVE' ELSE NULL END AS coupon_code,
        CASE event_type WHEN 'signup' THEN 'pro' WHEN 'purchase' THEN 'basic' ELSE 'free' END AS plan FROM {events}""",
    "event_tickets_v": """SELECT event_id, user_id, ts AS created_at,
        CASE WHEN value > 80 THEN 'critical' WHEN value > 40 THEN 'high' ELSE 'low' END AS severity,
        CASE WHEN value < 20 THEN NULL ELSE value END AS resolution_time_hours FROM {events} WHERE event_type = 'error'""",
    "transactions_v": """SELECT event_id AS transaction_id, user_id, ts AS event_time, value AS amount, value * 100 AS amount_usd,
        concat('dev_', cast((user_id * 7 + event_id % 5) % 97 AS string)) AS device_id,
        concat('C', cast((user_id + event_id % 3) % 20 AS string)) AS ip_address_country,
        CASE event_type WHEN 'purchase' THEN 'credit_card' WHEN 'view' THEN 'debit_card' WHEN 'click' THEN 'crypto' WHEN 'error' THEN 'cheque' ELSE NULL END AS payment_method,
        CASE event_type WHEN 'error' THEN 'XXX' WHEN 'signup' THEN 'EUR' ELSE 'USD' END AS currency, event_type FROM {events}""",
    "risk_signals_v": """SELECT event_id AS transaction_id, user_id, ts AS event_time,
        CASE event_id % 4 WHEN 0 THEN 'chargeback' WHEN 1 THEN 'fraud_flag' WHEN 2 THEN 'velocity_alert' ELSE 'device_alert' END AS signal_type,
        (event_id * 37 % 100) / 1e2 AS signal_value FROM {events} WHERE event_type = 'error'""",
    "profile_snapshots_v": """SELECT user_id, ts AS snapshot_time, event_id, cast(floor(value * 10) AS bigint) AS account_age_days,
        CASE event_id % 4 WHEN 0 THEN 'verified' WHEN 1 THEN 'pending' WHEN 2 THEN 'rejected' ELSE 'not_started' END AS kyc_status,
        CASE WHEN value > 50 THEN 'active' ELSE 'suspended' END AS account_status FROM {events} WHERE event_type = 'signup'""",
    "fraud_labels_v": """SELECT event_id AS transaction_id, ts AS event_time, ts + (event_id % 12) * INTERVAL '1' DAY AS label_time,
        CASE WHEN value > 60 THEN 1 ELSE 0 END AS fraud_label FROM {events} WHERE event_type = 'purchase'""",
    "scored_v": """SELECT doc_id, quality AS y, 0.2e0 * quality + 0.8e0 * ((doc_id * 7919) % 1000) / 1e3 AS p, toxic AS stratum FROM {labels}""",
    "txn_scored_v": """SELECT transaction_id, user_id, event_time, amount_usd, (transaction_id * 7919 % 1000) / 1e3 AS risk_score,
        transaction_id % 7 = 0 AS is_new_device, transaction_id % 11 = 0 AS country_change_flag_24h,
        CASE WHEN transaction_id * 7919 % 1000 > 700 AND transaction_id % 3 = 0 THEN 1 ELSE 0 END AS is_fraud FROM {transactions_v}""",
    "user_scores_v": """SELECT c_custkey AS user_id, (c_custkey * 7919 % 1000) / 1e3 AS churn_prob,
        CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0e0 END AS ltv_90d, c_mktsegment AS segment,
        CASE WHEN c_acctbal < 2000 THEN 1 ELSE 0 END AS churn FROM {customer}""",
    "ltv_scored_v": """SELECT o_orderkey AS id, o_totalprice AS y, o_totalprice * (0.8e0 + (o_orderkey % 41) / 1e2) AS yhat, o_orderstatus AS stratum FROM {orders}""",
    "audit_v": """SELECT concat('req_', cast(event_id AS string)) AS request_id, CASE WHEN event_type IN ('click', 'view') THEN 'churn' ELSE 'fraud' END AS domain,
        user_id AS entity_key, concat('{{"decision": "', CASE event_id % 3 WHEN 0 THEN 'APPROVE' WHEN 1 THEN 'REJECT' ELSE 'MANUAL_REVIEW' END,
        '", "recommended_action": "', CASE event_id % 4 WHEN 0 THEN 'NO_ACTION' WHEN 1 THEN 'OFFER_5' WHEN 2 THEN 'OFFER_10' ELSE 'CALL_SUPPORT' END, '"}}') AS decision,
        cast(event_id * 13 % 400 AS int) AS latency_ms, CASE WHEN value > 98 THEN 500 ELSE 200 END AS status, ts AS created_at FROM {events}""",
    "feedback_v": """SELECT request_id, cast(latency_ms % 5 + 1 AS int) AS rating,
        CASE WHEN latency_ms % 3 = 0 THEN NULL ELSE (latency_ms % 100) / 1e2 END AS faithfulness, created_at FROM {audit_v}""",
    "gold_v": """SELECT b.item_id AS query_id, d.doc_id FROM {benchmark} b JOIN {documents} d ON contains(d.text, b.text)""",
}


def _names(template: str) -> list[str]:
    return [name for _, name, _, _ in string.Formatter().parse(template) if name]


class Tables:
    """The given tables of one folder plus the views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in VIEWS:
            template = VIEWS[name]
            needed = {n: getattr(self, n) for n in _names(template)}
            return self.spark.sql(template, **needed)
        raise AttributeError(name)


def with_views(names: str, body: str) -> str:
    """Comparison SQL: the needed views as CTEs in front of ``body``."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for inner in _names(VIEWS[name]):
            need(inner)
        ordered.append(name)

    for name in names.split():
        need(name)
    ctes = []
    for name in ordered:
        template = VIEWS[name]
        ctes.append(f"{name} AS ({template.format(**{n: n for n in _names(template)})})")
    body = body.strip()
    recursive = body.startswith("WITH RECURSIVE ")
    if recursive:
        body = body.removeprefix("WITH RECURSIVE ")
        joiner = ", "
    elif body.startswith("WITH "):
        body = body.removeprefix("WITH ")
        joiner = ", "
    else:
        joiner = " "
    if not ctes:
        head = "WITH RECURSIVE " if recursive else "WITH " if joiner == ", " else ""
        return head + body
    return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join(ctes) + joiner + body
