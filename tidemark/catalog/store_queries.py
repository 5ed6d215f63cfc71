"""Queries over the online store, batch scoring, audit questions and service monitoring."""

from pyspark.sql import DataFrame, functions as F

from ..functions.temporal import moment
from ..operators import allocate as al, fraud, monitor as mo, policy
from ..plans import scoring
from ..sources import store as st
from .feature_queries import EVENT_AS_OF, EVENT_AS_OFS, rounded
from .registry import query
from .views import Tables

_NOW = "2024-01-31 06:00:00"
_TTL = 36 * 3600


_GENERATIONS = (("2024-01-16 00:00:00", "fs_v1"), ("2024-01-24 00:00:00", "fs_v1"), ("2024-01-31 00:00:00", "fs_v2"))


def _generations(t: Tables) -> list[DataFrame]:
    """Per-user history as materialised at three times; the second replaces the first, the third is another version."""
    out = []
    for at, version in _GENERATIONS:
        rows = t.events.filter(F.col("ts") < moment(at)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("event_time"))
        out.append(st.to_online(rows, "churn", version, "user_id", at, _TTL))
    return out


def _generation_sql(at: str, version: str) -> str:
    return f"""SELECT 'churn' AS domain, concat('user_id:', cast(user_id AS string)) AS entity_key, '{version}' AS feature_set_version, count(*) AS n, max(ts) AS event_time,
      TIMESTAMP '{at}' AS materialized_at, CAST({_TTL} AS BIGINT) AS ttl_seconds FROM events WHERE ts < TIMESTAMP '{at}' GROUP BY user_id"""


_STORE = "gens AS (" + " UNION ALL ".join(_generation_sql(*g) for g in _GENERATIONS) + """),
  store AS (SELECT * FROM gens QUALIFY row_number() OVER (PARTITION BY domain, entity_key, feature_set_version ORDER BY materialized_at DESC) = 1)"""


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("n", F.from_json("features", "n bigint").getField("n")).drop("features")


@query("feature_upsert", "events", f"WITH {_STORE} SELECT * FROM store")
def feature_upsert(t: Tables) -> DataFrame:
    return _flat(st.merge_online(*_generations(t)))


@query("ttl_expire", "events", f"WITH {_STORE} SELECT * FROM store WHERE NOT materialized_at + to_seconds(ttl_seconds) < TIMESTAMP '{_NOW}'")
def ttl_expire(t: Tables) -> DataFrame:
    return _flat(st.expire(st.merge_online(*_generations(t)), _NOW))


@query(
    "online_lookup", "events",
    f"""WITH {_STORE}, req AS (SELECT DISTINCT concat('user_id:', cast(user_id AS string)) AS entity_key FROM events)
      SELECT entity_key, s.n, s.event_time FROM req LEFT JOIN (SELECT * FROM store WHERE feature_set_version = 'fs_v1' AND NOT materialized_at + INTERVAL 200 HOUR < TIMESTAMP '{_NOW}') s USING (entity_key)""",
)
def online_lookup(t: Tables) -> DataFrame:
    asked = t.events.select(F.concat(F.lit("user_id:"), F.col("user_id").cast("string")).alias("entity_key")).distinct()
    return _flat(st.lookup(asked, st.merge_online(*_generations(t)), "churn", "fs_v1", _NOW, ttl_hours=200))


@query("online_store_files", "events", f"WITH {_STORE} SELECT * FROM store")
def online_store_files(t: Tables) -> DataFrame:
    """The same table through the append-log store, compacted half-way."""
    from ..session import scratch_path

    box = st.OnlineStore(t.spark, scratch_path(t.spark, "online"))
    first, second, third = _generations(t)
    box.upsert(first, 0)
    box.upsert(second, 1)
    box.compact()
    box.upsert(third, 2)
    return _flat(box.current())


@query(
    "audit_recent", "audit_v",
    "SELECT request_id, entity_key, decision, created_at FROM audit_v WHERE domain = 'churn' ORDER BY created_at DESC, request_id DESC LIMIT 10",
)
def audit_recent(t: Tables) -> DataFrame:
    return mo.recent(t.audit_v, "churn").select("request_id", "entity_key", "decision", "created_at")


@query(
    "audit_recent_per_domain", "audit_v",
    "SELECT domain, request_id, created_at, CAST(row_number() OVER (PARTITION BY domain ORDER BY created_at DESC, request_id DESC) AS INTEGER) AS rank FROM audit_v QUALIFY rank <= 10",
)
def audit_recent_per_domain(t: Tables) -> DataFrame:
    return mo.recent_per_domain(t.audit_v).select("domain", "request_id", "created_at", "rank")


@query(
    "audit_actions", "audit_v",
    """SELECT request_id, entity_key, json_extract_string(decision, '$.recommended_action') AS action, created_at FROM audit_v
       WHERE domain = 'churn' AND json_extract_string(decision, '$.recommended_action') <> 'NO_ACTION'""",
)
def audit_actions(t: Tables) -> DataFrame:
    return mo.acted(t.audit_v, "churn")


@query(
    "audit_rejects_last_day", "audit_v",
    """SELECT request_id, entity_key, 'REJECT' AS decision, created_at FROM audit_v WHERE domain = 'fraud' AND json_extract_string(decision, '$.decision') = 'REJECT'
       AND created_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 DAY""",
)
def audit_rejects_last_day(t: Tables) -> DataFrame:
    return mo.decided_since(t.audit_v, "fraud", "REJECT", EVENT_AS_OF)


@query(
    "action_mix", "audit_v",
    """WITH c AS (SELECT domain, CAST(date_trunc('day', created_at) AS TIMESTAMP) AS window_start, json_extract_string(decision, '$.decision') AS action, count(*) AS n FROM audit_v GROUP BY ALL)
      SELECT *, round(n / sum(n) OVER (PARTITION BY domain, window_start), 6) AS share FROM c""",
)
def action_mix(t: Tables) -> DataFrame:
    return rounded(mo.action_mix(t.audit_v), "share")


@query(
    "audit_feedback", "audit_v feedback_v",
    "SELECT domain, count(*) AS n, round(avg(rating), 6) AS mean_rating, round(avg(faithfulness), 6) AS mean_faithfulness FROM audit_v JOIN feedback_v USING (request_id) GROUP BY 1",
)
def audit_feedback(t: Tables) -> DataFrame:
    joined = mo.with_feedback(t.audit_v, t.feedback_v)
    out = joined.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n"), F.avg("rating").alias("mean_rating"), F.avg("faithfulness").alias("mean_faithfulness")
    )
    return rounded(out, "mean_rating", "mean_faithfulness")


@query(
    "usage_metrics", "audit_v",
    "SELECT domain, count(*) AS n, round(sum(latency_ms / 1e3), 6) AS latency_sum, "
    + ", ".join(f"count(*) FILTER (latency_ms / 1e3 <= {b}) AS le_{str(b).replace('.', '_')}" for b in mo.LATENCY_BOUNDS)
    + " FROM audit_v GROUP BY 1",
)
def usage_metrics(t: Tables) -> DataFrame:
    return rounded(mo.usage_metrics(t.audit_v), "latency_sum")


@query(
    "usage_tokens", "audit_v",
    """SELECT domain, count(*) AS n, CAST(sum(entity_key % 50) AS BIGINT) AS prompt_tokens, CAST(sum(latency_ms % 7) AS BIGINT) AS completion_tokens, count(*) FILTER (status >= 500) AS no_evidence
      FROM audit_v GROUP BY 1""",
)
def usage_tokens(t: Tables) -> DataFrame:
    """Token totals and answers without evidence."""
    asked = t.audit_v.withColumns({"prompt_tokens": F.col("entity_key") % 50, "completion_tokens": F.col("latency_ms") % 7, "no_evidence": F.col("status") >= 500})
    return mo.usage_metrics(asked).select("domain", "n", "prompt_tokens", "completion_tokens", "no_evidence")


_WIN = """win AS (SELECT domain, time_bucket(INTERVAL 1 MINUTE, created_at, TIMESTAMP '1970-01-01') - to_minutes(k) AS window_start, latency_ms, status FROM audit_v, (SELECT unnest(range(5)) AS k)),
  slo AS (SELECT domain, window_start, count(*) AS n, avg(CASE WHEN status >= 500 THEN 1e0 ELSE 0e0 END) AS error_rate, quantile_cont(latency_ms, 0.95) AS p95_ms FROM win GROUP BY ALL)"""


@query(
    "slo_windows", "audit_v",
    f"""WITH {_WIN} SELECT domain, window_start, n, round(error_rate, 6) AS error_rate, round(p95_ms, 6) AS p95_ms, CASE WHEN p95_ms > 240 THEN 'critical' WHEN p95_ms > 120 THEN 'warning' END AS latency_alert,
      CASE WHEN error_rate > 0.01 THEN 'critical' WHEN error_rate > 0.005 THEN 'warning' END AS error_alert FROM slo""",
)
def slo_windows(t: Tables) -> DataFrame:
    return rounded(mo.slo_alerts(mo.slo_windows(t.audit_v, method="exact")), "error_rate", "p95_ms")


#: Streaks of slow and of failing minutes over ``slo`` (domain, window_start, p95_ms, error_rate), as ``r``.
STREAKS = """h AS (SELECT *, p95_ms > CASE domain WHEN 'churn' THEN 240 ELSE 160 END AS slow, error_rate > 0.01 AS bad, lag(window_start) OVER (PARTITION BY domain ORDER BY window_start) AS prev FROM slo),
      g AS (SELECT *, sum(CASE WHEN slow AND prev + INTERVAL 1 MINUTE = window_start THEN 0 ELSE 1 END) OVER w AS gs, sum(CASE WHEN bad AND prev + INTERVAL 1 MINUTE = window_start THEN 0 ELSE 1 END) OVER w AS gb
        FROM h WINDOW w AS (PARTITION BY domain ORDER BY window_start)),
      r AS (SELECT domain, window_start, CASE WHEN slow THEN count(*) FILTER (slow) OVER (PARTITION BY domain, gs ORDER BY window_start) ELSE 0 END AS slow_minutes,
        CASE WHEN bad THEN count(*) FILTER (bad) OVER (PARTITION BY domain, gb ORDER BY window_start) ELSE 0 END AS error_minutes FROM g)"""


@query(
    "rollback_runs", "audit_v",
    f"""WITH {_WIN}, {STREAKS}
      SELECT *, slow_minutes >= 10 OR error_minutes >= 5 AS rollback FROM r""",
)
def rollback_runs(t: Tables) -> DataFrame:
    out = mo.rollback_condition(mo.slo_windows(t.audit_v, method="exact"))
    return out.select("domain", "window_start", "slow_minutes", "error_minutes", "rollback")


def _fraud_scorer(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_score", F.least(F.lit(1.0), F.col("transaction_count_7d") / 60.0 + F.col("max_amount_30d") / 1000.0))


@query(
    "batch_score_fraud", "transactions_v",
    """WITH f AS (SELECT user_id, count(*) FILTER (event_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY) AS c7, max(amount) AS m30 FROM transactions_v
        WHERE event_time < TIMESTAMP '2024-01-31 00:00:00' AND event_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 DAY GROUP BY 1),
      r AS (SELECT concat('job1_', cast(user_id AS string)) AS request_id, cast(user_id AS string) AS entity_key, least(1, c7 / 60e0 + m30 / 1e3) AS s FROM f)
      SELECT request_id, entity_key, round(s, 6) AS risk_score, CASE WHEN s >= 0.9 THEN 'REJECT' WHEN s >= 0.5 THEN 'MANUAL_REVIEW' ELSE 'APPROVE' END AS decision,
        'n/a' AS trace_id, ['(none)'] AS warnings FROM r""",
)
def batch_score_fraud(t: Tables) -> DataFrame:
    features = fraud.velocity_group(t.transactions_v, "user_id", [EVENT_AS_OFS[1]]).drop("as_of_time")
    online = st.to_online(features, "fraud", "fs_fraud_v1", "user_id", EVENT_AS_OF, 3600 * 24)
    requests = t.transactions_v.select("user_id").distinct()
    out = scoring.score_fraud(
        requests, online, _fraud_scorer, "transaction_count_7d bigint, max_amount_30d double", ["transaction_count_7d", "max_amount_30d"],
        policy.DEFAULT_RULES, _NOW, "job1", entity="user_id",
    )["audit"]
    score = F.round(F.get_json_object("predictions", "$.risk_score").cast("double"), 6)
    return out.select(
        "request_id", "entity_key", score.alias("risk_score"), F.get_json_object("decision", "$.decision").alias("decision"), "trace_id", "warnings"
    )


def _churn_scorer(df: DataFrame) -> DataFrame:
    return df.withColumns({"churn_prob": F.least(F.lit(1.0), F.col("n") / 8.0), "ltv_90d": F.col("n") * 100.0})


@query(
    "batch_score_churn", "events",
    f"""WITH {_STORE}, live AS (SELECT * FROM store WHERE feature_set_version = 'fs_v2' AND NOT materialized_at + to_seconds(ttl_seconds) < TIMESTAMP '{_NOW}')
      SELECT 'job2' AS job_id, (SELECT count(DISTINCT user_id) FROM events) AS total, (SELECT count(*) FROM live) AS succeeded,
        (SELECT count(DISTINCT user_id) FROM events) - (SELECT count(*) FROM live) AS failed""",
)
def batch_score_churn(t: Tables) -> DataFrame:
    requests = t.events.select("user_id").distinct()
    store = st.merge_online(*_generations(t))
    out = scoring.score_churn(requests, store, _churn_scorer, "n bigint", al.DEFAULT_OFFERS, 500.0, _NOW, "job2", "fs_v2")
    return out["summary"]
