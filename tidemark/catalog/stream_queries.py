"""Streaming queries driven to completion over the given tables."""

from pyspark.sql import DataFrame, functions as F

from ..operators import drift, monitor as mo, policy
from ..session import scratch_path, shuffle_width
from ..sources import store as st
from ..streaming import expiry, streams as sm
from .feature_queries import rounded
from .registry import query
from .store_queries import STREAKS
from .views import VIEWS, Tables


#: Micro-batches of the event stream, in time order.
_BATCHES = 4
_written: dict[tuple, tuple[str, int]] = {}


def write_slices(events: DataFrame, path: str, late: bool = False) -> int:
    """``events`` as files in time order; how many make a micro-batch: the session's shuffle width, written by as many tasks.

    A slice is a quarter of the time span, its rows dealt over its files; where it has rows for fewer, empty files
    fill it up.  With ``late``, a last slice brings the first hours once more, too late.  Rows without a time come in
    the first slice.
    """
    n, spark = shuffle_width(events.sparkSession), events.sparkSession
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    ts, slices = F.col("ts"), [F.lit(True)]
    if low is not None:
        edges = [low + k * (high - low) / _BATCHES for k in range(1, _BATCHES)]
        slices = [ts.isNull() | (ts < F.lit(edges[0]))]
        slices += [(ts >= F.lit(a)) & (ts < F.lit(b)) for a, b in zip(edges, edges[1:])] + [ts >= F.lit(edges[-1])]
        slices += [ts < F.lit(low) + F.expr("INTERVAL 3 HOUR")] if late else []
    for k, here in enumerate(slices, 1):
        events.filter(here).repartition(n).write.mode("append").parquet(path)
        for _ in range(k * n - len(spark.read.parquet(path).inputFiles())):
            events.filter(F.lit(False)).write.mode("append").parquet(path)
    return n


def _stream(t: Tables, late: bool = False) -> DataFrame:
    """``events`` as a stream of one slice after the other (``write_slices``)."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, late)
    if key not in _written:
        path = scratch_path(t.spark, "event-files")
        _written[key] = path, write_slices(t.events, path, late)
    path, n = _written[key]
    return sm.file_stream(t.spark, path, t.events.schema, files_per_batch=n)


def _view(t: Tables, name: str, **inputs: DataFrame) -> DataFrame:
    return t.spark.sql(VIEWS[name], **inputs)


def _run(t: Tables, df: DataFrame, label: str) -> DataFrame:
    out = scratch_path(t.spark, label)
    sm.run_available(df, out, scratch_path(t.spark, f"{label}-state"))
    return t.spark.read.schema(df.schema).parquet(out)


_CLOSED = "(SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


@query(
    "stream_velocity", "events",
    f"""WITH w AS (SELECT user_id, value, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - to_hours(6 * k) AS window_start FROM events, (SELECT unnest(range(4)) AS k))
      SELECT user_id, window_start, window_start + INTERVAL 24 HOUR AS window_end, count(*) AS n, round(sum(value), 6) AS total, round(avg(value), 6) AS mean, max(value) AS largest
      FROM w WHERE window_start + INTERVAL 24 HOUR <= {_CLOSED} GROUP BY ALL""",
)
def stream_velocity(t: Tables) -> DataFrame:
    df = sm.stream_velocity(_stream(t, late=True), "24 hours", "6 hours", "10 minutes", ts="ts", amount="value")
    return rounded(_run(t, df, "velocity"), "total", "mean")


@query(
    "stream_rolled_week", "events",
    f"""WITH h AS (SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS hr, count(*) AS n, sum(value) AS s, max(value) AS m FROM events GROUP BY ALL),
      c AS (SELECT * FROM h WHERE hr + INTERVAL 1 HOUR <= {_CLOSED})
      SELECT user_id, hr + INTERVAL 1 HOUR AS window_end, CAST(sum(n) OVER w AS BIGINT) AS n, round(sum(s) OVER w, 6) AS total, max(m) OVER w AS largest FROM c
      WINDOW w AS (PARTITION BY user_id ORDER BY hr RANGE BETWEEN INTERVAL 167 HOUR PRECEDING AND CURRENT ROW)""",
)
def stream_rolled_week(t: Tables) -> DataFrame:
    hourly = sm.stream_velocity(_stream(t, late=True), "1 hour", None, "10 minutes", ts="ts", amount="value")
    return rounded(sm.roll_up(_run(t, hourly, "hourly"), 168), "total")


@query(
    "stream_tumbling", "events",
    f"""SELECT user_id, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n FROM events
      WHERE time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 7 DAY <= {_CLOSED} GROUP BY ALL""",
)
def stream_tumbling(t: Tables) -> DataFrame:
    return _run(t, sm.stream_tumbling(_stream(t, late=True), "7 days", "10 minutes", ts="ts"), "weekly")


@query(
    "stream_late", "events",
    """WITH x AS (SELECT event_type, value > 40 AS late FROM events) SELECT event_type, count(*) FILTER (NOT late) AS on_time, count(*) FILTER (late) AS late FROM x GROUP BY 1""",
)
def stream_late(t: Tables) -> DataFrame:
    arrived = _stream(t).withColumn("processing_time", F.col("ts") + F.make_dt_interval(mins=F.ceil(F.col("value")).cast("int")))
    good, late = sm.split_late(arrived, F.expr("INTERVAL 40 MINUTE"), "ts")
    marked = good.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True))).select("event_type", "late")
    rows = _run(t, marked, "late")
    return rows.groupBy("event_type").agg(F.count_if(~F.col("late")).alias("on_time"), F.count_if("late").alias("late"))


@query(
    "stream_decisions", "txn_scored_v",
    """SELECT concat('req_', cast(transaction_id AS string)) AS request_id, CASE WHEN risk_score >= 0.9 THEN 'REJECT' WHEN risk_score >= 0.5 THEN 'MANUAL_REVIEW' ELSE 'APPROVE' END AS decision FROM txn_scored_v""",
)
def stream_decisions(t: Tables) -> DataFrame:
    source = _stream(t)
    scored = _view(t, "txn_scored_v", transactions_v=_view(t, "transactions_v", events=source.unionByName(source)))
    scored = scored.withColumn("request_id", F.concat(F.lit("req_"), F.col("transaction_id").cast("string")))
    df = sm.stream_decisions(scored, policy.DEFAULT_RULES, "1 day").select("request_id", "decision")
    return _run(t, df, "decisions")


@query(
    "stream_upsert", "events",
    "SELECT concat('user_id:', cast(user_id AS string)) AS entity_key, max(ts) AS event_time, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1",
)
def stream_upsert(t: Tables) -> DataFrame:
    rows = _stream(t).select("user_id", "value", F.col("ts").alias("event_time"))
    online = st.to_online(rows, "fraud", "fs_v1", "user_id", "2024-02-01 00:00:00")
    box = st.OnlineStore(t.spark, scratch_path(t.spark, "upsert"))
    sm.stream_upsert(online, box, scratch_path(t.spark, "upsert-state"))
    return box.current().select("entity_key", "event_time", F.from_json("features", "value double").getField("value").alias("value"))


@query(
    "stream_expire", "events",
    """WITH l AS (SELECT concat('user_id:', cast(user_id AS string)) AS entity_key, event_type, max(ts) AS event_time FROM events GROUP BY ALL)
      SELECT entity_key, count(*) AS n FROM l GROUP BY 1""",
)
def stream_expire(t: Tables) -> DataFrame:
    """Two feature versions per event type; the one with a short TTL is gone after compaction."""
    rows = _stream(t).select("user_id", "event_type", "value", F.col("ts").alias("event_time"))
    lasting = st.to_online(rows, "fraud", "x", "user_id", "2024-02-01 00:00:00").withColumn("feature_set_version", F.get_json_object("features", "$.event_type"))
    brief = st.to_online(rows, "churn", "x", "user_id", "2024-02-01 00:00:00", 60)
    box = st.OnlineStore(t.spark, scratch_path(t.spark, "expire"))
    sm.stream_expire(lasting.unionByName(brief), box, "2024-02-02 00:00:00", scratch_path(t.spark, "expire-state"), every=1)
    return box.current().groupBy("entity_key").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_live", "events",
    """WITH l AS (SELECT concat('user_id:', cast(user_id AS string)) AS entity_key, event_type AS feature_set_version, max(ts) AS materialized_at FROM events WHERE ts IS NOT NULL GROUP BY ALL)
      SELECT * FROM l WHERE materialized_at + INTERVAL 6 HOUR >= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def stream_live(t: Tables) -> DataFrame:
    """Features that are live when the stream ends: state of each key that timers clear six hours after its last row."""
    rows = _stream(t, late=True).filter("ts IS NOT NULL").select("user_id", "event_type", "value", "ts")
    online = st.to_online(rows, "fraud", "x", "user_id", "2024-02-01 00:00:00", 6 * 3600, "ts")
    online = online.withColumn("feature_set_version", F.get_json_object("features", "$.event_type")).withColumn("materialized_at", F.col("event_time"))
    with expiry.keyed_state(t.spark):
        changes = _run(t, expiry.live_changes(online, "10 minutes"), "live")
    return expiry.live_rows(changes).select("entity_key", "feature_set_version", sm.wall_clock("materialized_at").alias("materialized_at"))


#: Closed minutes of each service.
_MINUTES = f"""slo AS (SELECT domain, date_trunc('minute', created_at)::TIMESTAMP AS window_start, count(*) AS n, avg(CASE WHEN status >= 500 THEN 1e0 ELSE 0e0 END) AS error_rate,
      quantile_cont(latency_ms, 0.95) AS p95_ms FROM audit_v WHERE date_trunc('minute', created_at)::TIMESTAMP + INTERVAL 1 MINUTE <= {_CLOSED} GROUP BY domain, date_trunc('minute', created_at))"""


def _slo(t: Tables, label: str) -> DataFrame:
    audit = _view(t, "audit_v", events=_stream(t, late=True))
    return mo.slo_of_counts(_run(t, sm.stream_slo(audit, "10 minutes"), label))


@query("stream_slo", "audit_v events", f"WITH {_MINUTES} SELECT domain, window_start, n, round(error_rate, 6) AS error_rate, round(p95_ms, 6) AS p95_ms FROM slo")
def stream_slo(t: Tables) -> DataFrame:
    return rounded(_slo(t, "slo").select("domain", "window_start", "n", "error_rate", "p95_ms"), "error_rate", "p95_ms")


@query("stream_slo_rollback", "audit_v events", f"WITH {_MINUTES}, {STREAKS} SELECT *, slow_minutes >= 10 OR error_minutes >= 5 AS rollback FROM r")
def stream_slo_rollback(t: Tables) -> DataFrame:
    """Streaks of violating minutes and the rollback flag of every closed minute."""
    return mo.rollback_condition(_slo(t, "slo2")).select("domain", "window_start", "slow_minutes", "error_minutes", "rollback")


_DAY_EDGES = ", ".join(f"quantile_cont(value, {i / 10}) AS q{i}" for i in range(1, 10))
_DAY_BIN = " + ".join(f"CASE WHEN value >= q{i} THEN 1 ELSE 0 END" for i in range(1, 10))


@query(
    "stream_drift", "events",
    f"""WITH q AS (SELECT {_DAY_EDGES} FROM events), x AS (SELECT CAST(ts AS DATE) AS day, {_DAY_BIN} AS bin FROM events, q),
      base AS (SELECT bin, count(*) AS e FROM x GROUP BY 1), cur AS (SELECT day, bin, count(*) AS a FROM x GROUP BY ALL), tot AS (SELECT day, sum(a) AS na FROM cur GROUP BY 1),
      cells AS (SELECT day, coalesce(e, 0) / ((SELECT sum(e) FROM base) + 1e-6) + 1e-6 AS pe, coalesce(a, 0) / (na + 1e-6) + 1e-6 AS pa FROM (SELECT * FROM tot, (SELECT CAST(unnest(range(10)) AS INTEGER) AS bin)) LEFT JOIN base USING (bin) LEFT JOIN cur USING (day, bin))
      SELECT day, 'value' AS feature, round(sum((pa - pe) * ln(pa / pe)), 6) AS psi FROM cells WHERE day + INTERVAL 1 DAY <= {_CLOSED} GROUP BY 1""",
)
def stream_drift(t: Tables) -> DataFrame:
    """Days that are split over micro-batches and met again by late rows count once and whole."""
    edges = drift.baseline_edges(t.events, ["value"])
    counts = _run(t, sm.stream_bin_counts(_stream(t, late=True), edges, "10 minutes", "ts"), "drift")
    return rounded(sm.drift_state(counts, drift.bin_counts(t.events, edges, (), "e"), edges).select("day", "feature", "psi"), "psi")


@query(
    "stream_audit", "txn_scored_v",
    """SELECT concat('req_', cast(transaction_id AS string)) AS request_id, 'fraud' AS domain, CASE WHEN risk_score >= 0.9 THEN 'REJECT' WHEN risk_score >= 0.5 THEN 'MANUAL_REVIEW' ELSE 'APPROVE' END AS decision,
      'n/a' AS model_version, cast(event_time AS DATE) AS day FROM txn_scored_v""",
)
def stream_audit(t: Tables) -> DataFrame:
    """Every request arrives twice and is audited once."""
    source = _stream(t)
    scored = _view(t, "txn_scored_v", transactions_v=_view(t, "transactions_v", events=source.unionByName(source)))
    scored = scored.withColumn("request_id", F.concat(F.lit("req_"), F.col("transaction_id").cast("string")))
    decided = sm.stream_decisions(scored, policy.DEFAULT_RULES, "1 day")
    rows = decided.select("request_id", F.lit("fraud").alias("domain"), "decision", sm.wall_clock("event_time").alias("created_at"))
    path = scratch_path(t.spark, "stream-audit")
    sm.stream_audit(rows, path, scratch_path(t.spark, "stream-audit-state"))
    return t.spark.read.parquet(path).select("request_id", "domain", "decision", "model_version", "day")


@query(
    "stream_delayed_labels", "fraud_labels_v transactions_v",
    """SELECT t.transaction_id, t.user_id, l.fraud_label, l.label_time FROM transactions_v t JOIN fraud_labels_v l USING (transaction_id)
       WHERE l.label_time >= t.event_time AND l.label_time <= t.event_time + INTERVAL 8 DAY""",
)
def stream_delayed_labels(t: Tables) -> DataFrame:
    events = _view(t, "transactions_v", events=_stream(t)).select("transaction_id", "user_id", "event_time")
    labels = _view(t, "fraud_labels_v", events=_stream(t)).select("transaction_id", "label_time", "fraud_label")
    joined = sm.join_delayed_labels(events, labels, "8 DAYS", "1 day")
    return _run(t, joined.select("transaction_id", "user_id", "fraud_label", sm.wall_clock("label_time").alias("label_time")), "labels")
