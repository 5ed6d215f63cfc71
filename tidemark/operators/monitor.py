"""Audit questions, service-level windows and rollback conditions."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.temporal import Moment, moment, span
from .ordered import exact_quantiles, run_lengths, top_k

# Alert levels (seconds, share), rollback levels, latency histogram bounds (seconds).
LATENCY_ALERTS = {"warning": 0.12, "critical": 0.24}
ERROR_ALERTS = {"warning": 0.005, "critical": 0.01}
SLO_MS = {"churn": 120, "fraud": 80}
ROLLBACK_5XX = 0.01
ROLLBACK_MINUTES = {"p95": 10, "errors": 5}
LATENCY_BOUNDS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0)


def recent(audit: DataFrame, domain: str, limit: int = 10) -> DataFrame:
    """Newest decisions of a domain: a bounded top-k, no full sort."""
    return audit.filter(F.col("domain") == domain).orderBy(F.col("created_at").desc(), F.col("request_id").desc()).limit(limit)


def recent_per_domain(audit: DataFrame, limit: int = 10) -> DataFrame:
    return top_k(audit, ["domain"], [("created_at", "desc"), ("request_id", "desc")], limit)


def json_value(c: str, key: str) -> Column:
    return F.get_json_object(F.col(c), f"$.{key}")


def acted(audit: DataFrame, domain: str) -> DataFrame:
    """Decisions with a recommended action other than NO_ACTION."""
    action = json_value("decision", "recommended_action")
    return audit.filter((F.col("domain") == domain) & (action != "NO_ACTION")).select("request_id", "entity_key", action.alias("action"), "created_at")


def decided_since(audit: DataFrame, domain: str, decision: str, now: Moment, back: timedelta = timedelta(days=1)) -> DataFrame:
    """Decisions of one kind in the last ``back``; the time filter reaches the scan."""
    d = json_value("decision", "decision")
    keep = (F.col("domain") == domain) & (F.col("created_at") >= moment(now) - span(back)) & (d == decision)
    return audit.filter(keep).select("request_id", "entity_key", d.alias("decision"), "created_at")


def action_mix(audit: DataFrame, key: str = "decision", every: str = "1 day") -> DataFrame:
    """Counts and shares of decisions per domain and window."""
    w = F.window("created_at", every)
    counts = audit.groupBy("domain", w.start.alias("window_start"), json_value("decision", key).alias("action")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("domain", "window_start").agg(F.sum("n").alias("__total"))
    return counts.join(totals, ["domain", "window_start"]).withColumn("share", F.col("n") / F.col("__total")).drop("__total")


def with_feedback(audit: DataFrame, feedback: DataFrame) -> DataFrame:
    """Audit rows with their feedback by request id."""
    return audit.join(feedback.select("request_id", "rating", "faithfulness"), "request_id")


def usage_metrics(rows: DataFrame, latency_ms: str = "latency_ms", by: tuple[str, ...] = ("domain",)) -> DataFrame:
    """Cumulative latency histogram, totals and no-evidence counts."""
    seconds = F.col(latency_ms) / 1000.0
    buckets = [F.count_if(seconds <= b).alias(f"le_{str(b).replace('.', '_')}") for b in LATENCY_BOUNDS]
    extra = []
    for c in ("prompt_tokens", "completion_tokens"):
        if c in rows.columns:
            extra.append(F.sum(c).alias(c))
    if "no_evidence" in rows.columns:
        extra.append(F.count_if("no_evidence").alias("no_evidence"))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(seconds).alias("latency_sum"), *buckets, *extra)


def slo_windows(
    audit: DataFrame, size: str = "5 minutes", slide: str | None = "1 minute", ts: str = "created_at", by: str = "domain", method: str = "sketch"
) -> DataFrame:
    """p95 latency and 5xx share per service and window.

    The sketch has bounded memory however many requests a window holds;
    ``exact`` sorts across partitions.
    """
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    rows = audit.select(by, w.alias("w"), "latency_ms", (F.col("status") >= 500).cast("double").alias("failed"))
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("failed").alias("error_rate")]
    if method == "sketch":
        aggs.append(F.percentile_approx("latency_ms", 0.95, 10000).cast("double").alias("p95_ms"))
    out = rows.groupBy(by, "w").agg(*aggs)
    out = out.select(by, F.col("w.start").alias("window_start"), *[c for c in out.columns if c not in (by, "w")])
    if method == "sketch":
        return out
    flat = rows.select(by, F.col("w.start").alias("window_start"), "latency_ms")
    return out.join(exact_quantiles(flat, "latency_ms", {"p95_ms": 0.95}, (by, "window_start")), [by, "window_start"])


def latency_counts(audit: DataFrame, size: str = "1 minute", ts: str = "created_at", by: str = "domain") -> DataFrame:
    """(by, window_start, latency_ms, n, failed): requests per window and whole millisecond, and how many of them failed.

    Counts of the same window merge by addition, so they can be made by many
    tasks, also on a stream; their number is bounded by the latencies that
    occur, not by the requests.
    """
    rows = audit.select(by, F.window(ts, size).alias("w"), F.col("latency_ms").cast("bigint").alias("latency_ms"), (F.col("status") >= 500).cast("bigint").alias("failed"))
    counted = rows.groupBy(by, "w", "latency_ms").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"))
    return counted.select(by, F.col("w.start").alias("window_start"), "latency_ms", "n", "failed")


def slo_of_counts(counts: DataFrame, by: str = "domain", p: float = 0.95) -> DataFrame:
    """(by, window_start, n, error_rate, p95_ms) of ``latency_counts``: the quantile is exact, read off by rank.

    Requests without a latency count in n and the error rate only.
    """
    keys = (by, "window_start")
    merged = counts.groupBy(*keys, "latency_ms").agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"))
    # One row per millisecond that occurs in a window: its order is bounded.
    timed = F.when(F.col("latency_ms").isNotNull(), F.col("n")).otherwise(0)
    running = Window.partitionBy(*keys).orderBy(F.col("latency_ms").asc_nulls_first())
    placed = merged.withColumn("upto", F.sum(timed).over(running)).withColumn("total", F.sum(timed).over(Window.partitionBy(*keys)))
    position = (F.col("total") - 1) * F.lit(p)
    low = F.floor(position)

    def at(rank: Column) -> Column:
        here = F.col("latency_ms").isNotNull() & (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(here, F.col("latency_ms").cast("double")))

    out = placed.groupBy(*keys).agg(
        F.sum("n").alias("n"), (F.sum("failed") / F.sum("n")).alias("error_rate"),
        at(low).alias("lo"), at(F.least(low + 1, F.col("total") - 1)).alias("hi"), F.max(position - low).alias("w"),
    )
    return out.select(*keys, "n", "error_rate", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("w")).alias("p95_ms"))


def _level(value: Column, limits: dict[str, float]) -> Column:
    return F.when(value > limits["critical"], "critical").when(value > limits["warning"], "warning")


def slo_alerts(windows: DataFrame) -> DataFrame:
    """Adds the latency and error alert levels of each window (NULL when fine)."""
    return windows.withColumns(
        {"latency_alert": _level(F.col("p95_ms") / 1000.0, LATENCY_ALERTS), "error_alert": _level(F.col("error_rate"), ERROR_ALERTS)}
    )


def rollback_condition(minutes: DataFrame, slo_ms: dict[str, float] | None = None, by: str = "domain", at: str = "window_start") -> DataFrame:
    """Streaks of violating minutes and whether they call for a rollback.

    Latency over twice the objective for 10 minutes, or more than 1% 5xx for
    5 minutes; a missing minute ends a streak.
    """
    slo = slo_ms or SLO_MS
    limits = F.create_map(*[x for k, v in slo.items() for x in (F.lit(k), F.lit(float(2 * v)))])
    minute = F.expr("INTERVAL 1 MINUTE")
    slow = F.col("p95_ms") > F.try_element_at(limits, F.col(by))
    bad = F.col("error_rate") > ROLLBACK_5XX
    a = run_lengths(minutes, (by,), at, slow, minute).withColumnRenamed("streak", "slow_minutes")
    b = run_lengths(a, (by,), at, bad, minute).withColumnRenamed("streak", "error_minutes")
    due = (F.col("slow_minutes") >= ROLLBACK_MINUTES["p95"]) | (F.col("error_minutes") >= ROLLBACK_MINUTES["errors"])
    return b.withColumn("rollback", due)


def lasting_alerts(windows: DataFrame, level: str, column: str, minutes: int, by: str = "domain", at: str = "window_start") -> DataFrame:
    """Windows at which an alert level has held for ``minutes`` consecutive minutes."""
    rank = {"warning": [F.lit("warning"), F.lit("critical")], "critical": [F.lit("critical")]}[level]
    hit = F.col(column).isin(*rank)
    return run_lengths(windows, (by,), at, hit, F.expr("INTERVAL 1 MINUTE")).filter(F.col("streak") >= minutes)
