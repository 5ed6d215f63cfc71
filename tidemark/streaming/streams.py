"""Structured Streaming forms of the feature, decision, store and monitoring operators."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.temporal import Moment, time_bucket
from ..operators.drift import bin_counts, drift_triggers, psi_of_counts
from ..operators.monitor import latency_counts
from ..operators.policy import Rule, apply_rules
from ..sources.store import OnlineStore, append_audit


def file_stream(spark: SparkSession, folder: str, schema, pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


_VERSIONS = "spark.sql.streaming.maxBatchesToRetainInMemory"


@contextmanager
def _one_version(spark: SparkSession):
    """State kept in memory is that of the last micro-batch alone, half as much; a retried task reads the one before from its checkpoint."""
    before = spark.conf.get(_VERSIONS, None)
    spark.conf.set(_VERSIONS, "1")
    try:
        yield
    finally:
        spark.conf.set(_VERSIONS, before) if before is not None else spark.conf.unset(_VERSIONS)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there into a parquet folder and stop."""
    with _one_version(df.sparkSession):
        q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
    return q


def run_batches(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    with _one_version(df.sparkSession):
        q = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
    return q


def watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event times must be zoned for a watermark; wall-clock times are read in the session zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def wall_clock(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def stream_velocity(events: DataFrame, size: str, slide: str | None, delay: str, entity: str = "user_id", ts: str = "event_time", amount: str = "amount") -> DataFrame:
    """Count, sum, mean, maximum per entity and sliding window.

    Meant for short windows (1 hour, 24 hours).  For 7 days with a small slide
    use an hourly window here and :func:`roll_up` downstream: one state row per
    hour instead of 168.
    """
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return watermarked(events, ts, delay).groupBy(entity, w.alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total"), F.avg(amount).alias("mean"), F.max(amount).alias("largest")
    ).select(
        entity, wall_clock("w.start").alias("window_start"), wall_clock("w.end").alias("window_end"), "n", "total", "mean", "largest"
    )


def roll_up(hourly: DataFrame, hours: int, entity: str = "user_id") -> DataFrame:
    """Long windows from hourly rows: at most one row per entity and hour is ordered."""
    w = Window.partitionBy(entity).orderBy(time_bucket("window_start", timedelta(hours=1))).rangeBetween(-(hours - 1), 0)
    return hourly.select(
        entity, "window_end", F.sum("n").over(w).alias("n"), F.sum("total").over(w).alias("total"), F.max("largest").over(w).alias("largest")
    )


def stream_tumbling(events: DataFrame, size: str, delay: str, entity: str = "user_id", ts: str = "event_time") -> DataFrame:
    """Events per entity and tumbling window."""
    w = F.window(ts, size)
    return watermarked(events, ts, delay).groupBy(entity, w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        entity, wall_clock("w.start").alias("window_start"), "n"
    )


def is_late(delay: Column, ts: str = "event_time", seen: str = "processing_time") -> Column:
    """Arrived later than the allowed delay after the event."""
    return F.col(seen) - F.col(ts) > delay


def split_late(events: DataFrame, delay: Column, ts: str = "event_time", seen: str = "processing_time") -> tuple[DataFrame, DataFrame]:
    """(on time, late): late rows are kept apart and counted instead of silently dropped."""
    late = F.coalesce(is_late(delay, ts, seen), F.lit(False))
    return events.filter(~late), events.filter(late)


def stream_decisions(scored: DataFrame, rules: list[Rule], delay: str, ts: str = "event_time", request_id: str = "request_id") -> DataFrame:
    """Rule decisions, each request id once within the watermark."""
    return apply_rules(watermarked(scored, ts, delay).dropDuplicatesWithinWatermark([request_id]), rules)


def stream_upsert(online_rows: DataFrame, store: OnlineStore, checkpoint: str) -> StreamingQuery:
    """Every micro-batch becomes its own log folder, so a retried batch replaces itself."""
    return run_batches(online_rows, lambda rows, batch: store.upsert(rows, batch), checkpoint)


def stream_expire(online_rows: DataFrame, store: OnlineStore, now: Moment, checkpoint: str, every: int = 10) -> StreamingQuery:
    """Upsert and, every few batches, compact without the expired rows."""

    def each(rows: DataFrame, batch: int) -> None:
        store.upsert(rows, batch)
        if batch % every == 0:
            store.compact(now)

    return run_batches(online_rows, each, checkpoint)


def stream_slo(audit: DataFrame, delay: str, size: str = "1 minute", ts: str = "created_at") -> DataFrame:
    """Latency counts of closed service windows as a stream; ``monitor.slo_of_counts`` makes exact quantiles of what it wrote, then the streak rule runs."""
    counts = latency_counts(watermarked(audit, ts, delay), size, ts)
    return counts.withColumn("window_start", wall_clock("window_start"))


def stream_audit(decided: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Audit rows of decided requests; a micro-batch owns its folder, so a retry replaces it."""
    return run_batches(decided, lambda rows, batch: append_audit(rows, path, batch=f"{batch:09d}"), checkpoint)


def stream_bin_counts(features: DataFrame, edges: dict[str, list[float]], delay: str, ts: str = "event_time") -> DataFrame:
    """Counts per closed day, feature and bin as a stream: what drift needs, however a day is spread over micro-batches."""
    rows = watermarked(features.select(ts, *edges), ts, delay)
    counts = bin_counts(rows, edges, (F.window(ts, "1 day").alias("w"),), "a")
    return counts.select(F.to_date(wall_clock("w.start")).alias("day"), "feature", "bin", "a")


def drift_state(counts: DataFrame, baseline: DataFrame, edges: dict[str, list[float]], consecutive: int = 2) -> DataFrame:
    """Triggers over the days counted so far; ``baseline`` is counted once (``bin_counts`` with ``e``)."""
    series = psi_of_counts(baseline, counts, edges, ("day",))
    return drift_triggers(series, (), "day", consecutive=consecutive, step=F.expr("INTERVAL 1 DAY"))


def join_delayed_labels(
    events: DataFrame, labels: DataFrame, max_delay: str, watermark: str, key: str = "transaction_id", ts: str = "event_time", label_ts: str = "label_time"
) -> DataFrame:
    """Stream-stream join of events with labels arriving up to ``max_delay`` later; state is bounded by both watermarks."""
    e = watermarked(events, ts, watermark).alias("e")
    lab = watermarked(labels, label_ts, watermark).alias("l")
    cond = (
        (F.col(f"e.{key}") == F.col(f"l.{key}"))
        & (F.col(f"l.{label_ts}") >= F.col(f"e.{ts}"))
        & (F.col(f"l.{label_ts}") <= F.col(f"e.{ts}") + F.expr(f"INTERVAL {max_delay}"))
    )
    extra = [F.col(f"l.{c}") for c in labels.columns if c not in (key, *events.columns)]
    return e.join(lab, cond).select("e.*", *extra)
