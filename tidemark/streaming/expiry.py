"""Online features as keyed stream state: a key leaves in the first micro-batch after its time to live, without a rewrite of other buckets."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEY = ["domain", "entity_key", "feature_set_version"]
CHANGES = "domain string, entity_key string, feature_set_version string, change string, features string, event_time timestamp, materialized_at timestamp, until timestamp"
#: What the processor takes, holds and yields: times in microseconds, ``_NEVER`` where there is no event time or no end.
_TIMES = ["event_time", "materialized_at", "until"]
_HELD = [*KEY, "features", *_TIMES]
_STATE = ", ".join(f"{c} array<{'bigint' if c in _TIMES else 'string'}>" for c in _HELD)
_YIELDED = CHANGES.replace(" timestamp", " bigint")
_NEVER = -(2**63)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LiveFeatures(StatefulProcessor):
    """The latest row of each key (by materialisation, then event time, then features), until its time to live is over.

    Every newer row is an ``upsert``; when the watermark passes the end of a
    key's latest row, the key is cleared and reported as ``expire``.  Rows
    without a time to live stay.  A call of the state costs far more than a
    row, so the keys of a bucket are one state row, read and written once a
    micro-batch, with one timer at the earliest end.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("rows", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._read()
        timer, changed = _earliest(held), {}
        for part in rows:
            for domain, entity, version, *row in zip(*(part[f"held_{c}"].tolist() for c in _HELD)):
                name = (domain, entity, version)
                if name not in held or _rank(row) > _rank(held[name]):
                    held[name] = changed[name] = tuple(row)
        if changed:
            self._write(held, timer)
            yield _changes("upsert", changed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._read()
        timer = expiredTimerInfo.getExpiryTimeInMs()
        end = max(timer, timerValues.getCurrentWatermarkInMs() - 1)
        over = {name: row for name, row in held.items() if row[3] != _NEVER and _millis(row[3]) <= end}
        if over:
            self._write({name: row for name, row in held.items() if name not in over}, timer)
            yield _changes("expire", over)

    def _read(self) -> dict[tuple, tuple]:
        columns = self.held.get()
        return {row[:3]: row[3:] for row in zip(*columns)} if columns else {}

    def _write(self, held: dict[tuple, tuple], timer: int | None) -> None:
        """Replace the bucket's rows; ``timer`` is the one registered before."""
        if held:
            self.held.update(_columns(held))
        else:
            self.held.clear()
        earliest = _earliest(held)
        if earliest != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if earliest is not None:
                self.handle.registerTimer(earliest)

    def close(self) -> None:
        pass


def _columns(rows: dict[tuple, tuple]) -> tuple[list, ...]:
    return tuple(list(c) for c in zip(*(name + row for name, row in rows.items())))


def _changes(change: str, rows: dict[tuple, tuple]) -> pd.DataFrame:
    columns = dict(zip(_HELD, _columns(rows)))
    columns["change"] = [change] * len(rows)
    return pd.DataFrame(columns)[[c.split()[0] for c in CHANGES.split(", ")]]


def _rank(row: tuple) -> tuple:
    return (row[2], row[1], row[0] or "")


def _millis(at: int) -> int:
    """The first whole millisecond strictly after ``at`` (microseconds): age must exceed the time to live."""
    return at // 1000 + 1


def _earliest(held: dict[tuple, tuple]) -> int | None:
    """When the first of these rows ends, if any does."""
    return min((_millis(row[3]) for row in held.values() if row[3] != _NEVER), default=None)


@contextmanager
def keyed_state(spark: SparkSession):
    """Timers need the RocksDB state store; the session's own choice is put back afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before is not None else spark.conf.unset(_PROVIDER)


def live_changes(online_rows: DataFrame, delay: str, buckets: int = 2048) -> DataFrame:
    """A stream of online rows -> changes: what each key became (``upsert``) and when it went (``expire``).

    Time is ``materialized_at`` and its watermark, late by ``delay``; rows
    later than that are dropped, like in every keyed stream operator.  Keys
    share state by hash in ``buckets``, which a checkpoint fixes; a bucket's
    live keys are held in a task's memory, some thousands of them are few.
    """
    at = F.col("materialized_at").cast("timestamp")
    until = F.when(F.col("ttl_seconds").isNotNull(), at + F.make_dt_interval(secs=F.col("ttl_seconds")))
    values = {**{c: F.col(c) for c in [*KEY, "features"]}, "event_time": F.col("event_time").cast("timestamp"), "materialized_at": at, "until": until}
    taken = [(F.coalesce(F.unix_micros(v), F.lit(_NEVER)) if c in _TIMES else v).alias(f"held_{c}") for c, v in values.items()]
    rows = online_rows.select(F.pmod(F.xxhash64(*KEY), F.lit(buckets)).alias("bucket"), at.alias("materialized_at"), *taken)
    changes = rows.withWatermark("materialized_at", delay).groupBy("bucket").transformWithStateInPandas(LiveFeatures(), _YIELDED, "Append", "EventTime")
    return changes.select(*[F.timestamp_micros(F.nullif(F.col(c), F.lit(_NEVER))).alias(c) if c in _TIMES else F.col(c) for c in changes.columns])


def live_rows(changes: DataFrame) -> DataFrame:
    """The rows that are live after ``changes``: the last change of each key, unless it is an ``expire``."""
    order = F.struct(F.col("materialized_at"), (F.col("change") == "expire").alias("last"), "event_time", "features")
    last = changes.groupBy(*KEY).agg(F.max_by(F.struct("change", "features", "event_time", "materialized_at", "until"), order).alias("c"))
    return last.select(*KEY, "c.*").filter("change = 'upsert'").drop("change")
