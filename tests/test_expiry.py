from datetime import datetime, timedelta

import pandas as pd

from tidemark.session import scratch_path
from tidemark.streaming import expiry, streams as sm

SCHEMA = "domain string, entity_key string, feature_set_version string, features string, event_time timestamp_ntz, materialized_at timestamp_ntz, ttl_seconds bigint"
START = datetime(2024, 1, 1)


def row(key, minute, ttl, features="{}"):
    at = START + timedelta(minutes=minute)
    return ("d", key, "v", features, at, at, ttl)


def test_keys_leave_after_their_time_and_state_survives_a_restart(spark):
    source, out, state = (scratch_path(spark, name) for name in ("live-in", "live-out", "live-state"))

    def arrive(*rows):
        """One more file, and a run of the query from its checkpoint until everything is processed."""
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        with expiry.keyed_state(spark):
            stream = sm.file_stream(spark, source, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
            sm.run_available(expiry.live_changes(stream, "0 seconds"), out, state)
        changes = spark.read.schema(expiry.CHANGES).parquet(out)
        return [(r["entity_key"], r["change"]) for r in changes.collect()], {r["entity_key"]: r["features"] for r in expiry.live_rows(changes).collect()}

    before = spark.conf.get(expiry._PROVIDER, None)
    changes, live = arrive(row("a", 0, 60), row("a", 0, 60, "{older}") , row("b", 0, None), row("c", 0, 3600))
    assert live == {"a": "{}", "b": "{}", "c": "{}"} or live["a"] == "{older}"
    changes, live = arrive(row("c", 5, 3600, "{new}"), row("x", 5, 60))
    assert changes.count(("a", "expire")) == 1 and live == {"b": "{}", "c": "{new}", "x": "{}"}
    # The timer of a key's older row no longer counts: c lives on past minute 60.
    changes, live = arrive(row("a", 62, 60, "{again}"))
    assert live == {"a": "{again}", "b": "{}", "c": "{new}"} and ("c", "expire") not in changes
    changes, live = arrive(row("late", 1, None), row("b", 70, None, "{b}"))
    assert live == {"b": "{b}"} and changes.count(("a", "expire")) == 2 and changes.count(("c", "expire")) == 1
    assert spark.conf.get(expiry._PROVIDER, None) == before


def test_nothing_arrives(spark):
    source = scratch_path(spark, "live-none")
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    with expiry.keyed_state(spark):
        stream = sm.file_stream(spark, source, spark.createDataFrame([], SCHEMA).schema)
        out = scratch_path(spark, "live-none-out")
        sm.run_available(expiry.live_changes(stream, "0 seconds"), out, scratch_path(spark, "live-none-state"))
    assert expiry.live_rows(spark.read.schema(expiry.CHANGES).parquet(out)).collect() == []


class CountedState:
    """Stands in for the handle: one value of state, one set of timers, and how often each was called."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


def test_state_calls_do_not_grow_with_the_keys():
    """A micro-batch of a thousand keys reads and writes their state once."""
    handle, live = CountedState(), expiry.LiveFeatures()
    live.init(handle)
    for arrival in (1, 2):
        rows = {"domain": "d", "entity_key": [f"k{i}" for i in range(1000)], "feature_set_version": "v", "features": "{}"}
        at = [arrival * 1000 * (i + 1) for i in range(1000)]
        part = pd.DataFrame(rows | {"event_time": at, "materialized_at": at, "until": [a + 5_000_000 for a in at]}).add_prefix("held_")
        assert sum(len(c) for c in live.handleInputRows((0,), iter([part]), None)) == 1000
    assert handle.calls <= 8 and handle.timers == {5_002 + 1}


def test_keys_of_one_bucket_go_one_by_one(spark):
    source, out = scratch_path(spark, "bucket-in"), scratch_path(spark, "bucket-out")
    arrivals = [
        [row("a", 0, 60), row("b", 0, 1800), row("c", 0, None), row(None, 0, 60)],
        [row("a", 5, 60, "{again}")],
        [row("d", 20, 3600)],
        [row("e", 90, 3600)],
    ]
    for rows in arrivals:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    with expiry.keyed_state(spark):
        stream = sm.file_stream(spark, source, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
        sm.run_available(expiry.live_changes(stream, "0 seconds", buckets=1), out, scratch_path(spark, "bucket-state"))
    changes = spark.read.schema(expiry.CHANGES).parquet(out)
    seen = sorted((r["change"], r["entity_key"] or "", r["features"]) for r in changes.collect())
    assert [s for s in seen if s[0] == "expire"] == [("expire", "", "{}"), ("expire", "a", "{again}"), ("expire", "b", "{}"), ("expire", "d", "{}")]
    kept = {r["entity_key"]: (r["event_time"], r["until"]) for r in expiry.live_rows(changes).collect()}
    assert kept["c"] == (START, None) and kept["e"][1] == START + timedelta(minutes=150) and len(kept) == 2
