from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import temporal as tp
from tidemark.operators import asof, features as ft, fraud, saas, spine

AS_OF = "2024-01-31 00:00:00"


def times(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "s string").select("s", F.col("s").cast("timestamp_ntz").alias("t"))


def test_window_boundaries(spark):
    df = times(spark, "2024-01-24 00:00:00", "2024-01-23 23:59:59.999999", AS_OF, "2024-01-30 23:59:59.999999", "2024-01-31 00:00:00.000001")
    left = {r.s: r.x for r in df.select("s", tp.looking_back("t", AS_OF, timedelta(days=7)).alias("x")).collect()}
    both = {r.s: r.x for r in df.select("s", tp.looking_back("t", AS_OF, timedelta(days=7), "both").alias("x")).collect()}
    ahead = {r.s: r.x for r in df.select("s", tp.looking_ahead("t", AS_OF, timedelta(days=1)).alias("x")).collect()}
    assert left["2024-01-24 00:00:00"] and not left["2024-01-23 23:59:59.999999"]
    assert not left[AS_OF] and both[AS_OF]
    assert left["2024-01-30 23:59:59.999999"]
    assert not ahead[AS_OF] and ahead["2024-01-31 00:00:00.000001"]


def test_lenient_time(spark):
    rows = spark.createDataFrame([("2024-01-02",), ("",), ("junk",), (None,)], "s string").select(tp.lenient_time("s").alias("t")).collect()
    assert [r.t for r in rows] == [datetime(2024, 1, 2), None, None, None]


def test_overlap_days(spark):
    df = spark.sql(
        """SELECT id, cast(s AS timestamp_ntz) s, cast(e AS timestamp_ntz) e FROM VALUES (1, '2024-01-01', '2024-01-01 20:00:00'), (2, '2024-01-05', null),
        (3, '2023-12-01', '2024-02-01'), (4, '2024-03-01', null), (5, '2023-11-01', '2023-12-01') AS t(id, s, e)"""
    )
    got = {r.id: r.d for r in df.select("id", tp.overlap_days("s", "e", "2024-01-01", "2024-01-31").alias("d")).collect()}
    assert got == {1: 0, 2: 26, 3: 30, 4: None, 5: None}


def test_asof_is_strict_and_breaks_ties(spark):
    labels = spark.sql("SELECT id, cast(t AS timestamp_ntz) lt FROM VALUES (1, '2024-01-10 12:00:00'), (1, '2024-01-01'), (2, '2024-01-10'), (3, '2024-05-01') AS x(id, t)")
    feats = spark.sql(
        """SELECT id, cast(t AS timestamp_ntz) ft, v, k FROM VALUES (1, '2024-01-10 12:00:00', 'same', 1), (1, '2024-01-03', 'old', 2),
        (1, '2024-01-09', 'tie_a', 3), (1, '2024-01-09', 'tie_b', 4), (3, '2023-01-01', 'far', 5) AS x(id, t, v, k)"""
    )
    inner = {(r.id, str(r.lt)): r.v for r in asof.asof_join(labels, feats, "id", "lt", "ft", ["v"], tie="k").collect()}
    assert inner == {(1, "2024-01-10 12:00:00"): "tie_b", (3, "2024-05-01 00:00:00"): "far"}
    left = asof.asof_join(labels, feats, "id", "lt", "ft", ["v"], tie="k", how="left")
    assert left.count() == 4 and left.filter("v IS NULL").count() == 2


@pytest.mark.parametrize("bucket", [timedelta(minutes=7), timedelta(hours=3), timedelta(days=30)])
def test_asof_does_not_depend_on_bucket(spark, bucket):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    labels = ev.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("lt"), "event_id")
    feats = ev.filter("event_type <> 'purchase'").select("user_id", F.col("ts").alias("ft"), F.col("event_id").alias("f"))
    got = sorted(tuple(r) for r in asof.asof_join(labels, feats, "user_id", "lt", "ft", ["f"], tie="f", bucket=bucket).collect())
    pd_l, pd_f = labels.toPandas(), feats.toPandas()
    want = []
    for row in pd_l.itertuples():
        hit = pd_f[(pd_f.user_id == row.user_id) & (pd_f.ft < row.lt)].sort_values(["ft", "f"]).tail(1)
        if len(hit):
            want.append((row.user_id, row.lt.to_pydatetime(), row.event_id, hit.ft.iloc[0].to_pydatetime(), hit.f.iloc[0]))
    assert got == sorted(want)


def test_asof_window_is_not_keyed_by_entity_alone(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = asof.asof_join(ev.select("user_id", F.col("ts").alias("lt")), ev.select("user_id", F.col("ts").alias("ft"), "value"), "user_id", "lt", "ft", ["value"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__e" in plan and "__bucket" in plan


def test_leakage(spark):
    df = spark.sql("SELECT cast(f AS timestamp_ntz) f, cast(l AS timestamp_ntz) l FROM VALUES ('2024-01-01', '2024-01-02'), ('2024-01-02', '2024-01-02') AS t(f, l)")
    assert asof.leaking_rows(df, "f", "l").count() == 1
    assert asof.leaking_rows(df, "absent", "l").count() == 0
    with pytest.raises(Exception, match="feature time"):
        asof.assert_no_leakage(df, "f", "l").collect()


def test_rolling_splits_stop_at_the_end():
    splits = spine.rolling_splits(datetime(2024, 1, 1), datetime(2024, 12, 31), n_splits=5)
    assert max(s["split_id"] for s in splits) == 2
    first = [s for s in splits if s["split_id"] == 1]
    assert first[0]["ends"] == first[1]["starts"] and first[1]["ends"] == first[2]["starts"]
    assert first[2]["ends"] == datetime(2024, 1, 1) + timedelta(days=330)


def test_labels_with_open_contracts_and_missing_billing(spark):
    subs = spark.sql(
        """SELECT account_id, cast(s AS timestamp_ntz) start_date, cast(e AS timestamp_ntz) end_date, b billing_frequency, 30.0 mrr_amount, cast(null AS double) arr_amount
        FROM VALUES ('a', '2024-01-01', null, null), ('b', '2024-01-01', '2024-02-10', 'annual'), ('c', '2024-01-01', '2024-01-31', 'monthly'), ('d', '2024-02-15', null, 'monthly') AS t(account_id, s, e, b)"""
    )
    events = spark.sql("SELECT 'a' account_id, timestamp_ntz '2024-03-01 00:00:00' churn_date")
    churn = {r.account_id: r.churn for r in saas.churn_labels(events, subs, [AS_OF]).collect()}
    assert churn == {"a": 1, "b": 1}  # c ended exactly at as_of, d has not started
    ltv = {r.account_id: round(r.ltv_90d, 6) for r in saas.ltv_labels(subs, [AS_OF]).collect()}
    assert ltv == {"a": 90.0, "b": 0.0}


def test_per_event_velocity_of_one_busy_hour_is_linear(spark):
    import time

    n = 100_000
    rows = spark.range(n).select(
        F.lit(1).alias("u"), F.col("id"), (F.timestamp_seconds(F.lit(1_700_000_000 - 1_700_000_000 % 3600) + F.col("id") * 0.03)).cast("timestamp_ntz").alias("ts"), F.lit(2.0).alias("v")
    )
    begin = time.time()
    out = fraud.velocity_per_event(rows, "u", "ts", "v", "id", {"1h": timedelta(hours=1)})
    assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
    assert out.agg(F.sum("count_1h")).first()[0] == n * (n - 1) // 2
    assert time.time() - begin < 30


def test_active_days_by_bits(spark):
    """Calendar days inside the window, its first and last one included; nulls and rows outside count nothing."""
    times = ["2024-01-01 00:00:00", "2024-01-01 23:59:59", "2024-01-02 12:00:00", "2024-01-31 00:00:00", "2023-12-31 23:59:59", None]
    df = spark.createDataFrame([("a", t) for t in times], "k string, t string").selectExpr("k", "CAST(t AS TIMESTAMP_NTZ) AS ts")
    got = ft.build_features(df, "k", "ts", ["2024-01-31 00:00:00"], [ft.Feature("days", "active_days", timedelta(days=30)), ft.Feature("n", "count", timedelta(days=31))])
    assert [(r["days"], r["n"]) for r in got.collect()] == [(2, 4)]
    with pytest.raises(ValueError):
        ft.build_features(df, "k", "ts", ["2024-01-31 00:00:00"], [ft.Feature("days", "active_days", timedelta(days=90))])
