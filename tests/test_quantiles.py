import numpy as np
import pytest

from tidemark.operators import monitor as mo
from tidemark.operators.ordered import exact_quantiles

PROBS = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.951, "e": 1.0}


def check(spark, groups, **more):
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [(g, None) for g in groups]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r for r in exact_quantiles(df, "v", PROBS, ("g",), distinct="kinds", **more).collect()}
    for g, values in groups.items():
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
        kinds = len(set(values))
        assert got[g]["kinds"] == kinds if kinds <= 10 else got[g]["kinds"] > 10
    return got


def groups():
    rng = np.random.default_rng(1)
    return {
        "even": rng.normal(size=20_000), "heavy": np.where(rng.random(9000) < 0.4, 3.0, rng.normal(size=9000)), "few": rng.integers(0, 4, 5000).astype(float),
        "ten": rng.integers(0, 10, 5000).astype(float), "one": np.array([7.5]), "two": np.array([1.0, 2.0]), "flat": np.full(300, -2.0), None: rng.exponential(size=50),
    }


def test_against_numpy(spark):
    check(spark, groups())


def test_brackets_that_miss_are_widened(spark):
    """With no margin the sketch's own error leaves quantiles outside their brackets."""
    check(spark, {"even": groups()["even"]}, margin=1e-9)


def test_without_groups_and_without_rows(spark):
    values = groups()["heavy"]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = exact_quantiles(df, "v", {"q": 0.3}).first()
    assert row["q"] == pytest.approx(np.quantile(values, 0.3), rel=1e-12)
    assert [r["q"] for r in exact_quantiles(df.limit(0), "v", {"q": 0.3}).collect()] == [None]
    assert exact_quantiles(df.limit(0).selectExpr("1 AS g", "v"), "v", {"q": 0.3}, ("g",)).collect() == []


def test_only_brackets_are_ordered(spark):
    """Of 200,000 different values a few thousand reach the range sort."""
    from tidemark.operators import ordered

    seen, real = [], ordered.prefix_sum
    ordered.prefix_sum = lambda df, *a, **b: (seen.append(df.count()), real(df, *a, **b))[1]
    try:
        got = exact_quantiles(spark.range(200_000).selectExpr("id * 1.0D AS v"), "v", {"p10": 0.1, "p90": 0.9}).first()
    finally:
        ordered.prefix_sum = real
    assert (got["p10"], got["p90"]) == pytest.approx((19_999.9, 179_999.1)) and len(seen) == 1 and seen[0] < 4000


def test_p95_of_counts(spark):
    rng = np.random.default_rng(2)
    rows = [("a", f"2024-01-01 00:{m:02d}:{s:02d}", int(x), 500 if x % 50 == 0 else 200) for m in range(3) for s, x in enumerate(rng.integers(0, 40, 60))]
    rows += [("b", "2024-01-01 00:00:10", None, 503), ("c", "2024-01-01 00:00:10", 7, None), ("c", "2024-01-01 00:00:11", None, 200)]
    audit = spark.createDataFrame(rows, "domain string, t string, latency_ms int, status int").selectExpr("domain", "CAST(t AS TIMESTAMP_NTZ) AS created_at", "latency_ms", "status")
    counts = mo.latency_counts(audit)
    got = {(r["domain"], r["window_start"].minute): r for r in mo.slo_of_counts(counts.unionAll(counts.limit(0))).collect()}
    for m in range(3):
        x = [r[2] for r in rows if r[0] == "a" and r[1][14:16] == f"{m:02d}"]
        assert got["a", m]["p95_ms"] == pytest.approx(np.quantile(x, 0.95)) and got["a", m]["n"] == 60
        assert got["a", m]["error_rate"] == pytest.approx(np.mean([v % 50 == 0 for v in x]))
    assert (got["b", 0]["n"], got["b", 0]["error_rate"], got["b", 0]["p95_ms"]) == (1, 1.0, None)
    assert (got["c", 0]["n"], got["c", 0]["error_rate"], got["c", 0]["p95_ms"]) == (2, 0.0, 7.0)
