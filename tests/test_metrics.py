import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, gates, metrics as mx, ordered


def scored(spark, rows):
    return spark.createDataFrame([(i, y, float(p)) for i, (y, p) in enumerate(rows)], "id long, y int, p double")


def brute(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap = sum(sum(1 for y, q in rows if y and q == t) / len(pos) * (sum(y for y, q in rows if q >= t) / sum(1 for _, q in rows if q >= t)) for t in set(p for _, p in rows))
    edges = np.linspace(0, 1, 11)
    ece = 0.0
    for lo, hi in zip(edges[:-1], edges[1:]):
        cell = [(y, p) for y, p in rows if lo < p <= hi]
        if cell:
            ece += abs(np.mean([p for _, p in cell]) - np.mean([y for y, _ in cell])) * len(cell) / len(rows)
    return auc, ap, ece


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_binary_metrics_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 1), round(rng.random(), 1 if seed == 1 else 2)) for _ in range(200)]
    got = mx.binary_metrics(scored(spark, rows), "y", "p").first()
    auc, ap, ece = brute(rows)
    assert got.auc == pytest.approx(auc) and got.pr_auc == pytest.approx(ap) and got.ece == pytest.approx(ece)
    flipped = mx.binary_metrics(scored(spark, [(y, 1 - p) for y, p in rows]), "y", "p").first()
    assert flipped.auc == pytest.approx(1 - auc)


def test_ece_edges_and_log_loss_clip(spark):
    rows = [(1, 0.0), (0, 0.1), (1, 0.7), (0, 1.0)]
    got = mx.binary_metrics(scored(spark, rows), "y", "p").first()
    # p = 0 is in no bin; 0.1 is in the first; 0.7 is at most the edge 0.7000000000000001.
    assert got.ece == pytest.approx((0.1 + 0.3 + 1.0) / 4)
    assert math.isfinite(got.log_loss)
    assert mx.even_edges(10) == list(np.linspace(0, 1, 11))


def test_single_class_and_all_equal(spark):
    one = mx.binary_metrics(scored(spark, [(1, 0.4), (1, 0.6)]), "y", "p").first()
    assert one.auc is None
    same = mx.binary_metrics(scored(spark, [(1, 0.5), (0, 0.5)]), "y", "p").first()
    assert same.auc == pytest.approx(0.5)


def test_topk_zero_rows_is_null(spark):
    got = mx.topk_metrics(scored(spark, [(1, 0.4), (0, 0.6)]), "y", "p", "id", [0.1, 0.5]).first()
    assert got.topk_precision_10pct is None and got.topk_precision_50pct == 0.0


def test_prefix_sum_with_one_hot_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 1000, 5).otherwise(F.col("id") % 50).alias("v"), F.lit(2).alias("w"))
    out = ordered.prefix_sum(df, [("v", "desc"), ("id", "asc")], {"w": "run"}, totals={"w": "all"}, partitions=6)
    rows = out.orderBy("run").collect()
    assert [r.run for r in rows] == [2 * (i + 1) for i in range(3000)] and {r["all"] for r in rows} == {6000}
    assert [(r.v, r.id) for r in rows] == sorted([(r.v, r.id) for r in rows], key=lambda x: (-x[0], x[1]))


def test_prefix_sum_restarts_per_group_and_has_no_single_task(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id", F.lit(1).alias("w"))
    out = ordered.prefix_sum(df, [("id", "asc")], {"w": "rank"}, by=("g",))
    assert {r.g: r.m for r in out.groupBy("g").agg(F.max("rank").alias("m")).collect()} == {0: 167, 1: 167, 2: 166}
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_exact_quantiles(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=999), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = ordered.exact_quantiles(df, "v", {"a": 0.0, "b": 0.333, "c": 0.95, "d": 1.0}).first()
    assert [got.a, got.b, got.c, got.d] == pytest.approx([np.quantile(x, q) for q in (0, 0.333, 0.95, 1)])


def test_psi_and_ks(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=800), rng.normal(0.4, 1.2, size=700)
    frame = lambda x: spark.createDataFrame([(float(v),) for v in x], "v double")
    base, cur = frame(a), frame(b)
    edges = np.quantile(a, np.linspace(0, 1, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    e = np.histogram(a, edges)[0] / (800 + 1e-6) + 1e-6
    p = np.histogram(b, edges)[0] / (700 + 1e-6) + 1e-6
    want = float(np.sum((p - e) * np.log(p / e)))
    rep = drift.drift_report(base, cur, ["v"]).first()
    assert rep.psi == pytest.approx(want)
    grid = np.sort(np.concatenate([a, b]))
    ks = np.max(np.abs(np.searchsorted(np.sort(a), grid, "right") / 800 - np.searchsorted(np.sort(b), grid, "right") / 700))
    assert rep.ks == pytest.approx(ks)
    same = drift.drift_report(base, base, ["v"]).first()
    assert same.psi == pytest.approx(0) and same.ks == 0


def test_psi_of_few_values_uses_categories(spark):
    base = spark.range(100).select((F.col("id") % 4).cast("double").alias("v"))
    cur = spark.range(100).select((F.col("id") % 8).cast("double").alias("v"))
    assert drift.baseline_edges(base, ["v"]) == {}
    e, a = np.array([25, 25, 25, 25, 0]), np.array([13, 13, 13, 13, 48])
    e, a = e / (100 + 1e-6) + 1e-6, a / (100 + 1e-6) + 1e-6
    got = drift.drift_report(base, cur, ["v"]).first().psi
    assert got == pytest.approx(float(np.sum((a - e) * np.log(a / e))), rel=1e-6)


def test_gates(spark):
    m = spark.createDataFrame([("auc", 0.80), ("latency_p95_ms", 130.0), ("smape", 25.0)], "metric string, value double")
    assert gates.gate_verdict(gates.evaluate_gate(m, {"auc_min": 0.70})).first().passed
    assert not gates.gate_verdict(gates.evaluate_gate(m, {"auc_min": 0.90})).first().passed
    checks = {r.metric: r.passed for r in gates.evaluate_gate(m, {"slo": {"latency_p95_max_ms": 120}, "ltv": {"smape_max": {"threshold": 0.30, "unit": "ratio"}}}).collect()}
    assert checks == {"latency_p95_ms": False, "smape": True}
    assert gates.evaluate_gate(m, {"brier_max": 0.1}).count() == 0
    assert not gates.evaluate_gate(m, {"brier_max": 0.1}, missing="fail").first().passed


def test_guardrail_rules(spark):
    m = spark.createDataFrame([("idk_violation_rate", 0.1), ("hallucination_flag_rate", 0.01)], "metric string, value double")
    rows = gates.rag_gate(m, {"guardrails": {"must_return_idk_when_no_evidence": True, "hallucination_flag_rate_max": 0.05}}).collect()
    assert [(r.metric, r.passed) for r in rows] == [("must_return_idk", False)]


def test_streaks(spark):
    df = spark.createDataFrame([("a", d, p) for d, p in enumerate([0.3, 0.1, 0.4, 0.5, 0.2])], "feature string, d int, psi double")
    out = drift.drift_triggers(df, (), "d").orderBy("d").collect()
    assert [r.streak for r in out] == [1, 0, 1, 2, 0] and [r.retrain for r in out] == [False, False, False, True, False]
