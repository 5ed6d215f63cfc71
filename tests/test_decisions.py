import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import allocate as al, explain as ex, policy


def walk(users, offers, budget):
    """One candidate at a time."""
    cands = []
    for u, p, v in users:
        for o in offers:
            profit = p * o.uplift_rate * v - o.cost
            if profit > 0 and o.cost > 0:
                cands.append((-(profit / o.cost), o.cost, u, o.offer_type, profit))
    cands.sort()
    left, taken = round(budget * 100), {}
    for _, cost, u, name, profit in cands:
        if u not in taken and round(cost * 100) <= left:
            taken[u] = name
            left -= round(cost * 100)
    return taken


@pytest.mark.parametrize("seed", range(4))
def test_greedy_equals_the_sequential_walk(spark, seed):
    rng = random.Random(seed)
    users = [(i, rng.choice([0.1, 0.5, 0.9]), rng.choice([100.0, 800.0, 3000.0]) if seed % 2 else rng.random() * 3000) for i in range(120)]
    offers = [al.Offer(f"o{i}", c, rng.uniform(0.02, 0.2)) for i, c in enumerate(rng.sample([3.0, 5.0, 7.5, 10.0, 20.0, 33.0], 4))]
    df = spark.createDataFrame(users, "user_id long, churn_prob double, ltv_90d double")
    budgets = {"a": 95.0, "b": 333.0, "c": 0.0, "d": 1e6}
    # With and without a budget too small for the dearest offer: budgets that can pay any offer share the first phase.
    for some in (budgets, {k: b for k, b in budgets.items() if b > 33}):
        got = al.greedy_select(al.offer_options(df, offers), some).collect()
        for name, budget in some.items():
            assert {r.user_id: r.offer_type for r in got if r.budget_id == name} == walk(users, offers, budget)


def test_allocation_has_one_row_per_user_and_respects_the_budget(spark):
    df = spark.createDataFrame([(i, 0.05 if i % 5 == 0 else 0.8, 2000.0) for i in range(50)], "user_id long, churn_prob double, ltv_90d double")
    out = al.greedy_allocate(df, al.DEFAULT_OFFERS, 100.0, skip_low_risk=0.1).collect()
    assert len(out) == len({r.user_id for r in out}) == 50
    assert sum(r.cost for r in out) <= 100
    assert all(r.reason_codes == ["LOW_RISK"] for r in out if r.user_id % 5 == 0)
    assert all(r.action == "NO_ACTION" for r in out if r.user_id % 5 == 0)


def test_no_candidates_gives_no_action_for_everyone(spark):
    df = spark.createDataFrame([(1, 0.0, 10.0), (2, 0.1, 5.0)], "user_id long, churn_prob double, ltv_90d double")
    assert {r.action for r in al.greedy_allocate(df, al.DEFAULT_OFFERS, 100.0).collect()} == {"NO_ACTION"}


def test_lagrangian_is_within_its_bound_and_near_the_optimum(spark):
    rng = random.Random(3)
    users = [(i, rng.random(), rng.uniform(50, 900)) for i in range(9)]
    offers, budget = al.DEFAULT_OFFERS, 45.0
    best = 0.0
    for choice in itertools.product([None, *offers], repeat=len(users)):
        if sum(o.cost for o in choice if o) <= budget:
            best = max(best, sum(p * o.uplift_rate * v - o.cost for (_, p, v), o in zip(users, choice) if o))
    df = spark.createDataFrame(users, "user_id long, churn_prob double, ltv_90d double")
    decisions, report = al.lagrangian_allocate(df, offers, budget)
    r = report.first()
    assert r.cost <= budget and r.profit <= best + 1e-9 <= r.upper_bound + 1e-9 and r.profit >= 0.9 * best
    assert decisions.count() == 9


def test_profit_curve_grows_with_the_budget(spark):
    df = spark.createDataFrame([(i, 0.5 + i / 200, 500.0 + i) for i in range(60)], "user_id long, churn_prob double, ltv_90d double")
    rows = al.profit_curve(df, al.DEFAULT_OFFERS, 200.0).orderBy("budget").collect()
    assert [round(r.budget, 6) for r in rows] == [20.0 * (i + 1) for i in range(10)]
    assert all(a.profit <= b.profit for a, b in zip(rows, rows[1:])) and all(r.cost <= r.budget for r in rows)


def test_rules_treat_missing_and_nan_as_no_match(spark):
    df = spark.createDataFrame(
        [(1, 0.95, 1.0, True), (2, float("nan"), 1.0, True), (3, None, 1.0, True), (4, 0.75, None, False), (5, 0.75, 20000.0, False), (6, 0.65, 1.0, True), (7, 0.2, 1.0, False)],
        "id int, risk_score double, amount_usd double, is_new_device boolean",
    )
    got = {r.id: (r.decision, r.reason) for r in policy.apply_rules(df, policy.DEFAULT_RULES).collect()}
    assert got[1] == ("REJECT", "high_risk_reject")
    assert got[2] == got[3] == ("APPROVE", "default_approve")
    assert got[4] == ("MANUAL_REVIEW", "medium_risk_manual_review")
    assert got[5] == ("MANUAL_REVIEW", "high_amount_manual_review")
    assert got[6] == ("MANUAL_REVIEW", "new_device_manual_review")
    assert got[7] == ("APPROVE", "low_risk_approve")


def test_rule_names_do_not_clash_on_substrings(spark):
    df = spark.createDataFrame([(5.0, 50000.0)], "amount double, amount_usd double")
    rules = [policy.Rule("big", "amount_usd > 10000 and amount < 10", "REJECT", 1)]
    assert policy.apply_rules(df, rules).first().decision == "REJECT"


def test_threshold_sweep_against_direct_count(spark):
    scores = [0.0, 0.05, 1 / 3, 0.5, 0.9, 0.95, 1.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    for r in policy.threshold_sweep(df, "s").collect():
        lo, hi = min(r.threshold, 0.9), max(r.threshold, 0.9)
        assert r.approve_rate == pytest.approx(sum(s < lo for s in scores) / 7), r
        assert r.reject_rate == pytest.approx(sum(s >= hi for s in scores) / 7), r


def test_contribution_order_and_reasons(spark):
    df = spark.createDataFrame([(1, 3.0, -5.0, 0.2)], "id int, tickets_30d double, recency_days double, other double")
    names = ["tickets_30d", "recency_days", "other"]
    rows = ex.explain_rows(df, "id", names, top=2).collect()
    assert [(r.rank, r.feature) for r in rows] == [(1, "recency_days"), (2, "tickets_30d")]
    codes = df.select(ex.contribution_reasons(ex.contributions(names)).alias("c")).first().c
    assert codes == ["LOW_RECENCY", "SUPPORT_FRICTION"]


def test_plan_of_candidates_is_narrow(spark):
    df = spark.range(10).select(F.col("id").alias("user_id"), F.lit(0.9).alias("churn_prob"), F.lit(1000.0).alias("ltv_90d"))
    plan = al.offer_candidates(df, al.DEFAULT_OFFERS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_lagrangian_prices_a_table_of_one_file_in_all_tasks(spark, monkeypatch):
    users = spark.range(400).coalesce(1).select(F.col("id").alias("user_id"), (F.col("id") % 97 / 97).alias("churn_prob"), (F.col("id") * 7.0).alias("ltv_90d"))
    widths, cut = [], al.cut
    monkeypatch.setattr(al, "cut", lambda df: widths.append(df.rdd.getNumPartitions()) or cut(df))
    decisions, report = al.lagrangian_allocate(users, al.DEFAULT_OFFERS, 300.0)
    r = report.first()
    assert min(widths[:2]) >= int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert decisions.count() == 400 and r["cost"] <= 300 and 0 < r["profit"] <= r["upper_bound"] + 1e-6
