"""Queries over offer allocation, backtests and explanations."""

from pyspark.sql import DataFrame, functions as F

from ..operators import allocate as al, explain as ex, spine
from ..operators.metrics import decision_metrics
from .feature_queries import rounded
from .registry import query
from .views import Tables

BUDGET = 500.0
_PROFITS = """cand AS (SELECT user_id, segment, churn_prob, ltv_90d, o.offer_type, churn_prob * o.uplift * ltv_90d - o.cost AS profit, o.cost, (churn_prob * o.uplift * ltv_90d - o.cost) / o.cost AS ratio
    FROM user_scores_v, (VALUES ('OFFER_5', 5e0, 0.05e0), ('OFFER_10', 10e0, 0.10e0), ('CALL_SUPPORT', 20e0, 0.15e0)) o(offer_type, cost, uplift)
    WHERE churn_prob * o.uplift * ltv_90d - o.cost > 0)"""


def _walk(budget: str, by: str = "") -> str:
    """The sequential walk as a recursive query: one candidate per step."""
    return f"""ordered AS (SELECT *, row_number() OVER (ORDER BY ratio DESC, cost, user_id, offer_type) AS i FROM cand),
      walk(i, remaining, taken, chosen) AS (SELECT CAST(0 AS BIGINT), {budget}, FALSE, [CAST(-1 AS BIGINT)]
        UNION ALL SELECT o.i, CASE WHEN w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id) THEN w.remaining - o.cost ELSE w.remaining END,
          w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id),
          CASE WHEN w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id) THEN list_append(w.chosen, o.user_id) ELSE w.chosen END
        FROM walk w JOIN ordered o ON o.i = w.i + 1 WHERE w.remaining >= 5),
      picked AS (SELECT o.* FROM walk w JOIN ordered o USING (i) WHERE w.taken)"""


@query("offer_candidates", "user_scores_v", f"WITH {_PROFITS} SELECT user_id, offer_type, round(profit, 10) AS profit, cost, round(ratio, 10) AS profit_per_cost FROM cand")
def offer_candidates(t: Tables) -> DataFrame:
    return rounded(al.offer_candidates(t.user_scores_v, al.DEFAULT_OFFERS), "profit", "profit_per_cost", digits=10)


@query(
    "segment_candidates", "user_scores_v",
    """SELECT user_id, 'CALL_SUPPORT' AS offer_type, round(churn_prob * (0.15e0 * CASE WHEN segment = 'BUILDING' THEN 1.1e0 ELSE 0.9e0 END) * ltv_90d - 20, 10) AS profit, 20e0 AS cost,
      round((churn_prob * (0.15e0 * CASE WHEN segment = 'BUILDING' THEN 1.1e0 ELSE 0.9e0 END) * ltv_90d - 20) / 20, 10) AS profit_per_cost FROM user_scores_v
      WHERE churn_prob * (0.15e0 * CASE WHEN segment = 'BUILDING' THEN 1.1e0 ELSE 0.9e0 END) * ltv_90d - 20 > 0 AND churn_prob >= 0.1""",
)
def segment_candidates(t: Tables) -> DataFrame:
    offers = [al.Offer("CALL_SUPPORT", 20.0, 0.15, "BUILDING")]
    return rounded(al.offer_candidates(t.user_scores_v, offers, segment="segment", skip_low_risk=0.1), "profit", "profit_per_cost", digits=10)


@query(
    "greedy_allocate", "user_scores_v",
    f"""WITH RECURSIVE {_PROFITS}, {_walk('500e0')}
      SELECT u.user_id, coalesce(p.offer_type, 'NO_ACTION') AS action,
        CASE WHEN p.offer_type IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_filter([CASE WHEN u.churn_prob > 0.7 THEN 'HIGH_CHURN_RISK' WHEN u.churn_prob > 0.5 THEN 'MEDIUM_CHURN_RISK' END,
          CASE WHEN u.ltv_90d > 1000 THEN 'HIGH_VALUE' WHEN u.ltv_90d < 100 THEN 'LOW_VALUE' END], lambda x: x IS NOT NULL) END AS reason_codes,
        round(coalesce(p.profit, 0), 8) AS expected_profit, coalesce(p.cost, 0) AS cost FROM user_scores_v u LEFT JOIN picked p USING (user_id)""",
)
def greedy_allocate(t: Tables) -> DataFrame:
    return rounded(al.greedy_allocate(t.user_scores_v, al.DEFAULT_OFFERS, BUDGET), "expected_profit", digits=8)


@query(
    "decision_metrics", "user_scores_v",
    f"""WITH RECURSIVE {_PROFITS}, {_walk('500e0')}
      SELECT round(sum(profit), 8) AS total_expected_profit, round(sum(cost) / 500, 8) AS budget_utilization, round(sum(profit), 8) AS profit_uplift,
        (SELECT count(*) FROM user_scores_v) AS n_users, round(1 - sum(u.churn) * 1e0 / count(*), 8) AS offer_fp_rate FROM picked JOIN user_scores_v u USING (user_id)""",
)
def allocation_metrics(t: Tables) -> DataFrame:
    decisions = al.greedy_allocate(t.user_scores_v, al.DEFAULT_OFFERS, BUDGET)
    out = decision_metrics(decisions, BUDGET, t.user_scores_v.select("user_id", "churn"))
    return rounded(out, "total_expected_profit", "budget_utilization", "profit_uplift", "offer_fp_rate", digits=8)


@query(
    "backtest_strata", "user_scores_v",
    f"""WITH RECURSIVE {_PROFITS}, {_walk('500e0')}
      SELECT 'segment' AS stratum, u.segment AS stratum_value, round(coalesce(sum(p.profit), 0), 8) AS total_expected_profit, round(coalesce(sum(p.cost), 0) / 500, 8) AS budget_utilization,
        round(coalesce(sum(p.profit), 0), 8) AS profit_uplift, count(*) AS n_users, round(1 - sum(u.churn) FILTER (p.user_id IS NOT NULL) * 1e0 / nullif(count(p.user_id), 0), 8) AS offer_fp_rate
      FROM user_scores_v u LEFT JOIN picked p USING (user_id) GROUP BY u.segment""",
)
def backtest_strata(t: Tables) -> DataFrame:
    users = t.user_scores_v
    out = al.backtest(users, al.DEFAULT_OFFERS, BUDGET, users.select("user_id", "churn"), ["segment"])["stratified"]
    return rounded(out, "total_expected_profit", "budget_utilization", "profit_uplift", "offer_fp_rate", digits=8)


_BUDGETS = ", ".join(f"({BUDGET * (1.0 if i == 9 else 0.1 + 0.1 * i):.6f}::DOUBLE)" for i in range(10))


@query(
    "profit_curve", "user_scores_v",
    f"""WITH RECURSIVE {_PROFITS}, ordered AS (SELECT *, row_number() OVER (ORDER BY ratio DESC, cost, user_id, offer_type) AS i FROM cand),
      walk(budget, i, remaining, profit, chosen) AS (SELECT b, CAST(0 AS BIGINT), b, 0e0, [CAST(-1 AS BIGINT)] FROM (VALUES {_BUDGETS}) v(b)
        UNION ALL SELECT w.budget, o.i, CASE WHEN w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id) THEN w.remaining - o.cost ELSE w.remaining END,
          CASE WHEN w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id) THEN w.profit + o.profit ELSE w.profit END,
          CASE WHEN w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id) THEN list_append(w.chosen, o.user_id) ELSE w.chosen END
        FROM walk w JOIN ordered o ON o.i = w.i + 1 WHERE w.remaining >= 5),
      last AS (SELECT budget, arg_max(remaining, i) AS remaining, arg_max(profit, i) AS profit FROM walk GROUP BY 1)
      SELECT round(budget, 8) AS budget, round(profit, 8) AS profit, round(budget - remaining, 8) AS cost, round((budget - remaining) / budget, 8) AS budget_utilization FROM last""",
)
def profit_curve(t: Tables) -> DataFrame:
    out = al.profit_curve(t.user_scores_v, al.DEFAULT_OFFERS, BUDGET)
    return rounded(out, "budget", "profit", "cost", "budget_utilization", digits=8)


@query("lagrangian_report", "user_scores_v", "SELECT TRUE AS within_budget, TRUE AS below_bound, TRUE AS near_bound, count(*) > 0 AS has_users FROM user_scores_v")
def lagrangian_report(t: Tables) -> DataFrame:
    """The plan keeps the budget, and the dual bound shows how near it is to the optimum."""
    report = al.lagrangian_allocate(t.user_scores_v, al.DEFAULT_OFFERS, BUDGET)[1]
    return report.select(
        (F.col("cost") <= BUDGET).alias("within_budget"), (F.col("profit") <= F.col("upper_bound") + 1e-6).alias("below_bound"),
        (F.col("gap") <= 0.02 * F.col("upper_bound")).alias("near_bound"), F.lit(True).alias("has_users"),
    )


@query(
    "windowed_backtest", "orders",
    """WITH RECURSIVE b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
      win AS (SELECT CAST(i + 1 AS INTEGER) AS split_id, s + to_days(CAST(180 * i AS INTEGER)) AS starts, s + to_days(CAST(180 * i + 180 AS INTEGER)) AS ends
        FROM b, range(100) g(i) WHERE s + to_days(CAST(180 * i + 180 AS INTEGER)) <= e),
      scored AS (SELECT o_custkey AS user_id, o_orderdate, o_orderkey * 7919 % 1000 / 1e3 AS p, o_totalprice / 100 AS v FROM orders),
      latest AS (SELECT split_id, user_id, p, v FROM scored JOIN win ON o_orderdate >= starts AND o_orderdate < ends
        QUALIFY row_number() OVER (PARTITION BY split_id, user_id ORDER BY o_orderdate DESC, p DESC, v DESC) = 1),
      cand AS (SELECT split_id, user_id, p * o.uplift * v - o.cost AS profit, o.cost, (p * o.uplift * v - o.cost) / o.cost AS ratio, o.offer_type FROM latest,
        (VALUES ('OFFER_5', 5e0, 0.05e0), ('OFFER_10', 10e0, 0.10e0), ('CALL_SUPPORT', 20e0, 0.15e0)) o(offer_type, cost, uplift) WHERE p * o.uplift * v - o.cost > 0),
      ordered AS (SELECT *, row_number() OVER (PARTITION BY split_id ORDER BY ratio DESC, cost, user_id, offer_type) AS i FROM cand),
      walk(split_id, i, remaining, profit, n, chosen) AS (SELECT split_id, CAST(0 AS BIGINT), 500e0, 0e0, CAST(0 AS BIGINT), [CAST(-1 AS BIGINT)] FROM win
        UNION ALL SELECT w.split_id, o.i, CASE WHEN w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id) THEN w.remaining - o.cost ELSE w.remaining END,
          CASE WHEN w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id) THEN w.profit + o.profit ELSE w.profit END,
          CASE WHEN w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id) THEN w.n + 1 ELSE w.n END,
          CASE WHEN w.remaining >= o.cost AND NOT list_contains(w.chosen, o.user_id) THEN list_append(w.chosen, o.user_id) ELSE w.chosen END
        FROM walk w JOIN ordered o ON o.split_id = w.split_id AND o.i = w.i + 1 WHERE w.remaining >= 5)
      SELECT split_id, (SELECT count(*) FROM latest l WHERE l.split_id = walk.split_id) AS users, arg_max(n, i) AS offered, round(arg_max(profit, i), 4) AS profit, 500 - arg_max(remaining, i) AS cost FROM walk GROUP BY 1""",
)
def windowed_backtest(t: Tables) -> DataFrame:
    scored = t.orders.select(
        F.col("o_custkey").alias("user_id"), "o_orderdate", (F.col("o_orderkey") * 7919 % 1000 / 1e3).alias("churn_prob"), (F.col("o_totalprice") / 100).alias("ltv_90d")
    )
    start, end = spine.time_bounds(t.orders, "o_orderdate")
    out = al.windowed_backtest(scored, "o_orderdate", spine.rolling_windows(start, end, 6, 6), al.DEFAULT_OFFERS, BUDGET)
    return rounded(out, "profit", digits=4)


_COEF = {"l_quantity": 0.02, "l_extendedprice": -0.00003, "l_discount": 5.0, "l_tax": -2.5}
_MEANS = "m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in _COEF) + " FROM lineitem)"
_CONTRIB = " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_partkey, '{c}' AS feature, {w!r}::DOUBLE * ({c} - m_{c}) AS contribution FROM lineitem, m" for c, w in _COEF.items()
)


@query(
    "row_contributions", "lineitem",
    f"""WITH l AS (SELECT *, concat(cast(l_orderkey AS string), '_', cast(l_linenumber AS string), '_', cast(l_partkey AS string), '_', cast(l_suppkey AS string), '_', cast(l_shipdate AS string)) AS id FROM lineitem), {_MEANS},
      c AS ({_CONTRIB.replace('l_orderkey, l_linenumber, l_partkey', 'id').replace('FROM lineitem, m', 'FROM l, m')})
      SELECT feature, rank, count(*) AS n, round(sum(contribution), 4) AS total FROM
        (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, feature) AS rank FROM c) WHERE rank <= 10 GROUP BY ALL""",
)
def row_contributions(t: Tables) -> DataFrame:
    id_parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    rows = t.lineitem.withColumn("id", F.concat_ws("_", *[F.col(c).cast("string") for c in id_parts]))
    out = ex.explain_rows(rows, "id", list(_COEF), _COEF, ex.feature_means(t.lineitem, list(_COEF)))
    return out.groupBy("feature", "rank").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("contribution"), 4).alias("total"))


@query("global_importance", "lineitem", f"WITH {_MEANS}, c AS ({_CONTRIB}) SELECT feature, round(avg(abs(contribution)), 6) AS importance FROM c GROUP BY 1")
def global_importance(t: Tables) -> DataFrame:
    means = ex.feature_means(t.lineitem, list(_COEF))
    return rounded(ex.global_importance(t.lineitem, list(_COEF), _COEF, means), "importance")


_SAAS = ["payment_fail_30d", "recency_days", "tickets_30d", "plan_tier"]


@query(
    "contribution_reasons", "events",
    """WITH f AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS payment_fail_30d, date_diff('day', max(ts), TIMESTAMP '2024-02-10 00:00:00') AS recency_days,
        count(*) FILTER (event_type = 'signup') AS tickets_30d, count(DISTINCT event_type) AS plan_tier FROM events GROUP BY 1),
      c AS (SELECT user_id, unnest(['payment_fail_30d', 'recency_days', 'tickets_30d', 'plan_tier']) AS feature, unnest(['PAYMENT_FAIL', 'LOW_RECENCY', 'SUPPORT_FRICTION', 'PLAN_TIER']) AS code,
        unnest([payment_fail_30d, recency_days, tickets_30d, plan_tier]) * 0.1e0 AS v FROM f)
      SELECT user_id, list(code ORDER BY abs(v) DESC, feature) AS reason_codes FROM c WHERE abs(v) >= 1.0 GROUP BY 1""",
)
def contribution_reasons(t: Tables) -> DataFrame:
    e = F.col("event_type")
    rows = t.events.groupBy("user_id").agg(
        F.count_if(e == "error").alias("payment_fail_30d"),
        F.datediff(F.lit("2024-02-10").cast("date"), F.max("ts")).alias("recency_days"),
        F.count_if(e == "signup").alias("tickets_30d"),
        F.count_distinct(e).alias("plan_tier"),
    )
    codes = ex.contribution_reasons(ex.contributions(_SAAS), threshold=1.0)
    return rows.select("user_id", codes.alias("reason_codes")).filter(F.size("reason_codes") > 0)
