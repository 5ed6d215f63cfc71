"""Queries over evaluation metrics, curves, gates and run aggregation."""

from pyspark.sql import DataFrame, functions as F

from ..operators import gates, metrics as mx, spine
from ..operators.ordered import top_fraction
from .feature_queries import rounded
from .registry import query
from .views import Tables

_CURVE = """cells AS (SELECT p AS score, sum(y) AS pos, count(*) AS n FROM scored_v GROUP BY 1),
  c AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS taken, sum(pos) OVER () AS positives, sum(n) OVER () AS total
    FROM cells WINDOW w AS (ORDER BY score DESC))"""
_EDGES = mx.even_edges(10)
_BIN = "CASE " + " ".join(f"WHEN p > {_EDGES[i]!r}::DOUBLE AND p <= {_EDGES[i + 1]!r}::DOUBLE THEN {i}" for i in range(10)) + " END"


@query(
    "auc_pr", "scored_v",
    """SELECT round((SELECT count(*) FILTER (a.p > b.p) + 0.5e0 * count(*) FILTER (a.p = b.p) FROM scored_v a JOIN scored_v b ON a.y = 1 AND b.y = 0)
        / ((SELECT count(*) FROM scored_v WHERE y = 1) * (SELECT count(*) FROM scored_v WHERE y = 0)), 6) AS auc,
      round((SELECT sum(s.n * (SELECT count(*) FILTER (y = 1) * 1e0 / count(*) FROM scored_v z WHERE z.p >= s.p))
        FROM (SELECT p, count(*) FILTER (y = 1) AS n FROM scored_v GROUP BY 1) s) / (SELECT count(*) FROM scored_v WHERE y = 1), 6) AS pr_auc""",
)
def auc_pr(t: Tables) -> DataFrame:
    return rounded(mx.binary_metrics(t.scored_v, "y", "p").select("auc", "pr_auc"), "auc", "pr_auc")


_BINARY = f"""SELECT {{by}} count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, round(avg((p - y) * (p - y)), 6) AS brier,
  round(avg(-(y * ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)) + (1 - y) * ln(1 - least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)))), 6) AS log_loss,
  round(coalesce(count(*) FILTER (p >= 0.5 AND y = 1) * 1e0 / nullif(count(*) FILTER (p >= 0.5), 0), 0), 6) AS precision,
  round(coalesce(count(*) FILTER (p >= 0.5 AND y = 1) * 1e0 / nullif(sum(y), 0), 0), 6) AS recall,
  round(coalesce(2e0 * count(*) FILTER (p >= 0.5 AND y = 1) / nullif(count(*) FILTER (p >= 0.5) + sum(y), 0), 0), 6) AS f1,
  round(avg(CASE WHEN (p >= 0.5) = (y = 1) THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM scored_v {{group}}"""


@query("binary_metrics", "scored_v", _BINARY.format(by="", group=""))
def binary_metrics(t: Tables) -> DataFrame:
    out = mx.binary_metrics(t.scored_v, "y", "p").select("n", "positives", "brier", "log_loss", "precision", "recall", "f1", "accuracy")
    return rounded(out, *out.columns[2:])


@query(
    "stratified_metrics", "scored_v labels",
    f"""WITH k AS (SELECT s.*, 'toxic' AS strat, cast(s.stratum AS VARCHAR) AS val FROM scored_v s UNION ALL
        SELECT s.*, 'source_group' AS strat, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS val FROM scored_v s)
      SELECT strat AS stratum, val AS stratum_value, * EXCLUDE (strat, val) FROM ({_BINARY.replace('scored_v', 'k').format(by='strat, val,', group='GROUP BY strat, val')})""",
)
def stratified_metrics(t: Tables) -> DataFrame:
    rows = t.scored_v.select(
        "y", "p", F.col("stratum").alias("toxic"), F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd").alias("source_group")
    )
    out = mx.stratified(rows, ["toxic", "source_group"], lambda d, by: mx.binary_metrics(d, "y", "p", by))
    names = ["n", "positives", "brier", "log_loss", "precision", "recall", "f1", "accuracy"]
    return rounded(out.select("stratum", "stratum_value", *names), *names[2:])


@query(
    "ece", "scored_v",
    f"""SELECT round(sum(g), 6) AS ece FROM (SELECT abs(avg(p) - avg(y)) * count(*) / (SELECT count(*) FROM scored_v) AS g
        FROM (SELECT p, y, {_BIN} AS b FROM scored_v) WHERE b IS NOT NULL GROUP BY b)""",
)
def ece(t: Tables) -> DataFrame:
    return rounded(mx.binary_metrics(t.scored_v, "y", "p").select("ece"), "ece")


@query(
    "recall_at_precision", "scored_v",
    f"""WITH {_CURVE} SELECT round(coalesce(max(tp / positives) FILTER (tp * 1e0 / taken >= 0.90), 0), 6) AS recall_at_precision_90,
      round(coalesce(max(tp / positives) FILTER (tp * 1e0 / taken >= 0.95), 0), 6) AS recall_at_precision_95,
      round(coalesce(min((taken - tp) / (total - positives)) FILTER (tp / positives >= 0.80), 1), 6) AS fpr_at_recall_80,
      round(coalesce(min((taken - tp) / (total - positives)) FILTER (tp / positives >= 0.90), 1), 6) AS fpr_at_recall_90 FROM c""",
)
def recall_at_precision(t: Tables) -> DataFrame:
    names = ["recall_at_precision_90", "recall_at_precision_95", "fpr_at_recall_80", "fpr_at_recall_90"]
    return rounded(mx.binary_metrics(t.scored_v, "y", "p").select(*names), *names)


@query(
    "topk_lift", "scored_v",
    """WITH r AS (SELECT y, row_number() OVER (ORDER BY p DESC, doc_id) AS rk, count(*) OVER () AS n, avg(y) OVER () AS base FROM scored_v)
      SELECT round(avg(y) FILTER (rk <= floor(n * 0.05e0)), 6) AS topk_precision_5pct, round(avg(y) FILTER (rk <= floor(n * 0.05e0)) / max(base), 6) AS lift_5pct,
      round(avg(y) FILTER (rk <= floor(n * 0.1e0)), 6) AS topk_precision_10pct, round(avg(y) FILTER (rk <= floor(n * 0.1e0)) / max(base), 6) AS lift_10pct,
      round(avg(y) FILTER (rk <= floor(n * 0.2e0)), 6) AS topk_precision_20pct, round(avg(y) FILTER (rk <= floor(n * 0.2e0)) / max(base), 6) AS lift_20pct FROM r""",
)
def topk_lift(t: Tables) -> DataFrame:
    out = mx.topk_metrics(t.scored_v, "y", "p", "doc_id", [0.05, 0.10, 0.20])
    return rounded(out, *out.columns)


@query(
    "top_fraction", "txn_scored_v",
    """SELECT transaction_id, risk_score FROM txn_scored_v
       QUALIFY row_number() OVER (ORDER BY risk_score DESC, transaction_id) <= floor((SELECT count(*) FROM txn_scored_v) * 0.05e0)""",
)
def top_five_percent(t: Tables) -> DataFrame:
    rows = t.txn_scored_v.select("transaction_id", "risk_score")
    return top_fraction(rows, [("risk_score", "desc"), ("transaction_id", "asc")], 0.05)


@query(
    "pr_curve", "scored_v",
    f"WITH {_CURVE} SELECT score AS threshold, round(tp * 1e0 / taken, 6) AS precision, round(tp * 1e0 / positives, 6) AS recall FROM c",
)
def pr_curve(t: Tables) -> DataFrame:
    return rounded(mx.pr_curve(t.scored_v, "y", "p"), "precision", "recall")


@query(
    "roc_curve", "scored_v",
    f"WITH {_CURVE} SELECT score AS threshold, round((taken - tp) * 1e0 / (total - positives), 6) AS fpr, round(tp * 1e0 / positives, 6) AS tpr FROM c",
)
def roc_curve(t: Tables) -> DataFrame:
    return rounded(mx.roc_curve(t.scored_v, "y", "p"), "fpr", "tpr")


@query(
    "lift_curve", "scored_v",
    f"""WITH {_CURVE} SELECT score AS threshold, round(taken * 1e2 / total, 6) AS population_pct,
      round(tp / (taken * (positives * 1e0 / total)), 6) AS cumulative_lift FROM c""",
)
def lift_curve(t: Tables) -> DataFrame:
    return rounded(mx.lift_curve(t.scored_v, "y", "p"), "population_pct", "cumulative_lift")


@query(
    "calibration_table", "scored_v",
    "WITH b AS (SELECT y, p, CAST(" + " + ".join(f"CASE WHEN p >= {e!r}::DOUBLE THEN 1 ELSE 0 END" for e in _EDGES[1:-1]) + """ AS INTEGER) AS bin FROM scored_v)
      SELECT bin, count(*) AS n, round(avg(y), 6) AS fraction_of_positives, round(avg(p), 6) AS mean_predicted_value FROM b GROUP BY 1""",
)
def calibration_table(t: Tables) -> DataFrame:
    return rounded(mx.calibration_table(t.scored_v, "y", "p"), "fraction_of_positives", "mean_predicted_value")


@query(
    "confusion_matrix", "scored_v",
    "SELECT CAST(y AS INTEGER) AS actual, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM scored_v GROUP BY ALL",
)
def confusion_matrix(t: Tables) -> DataFrame:
    return mx.confusion_matrix(t.scored_v, "y", "p")


@query(
    "regression_metrics", "ltv_scored_v",
    """SELECT stratum, round(avg(abs(y - yhat)), 4) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse,
      round(100 * avg(abs(y - yhat) / (abs(y) + abs(yhat) + 1e-8)), 6) AS smape FROM ltv_scored_v GROUP BY 1""",
)
def regression_metrics(t: Tables) -> DataFrame:
    out = mx.regression_metrics(t.ltv_scored_v, "y", "yhat", ("stratum",))
    return out.withColumns({"mae": F.round("mae", 4), "rmse": F.round("rmse", 4), "smape": F.round("smape", 6)})


@query(
    "rolling_evaluation", "orders",
    """WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
       r AS (SELECT i + 1 AS split_id, s + to_days(CAST(30 * i + 300 AS INTEGER)) AS starts, s + to_days(CAST(30 * i + 330 AS INTEGER)) AS ends FROM b,
         (SELECT unnest(range(6)) AS i) g WHERE s + to_days(CAST(30 * i + 330 AS INTEGER)) <= e),
       m AS (SELECT split_id, avg(abs(o_totalprice - o_totalprice * (0.8e0 + (o_orderkey % 41) / 1e2))) AS mae,
         sqrt(avg(pow(o_totalprice - o_totalprice * (0.8e0 + (o_orderkey % 41) / 1e2), 2))) AS rmse
         FROM r JOIN orders ON o_orderdate >= starts AND o_orderdate < ends GROUP BY 1),
       l AS (SELECT 'mae' AS metric, mae AS value FROM m UNION ALL SELECT 'rmse', rmse FROM m)
       SELECT metric, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min, round(max(value), 4) AS max, count(*) AS n_runs FROM l GROUP BY 1""",
)
def rolling_evaluation(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderdate", F.col("o_totalprice").alias("y"), (F.col("o_totalprice") * (F.lit(0.8) + F.col("o_orderkey") % 41 / F.lit(100.0))).alias("yhat")
    )
    start, end = spine.time_bounds(t.orders, "o_orderdate")
    tests = [s for s in spine.rolling_splits(start, end, n_splits=6) if s["part"] == "test"]
    per_split = mx.regression_metrics(spine.assign_splits(rows, "o_orderdate", tests), "y", "yhat", ("split_id",)).select("split_id", "mae", "rmse")
    out = mx.aggregate_runs(mx.to_long(per_split, ("split_id",)))
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "min", "max")})


@query(
    "rolling_classification", "orders",
    """WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
       r AS (SELECT i + 1 AS split_id, s + to_days(CAST(30 * i + 300 AS INTEGER)) AS starts, s + to_days(CAST(30 * i + 330 AS INTEGER)) AS ends FROM b,
         (SELECT unnest(range(6)) AS i) g WHERE s + to_days(CAST(30 * i + 330 AS INTEGER)) <= e),
       x AS (SELECT o_orderdate, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS y, (o_orderkey * 7919 % 1000) / 1e3 AS p FROM orders),
       m AS (SELECT split_id, avg((p - y) * (p - y)) AS brier, avg(CASE WHEN (p >= 0.5) = (y = 1) THEN 1e0 ELSE 0e0 END) AS accuracy,
         coalesce(count(*) FILTER (p >= 0.5 AND y = 1) * 1e0 / nullif(count(*) FILTER (p >= 0.5), 0), 0) AS precision,
         coalesce(count(*) FILTER (p >= 0.5 AND y = 1) * 1e0 / nullif(count(*) FILTER (y = 1), 0), 0) AS recall
         FROM r JOIN x ON o_orderdate >= starts AND o_orderdate < ends GROUP BY 1),
       l AS (UNPIVOT m ON brier, accuracy, precision, recall INTO NAME metric VALUE value)
       SELECT metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, count(*) AS n_runs FROM l GROUP BY 1""",
)
def rolling_classification(t: Tables) -> DataFrame:
    """Classifier metrics of each rolling test part, then their mean, population spread and range."""
    score = (F.col("o_orderkey") * 7919 % 1000) / F.lit(1000.0)
    rows = t.orders.select("o_orderdate", (F.col("o_totalprice") > 150000).cast("int").alias("y"), score.alias("p"))
    start, end = spine.time_bounds(t.orders, "o_orderdate")
    tests = [s for s in spine.rolling_splits(start, end, n_splits=6) if s["part"] == "test"]
    per_split = mx.binary_metrics(spine.assign_splits(rows, "o_orderdate", tests), "y", "p", ("split_id",))
    per_split = per_split.select("split_id", "brier", "accuracy", "precision", "recall")
    out = mx.aggregate_runs(mx.to_long(per_split, ("split_id",)), population=True)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "min", "max")})


# Gate thresholds of the churn model.
CHURN_GATE = {
    "churn": {
        "pr_auc_min": 0.45, "auc_min": 0.82, "ece_max": 0.05, "brier_max": 0.18, "topk_precision_10pct_min": 0.65, "lift_10pct_min": 3.2,
    }
}


def _gate_metrics(t: Tables) -> DataFrame:
    m = mx.binary_metrics(t.scored_v, "y", "p").select("brier", "accuracy", "precision", "recall")
    return mx.to_long(m).withColumn("value", F.round("value", 6))


@query(
    "promotion_gate", "scored_v",
    """WITH m AS (SELECT round(avg((p - y) * (p - y)), 6) AS brier, round(avg(CASE WHEN (p >= 0.5) = (y = 1) THEN 1e0 ELSE 0e0 END), 6) AS accuracy,
        round(count(*) FILTER (p >= 0.5 AND y = 1) * 1e0 / count(*) FILTER (p >= 0.5), 6) AS precision FROM scored_v)
      SELECT 'churn' AS section, 'brier' AS metric, 'max' AS rule, brier AS value, 0.18e0 AS threshold, brier <= 0.18 AS passed FROM m
      UNION ALL SELECT 'churn', 'accuracy', 'min', accuracy, 0.5e0, accuracy >= 0.5 FROM m
      UNION ALL SELECT 'churn', 'precision', 'min', precision, 0.95e0, precision >= 0.95 FROM m""",
)
def promotion_gate(t: Tables) -> DataFrame:
    config = {"churn": {"brier_max": 0.18, "accuracy_min": 0.5, "precision_min": 0.95, "auc_min": 0.82}}
    return gates.evaluate_gate(_gate_metrics(t), config)


@query(
    "strict_gate", "scored_v",
    """WITH m AS (SELECT round(avg((p - y) * (p - y)), 6) AS brier FROM scored_v)
      SELECT brier <= 0.18 AND FALSE AS passed, CAST(6 AS BIGINT) AS n_checks, CAST(CASE WHEN brier <= 0.18 THEN 5 ELSE 6 END AS BIGINT) AS n_failed FROM m""",
)
def strict_gate(t: Tables) -> DataFrame:
    # Only brier of the six gated metrics is reported here: the other five fail as missing.
    return gates.gate_verdict(gates.evaluate_gate(_gate_metrics(t), CHURN_GATE, missing="fail"))
