"""Exact evaluation metrics as grouped, distributed aggregations.

Every function takes ``by`` so strata, splits or models are only extra keys.
Ranking metrics first collapse equal scores: a score shared by a third of the
rows becomes one row before anything is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import ratio
from .ordered import prefix_sum, ranked

# Fixed value: probabilities are clipped by the double-precision machine epsilon before the logarithm.
LOG_CLIP = 2.220446049250313e-16


def even_edges(bins: int) -> list[float]:
    """Edges of equal-width bins on [0, 1], as repeated multiples of the step."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def _binned(p: Column, edges: list[float]) -> Column:
    """Bin index of ``(lo, hi]`` bins; 0 and anything outside fall in no bin."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        out = F.when((p > edges[i]) & (p <= edges[i + 1]), i).otherwise(out)
    return out


def collapse_scores(df: DataFrame, y: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, score) -> positives and rows; partial aggregation keeps the shuffle small."""
    score = F.col(p).cast("double")
    clean = df.filter(F.col(y).isNotNull() & score.isNotNull() & ~F.isnan(score))
    return clean.groupBy(*by, score.alias("score")).agg(F.sum(F.col(y).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"))


def score_curve(df: DataFrame, y: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Cumulative counts per distinct score, highest first; shared by all ranking metrics."""
    cells = collapse_scores(df, y, p, by)
    return prefix_sum(
        cells, [("score", "desc")], {"pos": "tp", "n": "taken"}, by=by, totals={"pos": "positives", "n": "rows"}
    )


def binary_metrics(df: DataFrame, y: str, p: str, by: tuple[str, ...] = (), bins: int = 10) -> DataFrame:
    """AUC, average precision, Brier, log-loss, ECE, precision/recall/F1/accuracy at 0.5,
    recall at fixed precision and false-positive rate at fixed recall, in one ordered pass."""
    curve = score_curve(df, y, p, by)
    s, pos, n = F.col("score"), F.col("pos").cast("double"), F.col("n").cast("double")
    neg = n - pos
    tp, taken = F.col("tp").cast("double"), F.col("taken").cast("double")
    positives, rows = F.col("positives").cast("double"), F.col("rows").cast("double")
    fp = taken - tp
    precision, recall, fpr = tp / taken, ratio(tp, positives), ratio(fp, rows - positives)
    clipped = F.least(F.greatest(s, F.lit(LOG_CLIP)), F.lit(1 - LOG_CLIP))
    hot = s >= 0.5
    edges = even_edges(bins)
    bin_of = _binned(s, edges)

    def at_half(v: Column) -> Column:
        return F.sum(F.when(hot, v).otherwise(0.0))

    ece = F.lit(0.0)
    for i in range(len(edges) - 1):
        gap = F.sum(F.when(bin_of == i, s * n - pos).otherwise(0.0))
        ece = ece + F.abs(gap)
    aggs = [
        F.max("rows").alias("n"),
        F.max("positives").alias("positives"),
        ratio(F.sum(neg * (tp - pos + pos / 2)), F.max(positives * (rows - positives))).alias("auc"),
        ratio(F.sum(pos * precision), F.max(positives)).alias("pr_auc"),
        (F.sum(pos * (s - 1) * (s - 1) + neg * s * s) / F.max(rows)).alias("brier"),
        (-F.sum(pos * F.ln(clipped) + neg * F.ln(1 - clipped)) / F.max(rows)).alias("log_loss"),
        (ece / F.max(rows)).alias("ece"),
        ratio(at_half(pos), at_half(n), 0.0).alias("precision"),
        ratio(at_half(pos), F.max(positives), 0.0).alias("recall"),
        ratio(2 * at_half(pos), at_half(n) + F.max(positives), 0.0).alias("f1"),
        ((at_half(pos) + F.sum(F.when(~hot, neg).otherwise(0.0))) / F.max(rows)).alias("accuracy"),
    ]
    for t in (0.90, 0.95):
        best = F.max(F.when(precision >= t, recall))
        aggs.append(F.coalesce(best, F.lit(0.0)).alias(f"recall_at_precision_{int(t * 100)}"))
    for t in (0.80, 0.90):
        best = F.min(F.when(recall >= t, fpr))
        aggs.append(F.coalesce(best, F.lit(1.0)).alias(f"fpr_at_recall_{int(t * 100)}"))
    return curve.groupBy(*by).agg(*aggs)


def topk_metrics(df: DataFrame, y: str, p: str, row_id: str, fractions: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """Precision and lift of the top ``int(n * fraction)`` rows, ties broken by id; NULL when that is 0 rows."""
    narrow = df.select(*by, F.col(row_id).alias("__id"), F.col(p).cast("double").alias("__p"), F.col(y).cast("double").alias("__y"))
    r = ranked(narrow.filter(F.col("__p").isNotNull()), [("__p", "desc"), ("__id", "asc")], by=by, rank="__rank", size="__size")
    aggs = []
    for f in fractions:
        top = F.avg(F.when(F.col("__rank") <= F.floor(F.col("__size") * F.lit(f)), F.col("__y")))
        label = f"{round(f * 100)}pct"
        aggs += [top.alias(f"topk_precision_{label}"), ratio(top, F.avg("__y")).alias(f"lift_{label}")]
    return r.groupBy(*by).agg(*aggs)


def pr_curve(df: DataFrame, y: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    c = score_curve(df, y, p, by)
    return c.select(
        *by, F.col("score").alias("threshold"), (F.col("tp") / F.col("taken")).alias("precision"), ratio(F.col("tp"), F.col("positives")).alias("recall")
    )


def roc_curve(df: DataFrame, y: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    c = score_curve(df, y, p, by)
    return c.select(
        *by,
        F.col("score").alias("threshold"),
        ratio(F.col("taken") - F.col("tp"), F.col("rows") - F.col("positives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )


def lift_curve(df: DataFrame, y: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Cumulative lift after each distinct score, highest first."""
    c = score_curve(df, y, p, by)
    base = F.col("positives") / F.col("rows")
    return c.select(
        *by,
        F.col("score").alias("threshold"),
        (F.col("taken") / F.col("rows") * 100).alias("population_pct"),
        ratio(F.col("tp"), F.col("taken") * base).alias("cumulative_lift"),
    )


def calibration_table(df: DataFrame, y: str, p: str, by: tuple[str, ...] = (), bins: int = 10) -> DataFrame:
    """Equal-width bins: observed rate and mean score (last bin closed on both sides)."""
    s = F.col(p).cast("double")
    edges = even_edges(bins)
    idx = F.lit(0)
    for e in edges[1:-1]:
        idx = idx + F.when(s >= e, 1).otherwise(0)
    return df.filter(s.isNotNull()).groupBy(*by, idx.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(y).cast("double")).alias("fraction_of_positives"), F.avg(s).alias("mean_predicted_value")
    )


def confusion_matrix(df: DataFrame, y: str, p: str, threshold: float = 0.5, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(y).cast("int").alias("actual"), (F.col(p) >= threshold).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def regression_metrics(df: DataFrame, y: str, yhat: str, by: tuple[str, ...] = ()) -> DataFrame:
    """MAE, RMSE and SMAPE on the 0..100 scale without a factor of two."""
    a, b = F.col(y).cast("double"), F.col(yhat).cast("double")
    e = a - b
    return df.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (100 * F.avg(F.abs(e) / (F.abs(a) + F.abs(b) + 1e-8))).alias("smape"),
    )


def decision_metrics(
    decisions: DataFrame, budget: float, outcomes: DataFrame | None = None, by: tuple[str, ...] = (), user: str = "user_id"
) -> DataFrame:
    """Profit, utilization, uplift over doing nothing, offer false-positive rate, offer mix."""
    rows = decisions
    if outcomes is not None:
        rows = rows.join(outcomes.select(user, F.col("churn").alias("__churn")), user, "left")
    offered = F.col("action") != "NO_ACTION"
    cost = F.col("cost") if "cost" in decisions.columns else F.lit(0.0)
    aggs = [
        F.sum("expected_profit").alias("total_expected_profit"),
        (F.sum(cost) / F.lit(float(budget)) if budget > 0 else F.lit(0.0)).alias("budget_utilization"),
        F.sum("expected_profit").alias("profit_uplift"),
        F.count(F.lit(1)).alias("n_users"),
    ]
    if outcomes is not None:
        churned = F.sum(F.when(offered, F.coalesce("__churn", F.lit(0))).otherwise(0))
        aggs.append((1 - ratio(churned, F.count_if(offered))).alias("offer_fp_rate"))
    return rows.groupBy(*by).agg(*aggs)


def value_shares(df: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and shares of the values of a column."""
    counts = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    if not by:
        total = df.agg(F.count(F.lit(1)).alias("__total")).scalar()
        return counts.withColumn("share", F.col("n") / total)
    totals = counts.groupBy(*by).agg(F.sum("n").alias("__total"))
    return counts.join(totals, list(by)).withColumn("share", F.col("n") / F.col("__total")).drop("__total")


def to_long(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Wide metrics -> (by, metric, value)."""
    names = [c for c in df.columns if c not in by]
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in names])
    return doubles.unpivot(list(by), names, "metric", "value")


def aggregate_runs(long: DataFrame, population: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean, spread and range of each metric over runs; sample or population spread."""
    spread = F.stddev_pop("value") if population else F.stddev_samp("value")
    return long.groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"), spread.alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("n_runs")
    )


def stratified(df: DataFrame, strata: list[str], metric, keys: tuple[str, ...] = ()) -> DataFrame:
    """Apply a metric function once for several strata columns.

    Each row is tagged with its (stratum, value) pairs by a generator, so all
    strata share one pass instead of one job per column.
    """
    pairs = F.array(*[F.struct(F.lit(s).alias("stratum"), F.col(s).cast("string").alias("stratum_value")) for s in strata])
    tagged = df.select("*", F.inline(pairs))
    return metric(tagged, (*keys, "stratum", "stratum_value"))
