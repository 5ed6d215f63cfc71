"""Per-row contributions, reason codes and global importance of linear scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Feature -> reason code; any other feature is its upper-cased name.
REASON_OF_FEATURE = {
    "payment_fail_30d": "PAYMENT_FAIL",
    "recency_days": "LOW_RECENCY",
    "tickets_30d": "SUPPORT_FRICTION",
    "high_sev_ticket_30d": "HIGH_SEVERITY_TICKET",
    "usage_slope_4w": "DECLINING_USAGE",
    "active_days_30d": "LOW_ACTIVITY",
}


def contributions(features: list[str], coefficients: dict[str, float] | None = None, means: dict[str, float] | None = None) -> Column:
    """Array of (importance, feature, contribution), largest first, ties by name.

    With coefficients: coef * (x - mean).  Without: the value proxy x * 0.1.
    """
    entries = []
    for name in features:
        x = F.col(name).cast("double")
        if coefficients is None:
            c = x * F.lit(0.1)
        else:
            c = F.lit(float(coefficients[name])) * (x - F.lit(float((means or {}).get(name, 0.0))))
        entries.append(F.when(c.isNotNull(), F.struct((-F.abs(c)).alias("order"), F.lit(name).alias("feature"), c.alias("contribution"))))
    ordered = F.sort_array(F.array_compact(F.array(*entries)))
    return F.transform(
        ordered, lambda e: F.struct((-e["order"]).alias("importance"), e["feature"].alias("feature"), e["contribution"].alias("contribution"))
    )


def explain_rows(
    df: DataFrame,
    row_id: str,
    features: list[str],
    coefficients: dict[str, float] | None = None,
    means: dict[str, float] | None = None,
    top: int = 10,
) -> DataFrame:
    """(row_id, rank, feature, contribution, importance): the strongest features of each row, without a shuffle."""
    best = F.slice(contributions(features, coefficients, means), 1, top)
    rows = df.select(row_id, F.posexplode(best).alias("pos", "e"))
    return rows.select(row_id, (F.col("pos") + 1).alias("rank"), "e.feature", "e.contribution", "e.importance")


def contribution_reasons(contribution_array: Column, threshold: float = 0.1) -> Column:
    """Reason codes of contributions at or over the threshold, strongest first, each once."""
    names = F.create_map(*[F.lit(x) for pair in REASON_OF_FEATURE.items() for x in pair])
    strong = F.filter(contribution_array, lambda e: e["importance"] >= threshold)
    codes = F.transform(strong, lambda e: F.coalesce(F.try_element_at(names, e["feature"]), F.upper(e["feature"])))
    return F.array_distinct(codes)


def global_importance(df: DataFrame, features: list[str], coefficients: dict[str, float] | None = None, means: dict[str, float] | None = None) -> DataFrame:
    """Mean absolute contribution per feature: one row per feature leaves each task."""
    rows = df.select(F.inline(contributions(features, coefficients, means)))
    return rows.groupBy("feature").agg(F.avg("importance").alias("importance"))


def feature_means(df: DataFrame, features: list[str]) -> dict[str, float]:
    """One aggregated row read back."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).first()
    return {c: row[c] or 0.0 for c in features}
