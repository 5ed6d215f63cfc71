"""Prioritised rules, decision rates, threshold sweep and reason codes."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import flagged


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str
    priority: int


# The default rule set.
DEFAULT_RULES = [
    Rule("high_risk_reject", "risk_score >= 0.9", "REJECT", 100),
    Rule("high_amount_manual_review", "risk_score >= 0.7 and amount_usd >= 10000", "MANUAL_REVIEW", 90),
    Rule("new_device_manual_review", "risk_score >= 0.6 and is_new_device == True", "MANUAL_REVIEW", 80),
    Rule("country_change_manual_review", "risk_score >= 0.6 and country_change_flag_24h == True", "MANUAL_REVIEW", 70),
    Rule("medium_risk_manual_review", "risk_score >= 0.5", "MANUAL_REVIEW", 60),
    Rule("low_risk_approve", "risk_score < 0.5", "APPROVE", 50),
]

_WORDS = {"and", "or", "not", "true", "false", "null", "is", "in", "between"}


def _identifiers(condition: str) -> set[str]:
    bare = re.sub(r"'[^']*'", "", condition)
    return {w for w in re.findall(r"[A-Za-z_]\w*", bare) if w.lower() not in _WORDS}


def apply_rules(df: DataFrame, rules: list[Rule], default: str = "APPROVE") -> DataFrame:
    """First matching rule by descending priority, as one CASE expression.

    A rule over an absent column, a NULL or a NaN does not match.
    """
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    clean = df.withColumns({f"__in_{c}": F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats})
    action: Column | None = None
    name: Column | None = None
    for rule in sorted(rules, key=lambda r: -r.priority):
        used = _identifiers(rule.condition)
        if not used <= set(df.columns):
            continue
        text = rule.condition
        for c in sorted(used & set(floats), key=len, reverse=True):
            text = re.sub(rf"\b{re.escape(c)}\b", f"`__in_{c}`", text)
        test = F.coalesce(F.expr(text), F.lit(False))
        action = F.when(test, rule.action) if action is None else action.when(test, rule.action)
        name = F.when(test, rule.name) if name is None else name.when(test, rule.name)
    picked = F.lit(default) if action is None else action.otherwise(default)
    applied = F.lit(None).cast("string") if name is None else name
    out = clean.withColumns({"decision": picked, "rule_applied": applied}).drop(*[f"__in_{c}" for c in floats])
    return out.withColumn("reason", F.coalesce("rule_applied", F.lit("default_approve")))


def _share(cond: Column) -> Column:
    return F.avg(cond.cast("double"))


def _rates() -> list[Column]:
    d = F.col("decision")
    return [
        _share(d == "APPROVE").alias("approval_rate"),
        _share(d == "REJECT").alias("rejection_rate"),
        _share(d == "MANUAL_REVIEW").alias("manual_review_rate"),
        F.count(F.lit(1)).alias("total"),
    ]


def decision_rates(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_rates())


def policy_metrics(df: DataFrame, fraud: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Rates, the fraud share of approvals and the legitimate share of rejections
    (reported under the false positive / negative names), plus the two conventional rates."""
    y, d = F.col(fraud).cast("double"), F.col("decision")
    return df.groupBy(*by).agg(
        *_rates(),
        F.avg(F.when(d == "APPROVE", y)).alias("false_positive_rate"),
        F.avg(F.when(d == "REJECT", 1 - y)).alias("false_negative_rate"),
        F.avg(F.when(y == 0, (d == "REJECT").cast("double"))).alias("legit_rejected_rate"),
        F.avg(F.when(y == 1, (d == "APPROVE").cast("double"))).alias("fraud_approved_rate"),
    )


def threshold_sweep(df: DataFrame, score: str, points: int = 100, reject_at: float = 0.9) -> DataFrame:
    """Decision rates when the review threshold moves over ``points`` even steps.

    Each row is first put into the number of thresholds it passes, so one
    small histogram is shuffled instead of rows x thresholds.
    """
    steps = [i / (points - 1) for i in range(points)]
    grid = F.array(*[F.lit(s) for s in steps])
    s = F.nanvl(F.col(score), F.lit(None).cast("double"))
    # Thresholds are sorted, so the number passed is found without comparing all of them.
    guess = F.least(F.greatest(F.floor(s * (points - 1)), F.lit(-1)), F.lit(points - 1)).cast("int")
    passed = (
        guess + 1
        + F.when(F.get(grid, guess + 1) <= s, 1).otherwise(0)
        - F.when(F.get(grid, guess) > s, 1).otherwise(0)
    )
    hist = df.filter(s.isNotNull()).groupBy(passed.alias("passed"), (s >= reject_at).alias("high")).agg(F.count(F.lit(1)).alias("n"))
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(v).alias("threshold")) for i, v in enumerate(steps)])
    at = hist.select("passed", "high", "n", F.inline(cells))
    over = F.col("passed") > F.col("i")
    low, high = F.col("threshold") < reject_at, F.col("high")
    approve = F.when(low, ~over).otherwise(~high)
    reject = F.when(low, high).otherwise(over)
    total = F.sum("n").cast("double")

    def rate(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0)) / total

    return at.groupBy("threshold").agg(
        rate(approve).alias("approve_rate"), rate(reject).alias("reject_rate"), rate(~approve & ~reject).alias("manual_review_rate")
    )


def fraud_reason_codes(columns: list[str]) -> Column:
    """Reason codes from the inputs that are present."""

    def present(name: str, test) -> Column:
        return F.coalesce(test(F.col(name)), F.lit(False)) if name in columns else F.lit(False)

    score = F.col("risk_score")
    return flagged(
        [
            (score >= 0.9, "HIGH_RISK_SCORE"),
            ((score >= 0.7) & (score < 0.9), "MEDIUM_RISK_SCORE"),
            (present("velocity_risk_score", lambda c: c > 0.8), "HIGH_VELOCITY"),
            (present("device_risk_score", lambda c: c > 0.7), "SUSPICIOUS_DEVICE"),
            (present("is_new_device", lambda c: c), "NEW_DEVICE"),
            (present("country_change_flag_24h", lambda c: c), "COUNTRY_CHANGE"),
            (present("chargeback_count_90d", lambda c: c > 0), "HISTORICAL_CHARGEBACK"),
            (present("amount_usd", lambda c: c > 10000), "HIGH_AMOUNT"),
        ]
    )


def churn_reason_codes(prob: str | Column, value: str | Column) -> Column:
    p = F.col(prob) if isinstance(prob, str) else prob
    v = F.col(value) if isinstance(value, str) else value
    return flagged(
        [
            (p > 0.7, "HIGH_CHURN_RISK"),
            ((p > 0.5) & (p <= 0.7), "MEDIUM_CHURN_RISK"),
            (v > 1000, "HIGH_VALUE"),
            (v < 100, "LOW_VALUE"),
        ]
    )
