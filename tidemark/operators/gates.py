"""Promotion gates over long metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def threshold_entries(config: dict) -> Column:
    """Config -> array of (section, metric, rule, threshold, scale) literals.

    Keys end in ``_min`` (>=), ``_max`` (<=) or ``_max_ms`` (<=, metric in
    milliseconds).  Nested dictionaries are sections; boolean rules and other
    keys are not thresholds.
    """
    rows = []
    for key, value in config.items():
        nested = isinstance(value, dict) and "threshold" not in value
        for name, limit in (value if nested else {key: value}).items():
            spec = limit if isinstance(limit, dict) else {"threshold": limit}
            if isinstance(spec["threshold"], bool):
                continue
            for suffix, rule, unit in (("_max_ms", "max", "_ms"), ("_min", "min", ""), ("_max", "max", "")):
                if name.endswith(suffix):
                    rows.append(
                        F.struct(
                            F.lit(key if nested else "").alias("section"),
                            F.lit(name.removesuffix(suffix) + unit).alias("metric"),
                            F.lit(rule).alias("rule"),
                            F.lit(float(spec["threshold"])).alias("threshold"),
                            F.lit(100.0 if spec.get("unit") == "ratio" else 1.0).alias("scale"),
                        )
                    )
                    break
    kind = "array<struct<section:string,metric:string,rule:string,threshold:double,scale:double>>"
    return F.array(*rows).cast(kind)


def evaluate_gate(metrics: DataFrame, config: dict, by: tuple[str, ...] = (), missing: str = "skip") -> DataFrame:
    """One row per check: (by, section, metric, rule, value, threshold, passed).

    The thresholds ride along as a literal, so checking is a narrow step.
    ``missing='skip'`` leaves absent metrics out; ``'fail'`` reports them as
    failed.  A threshold given with ``unit: ratio`` compares a percentage
    metric on the 0..1 scale.
    """
    limits = threshold_entries(config)
    long = metrics.select(*by, "metric", "value")
    if missing == "skip":
        hits = F.filter(limits, lambda t: t["metric"] == F.col("metric"))
        checked = long.filter(F.col("value").isNotNull()).select(*by, F.col("value").alias("__v"), F.inline(hits))
    else:
        # Every run meets every threshold as a row without a value; real values win.
        wanted = long.select(*by).distinct().select(*by, F.inline(limits))
        found = long.select(*by, F.col("value").alias("__v"), F.inline(F.filter(limits, lambda t: t["metric"] == F.col("metric"))))
        both = wanted.unionByName(found, allowMissingColumns=True)
        checked = both.groupBy(*by, "section", "metric", "rule", "threshold", "scale").agg(F.max("__v").alias("__v"))
    value = F.col("__v") / F.col("scale")
    ok = F.when(F.col("rule") == "min", value >= F.col("threshold")).otherwise(value <= F.col("threshold"))
    return checked.select(*by, "section", "metric", "rule", value.alias("value"), "threshold", F.coalesce(ok, F.lit(False)).alias("passed"))


def gate_verdict(checks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return checks.groupBy(*by).agg(
        F.bool_and("passed").alias("passed"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
    )


def rag_gate(metrics: DataFrame, config: dict, by: tuple[str, ...] = ()) -> DataFrame:
    """Threshold sections plus the two guardrail rules (only reported when violated)."""
    checked = {k: v for k, v in config.items() if k in ("eval", "citation", "slo")}
    checks = evaluate_gate(metrics, checked, by)
    guard = config.get("guardrails", {})
    rules = []
    if guard.get("must_return_idk_when_no_evidence"):
        rules.append(("idk_violation_rate", "must_return_idk", 0.0))
    if "hallucination_flag_rate_max" in guard:
        rules.append(("hallucination_flag_rate", "hallucination_flag_rate", float(guard["hallucination_flag_rate_max"])))
    for source, name, limit in rules:
        broken = metrics.filter((F.col("metric") == source) & (F.col("value") > limit)).select(
            *by, F.lit("guardrails").alias("section"), F.lit(name).alias("metric"), F.lit("max").alias("rule"),
            F.col("value").cast("double").alias("value"), F.lit(limit).alias("threshold"), F.lit(False).alias("passed"),
        )
        checks = checks.unionByName(broken)
    return checks
