"""Batch scoring: requests -> online features -> model -> decision -> audit rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.temporal import Moment
from ..operators.allocate import Offer, greedy_allocate
from ..operators.policy import Rule, apply_rules
from ..operators.prep import align_columns, amount_or_zero
from ..sources.store import audit_rows, lookup

Scorer = Callable[[DataFrame], DataFrame]


def _with_features(requests: DataFrame, store: DataFrame, domain: str, version: str, now: Moment, entity: str, schema: str) -> tuple[DataFrame, DataFrame]:
    keyed = requests.select(entity, F.concat(F.lit(f"{entity}:"), F.col(entity).cast("string")).alias("entity_key"))
    found = lookup(keyed, store, domain, version, now).withColumn("f", F.from_json("features", schema))
    missing = found.filter(F.col("features").isNull()).select(entity, F.concat(F.lit("no features for "), F.col("entity_key")).alias("error"))
    return found.filter(F.col("features").isNotNull()).select(entity, "entity_key", "f.*"), missing


def _audited(rows: DataFrame, domain: str, model: str, version: str, job: str, entity: str, predictions: list[str], decision: list[str], now: Moment) -> DataFrame:
    flat = rows.select(
        F.concat(F.lit(f"{job}_"), F.col(entity).cast("string")).alias("request_id"),
        F.lit(domain).alias("domain"), F.lit(model).alias("model_name"), F.lit("v1.0").alias("model_version"),
        F.lit(version).alias("feature_set_version"), F.col(entity).cast("string").alias("entity_key"),
        F.to_json(F.struct(*predictions)).alias("predictions"), F.to_json(F.struct(*decision)).alias("decision"),
    )
    return audit_rows(flat, now)


def summary(requests: DataFrame, results: DataFrame, job: str) -> DataFrame:
    """total, succeeded, failed of one job."""
    asked = requests.agg(F.count(F.lit(1))).scalar()
    return results.agg(F.lit(job).alias("job_id"), F.count(F.lit(1)).alias("succeeded")).select(
        "job_id", asked.alias("total"), "succeeded", (asked - F.col("succeeded")).alias("failed")
    )


def score_churn(
    requests: DataFrame, store: DataFrame, scorer: Scorer, feature_schema: str, offers: list[Offer], budget: float, now: Moment,
    job: str, version: str = "fs_churn_v1", entity: str = "user_id",
) -> dict[str, DataFrame]:
    """results, errors, audit, summary.

    ``scorer`` adds churn_prob and ltv_90d.  The budget binds over the whole
    batch, not per request.
    """
    rows, errors = _with_features(requests, store, "churn", version, now, entity, feature_schema)
    scored = scorer(rows).select(F.col(entity).alias("user_id"), "churn_prob", "ltv_90d")
    decided = greedy_allocate(scored, offers, budget, keep=("churn_prob", "ltv_90d")).withColumnRenamed("user_id", entity)
    audit = _audited(decided, "churn", "churn_risk", version, job, entity, ["churn_prob", "ltv_90d"], ["action", "reason_codes"], now)
    return {"results": decided, "errors": errors, "audit": audit, "summary": summary(requests, decided, job)}


def score_fraud(
    requests: DataFrame, store: DataFrame, scorer: Scorer, feature_schema: str, model_columns: list[str], rules: list[Rule], now: Moment,
    job: str, version: str = "fs_fraud_v1", entity: str = "transaction_id",
) -> dict[str, DataFrame]:
    """results, errors, audit, summary; ``scorer`` adds risk_score from the model's aligned columns."""
    rows, errors = _with_features(requests, store, "fraud", version, now, entity, feature_schema)
    amount: Column = amount_or_zero(rows)
    inputs = align_columns(rows.withColumn("__amount", amount), model_columns, tuple([c for c in rows.columns if c not in model_columns] + ["__amount"]))
    scored = scorer(inputs).withColumn("amount_usd", F.col("__amount")).drop("__amount")
    decided = apply_rules(scored, rules)
    audit = _audited(decided, "fraud", "fraud_risk", version, job, entity, ["risk_score"], ["decision", "reason", "rule_applied"], now)
    return {"results": decided, "errors": errors, "audit": audit, "summary": summary(requests, decided, job)}
