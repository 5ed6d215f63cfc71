"""Offline churn pipeline: tables -> features and labels -> split -> model -> metrics -> gate."""

from __future__ import annotations

from datetime import timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..functions.temporal import Moment
from ..operators import gates, metrics, models, saas
from ..session import cut

FEATURES = saas.FEATURES


def training_table(tables: dict[str, DataFrame], as_ofs: list[Moment], churn_days: int = 30, ltv_days: int = 90) -> DataFrame:
    """Labels joined with features on (account, as_of); every side holds one row per key."""
    keys = ["account_id", "as_of_time"]
    churn = saas.churn_labels(tables["churn_events"], tables["subscriptions"], as_ofs, timedelta(days=churn_days))
    ltv = saas.ltv_labels(tables["subscriptions"], as_ofs, timedelta(days=ltv_days))
    features = saas.saas_features(tables["accounts"], tables["subscriptions"], tables["feature_usage"], tables["support_tickets"], as_ofs)
    return churn.join(ltv, keys).join(features, keys)


def train_and_gate(table: DataFrame, gate: dict, kind: str = "logistic", seed: int = 42, **settings) -> dict[str, DataFrame | PipelineModel]:
    """80/20 stratified split, model, held-out metrics and gate checks."""
    from pyspark.sql import functions as F

    keyed = table.withColumn("row_id", F.concat_ws("@", F.col("account_id").cast("string"), F.col("as_of_time").cast("string")))
    split = cut(models.stratified_split(keyed, "churn", "row_id", 0.2, seed))
    model = models.train(kind, split.filter("part = 'train'"), FEATURES, "churn", **settings)
    scored = cut(models.predict(model, split.filter("part = 'test'"), "churn_prob"))
    wide = metrics.binary_metrics(scored, "churn", "churn_prob")
    top = metrics.topk_metrics(scored, "churn", "churn_prob", "row_id", [0.05, 0.10, 0.20])
    long = metrics.to_long(wide).unionByName(metrics.to_long(top))
    return {"model": model, "scored": scored, "metrics": long, "checks": gates.evaluate_gate(long, gate)}
