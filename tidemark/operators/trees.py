"""Contributions of tree ensembles: what each feature adds to a row's score on its way down every tree.

A node's value is the mean of its leaves' values, weighted by the training
rows they cover.  Where a row goes from a node to a child, the feature that
the node splits on is credited with the change of value.  Summed over a path
and all trees, the credits and the trees' root values (the bias) are the
score: a boosted model's margin, a forest's probability, a regressor's
prediction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path


@dataclass(frozen=True)
class Ensemble:
    """One array per tree (feature, threshold, left, right, value) and its weight; feature -1 marks a leaf."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    weights: list[float]

    @property
    def bias(self) -> float:
        return float(sum(w * t[4][0] for t, w in zip(self.trees, self.weights)))


def ensemble(model: PipelineModel) -> Ensemble:
    """The trees of a fitted boosted or forest pipeline, read from the table that the model writes of itself.

    What comes to the driver has a bound in the model's settings: trees times
    2 ** (depth + 1) nodes, whatever the training rows.
    """
    last = model.stages[-1]
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    last.write().save(path)
    node = F.col("nodeData")
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["prediction"].alias("prediction"), node["impurityStats"].alias("stats"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        node["split"]["leftCategoriesOrThreshold"].alias("threshold"), node["split"]["numCategories"].alias("categories"),
    )
    nodes = rows.toPandas().sort_values(["tree", "id"])
    if (nodes["categories"] >= 0).any():
        raise ValueError("splits on categories have no order to follow")
    votes = hasattr(last, "numClasses") and not _boosted(last)
    trees = []
    for _, t in nodes.groupby("tree"):
        stats = t["stats"].tolist()
        cover = np.array([sum(s) if votes else s[0] for s in stats])
        value = np.array([s[1] / max(sum(s), 1e-300) for s in stats]) if votes else t["prediction"].to_numpy(float)
        left, right = t["left"].to_numpy(), t["right"].to_numpy()
        for k in range(len(t) - 1, -1, -1):  # children come after their parent
            if left[k] >= 0:
                a, b = left[k], right[k]
                value[k] = (cover[a] * value[a] + cover[b] * value[b]) / (cover[a] + cover[b])
        cut = np.array([x[0] if len(x) else np.inf for x in t["threshold"]])
        trees.append((np.where(left >= 0, t["feature"].to_numpy(), -1), cut, left, right, value))
    weights = [float(w) for w in last.treeWeights]
    return Ensemble(trees, [w / len(weights) for w in weights] if votes else weights)


def _boosted(model) -> bool:
    return type(model).__name__.startswith("GBT")


def path_contributions(found: Ensemble, x: np.ndarray) -> np.ndarray:
    """Rows x features: the credits of every row of ``x``; a row goes left where its value is at most the threshold."""
    out = np.zeros(x.shape)
    for (feature, threshold, left, right, value), weight in zip(found.trees, found.weights):
        at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while True:
            rows = rows[feature[at[rows]] >= 0]
            if not len(rows):
                break
            node = at[rows]
            f = feature[node]
            child = np.where(x[rows, f] <= threshold[node], left[node], right[node])
            out[rows, f] += weight * (value[child] - value[node])
            at[rows] = child
    return out


def with_contributions(df: DataFrame, found: Ensemble, features: list[str], out: str = "contributions") -> DataFrame:
    """``df`` with an array of one contribution per feature, in their order; nulls and NaN go right, as in the model."""
    shared = df.sparkSession.sparkContext.broadcast(found)

    @F.pandas_udf("array<double>")
    def credits(*columns):
        import pandas as pd

        x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
        return pd.Series(list(path_contributions(shared.value, x)))

    return df.withColumn(out, credits(*[F.col(c).cast("double") for c in features]))


def ordered(contributions: Column, features: list[str]) -> Column:
    """Array of (importance, feature, contribution), largest first, ties by name."""
    names = F.array(*[F.lit(f) for f in features])
    entries = F.zip_with(contributions, names, lambda c, f: F.struct((-F.abs(c)).alias("order"), f.alias("feature"), c.alias("contribution")))
    return F.transform(
        F.sort_array(entries), lambda e: F.struct((-e["order"]).alias("importance"), e["feature"].alias("feature"), e["contribution"].alias("contribution"))
    )


def explain_rows(df: DataFrame, row_id: str, model: PipelineModel, features: list[str], top: int = 10) -> DataFrame:
    """(row_id, rank, feature, contribution, importance): the strongest features of each row, without a shuffle."""
    rows = with_contributions(df.select(row_id, *features), ensemble(model), features)
    best = rows.select(row_id, F.posexplode(F.slice(ordered(F.col("contributions"), features), 1, top)).alias("pos", "e"))
    return best.select(row_id, (F.col("pos") + 1).alias("rank"), "e.feature", "e.contribution", "e.importance")


def mean_contributions(df: DataFrame, model: PipelineModel, features: list[str]) -> DataFrame:
    """Mean absolute contribution per feature: one row per feature leaves each task."""
    rows = with_contributions(df.select(*features), ensemble(model), features)
    return rows.select(F.inline(ordered(F.col("contributions"), features))).groupBy("feature").agg(F.avg("importance").alias("importance"))
