import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import models as md, trees as tr

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2)).round(2)
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=400) > 0).astype(int)
    data = [(i, float(p), float(q), 1.0, int(v)) for i, ((p, q), v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id bigint, a double, b double, c double, y int")


@pytest.mark.parametrize("kind, settings", [("boosted", {"maxIter": 8, "maxDepth": 3}), ("forest", {"numTrees": 7, "maxDepth": 4})])
def test_contributions_and_bias_are_the_score(rows, kind, settings):
    model = md.train(kind, rows, FEATURES, "y", **settings)
    found = tr.ensemble(model)
    scored = model.transform(rows.withColumn("weight", F.lit(1.0)))
    score = vector_to_array("rawPrediction" if kind == "boosted" else "probability")[1]
    got = tr.with_contributions(scored.select("id", *FEATURES, score.alias("score")), found, FEATURES).collect()
    assert all(abs(found.bias + sum(r["contributions"]) - r["score"]) < 1e-12 for r in got)
    assert all(r["contributions"][2] == 0 for r in got)  # never split on
    assert np.std([r["contributions"][0] for r in got]) > np.std([r["contributions"][1] for r in got]) > 0


def test_value_model(rows):
    model = md.train_ltv(rows.withColumn("y", F.col("a") * 3), FEATURES, "y", maxIter=5)
    found = tr.ensemble(model)
    got = tr.with_contributions(model.transform(rows.drop("y")).select("id", *FEATURES, "prediction"), found, FEATURES).collect()
    assert all(abs(found.bias + sum(r["contributions"]) - r["prediction"]) < 1e-9 for r in got)


def test_paths_by_hand():
    """One tree: a <= 1 goes to a leaf of 2 (cover 3), else b <= 0 to 4 (cover 1) or 10 (cover 2)."""
    feature, threshold = np.array([0, -1, 1, -1, -1]), np.array([1.0, 0, 0.0, 0, 0])
    left, right = np.array([1, -1, 3, -1, -1]), np.array([2, -1, 4, -1, -1])
    found = tr.Ensemble([(feature, threshold, left, right, np.array([5.0, 2.0, 8.0, 4.0, 10.0]))], [0.5])
    x = np.array([[1.0, 9.0], [2.0, 0.0], [2.0, 1.0], [np.nan, np.nan]])
    assert found.bias == 2.5
    assert tr.path_contributions(found, x).tolist() == [[-1.5, 0], [1.5, -2], [1.5, 1], [1.5, 1]]


def test_strongest_features_first(rows):
    model = md.train("forest", rows, FEATURES, "y", numTrees=5, maxDepth=3)
    got = tr.explain_rows(rows, "id", model, FEATURES, top=2).collect()
    assert len(got) == 800 and {r["rank"] for r in got} == {1, 2}
    first = {r["id"]: r for r in got if r["rank"] == 1}
    assert all(first[r["id"]]["importance"] >= r["importance"] for r in got)
    means = {r["feature"]: r["importance"] for r in tr.mean_contributions(rows, model, FEATURES).collect()}
    assert means["a"] > means["b"] > means["c"] == 0
    assert tr.explain_rows(rows.limit(0), "id", model, FEATURES).collect() == []
