import math

import pytest

from tidemark.operators import models as md


def test_scores_against_a_walk_and_made_once(spark, monkeypatch):
    """Every tree walked node by node, missing values to the right; the quantile does not walk the trees again."""
    rows = [(i, float(i * 37 % 101), float(i % 7), None if i % 50 == 3 else i * 0.5) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    seen, exact = [], md.exact_quantiles
    monkeypatch.setattr(md, "exact_quantiles", lambda d, *more: seen.append(d._jdf.queryExecution().executedPlan().toString()) or exact(d, *more))
    forest = md.IsolationForest(["a", "b", "c"], "id", sample=64, trees=7).fit(df.na.fill(0.0))
    assert len(seen) == 1 and "ArrowEvalPython" not in seen[0]
    trees = [t.to_dict("records") for _, t in forest.nodes.groupby("tree")]

    def walked(row):
        total = 0.0
        for tree in trees:
            at = tree[0]
            while at["feature"] >= 0:
                value = row[1 + at["feature"]]
                at = tree[at["left"] if value is not None and value < at["cut"] else at["right"]]
            total += at["path"]
        return -(2.0 ** (-total / sum(md._average_path(t[0]["size"]) for t in trees)))

    got = {r["id"]: r["s"] for r in forest.score(df, "s").collect()}
    assert all(got[r[0]] == pytest.approx(walked(r), rel=1e-12) for r in rows) and len(got) == 400
    assert not math.isnan(forest.offset)
    other = md.IsolationForest(["a", "b", "c"], "id", sample=64, trees=7)
    once = other.fit_predict(df.na.fill(0.0), ["id"])
    assert "ArrowEvalPython" not in once._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, forest.predict(df.na.fill(0.0)).select("id", "score").collect()))
