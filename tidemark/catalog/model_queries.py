"""Queries that split, train, calibrate and score. Model outputs have no SQL form; the split has."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..operators import forest as fr, metrics as mx, models as md, trees as tr
from ..plans import churn as plan
from ..session import cut
from .feature_queries import SAAS_AS_OFS, TRAINING_SQL
from .registry import query
from .views import Tables


@query(
    "stratified_split", "scored_v",
    """SELECT doc_id, y, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY md5(concat(cast(doc_id AS string), '#42')), doc_id) <= round(count(*) OVER (PARTITION BY y) * 0.2e0) THEN 'test' ELSE 'train' END AS part FROM scored_v""",
)
def stratified_split(t: Tables) -> DataFrame:
    return md.stratified_split(t.scored_v.select("doc_id", "y"), "y", "doc_id")


def _training(t: Tables) -> DataFrame:
    """Training table in train, validation and test parts."""
    tables = {
        "accounts": t.accounts_v, "subscriptions": t.subscriptions_v, "feature_usage": t.feature_usage_v,
        "support_tickets": t.support_tickets_v, "churn_events": t.churn_events_v,
    }
    rows = plan.training_table(tables, SAAS_AS_OFS)
    keyed = rows.withColumn("row_id", F.concat_ws("@", F.col("account_id").cast("string"), F.col("as_of_time").cast("string")))
    return cut(md.three_way_split(keyed, "churn", "row_id"))


def _part(rows: DataFrame, *names: str) -> DataFrame:
    return rows.filter(F.col("part").isin(*names))


_VIEWS, _LABELS = "churn_events_v subscriptions_v", TRAINING_SQL
# The held-out rows: the first fifth of each class by hash.
_TEST = f"""x AS ({_LABELS}),
  test AS (SELECT account_id, as_of_time, churn FROM (SELECT *, concat(cast(account_id AS string), '@', cast(as_of_time AS string)) AS id FROM x)
    QUALIFY row_number() OVER (PARTITION BY churn ORDER BY md5(concat(id, '#42')), id) <= round(count(*) OVER (PARTITION BY churn) * 0.2e0))"""
_SCORED_SQL = f"WITH {_TEST} SELECT account_id, as_of_time, churn, TRUE AS in_range, TRUE AS consistent FROM test"


def _facts(scored: DataFrame) -> DataFrame:
    """What must hold of every held-out score."""
    return scored.select(
        "account_id", "as_of_time", "churn", F.col("score").between(0, 1).alias("in_range"), ((F.col("score") >= 0.5).cast("int") == F.col("predicted")).alias("consistent")
    )


@query("three_way_split", _VIEWS, f"WITH {_TEST} SELECT account_id, as_of_time FROM test")
def three_way_split(t: Tables) -> DataFrame:
    rows = _training(t)
    assert_apart = rows.groupBy("account_id", "as_of_time").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("part"))
    return assert_apart.filter("n = 1 AND part = 'test'").select("account_id", "as_of_time")


@query(
    "churn_model_gate", _VIEWS,
    f"WITH {_TEST} SELECT count(*) AS n, cast(sum(churn) AS bigint) AS churned, TRUE AS in_range, TRUE AS ranked FROM test",
)
def churn_model_gate(t: Tables) -> DataFrame:
    """Logistic model with all its iterations; its held-out scores and metrics are sound."""
    rows = _training(t)
    model = md.train("logistic", _part(rows, "train", "validation"), plan.FEATURES, "churn")
    scored = cut(md.predict(model, _part(rows, "test"), "churn_prob"))
    wide = mx.binary_metrics(scored, "churn", "churn_prob").first().asDict()
    sound = all(v is None or 0 <= v <= 1 for k, v in wide.items() if k in ("auc", "pr_auc", "ece", "brier"))
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.sum("churn").cast("bigint").alias("churned"), F.bool_and(F.col("churn_prob").between(0, 1)).alias("in_range"),
        F.lit(sound).alias("ranked"),
    )


@query("boosted_scores", _VIEWS, _SCORED_SQL)
def boosted_scores(t: Tables) -> DataFrame:
    rows = _training(t)
    seen = _part(rows, "train", "validation").withColumn("validation", F.col("part") == "validation")
    model = md.train("boosted", seen, plan.FEATURES, "churn", validation="validation")
    return _facts(md.predict(model, _part(rows, "test")))


@query("forest_scores", _VIEWS, _SCORED_SQL)
def forest_scores(t: Tables) -> DataFrame:
    """All trees at their full depth; their leaves grow with the rows, so no trained model is gathered."""
    rows = _training(t)
    scored = fr.forest_scores(_part(rows, "train", "validation"), _part(rows, "test"), plan.FEATURES, "churn", "row_id", **md.FOREST)
    return _facts(scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


@query(
    "calibrated_scores", _VIEWS,
    f"WITH {_TEST} SELECT method, count(*) AS n, TRUE AS in_range, TRUE AS monotone FROM test, (SELECT unnest(['isotonic', 'platt']) AS method) GROUP BY 1",
)
def calibrated_scores(t: Tables) -> DataFrame:
    """Fitted on out-of-fold scores of the training rows, judged on the test rows."""
    rows = _training(t)
    seen, held = _part(rows, "train", "validation"), _part(rows, "test")
    folds = cut(md.out_of_fold("logistic", seen, plan.FEATURES, "churn", "row_id"))
    scored = cut(md.predict(md.train("logistic", seen, plan.FEATURES, "churn"), held))
    middle = scored.agg(F.percentile_approx("score", 0.5)).first()[0]
    out = None
    for method in ("isotonic", "platt"):
        done = md.Calibrator(method).fit(folds, "churn").transform(scored)
        low, high = F.when(F.col("score") <= middle, F.col("calibrated")), F.when(F.col("score") > middle, F.col("calibrated"))
        one = done.agg(
            F.lit(method).alias("method"), F.count(F.lit(1)).alias("n"), F.bool_and(F.col("calibrated").between(0, 1)).alias("in_range"),
            F.coalesce((F.max(low) <= F.min(high) + 1e-9) | (F.min(low) >= F.max(high) - 1e-9), F.lit(True)).alias("monotone"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "ltv_scores", _VIEWS,
    f"WITH {_TEST} SELECT account_id, as_of_time, TRUE AS floored, TRUE AS spread FROM test",
)
def ltv_scores(t: Tables) -> DataFrame:
    rows = _training(t).withColumnRenamed("ltv_90d", "y")
    model = md.train_ltv(_part(rows, "train", "validation"), plan.FEATURES, "y")
    out = md.predict_ltv(model, _part(rows, "test"))
    spread = (F.col("ltv_p10") == F.col("ltv_p50") * 0.5) & (F.col("ltv_p90") == F.col("ltv_p50") * 1.5) & (F.col("ltv_p50") == F.col("ltv_90d"))
    return out.select("account_id", "as_of_time", (F.col("ltv_90d") >= 0).alias("floored"), spread.alias("spread"))


@query("isolation_scores", "lineitem", "SELECT l_orderkey, l_linenumber, l_partkey, TRUE AS in_range FROM lineitem")
def isolation_scores(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("id", F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    scored = md.IsolationForest(columns, "id", sample=256).fit_predict(rows, ["l_orderkey", "l_linenumber", "l_partkey"])
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", F.col("score").between(0, 1).alias("in_range"))


@query(
    "search_logistic", "",
    "SELECT unnest([" + ", ".join(f"'{f}'" for f in plan.FEATURES) + "]) AS feature, TRUE AS finite, CAST(4 AS INTEGER) AS tried",
)
def search_logistic(t: Tables) -> DataFrame:
    rows = _training(t)
    best, tried = md.search(_part(rows, "train", "validation"), plan.FEATURES, "churn", {"regParam": [0.0, 0.01, 0.1, 1.0]})
    weights = md.linear_weights(best, plan.FEATURES)
    return t.spark.createDataFrame([(k, v == v and abs(v) < float("inf")) for k, v in weights.items()], "feature string, finite boolean").withColumn("tried", F.lit(len(tried)))


#: Ensembles that the contribution queries explain: kind and settings.
_EXPLAINED = {"boosted": {"maxIter": 20}, "forest": {"numTrees": 20, "maxDepth": 8}}
_KINDS = "(SELECT unnest(['boosted', 'forest']) AS kind)"


def _explained(t: Tables):
    """kind, model and held-out rows with score, contributions and bias."""
    rows = _training(t)
    seen, held = _part(rows, "train", "validation"), _part(rows, "test")
    for kind, settings in _EXPLAINED.items():
        model = md.train(kind, seen, plan.FEATURES, "churn", **settings)
        found = tr.ensemble(model)
        scored = model.transform(held.withColumn("weight", F.lit(1.0)))
        score = vector_to_array("rawPrediction" if kind == "boosted" else "probability")[1]
        wide = tr.with_contributions(scored.select("account_id", "as_of_time", "churn", *plan.FEATURES, score.alias("score")), found, plan.FEATURES)
        yield kind, model, wide.withColumn("bias", F.lit(found.bias)).withColumn("kind", F.lit(kind))


@query(
    "tree_contributions", _VIEWS,
    f"WITH {_TEST} SELECT kind, account_id, as_of_time, {len(plan.FEATURES)} AS n_features, TRUE AS adds_up, TRUE AS rows_differ FROM test, {_KINDS}",
)
def tree_contributions(t: Tables) -> DataFrame:
    """Bias and contributions of every held-out row are its score; a model of one value for all rows would have no contribution anywhere."""
    out = None
    for _, _, rows in _explained(t):
        total = F.col("bias") + F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c)
        rows = cut(rows)
        moved = rows.agg(F.max(F.aggregate("contributions", F.lit(0.0), lambda a, c: a + F.abs(c))).alias("most")).first()["most"] or 0.0
        one = rows.select(
            "kind", "account_id", "as_of_time", F.size("contributions").alias("n_features"), (F.abs(total - F.col("score")) < 1e-9).alias("adds_up"),
            F.lit(moved > 1e-6).alias("rows_differ"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "tree_importance", _VIEWS,
    "SELECT kind, unnest([" + ", ".join(f"'{f}'" for f in plan.FEATURES) + f"]) AS feature, TRUE AS sums_to_one, TRUE AS unused_is_zero FROM {_KINDS}",
)
def tree_importance(t: Tables) -> DataFrame:
    """Impurity importance sums to one over the features; a feature without any has no contribution in any row."""
    out = None
    for kind, model, rows in _explained(t):
        gains = md.tree_importance(model, plan.FEATURES)
        whole = F.lit(abs(sum(gains.values()) - 1) < 1e-9)
        means = rows.select(F.inline(tr.ordered(F.col("contributions"), plan.FEATURES))).groupBy("feature").agg(F.max("importance").alias("most"))
        unused = [f for f, g in gains.items() if g == 0]
        one = means.select(F.lit(kind).alias("kind"), "feature", whole.alias("sums_to_one"), (~F.col("feature").isin(unused) | (F.col("most") == 0)).alias("unused_is_zero"))
        out = one if out is None else out.unionByName(one)
    return out
