"""Models on MLlib: training, calibration, scoring, search, isolation forest."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .ordered import exact_quantiles, ranked

# Boosting and forest settings, LTV quantile factors, isolation forest size.
BOOST = {"maxIter": 100, "stepSize": 0.05, "maxDepth": 5, "subsamplingRate": 0.8, "seed": 42}
FOREST = {"numTrees": 200, "maxDepth": 20, "minInstancesPerNode": 5, "seed": 42}
LTV_FACTORS = {"ltv_p10": 0.5, "ltv_p50": 1.0, "ltv_p90": 1.5}
ISOLATION = {"trees": 100, "contamination": 0.01, "seed": 42}


def stratified_split(df: DataFrame, label: str, row_id: str, fraction: float = 0.2, seed: int = 42, part: str = "part", names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Exact per-class split, reproducible from ids: the first ``round(n * fraction)`` rows by hash are held out.

    Ranks come from a range-partitioned order, so a class with most of the
    rows is not one task.
    """
    keyed = df.withColumn("__h", F.md5(F.concat_ws("#", F.col(row_id).cast("string"), F.lit(str(seed)))))
    r = ranked(keyed, [("__h", "asc"), (row_id, "asc")], by=(label,), rank="__rank", size="__size")
    held = F.col("__rank") <= F.round(F.col("__size") * F.lit(fraction))
    return r.withColumn(part, F.when(held, names[1]).otherwise(names[0])).drop("__h", "__rank", "__size")


def three_way_split(df: DataFrame, label: str, row_id: str, test: float = 0.2, validation: float = 0.2, seed: int = 42, part: str = "part") -> DataFrame:
    """train, validation and test rows, exact per class: test is cut first, validation from the rest."""
    outer = stratified_split(df, label, row_id, test, seed, "__outer", ("rest", "test"))
    inner = stratified_split(outer.filter("__outer = 'rest'"), label, row_id, validation, seed + 1, part, ("train", "validation"))
    return inner.drop("__outer").unionByName(outer.filter("__outer = 'test'").withColumn(part, F.lit("test")).drop("__outer"))


def hashed_split(df: DataFrame, row_id: str, fraction: float = 0.2, seed: int = 42, part: str = "part") -> DataFrame:
    """Approximate split without a shuffle: each row decides by its own hash."""
    share = F.pmod(F.xxhash64(F.col(row_id).cast("string"), F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    return df.withColumn(part, F.when(share < fraction, "test").otherwise("train"))


def balanced_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """n / (2 * n_class): two counts read back."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    n = sum(counts.values())
    chain: Column = F.lit(1.0)
    for value, c in counts.items():
        chain = F.when(F.col(label) == value, n / (len(counts) * c)).otherwise(chain)
    return df.withColumn(weight, chain)


def _assembler(features: list[str], scaled: bool) -> list:
    stages = [VectorAssembler(inputCols=features, outputCol="raw_vector" if scaled else "vector", handleInvalid="error")]
    if scaled:
        stages.append(StandardScaler(inputCol="raw_vector", outputCol="vector", withMean=True, withStd=True))
    return stages


def classifier(kind: str, features: list[str], label: str, **settings) -> Pipeline:
    """``logistic`` (standardised, balanced), ``boosted`` (optional early stopping), ``forest`` (balanced)."""
    if kind == "logistic":
        est = LogisticRegression(featuresCol="vector", labelCol=label, weightCol="weight", maxIter=settings.pop("maxIter", 1000), standardization=False, **settings)
        return Pipeline(stages=[*_assembler(features, True), est])
    if kind == "boosted":
        stop = settings.pop("validation", None)
        est = GBTClassifier(featuresCol="vector", labelCol=label, **{**BOOST, **settings})
        if stop:
            est = est.setValidationIndicatorCol(stop)
        return Pipeline(stages=[*_assembler(features, False), est])
    if kind == "forest":
        est = RandomForestClassifier(featuresCol="vector", labelCol=label, weightCol="weight", **{**FOREST, **settings})
        return Pipeline(stages=[*_assembler(features, False), est])
    raise ValueError(f"unknown model kind {kind}")


def train(kind: str, df: DataFrame, features: list[str], label: str, **settings) -> PipelineModel:
    rows = balanced_weights(df, label) if kind in ("logistic", "forest") else df
    return classifier(kind, features, label, **settings).fit(rows)


def predict(model: PipelineModel, df: DataFrame, out: str = "score", threshold: float = 0.5) -> DataFrame:
    """Probability of the positive class and the thresholded class."""
    scored = model.transform(df.withColumn("weight", F.lit(1.0)) if "weight" not in df.columns else df)
    keep = [c for c in df.columns if c != "weight"]
    rows = scored.select(*keep, vector_to_array("probability")[1].alias(out))
    return rows.withColumn("predicted", (F.col(out) >= threshold).cast("int"))


def out_of_fold(kind: str, df: DataFrame, features: list[str], label: str, row_id: str, folds: int = 3, **settings) -> DataFrame:
    """Every row scored by a model that has not seen it."""
    rows = df.withColumn("__fold", F.pmod(F.xxhash64(F.col(row_id).cast("string")), F.lit(folds)))
    parts = None
    for i in range(folds):
        model = train(kind, rows.filter(F.col("__fold") != i), features, label, **settings)
        part = predict(model, rows.filter(F.col("__fold") == i)).drop("__fold", "predicted")
        parts = part if parts is None else parts.unionByName(part)
    return parts


class Calibrator:
    """Isotonic or Platt calibration fitted on out-of-fold scores.

    The isotonic fit pools scores on a grid of ``cells`` equal steps first, so
    what it gathers has a fixed size.
    """

    def __init__(self, method: str = "isotonic", cells: int = 2_000):
        self.method, self.cells, self.model = method, cells, None

    def fit(self, scored: DataFrame, label: str, score: str = "score") -> "Calibrator":
        rows = scored.select(F.col(label).cast("double").alias("label"), F.col(score).alias("__s"))
        if self.method == "isotonic":
            # Scores of one grid cell collapse to one weighted row before the ordered fit.
            cells = rows.groupBy((F.round(F.col("__s") * self.cells) / self.cells).alias("__s")).agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("w"))
            cells = VectorAssembler(inputCols=["__s"], outputCol="__v").transform(cells)
            self.model = IsotonicRegression(featuresCol="__v", labelCol="label", weightCol="w").fit(cells)
        else:
            v = VectorAssembler(inputCols=["__s"], outputCol="__v").transform(rows)
            self.model = LogisticRegression(featuresCol="__v", labelCol="label", maxIter=100).fit(v)
        return self

    def transform(self, scored: DataFrame, score: str = "score", out: str = "calibrated") -> DataFrame:
        v = VectorAssembler(inputCols=[score], outputCol="__v").transform(scored)
        done = self.model.transform(v)
        value = F.col("prediction") if self.method == "isotonic" else vector_to_array("probability")[1]
        return done.select(*scored.columns, F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)).alias(out))


def train_ltv(df: DataFrame, features: list[str], label: str = "ltv_90d", **settings) -> PipelineModel:
    est = GBTRegressor(featuresCol="vector", labelCol=label, **{**BOOST, **settings})
    return Pipeline(stages=[*_assembler(features, False), est]).fit(df)


def predict_ltv(model: PipelineModel, df: DataFrame, out: str = "ltv_90d") -> DataFrame:
    """Prediction floored at 0 with its p10/p50/p90 factors."""
    keep = [c for c in df.columns if c != out]
    rows = model.transform(df).select(*keep, F.greatest(F.col("prediction"), F.lit(0.0)).alias(out))
    return rows.withColumns({name: F.col(out) * f for name, f in LTV_FACTORS.items()})


def linear_weights(model: PipelineModel, features: list[str]) -> dict[str, float]:
    """Coefficients of a logistic pipeline on the original feature scale."""
    scaler, last = model.stages[-2], model.stages[-1]
    spread = scaler.std.toArray()
    return {f: float(c / s) if s else 0.0 for f, c, s in zip(features, last.coefficients.toArray(), spread)}


def tree_importance(model: PipelineModel, features: list[str]) -> dict[str, float]:
    return dict(zip(features, [float(v) for v in model.stages[-1].featureImportances.toArray()]))


def search(df: DataFrame, features: list[str], label: str, grid: dict[str, list], parallelism: int = 2, metric: str = "areaUnderPR") -> tuple[PipelineModel, list[tuple[dict, float]]]:
    """Grid search with one held-out part -> (best model, tried settings with their score)."""
    rows = balanced_weights(df, label)
    pipe = classifier("logistic", features, label)
    est = pipe.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), values)
    maps = builder.build()
    judge = BinaryClassificationEvaluator(labelCol=label, metricName=metric)
    fitted = TrainValidationSplit(estimator=pipe, estimatorParamMaps=maps, evaluator=judge, trainRatio=0.8, parallelism=parallelism, seed=42).fit(rows)
    tried = [({p.name: v for p, v in m.items()}, s) for m, s in zip(maps, fitted.validationMetrics)]
    return fitted.bestModel, tried


# Isolation forest ------------------------------------------------------------------------------

def _average_path(n: float) -> float:
    """Expected path length of an unsuccessful search in a binary tree of n nodes."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def grow_isolation_trees(df: DataFrame, features: list[str], row_id: str, trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, node, feature, cut, left, right, depth_value) rows.

    Each row decides by hash which trees it joins, so a tree's group is a
    bounded sample whatever the table size.
    """
    n = df.agg(F.count(F.lit(1))).first()[0]
    rate = min(1.0, 2.0 * sample / max(n, 1))
    ids = F.sequence(F.lit(0), F.lit(trees - 1))
    draw = F.transform(ids, lambda t: F.struct(t.alias("tree"), F.pmod(F.xxhash64(F.col(row_id).cast("string"), t, F.lit(seed)), F.lit(1 << 30)).alias("draw")))
    joined = F.filter(draw, lambda e: e["draw"] < int(rate * (1 << 30)))
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.inline(joined))

    def grow(key, pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(["draw", *features]).head(sample)
        x = pdf[features].to_numpy()
        rng = np.random.default_rng(seed + int(key[0]))
        limit = math.ceil(math.log2(max(len(x), 2)))
        out, todo = [], [(0, np.arange(len(x)), 0)]
        next_id = 1
        while todo:
            node, idx, depth = todo.pop()
            part = x[idx]
            spans = part.max(axis=0) - part.min(axis=0) if len(idx) else np.zeros(x.shape[1])
            usable = np.flatnonzero(spans > 0)
            if depth >= limit or len(idx) <= 1 or len(usable) == 0:
                out.append((int(key[0]), node, -1, 0.0, -1, -1, depth + _average_path(len(idx)), len(x)))
                continue
            f = int(rng.choice(usable))
            at = float(rng.uniform(part[:, f].min(), part[:, f].max()))
            goes_left = part[:, f] < at
            out.append((int(key[0]), node, f, at, next_id, next_id + 1, 0.0, len(x)))
            todo += [(next_id, idx[goes_left], depth + 1), (next_id + 1, idx[~goes_left], depth + 1)]
            next_id += 2
        return pd.DataFrame(out, columns=["tree", "node", "feature", "cut", "left", "right", "path", "size"])

    schema = "tree int, node int, feature int, cut double, left int, right int, path double, size int"
    return rows.groupBy("tree").applyInPandas(grow, schema)


def _walkable(nodes) -> tuple:
    """Feature, cut, children (right, left) and path of every node of one tree, its number of levels and its sample size."""
    import numpy as np

    feature, left, right = (nodes[c].to_numpy(np.int64) for c in ("feature", "left", "right"))
    ids, inner = np.arange(len(nodes)), feature >= 0
    child = np.column_stack([np.where(inner, right, ids), np.where(inner, left, ids)])
    levels, at = 0, np.zeros(1, np.int64)
    while inner[at].any():
        levels, at = levels + 1, np.unique(child[at[inner[at]]])
    return np.where(inner, feature, 0), nodes["cut"].to_numpy(float), child.ravel(), nodes["path"].to_numpy(float), levels, int(nodes["size"].iloc[0])


class IsolationForest:
    """Isolation forest: each tree is grown on ``sample`` rows drawn by hash, as the algorithm has it; all rows are scored.

    Rows that no tree draws shape no tree.  The trees (at most trees x 2 x
    sample nodes) are the only thing sent to the tasks.
    """

    def __init__(self, features: list[str], row_id: str, sample: int, **settings):
        self.features, self.row_id = features, row_id
        self.settings = {**ISOLATION, "sample": sample, **settings}
        self.nodes, self.offset = None, 0.0

    def _fitted(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` and the score ``__s`` of all rows, written: the passes of the quantile and the caller read them, the trees are walked once."""
        s = self.settings
        grown = grow_isolation_trees(df, self.features, self.row_id, s["trees"], s["sample"], s["seed"])
        self.nodes = grown.toPandas().sort_values(["tree", "node"])
        scored = cut(self.score(df, "__s").select(*keep, "__s"))
        self.offset = exact_quantiles(scored.select("__s"), "__s", {"q": s["contamination"]}).first()["q"]
        return scored

    def fit(self, df: DataFrame) -> "IsolationForest":
        self._fitted(df, [])
        return self

    def fit_predict(self, df: DataFrame, keep: list[str], out: str = "score") -> DataFrame:
        """``keep`` and the score of the rows the forest is fitted to."""
        return self._decided(self._fitted(df, keep), out)

    def score(self, df: DataFrame, out: str = "score_sample") -> DataFrame:
        """Negative anomaly score in [-1, 0]; lower is more anomalous."""
        shared = df.sparkSession.sparkContext.broadcast([_walkable(t) for _, t in self.nodes.groupby("tree")])
        weight = sum(_average_path(size) for _, _, _, _, _, size in shared.value)

        @F.pandas_udf("double")
        def depth(*columns):
            import numpy as np
            import pandas as pd

            x = np.concatenate([c.to_numpy(dtype=float) for c in columns])
            n = len(columns[0])
            place, total = np.arange(n), np.zeros(n)
            for feature, below, child, path, levels, _ in shared.value:
                at, column = np.zeros(n, np.int64), feature * n
                # A leaf leads to itself, so that all rows take the same steps.
                for _ in range(levels):
                    left = x.take(column.take(at) + place) < below.take(at)
                    at = child.take(2 * at + left)
                total += path.take(at)
            return pd.Series(-np.power(2.0, -total / max(weight, 1e-12)))

        return df.withColumn(out, depth(*[F.col(c).cast("double") for c in self.features]))

    def predict(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Sigmoid of the negated decision value, so that higher means more anomalous."""
        return self._decided(self.score(df, "__s"), out)

    def _decided(self, scored: DataFrame, out: str) -> DataFrame:
        return scored.withColumn(out, 1 / (1 + F.exp(F.col("__s") - F.lit(self.offset)))).drop("__s")
