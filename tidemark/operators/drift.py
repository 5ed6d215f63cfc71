"""Population stability, Kolmogorov-Smirnov, triggers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import numeric_columns, ratio
from .ordered import exact_quantiles, prefix_sum, quantiles, run_lengths, top_k, union_all
from .profile import unpivot_numeric

# Smoothing constant, number of bins, trigger levels, features that count as critical.
EPSILON = 1e-6
BINS = 10
SCORE_PSI = 0.25
FEATURE_PSI = 0.30
CRITICAL_FEATURES = ["amount", "velocity_risk_score", "device_risk_score"]


def _index(counts: DataFrame, by: tuple[str, ...], epsilon: float) -> DataFrame:
    """(by, bin, e, a, e_total, a_total) -> PSI per ``by``."""
    e = F.col("e") / (F.col("e_total") + epsilon) + epsilon
    a = F.col("a") / (F.col("a_total") + epsilon) + epsilon
    return counts.groupBy(*by).agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))


def baseline_edges(base: DataFrame, features: list[str], bins: int = BINS, method: str = "exact") -> dict[str, list[float]]:
    """Inner quantile edges per numeric feature with more than ``bins`` distinct values.

    Read back to the driver: at most features x (bins - 1) numbers.
    """
    long = unpivot_numeric(base, features)
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    if method == "exact":
        edges = exact_quantiles(long, "value", probs, ("feature",), distinct="kinds")
    else:
        # At most bins + 1 values per feature and task leave the partial top-k, so counting stays bounded.
        values = long.groupBy("feature", "value").agg(F.lit(1).alias("one"))
        kinds = top_k(values, ["feature"], [("value", "asc")], bins + 1).groupBy("feature").agg(F.count(F.lit(1)).alias("kinds"))
        edges = quantiles(long, "value", probs, ("feature",), method).join(kinds, "feature")
    rows = edges.filter(F.col("kinds") > bins).collect()
    return {r["feature"]: [r[f"q{i}"] for i in range(1, bins)] for r in rows}


def bin_counts(df: DataFrame, edges: dict[str, list[float]], by: tuple[str | Column, ...] = (), out: str = "n") -> DataFrame:
    """Rows per (by, feature, bin) against literal edges; also on streams, where ``by`` holds the window."""
    names = list(edges)
    keys = tuple(c for c in by if isinstance(c, str))
    extra = [c for c in by if not isinstance(c, str)]
    keep = tuple(dict.fromkeys([*keys, *(c for c in df.columns if extra and c not in names)]))
    long = unpivot_numeric(df, names, keep)
    chain = F.lit(None).cast("int")
    for name in names:
        place = F.lit(0)
        for edge in edges[name]:
            place = place + F.when(F.col("value") >= F.lit(float(edge)), 1).otherwise(0)
        chain = F.when(F.col("feature") == name, place).otherwise(chain)
    return long.groupBy(*keys, *extra, "feature", chain.alias("bin")).agg(F.count(F.lit(1)).alias(out))


def psi_of_counts(expected: DataFrame, actual: DataFrame, edges: dict[str, list[float]], by: tuple[str, ...] = (), epsilon: float = EPSILON) -> DataFrame:
    """PSI per (by, feature) from counts: ``expected`` (feature, bin, e) and ``actual`` (by, feature, bin, a)."""
    keys = (*by, "feature")
    sizes = F.lit(0)
    for name, cuts in edges.items():
        sizes = F.when(F.col("feature") == name, F.lit(len(cuts))).otherwise(sizes)
    # Every (group, feature) meets every bin, also the empty ones.
    totals = actual.groupBy(*keys).agg(F.sum("a").alias("a_total"))
    grid = totals.withColumn("bin", F.explode(F.sequence(F.lit(0), sizes)))
    e_tot = expected.groupBy("feature").agg(F.sum("e").alias("e_total"))
    cells = (
        grid.join(expected, ["feature", "bin"], "left").join(e_tot, "feature").join(actual, [*keys, "bin"], "left").fillna(0, ["e", "a"])
    )
    return _index(cells, keys, epsilon)


def psi_numeric(
    base: DataFrame, current: DataFrame, edges: dict[str, list[float]], by: tuple[str, ...] = (), epsilon: float = EPSILON
) -> DataFrame:
    """PSI per feature (and per ``by`` group of the current side) over the baseline's quantile bins.

    Rows are binned in place against literal edges; what is shuffled is one
    partial count per (group, feature, bin) and task.
    """
    return psi_of_counts(bin_counts(base, edges, (), "e"), bin_counts(current, edges, by, "a"), edges, by, epsilon)


def psi_categorical(
    base: DataFrame, current: DataFrame, columns: list[str], by: tuple[str, ...] = (), keep: int = 10, epsilon: float = EPSILON
) -> DataFrame:
    """PSI over the baseline's ``keep`` most frequent values plus OTHER (ties by value)."""

    def counted(df: DataFrame, keys: tuple[str, ...], out: str) -> DataFrame:
        long = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(list(keys), columns, "feature", "value")
        return long.filter(F.col("value").isNotNull()).groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias(out))

    expected = counted(base, (), "e")
    top = top_k(expected, ["feature"], [("e", "desc"), ("value", "asc")], keep).select("feature", "value", F.lit(True).alias("top"))

    def grouped(df: DataFrame, keys: tuple[str, ...], out: str) -> DataFrame:
        label = F.when(F.col("top"), F.col("value")).otherwise(F.lit("OTHER"))
        return df.join(top, ["feature", "value"], "left").groupBy(*keys, "feature", label.alias("bin")).agg(F.sum(out).alias(out))

    keys = (*by, "feature")
    actual = grouped(counted(current, by, "a"), by, "a")
    base_bins = grouped(expected, (), "e")
    e_tot = base_bins.groupBy("feature").agg(F.sum("e").alias("e_total"))
    totals = actual.groupBy(*keys).agg(F.sum("a").alias("a_total"))
    bins = top.select("feature", F.col("value").alias("bin")).unionByName(
        top.select("feature", F.lit("OTHER").alias("bin")).distinct()
    )
    grid = totals.join(bins, "feature")
    cells = grid.join(base_bins, ["feature", "bin"], "left").join(e_tot, "feature").join(actual, [*keys, "bin"], "left")
    return _index(cells.fillna(0, ["e", "a"]), keys, epsilon)


def ks_statistic(base: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Largest difference of the two empirical distributions per feature, ties collapsed first."""

    def side(df: DataFrame, b: int, c: int) -> DataFrame:
        long = unpivot_numeric(df, features)
        return long.select("feature", "value", F.lit(b).cast("bigint").alias("b"), F.lit(c).cast("bigint").alias("c"))

    both = side(base, 1, 0).unionByName(side(current, 0, 1))
    cells = both.groupBy("feature", "value").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    run = prefix_sum(cells, [("value", "asc")], {"b": "cb", "c": "cc"}, by=("feature",), totals={"b": "nb", "c": "nc"})
    gap = F.abs(ratio(F.col("cb"), F.col("nb")) - ratio(F.col("cc"), F.col("nc")))
    return run.groupBy("feature").agg(F.max(gap).alias("ks"))


def drift_report(base: DataFrame, current: DataFrame, features: list[str] | None = None, method: str = "exact") -> DataFrame:
    """(feature, psi, ks) for every shared numeric column; few-valued columns use the categorical form."""
    shared = [c for c in (features or numeric_columns(base.schema)) if c in current.columns]
    edges = baseline_edges(base, shared, method=method)
    few = [c for c in shared if c not in edges]
    parts = []
    if edges:
        parts.append(psi_numeric(base, current, edges))
    if few:
        parts.append(psi_categorical(base, current, few))
    return union_all(parts).join(ks_statistic(base, current, shared), "feature")


def alerts(report: DataFrame, score: str = "score") -> DataFrame:
    """Rows at or over their limit, with type and severity."""
    is_score = F.col("feature") == score
    limit = F.when(is_score, F.lit(SCORE_PSI)).otherwise(F.lit(FEATURE_PSI))
    kind = F.when(is_score, "score_drift").otherwise("feature_drift")
    return report.filter(F.col("psi") >= limit).withColumns({"type": kind, "severity": F.lit("high")})


def drift_triggers(
    series: DataFrame, keys: tuple[str, ...], at: str, score: str = "score", consecutive: int = 2, step: Column | None = None,
    critical: list[str] | None = None,
) -> DataFrame:
    """Per (keys, feature, window): alert, streak and whether retraining is due.

    ``series`` has one PSI per feature and window.  With ``critical`` only the
    score and the listed features may trigger.
    """
    is_score = F.col("feature") == score
    hit = F.col("psi") >= F.when(is_score, F.lit(SCORE_PSI)).otherwise(F.lit(FEATURE_PSI))
    out = run_lengths(series, (*keys, "feature"), at, hit, step)
    allowed = F.lit(True) if critical is None else is_score | F.col("feature").isin(critical)
    return out.withColumns({"alert": F.coalesce(hit, F.lit(False)), "retrain": (F.col("streak") >= consecutive) & allowed})

