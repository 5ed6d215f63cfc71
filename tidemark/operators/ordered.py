"""Order-dependent operators that never funnel rows into one task.

``prefix_sum`` range-partitions on the full sort key (so a heavily repeated
leading value is still split by the later keys), writes that layout once, sums
per partition, and lets each partition start from a seed row that carries the
total of everything before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut, shuffle_width

_PART = "__part"
_SEED = "__seed"


def _sort_columns(order: list[tuple[str, str]]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_first() for c, d in order]


def prefix_sum(
    df: DataFrame,
    order: list[tuple[str, str]],
    sums: dict[str, str],
    by: tuple[str, ...] = (),
    totals: dict[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums over ``order``, optionally restarting per ``by``.

    ``sums`` maps a value column to the name of its running sum and ``totals``
    maps a value column to the name of its whole-group total.  ``order``
    should be unique inside a group: collapse ties or append an id.
    """
    totals = totals or {}
    spark = df.sparkSession
    width = partitions or shuffle_width(spark)
    keys = [F.col(c).asc() for c in by] + _sort_columns(order)
    ranged = cut(df.repartitionByRange(width, *keys).withColumn(_PART, F.spark_partition_id()))

    values = list(dict.fromkeys([*sums, *totals]))
    per_part = ranged.groupBy(*by, _PART).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    # One row per (group, range partition): at most `width` + number of groups.
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    seeds = per_part.select(
        *by,
        _PART,
        F.lit(True).alias(_SEED),
        *[F.coalesce(F.sum(f"__t_{v}").over(earlier), F.lit(0)).alias(f"__v_{v}") for v in values],
        *[F.sum(f"__t_{v}").over(whole).alias(t) for v, t in totals.items()],
    )
    rows = ranged.withColumn(_SEED, F.lit(False)).withColumns({f"__v_{v}": F.coalesce(F.col(v), F.lit(0)) for v in values})
    both = rows.unionByName(seeds, allowMissingColumns=True)
    inside = Window.partitionBy(_PART, *by).orderBy(F.col(_SEED).desc(), *_sort_columns(order))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumns(
        {
            **{s: F.sum(f"__v_{v}").over(running) for v, s in sums.items()},
            **{t: F.first(t).over(running) for t in totals.values()},
        }
    )
    return out.filter(~F.col(_SEED)).drop(_PART, _SEED, *[f"__v_{v}" for v in values])


def ranked(
    df: DataFrame,
    order: list[tuple[str, str]],
    by: tuple[str, ...] = (),
    rank: str = "rank",
    size: str | None = None,
) -> DataFrame:
    """Global (or per-group) row number, and optionally the group size."""
    one = df.withColumn("__one", F.lit(1).cast("bigint"))
    out = prefix_sum(one, order, {"__one": rank}, by=by, totals={"__one": size} if size else None)
    return out.drop("__one")


def top_fraction(df: DataFrame, order: list[tuple[str, str]], fraction: float, by: tuple[str, ...] = ()) -> DataFrame:
    """The first ``int(n * fraction)`` rows of each group; none when that is 0."""
    out = ranked(df, order, by=by, rank="__rank", size="__size")
    return out.filter(F.col("__rank") <= F.floor(F.col("__size") * F.lit(fraction))).drop("__rank", "__size")


#: Accuracy of the sketch that brackets quantiles, and the share of ranks that a bracket leaves on either side.
SKETCH, MARGIN = 2000, 3 / 2000
#: Groups whose brackets may be sent to all tasks (a few hundred bytes each); beyond that rows and brackets meet in a shuffle.
SENT_GROUPS = 20_000


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: tuple[str, ...] = (), distinct: str | None = None, few: int = 10, margin: float = MARGIN
) -> DataFrame:
    """Linear-interpolated quantiles by bracketing: no sort of all values, no group in one task.

    A sketch pass gives each quantile two values of the data that enclose it.
    A second pass keeps the values inside brackets, equal ones collapsed, and
    collapses each gap between brackets to one count; only those few rows are
    put in order.  Where a bracket should miss its quantile, wider ones are
    tried; the widest hold everything.  ``distinct`` names a column for the
    number of distinct values: exact up to ``few``, else some number above.
    """
    keyed = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("__v"))
    names = list(probs)
    ends = [max(0.0, p - margin) for p in probs.values()] + [min(1.0, p + margin) for p in probs.values()]
    grid = [i / 100 for i in range(101)] if distinct else []
    sketch = keyed.groupBy(*by).agg(F.percentile_approx("__v", [*ends, *grid], SKETCH).alias("__q"))
    n = len(names)
    brackets = sketch.select(
        *[F.col(c).alias(f"__b_{c}") for c in by],
        *[F.col("__q")[i].alias(f"__lo{i}") for i in range(n)],
        *[F.col("__q")[n + i].alias(f"__hi{i}") for i in range(n)],
        F.size(F.array_distinct("__q")).alias("__seen"),
    )
    brackets = cut(brackets)
    condition = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__b_{c}")) for c in by], F.lit(True))
    sides = F.broadcast(brackets) if not by or brackets.count() <= SENT_GROUPS else brackets
    rows = keyed.join(sides, condition)
    v = F.col("__v")
    inside = reduce(lambda x, y: x | y, [(F.col(f"__lo{i}") <= v) & (v <= F.col(f"__hi{i}")) for i in range(n)])
    if distinct:
        inside = inside | (F.col("__seen") <= few)  # so few values: all are kept, and counted
    below = [F.when(F.col(f"__hi{i}") < v, F.col(f"__hi{i}")) for i in range(n)]
    gap = below[0] if n == 1 else F.greatest(*below)
    rows = rows.select(*by, F.when(inside, v).otherwise(gap).alias("__k"), (~inside).alias("__gap"), "__seen")
    collapsed = rows.groupBy(*by, "__k", "__gap").agg(F.count(F.lit(1)).alias("__n"), F.first("__seen").alias("__seen"))
    ordered = prefix_sum(collapsed, [("__k", "asc"), ("__gap", "asc")], {"__n": "__upto"}, by=by, totals={"__n": "__total"})
    first = F.col("__upto") - F.col("__n")

    def at(index: Column) -> Column:
        return F.max(F.when(~F.col("__gap") & (first <= index) & (index < F.col("__upto")), F.col("__k").cast("double")))

    aggs = []
    for name, p in probs.items():
        position = (F.col("__total") - 1) * F.lit(float(p))
        low = F.floor(position)
        aggs += [
            at(low).alias(f"__lo_{name}"),
            at(F.least(low + 1, F.col("__total") - 1)).alias(f"__hi_{name}"),
            F.max(position - low).alias(f"__w_{name}"),
        ]
    kinds = F.greatest(F.count(F.lit(1)), F.max("__seen").cast("bigint"))
    picked = cut(ordered.groupBy(*by).agg(*aggs, kinds.alias("__kinds"), F.max("__total").alias("__total")))
    missed = reduce(lambda x, y: x | y, [F.col(f"__lo_{m}").isNull() | F.col(f"__hi_{m}").isNull() for m in names])
    if margin < 1 and not picked.filter(missed & (F.col("__total") > 0)).isEmpty():
        return exact_quantiles(df, value, probs, by, distinct, few, margin * 20)
    return picked.select(
        *by,
        *([F.col("__kinds").alias(distinct)] if distinct else []),
        *[
            (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__w_{n}")).alias(n)
            for n in probs
        ],
    )


def quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: tuple[str, ...] = (),
    method: str = "exact",
    accuracy: int = 10000,
) -> DataFrame:
    """``method='exact'`` sorts across partitions; ``'sketch'`` is one bounded-memory pass."""
    if method == "exact":
        return exact_quantiles(df, value, probs, by)
    picked = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.percentile_approx(F.col(value).cast("double"), [float(p) for p in probs.values()], accuracy).alias("__q")
    )
    return picked.select(*by, *[F.col("__q")[i].alias(n) for i, n in enumerate(probs)])


def run_lengths(df: DataFrame, keys: tuple[str, ...], at: str, hit: Column, step: Column | None = None) -> DataFrame:
    """Length of the current streak of ``hit`` at every row of an already aggregated series.

    Input has one row per (keys, window), so the per-key order is bounded by
    the number of windows.  With ``step`` (an interval) a missing window ends
    the streak.
    """
    w = Window.partitionBy(*keys).orderBy(at)
    marked = df.withColumn("__hit", F.coalesce(hit, F.lit(False)))
    broken = ~F.col("__hit") | F.lag("__hit").over(w).isNull()
    if step is not None:
        broken = broken | (F.lag(at).over(w) + step != F.col(at))
    marked = marked.withColumn("__break", broken.cast("int"))
    marked = marked.withColumn("__island", F.sum("__break").over(w))
    inside = Window.partitionBy(*keys, "__island").orderBy(at)
    streak = F.when(F.col("__hit"), F.sum(F.col("__hit").cast("int")).over(inside)).otherwise(F.lit(0))
    return marked.withColumn("streak", streak.cast("bigint")).drop("__hit", "__break", "__island")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key by ``order``; combines map-side, so hot keys are safe."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def top_k(df: DataFrame, keys: list[str], order: list[tuple[str, str]], k: int, rank: str = "rank") -> DataFrame:
    """Best ``k`` rows per key.

    The literal bound lets Spark keep only ``k`` rows per key and task before
    the shuffle, so a key matching a third of the corpus ships ``k`` x tasks rows.
    """
    w = Window.partitionBy(*keys).orderBy(*_sort_columns(order))
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
