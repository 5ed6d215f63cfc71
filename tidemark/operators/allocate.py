"""Budgeted offer allocation: greedy, near-optimal, profit curve, backtest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..session import cut, shuffle_width
from .metrics import decision_metrics, stratified, value_shares
from .ordered import prefix_sum, union_all
from .policy import churn_reason_codes
from .spine import assign_splits


@dataclass(frozen=True)
class Offer:
    offer_type: str
    cost: float
    uplift_rate: float
    min_segment: str | None = None


# Default offers and budget.
DEFAULT_OFFERS = [Offer("OFFER_5", 5.0, 0.05), Offer("OFFER_10", 10.0, 0.10), Offer("CALL_SUPPORT", 20.0, 0.15)]
DEFAULT_BUDGET = 10000.0


def _cents(amount: float) -> int:
    return round(amount * 100)


def offer_options(
    users: DataFrame,
    offers: list[Offer],
    user: str = "user_id",
    prob: str = "churn_prob",
    ltv: str = "ltv_90d",
    segment: str | None = None,
    skip_low_risk: float | None = None,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """(keys, user_id, options): each user's profitable offers, best profit per cost first.

    Offers are configuration, evaluated per row as expressions: no join, no
    shuffle.  Order inside ``options``: profit per cost, then lower cost, then
    name.
    """
    p, v = F.col(prob), F.col(ltv)
    choices = []
    for o in offers:
        if o.offer_type == "NO_ACTION" or o.cost <= 0:
            continue
        uplift = F.lit(float(o.uplift_rate))
        if o.min_segment and segment:
            tuned = F.when(F.col(segment) == o.min_segment, uplift * 1.1).otherwise(uplift * 0.9)
            uplift = F.when(F.coalesce(F.col(segment), F.lit("")) != "", tuned).otherwise(uplift)
        profit = p * uplift * v - F.lit(float(o.cost))
        entry = F.struct(
            (-(profit / F.lit(float(o.cost)))).alias("order"),
            F.lit(_cents(o.cost)).cast("bigint").alias("cents"),
            F.lit(o.offer_type).alias("offer_type"),
            profit.alias("profit"),
        )
        choices.append(F.when(profit > 0, entry))
    rows = users if skip_low_risk is None else users.filter(p >= skip_low_risk)
    return rows.select(*keys, F.col(user).alias("user_id"), F.array_sort(F.array_compact(F.array(*choices))).alias("options"))


def offer_candidates(users: DataFrame, offers: list[Offer], **names) -> DataFrame:
    """(user_id, offer_type, profit, cost, profit_per_cost) rows with positive profit and cost."""
    rows = offer_options(users, offers, **names).select("user_id", F.inline("options"))
    return rows.select("user_id", "offer_type", "profit", (F.col("cents") / 100.0).alias("cost"), (-F.col("order")).alias("profit_per_cost"))


_ORDER = [("order", "asc"), ("cents", "asc"), ("user_id", "asc")]


def _dearest(options: DataFrame) -> int:
    """The largest cost in cents: one number."""
    return options.agg(F.max(F.array_max(F.transform("options", lambda o: o["cents"]))).alias("c")).first()["c"] or 0


def _first_phase(options: DataFrame, limits: dict[str, int]) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The first phase of all budgets at once, where each could pay any option: one prefix sum of every user's best option.

    Budgets differ in where they cut it; a user is unfolded per budget only
    then.  Returns taken rows, waiting rows, and what is left of each budget
    that overflowed.
    """
    rows = options.select("user_id", "options").filter(F.size("options") > 0)
    rows = rows.withColumns({"order": F.col("options")[0]["order"], "cents": F.col("options")[0]["cents"]})
    run = cut(prefix_sum(rows, _ORDER, {"cents": "spent"}).select("user_id", "options", "cents", "spent"))
    spent, names = F.col("spent"), list(limits)
    sums = [F.sum(F.when(spent <= limits[k], F.col("cents"))).alias(f"u{i}") for i, k in enumerate(names)]
    state = run.agg(F.coalesce(F.max("spent"), F.lit(0)).alias("all"), *sums).first()
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).cast("bigint").alias("v")) for k, v in limits.items()])
    within = F.transform(F.filter(table, lambda b: spent <= b["v"]), lambda b: b["k"])
    beyond = F.transform(F.filter(table, lambda b: spent > b["v"]), lambda b: b["k"])
    taken = run.select(F.explode(within).alias("budget_id"), "user_id", F.col("options")[0].alias("o"))
    waiting = run.select(F.explode(beyond).alias("budget_id"), "user_id", "options")
    return taken, waiting, {k: limits[k] - (state[f"u{i}"] or 0) for i, k in enumerate(names) if state["all"] > limits[k]}


def greedy_select(options: DataFrame, budgets: dict[str, float]) -> DataFrame:
    """Skip-and-continue greedy for several budgets at once.

    ``options`` comes from :func:`offer_options`; with a ``budget_id`` column a
    row competes for that budget only, otherwise for all of them.  Returns
    (budget_id, user_id, offer_type, profit, cost).

    Sequential meaning: walk all options by profit per cost (ties: lower cost,
    then user); take one when its user is free and the cost still fits,
    otherwise go on.

    Distributed form: as long as a prefix of every user's best open option
    fits, the walk takes exactly that prefix.  Past the first overflow, users
    served and options that no longer fit drop out and the next phase goes on.
    Budgets that can pay any option share the first phase.
    Each phase retires at least one cost level, so phases <= distinct costs.
    Costs are whole cents, so sums do not depend on their order.  A user's
    options travel in its row: a phase is one range-partitioned prefix sum.
    """
    left = {k: _cents(v) for k, v in budgets.items()}
    taken_parts: list[DataFrame] = []
    if "budget_id" in options.columns:
        waiting = options.select("budget_id", "user_id", "options")
    elif len(budgets) > 1 and min(left.values()) >= _dearest(options):
        taken, waiting, left = _first_phase(options, left)
        taken_parts.append(taken)
    else:
        waiting = options.select(F.explode(F.array(*[F.lit(k) for k in budgets])).alias("budget_id"), "user_id", "options")
    while left:
        limits = F.create_map(*[x for k, v in left.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
        limit = F.try_element_at(limits, F.col("budget_id"))
        affordable = F.filter("options", lambda o: o["cents"] <= limit)
        rows = waiting.withColumn("options", affordable).filter(F.size("options") > 0)
        rows = rows.withColumns({"order": F.col("options")[0]["order"], "cents": F.col("options")[0]["cents"]})
        run = prefix_sum(rows, _ORDER, {"cents": "spent"}, by=("budget_id",))
        run = cut(run.withColumn("taken", F.col("spent") <= limit))
        state = run.groupBy("budget_id").agg(
            F.sum(F.when(F.col("taken"), F.col("cents")).otherwise(0)).alias("used"), F.bool_or(~F.col("taken")).alias("overflow")
        ).collect()
        taken_parts.append(run.filter("taken").select("budget_id", "user_id", F.col("options")[0].alias("o")))
        left = {r["budget_id"]: left[r["budget_id"]] - r["used"] for r in state if r["overflow"]}
        waiting = run.filter(~F.col("taken")).select("budget_id", "user_id", "options")
    return union_all(taken_parts).select(
        "budget_id", "user_id", "o.offer_type", "o.profit", (F.col("o.cents") / 100.0).alias("cost")
    )


def _complete(
    users: DataFrame, chosen: DataFrame, user: str, prob: str, ltv: str, skip_low_risk: float | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Exactly one row per user; users without an offer get NO_ACTION."""
    spine = users.select(F.col(user).alias("user_id"), F.col(prob).alias("__p"), F.col(ltv).alias("__v"), *keep)
    j = spine.join(chosen.select("user_id", "offer_type", "profit", "cost"), "user_id", "left")
    empty = F.array().cast("array<string>")
    idle = empty if skip_low_risk is None else F.when(F.col("__p") < skip_low_risk, F.array(F.lit("LOW_RISK"))).otherwise(empty)
    return j.select(
        "user_id", *keep,
        F.coalesce("offer_type", F.lit("NO_ACTION")).alias("action"),
        F.when(F.col("offer_type").isNotNull(), churn_reason_codes("__p", "__v")).otherwise(idle).alias("reason_codes"),
        F.coalesce("profit", F.lit(0.0)).alias("expected_profit"),
        F.coalesce("cost", F.lit(0.0)).alias("cost"),
    )


def greedy_allocate(
    users: DataFrame,
    offers: list[Offer],
    budget: float,
    user: str = "user_id",
    prob: str = "churn_prob",
    ltv: str = "ltv_90d",
    segment: str | None = None,
    skip_low_risk: float | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """user_id, action, reason_codes, expected_profit, cost: one row per user."""
    options = offer_options(users, offers, user, prob, ltv, segment, skip_low_risk)
    return _complete(users, greedy_select(options, {"all": budget}), user, prob, ltv, skip_low_risk, keep)


def profit_curve(
    users: DataFrame, offers: list[Offer], budget: float, points: int = 10, user: str = "user_id", prob: str = "churn_prob", ltv: str = "ltv_90d"
) -> DataFrame:
    """Profit, cost and utilization for 10%..100% of the budget; all budgets share the same phases."""
    step = 0.9 / (points - 1)
    levels = {f"b{i:03d}": budget * (1.0 if i == points - 1 else 0.1 + step * i) for i in range(points)}
    chosen = greedy_select(offer_options(users, offers, user, prob, ltv), levels)
    totals = chosen.groupBy("budget_id").agg(F.sum("profit").alias("profit"), F.sum("cost").alias("cost"))
    table = users.sparkSession.createDataFrame([(k, float(v)) for k, v in levels.items()], "budget_id string, budget double")
    out = table.join(totals, "budget_id", "left").fillna(0.0, ["profit", "cost"])
    return out.select("budget", "profit", "cost", F.try_divide(F.col("cost"), F.col("budget")).alias("budget_utilization"))


def _priced(options: DataFrame, prices: list[float]) -> DataFrame:
    """(i, cents, profit, surplus): totals when every user takes its best offer at each price of a cent.

    The best offer is found inside the user's row; only one partial sum per
    price and task is shuffled.
    """
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(v)).alias("price")) for i, v in enumerate(prices)])
    rows = options.select("options", F.inline(grid))
    scored = F.transform(
        "options",
        lambda o: F.struct(
            (o["profit"] - F.col("price") * o["cents"]).alias("surplus"), (-o["cents"]).alias("minus"), o["profit"].alias("profit")
        ),
    )
    best = rows.select("i", F.array_max(scored).alias("b")).filter(F.col("b.surplus") > 0)
    return best.groupBy("i").agg(
        (-F.sum("b.minus")).alias("cents"), F.sum("b.profit").alias("profit"), F.sum("b.surplus").alias("surplus")
    )


def lagrangian_allocate(
    users: DataFrame,
    offers: list[Offer],
    budget: float,
    user: str = "user_id",
    prob: str = "churn_prob",
    ltv: str = "ltv_90d",
    rounds: int = 4,
    grid: int = 24,
) -> tuple[DataFrame, DataFrame]:
    """Near-optimal assignment under one budget -> (decisions, report).

    A price per cent of budget is searched on a grid; each round prices the
    whole grid in one pass over all tasks and reads back at most ``grid`` rows.  Money left at
    the final price goes to the remaining users greedily.  The report carries
    the dual bound, so the distance to the optimum is known.
    """
    # Few bytes a user, much to reckon: a table of one file would be priced in one task.
    spread = users.select(user, prob, ltv).repartition(shuffle_width(users.sparkSession), user)
    options = cut(offer_options(spread, offers, user, prob, ltv)).filter(F.size("options") > 0)
    limit = _cents(budget)
    steepest = options.agg(F.max(F.array_max(F.transform("options", lambda o: o["profit"] / o["cents"])))).first()[0] or 0.0
    low, high, bound, price = 0.0, steepest, float("inf"), steepest
    for _ in range(rounds):
        prices = [low + (high - low) * i / (grid - 1) for i in range(grid)]
        priced = {r["i"]: r for r in _priced(options, prices).collect()}
        bound = min(bound, *[v * limit + (priced[i]["surplus"] if i in priced else 0.0) for i, v in enumerate(prices)])
        fitting = [i for i in range(grid) if (priced[i]["cents"] if i in priced else 0) <= limit]
        first = fitting[0]
        price = prices[first]
        if first == 0:
            break
        low, high = prices[first - 1], prices[first]
    gain = F.transform(
        "options", lambda o: F.struct((o["profit"] - F.lit(price) * o["cents"]).alias("s"), (-o["cents"]).alias("m"), o.alias("o"))
    )
    best = cut(options.withColumn("b", F.array_max(gain)))
    served = best.filter(F.col("b.s") > 0)
    spent = served.agg(F.coalesce(F.sum("b.o.cents"), F.lit(0))).first()[0]
    rest = greedy_select(best.filter(F.col("b.s") <= 0), {"all": (limit - spent) / 100.0}).drop("budget_id")
    picked = served.select("user_id", "b.o.offer_type", "b.o.profit", (F.col("b.o.cents") / 100.0).alias("cost")).unionByName(rest)
    report = picked.agg(
        F.lit(float(price)).alias("price"), F.coalesce(F.sum("profit"), F.lit(0.0)).alias("profit"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"), F.lit(float(bound)).alias("upper_bound"),
    ).withColumn("gap", F.col("upper_bound") - F.col("profit"))
    return _complete(users, picked, user, prob, ltv), report


def backtest(
    users: DataFrame, offers: list[Offer], budget: float, outcomes: DataFrame | None = None, strata: list[str] | None = None
) -> dict[str, DataFrame]:
    """decisions, metrics, offer mix, per-stratum metrics and the profit curve."""
    strata = strata or []
    decisions = cut(greedy_allocate(users, offers, budget, keep=tuple(strata)))
    out = {
        "decisions": decisions,
        "metrics": decision_metrics(decisions, budget, outcomes),
        "offer_mix": value_shares(decisions, "action"),
        "profit_curve": profit_curve(users, offers, budget),
    }
    if strata:
        out["stratified"] = stratified(decisions, strata, lambda d, by: decision_metrics(d, budget, outcomes, by))
    return out


def windowed_backtest(scored: DataFrame, ts: str, windows: list[dict], offers: list[Offer], budget: float) -> DataFrame:
    """Greedy allocation inside every rolling window, one budget each, in shared phases.

    ``scored`` has user_id, churn_prob, ltv_90d and ``ts``; a user's latest
    score inside a window counts.
    """
    rows = assign_splits(scored, ts, windows)
    latest = rows.groupBy(F.col("split_id").cast("string").alias("budget_id"), "user_id").agg(
        F.max_by(F.struct("churn_prob", "ltv_90d"), F.struct(ts, "churn_prob", "ltv_90d")).alias("s")
    ).select("budget_id", "user_id", "s.*")
    chosen = greedy_select(offer_options(latest, offers, keys=("budget_id",)), {str(w["split_id"]): budget for w in windows})
    totals = chosen.groupBy("budget_id").agg(F.sum("profit").alias("profit"), F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("offered"))
    sizes = latest.groupBy("budget_id").agg(F.count(F.lit(1)).alias("users"))
    out = sizes.join(totals, "budget_id", "left").fillna(0)
    return out.select(F.col("budget_id").cast("int").alias("split_id"), "users", "offered", "profit", "cost")
