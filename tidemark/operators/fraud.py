"""Transaction, behaviour, device and risk-signal features."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.temporal import Moment, epoch_micros, looking_back, moment, span
from ..session import shuffle_width
from .features import DAY, Feature, add_metadata, build_features, merge_groups
from .ordered import latest_per_key
from .skew import spread_join

HOUR = timedelta(hours=1)
#: Rows that a task of the per-event velocity orders, on average: what it holds does not grow with the events.
TASK_ROWS = 500_000


def velocity_group(behavior: DataFrame, entity: str, as_ofs: list[Moment]) -> DataFrame:
    """Counts over 1h/24h/7d, 24h sum, 7d mean, 30d maximum; half-open look-backs."""
    return build_features(
        behavior, entity, "event_time", as_ofs,
        [
            Feature("transaction_count_1h", "count", HOUR),
            Feature("transaction_count_24h", "count", DAY),
            Feature("transaction_count_7d", "count", 7 * DAY),
            Feature("total_amount_24h", "sum", DAY, "amount", default=0.0),
            Feature("avg_amount_7d", "mean", 7 * DAY, "amount", default=0.0),
            Feature("max_amount_30d", "max", 30 * DAY, "amount", default=0.0),
        ],
    )


def country_group(behavior: DataFrame, entity: str, as_ofs: list[Moment]) -> DataFrame:
    return build_features(
        behavior, entity, "event_time", as_ofs, [Feature("country_change_flag_24h", "changed", DAY, "ip_address_country")]
    )


def risk_group(signals: DataFrame, entity: str, as_ofs: list[Moment]) -> DataFrame:
    """All four signal types in one grouped pass."""

    def of(kind: str) -> Column:
        return F.col("signal_type") == kind

    return build_features(
        signals, entity, "event_time", as_ofs,
        [
            Feature("chargeback_count_90d", "count", 90 * DAY, where=of("chargeback")),
            Feature("fraud_flag_count_90d", "count", 90 * DAY, where=of("fraud_flag")),
            Feature("velocity_risk_score", "max", 90 * DAY, "signal_value", of("velocity_alert"), default=0.0),
            Feature("device_risk_score", "max", 90 * DAY, "signal_value", of("device_alert"), default=0.0),
        ],
    )


def new_device_flags(spine: DataFrame, behavior: DataFrame, as_of: Moment, device: str = "device_id") -> DataFrame:
    """``is_new_device``: first seen within 90 days before as_of over the full history, or never seen."""
    a = moment(as_of)
    seen = (
        behavior.filter((F.col("event_time") < a) & F.col(device).isNotNull())
        .groupBy(device).agg(F.min("event_time").alias("__first"))
    )
    joined = spread_join(spine, seen, device)
    return joined.withColumn("is_new_device", F.coalesce(F.col("__first") >= a - span(90 * DAY), F.lit(True))).drop("__first")


def fraud_features(
    transactions: DataFrame,
    behavior: DataFrame,
    signals: DataFrame,
    profiles: DataFrame,
    as_of: Moment,
    keep: list[str],
    version: str = "fs_fraud_v1",
    ids: list | None = None,
    profile_tie: str | None = None,
) -> DataFrame:
    """One row per transaction of the last day: transaction, velocity, device, risk and profile features.

    User-level groups are aggregated first and merged on the user once, so the
    transaction spine is joined twice (user, device) whatever the number of groups.
    """
    a = moment(as_of)
    spine = transactions.filter(looking_back("event_time", a, DAY))
    if ids:
        spine = spine.filter(F.col("transaction_id").isin(ids))
    recent = behavior.filter(looking_back("event_time", a, 90 * DAY))
    users = merge_groups(
        [velocity_group(recent, "user_id", [as_of]), country_group(recent, "user_id", [as_of]), risk_group(signals, "user_id", [as_of])],
        ["user_id", "as_of_time"],
    ).drop("as_of_time")
    snapshots = profiles.filter(F.col("snapshot_time") <= a)
    order = ["snapshot_time"] + ([profile_tie] if profile_tie else [])
    profile = latest_per_key(snapshots, ["user_id"], order).select("user_id", "account_age_days", "kyc_status", "account_status")
    per_user = users.join(profile, "user_id", "full")
    out = spread_join(new_device_flags(spine.select("transaction_id", "user_id", *keep), behavior, as_of), per_user, "user_id")
    numeric = [c for c in users.columns if c != "user_id"] + ["account_age_days"]
    out = out.fillna(0, numeric).withColumn("country_change_flag_24h", F.col("country_change_flag_24h") == 1)
    return add_metadata(out, version, a)


def velocity_per_event(
    events: DataFrame,
    entity: str,
    ts: str,
    amount: str,
    event_id: str,
    windows: dict[str, timedelta],
    grain: timedelta = HOUR,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Count, sum and maximum over ``[t-w, t)`` for every event, for several look-backs.

    Work is partitioned on (entity, hour), never on entity alone.  A look-back
    is cut into three pieces: the current hour before the event, whole hours in
    between (from an hourly roll-up), and the tail of the oldest hour.  The
    tail arrives as a shifted copy of that hour's rows, so all pieces meet in
    one partition and a busy entity spreads over its hours.  There are as many
    partitions as the counted events need at ``task_rows`` rows each.
    """
    step = int(grain.total_seconds() * 1_000_000)
    base = events.select(
        F.col(entity).alias("e"), F.col(event_id).alias("id"), epoch_micros(ts).alias("t"), F.col(amount).alias("v")
    ).withColumn("h", F.floor(F.col("t") / F.lit(step)).cast("bigint"))
    for w in windows.values():
        if (w.total_seconds() * 1_000_000) % step:
            raise ValueError("a look-back must be a multiple of the grain")
    hours = {n: int(w.total_seconds() * 1_000_000) // step for n, w in windows.items()}

    # Hourly roll-up and, per (entity, hour), what the whole hours in between add up to.
    dealt = events.count() * (len(hours) + 2)
    width = max(shuffle_width(events.sparkSession), -(-dealt // task_rows))
    hourly = base.repartition(width, "e", "h").groupBy("e", "h").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.max("v").alias("m"))
    between = {}
    for name, k in hours.items():
        w = Window.partitionBy("e").orderBy("h").rangeBetween(-(k - 1), -1)
        between |= {f"bn_{name}": F.sum("n").over(w), f"bs_{name}": F.sum("s").over(w), f"bm_{name}": F.max("m").over(w)}
    seeds = hourly.repartition(width, "e").withColumns(between).drop("n", "s", "m").withColumns({"kind": F.lit(""), "t": F.col("h") * F.lit(step) - 1})

    own = base.withColumn("kind", F.lit("own"))
    copies = F.explode(
        F.array(*[F.struct(F.lit(n).alias("kind"), F.lit(k).cast("bigint").alias("k")) for n, k in hours.items()])
    )
    shifted = base.select("e", "t", "v", "h", copies.alias("c")).select(
        "e", (F.col("t") + F.col("c.k") * step).alias("t"), "v", (F.col("h") + F.col("c.k")).alias("h"), F.col("c.kind").alias("kind")
    )
    rows = own.unionByName(shifted, allowMissingColumns=True).unionByName(seeds, allowMissingColumns=True).repartition(width, "e", "h")
    hour = Window.partitionBy("e", "h").orderBy("t")
    before = hour.rangeBetween(Window.unboundedPreceding, -1)
    # From this row to the hour's end, as a growing frame: each row is added once.
    after = Window.partitionBy("e", "h").orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    mine = F.col("kind") == "own"
    cols: dict[str, Column] = {
        "__n": F.count(F.when(mine, 1)).over(before),
        "__s": F.sum(F.when(mine, F.col("v"))).over(before),
        "__m": F.max(F.when(mine, F.col("v"))).over(before),
    }
    for name in hours:
        tail = F.col("kind") == name
        cols |= {
            f"tn_{name}": F.count(F.when(tail, 1)).over(after),
            f"ts_{name}": F.sum(F.when(tail, F.col("v"))).over(after),
            f"tm_{name}": F.max(F.when(tail, F.col("v"))).over(after),
            f"cn_{name}": F.max(f"bn_{name}").over(before),
            f"cs_{name}": F.max(f"bs_{name}").over(before),
            f"cm_{name}": F.max(f"bm_{name}").over(before),
        }
    out = rows.withColumns(cols).filter(mine)
    zero = F.lit(0)
    picked = [F.col("id").alias(event_id), F.col("e").alias(entity)]
    for name in hours:
        picked += [
            (F.col("__n") + F.col(f"tn_{name}") + F.coalesce(F.col(f"cn_{name}"), zero)).cast("bigint").alias(f"count_{name}"),
            (F.coalesce("__s", zero) + F.coalesce(f"ts_{name}", zero) + F.coalesce(f"cs_{name}", zero)).alias(f"sum_{name}"),
            F.greatest("__m", f"tm_{name}", f"cm_{name}").alias(f"max_{name}"),
        ]
    return out.select(*picked)


def mature_labels(labels: DataFrame, as_of: Moment, investigation: timedelta = 7 * DAY) -> DataFrame:
    """Labels whose investigation period has passed and that are known at as_of."""
    known = (F.col("label_time") >= F.col("event_time") + span(investigation)) & (F.col("label_time") <= moment(as_of))
    return labels.filter(known)
