"""Queries over profiles, contracts, quality gates and drift."""

from pyspark.sql import DataFrame, functions as F

from ..functions.temporal import moment
from ..operators import drift, prep, profile, quality as ql
from ..operators.metrics import value_shares
from .feature_queries import rounded
from .registry import query
from .views import Tables

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _long(table: str, names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {table}" for c in names)


@query(
    "describe_long", "lineitem",
    f"""SELECT feature, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max, count(*) AS sample_size,
      round(quantile_cont(value, 0.10), 6) AS p10, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.50), 6) AS p50,
      round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 0.90), 6) AS p90 FROM ({_long('lineitem', _NUM)}) GROUP BY 1""",
)
def describe_long(t: Tables) -> DataFrame:
    return rounded(profile.describe_long(t.lineitem, _NUM), "mean", "std", "p10", "p25", "p50", "p75", "p90")


@query(
    "score_baseline", "txn_scored_v",
    """SELECT 'score' AS kind, 'risk_score' AS feature, round(avg(risk_score), 6) AS mean, round(stddev_pop(risk_score), 6) AS std, min(risk_score) AS min, max(risk_score) AS max,
      count(*) AS sample_size, round(quantile_cont(risk_score, 0.10), 6) AS p10, round(quantile_cont(risk_score, 0.25), 6) AS p25, round(quantile_cont(risk_score, 0.50), 6) AS p50,
      round(quantile_cont(risk_score, 0.75), 6) AS p75, round(quantile_cont(risk_score, 0.90), 6) AS p90, CAST(NULL AS VARCHAR) AS value, 'base_1' AS baseline_version FROM txn_scored_v
    UNION ALL SELECT 'numeric', 'amount_usd', round(avg(amount_usd), 6), round(stddev_samp(amount_usd), 6), min(amount_usd), max(amount_usd), count(*),
      round(quantile_cont(amount_usd, 0.10), 6), round(quantile_cont(amount_usd, 0.25), 6), round(quantile_cont(amount_usd, 0.50), 6),
      round(quantile_cont(amount_usd, 0.75), 6), round(quantile_cont(amount_usd, 0.90), 6), NULL, 'base_1' FROM txn_scored_v
    UNION ALL SELECT 'category', 'currency', NULL, NULL, NULL, NULL, count(*), NULL, NULL, NULL, NULL, NULL, currency, 'base_1'
      FROM (SELECT CASE WHEN amount_usd > 10000 THEN 'BIG' ELSE 'SMALL' END AS currency FROM txn_scored_v) GROUP BY currency""",
)
def score_baseline(t: Tables) -> DataFrame:
    rows = t.txn_scored_v.select(
        "risk_score", "amount_usd", F.when(F.col("amount_usd") > 10000, "BIG").otherwise("SMALL").alias("currency")
    )
    return rounded(profile.drift_baseline(rows, "base_1", score="risk_score"), "mean", "std", "p10", "p25", "p50", "p75", "p90")


@query(
    "missing_rates", "transactions_v",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END), 6) AS missing_rate, count(*) AS n_rows FROM transactions_v"
        for c in ("transaction_id", "user_id", "amount", "payment_method", "currency")
    ),
)
def missing_rates(t: Tables) -> DataFrame:
    names = ["transaction_id", "user_id", "amount", "payment_method", "currency"]
    return rounded(profile.missing_rates(t.transactions_v, names), "missing_rate")


@query(
    "value_shares", "transactions_v",
    "SELECT currency, count(*) AS n, round(count(*) * 1e0 / (SELECT count(*) FROM transactions_v), 6) AS share FROM transactions_v GROUP BY 1",
)
def currency_shares(t: Tables) -> DataFrame:
    return rounded(value_shares(t.transactions_v, "currency"), "share")


@query(
    "contract_check", "transactions_v",
    """SELECT transaction_id, list_filter([CASE WHEN event_time > TIMESTAMP '2024-01-25 00:00:00' THEN 'event_time_in_future' END,
      CASE WHEN amount - 1 < 0 THEN 'negative_amount' END, CASE WHEN payment_method IS NULL OR length(trim(payment_method)) = 0 THEN 'blank_id' END], lambda x: x IS NOT NULL) AS violations
      FROM transactions_v""",
)
def contract_check(t: Tables) -> DataFrame:
    rows = t.transactions_v.withColumn("amount", F.col("amount") - 1)
    rules = ql.transaction_contract("2024-01-25 00:00:00", "payment_method")
    return ql.check_contract(rows, rules).select("transaction_id", "violations")


# Allowed payment methods and currencies.
_DOMAINS = {"payment_method": ["credit_card", "debit_card", "bank_transfer", "digital_wallet", "crypto", "other"], "currency": ["USD", "EUR", "GBP", "CNY", "JPY", "OTHER"]}
_METHODS, _CURRENCIES = (", ".join(f"'{v}'" for v in _DOMAINS[c]) for c in ("payment_method", "currency"))


@query(
    "domain_check", "transactions_v",
    f"""SELECT 'payment_method' AS "column", count(*) AS violations, list_slice(list_sort(list(DISTINCT payment_method)), 1, 10) AS bad_values FROM transactions_v
        WHERE payment_method NOT IN ({_METHODS})
      UNION ALL SELECT 'currency', count(*), list_slice(list_sort(list(DISTINCT currency)), 1, 10) FROM transactions_v WHERE currency NOT IN ({_CURRENCIES})""",
)
def domain_check(t: Tables) -> DataFrame:
    return ql.domain_check(t.transactions_v, _DOMAINS)


@query(
    "feature_values_valid", "transactions_v",
    """SELECT valid, count(*) AS n FROM (SELECT coalesce(payment_method IN ('credit_card', 'debit_card', 'crypto'), FALSE) AND coalesce(currency IN ('USD', 'EUR'), FALSE) AS valid FROM transactions_v) GROUP BY 1""",
)
def feature_values_valid(t: Tables) -> DataFrame:
    spec = {
        "features": [{"name": "payment_method", "categories": ["credit_card", "debit_card", "crypto"]}, {"name": "currency"}, {"name": "amount"}],
        "domain_sets": {"currency": ["USD", "EUR"]},
    }
    rows = t.transactions_v.select("payment_method", "currency", "amount")
    return rows.groupBy(ql.valid_feature_values(rows, spec).alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "schema_check", "transactions_v",
    """SELECT 'payment_method' AS "column", 'null' AS problem, count(*) AS n FROM transactions_v WHERE payment_method IS NULL
      UNION ALL SELECT 'amount', 'type', 1 UNION ALL SELECT 'merchant_category', 'missing', 1""",
)
def schema_check(t: Tables) -> DataFrame:
    expected = {
        "payment_method": {"type": "categorical"}, "amount": {"type": "categorical", "nullable": True},
        "amount_usd": {"type": "numeric"}, "merchant_category": {"type": "categorical"},
    }
    return ql.schema_check(t.transactions_v, expected)


@query(
    "expectations", "transactions_v",
    """SELECT 'row_count' AS expectation, '' AS "column", count(*) * 1e0 AS observed, count(*) >= 1 AS passed FROM transactions_v
      UNION ALL SELECT 'column_order', '', 1e0, TRUE
      UNION ALL SELECT 'not_null', 'payment_method', round(avg(CASE WHEN payment_method IS NULL THEN 0e0 ELSE 1e0 END), 6), avg(CASE WHEN payment_method IS NULL THEN 0e0 ELSE 1e0 END) >= 0.95 FROM transactions_v
      UNION ALL SELECT 'not_null', 'amount', round(avg(CASE WHEN amount IS NULL THEN 0e0 ELSE 1e0 END), 6), avg(CASE WHEN amount IS NULL THEN 0e0 ELSE 1e0 END) >= 0.95 FROM transactions_v""",
)
def expectations(t: Tables) -> DataFrame:
    return rounded(ql.expectation_report(t.transactions_v.select("payment_method", "amount")), "observed")


@query(
    "quality_gate", "transactions_v",
    f"""WITH m AS (SELECT max(r) AS max_missing_rate FROM (SELECT avg(CASE WHEN payment_method IS NULL THEN 1e0 ELSE 0e0 END) AS r FROM transactions_v UNION ALL
        SELECT avg(CASE WHEN amount IS NULL THEN 1e0 ELSE 0e0 END) FROM transactions_v)),
      v AS (SELECT count(*) FILTER (payment_method NOT IN ({_METHODS}))
        + count(*) FILTER (currency NOT IN ({_CURRENCIES})) AS violations FROM transactions_v)
      SELECT round(max_missing_rate, 6) AS max_missing_rate, CAST(1 AS BIGINT) AS schema_drift, violations,
        ['missing_rate_exceeded', 'schema_drift', 'domain_set_violations'] AS failure_reasons, FALSE AS passed, 'block' AS action FROM m, v""",
)
def quality_gate(t: Tables) -> DataFrame:
    report = ql.quality_report(t.transactions_v.select("payment_method", "currency", "amount"), _DOMAINS)
    return rounded(ql.quality_gate(report), "max_missing_rate")


@query(
    "quality_report", "transactions_v",
    f"""WITH r AS (SELECT 'payment_method' AS "column", avg(CASE WHEN payment_method IS NULL THEN 1e0 ELSE 0e0 END) AS missing_rate,
        count(*) FILTER (payment_method NOT IN ({_METHODS})) AS violations, 1 AS drift, list_slice(list_sort(list(DISTINCT payment_method) FILTER (payment_method NOT IN ({_METHODS}))), 1, 10) AS bad FROM transactions_v
      UNION ALL SELECT 'currency', avg(CASE WHEN currency IS NULL THEN 1e0 ELSE 0e0 END), count(*) FILTER (currency NOT IN ({_CURRENCIES})), 0,
        list_slice(list_sort(list(DISTINCT currency) FILTER (currency NOT IN ({_CURRENCIES}))), 1, 10) FROM transactions_v
      UNION ALL SELECT 'amount', avg(CASE WHEN amount IS NULL THEN 1e0 ELSE 0e0 END), 0, 1, NULL FROM transactions_v)
      SELECT "column", round(missing_rate, 6) AS missing_rate, CAST(drift AS BIGINT) AS schema_drift, violations,
        list_sort(list_filter([CASE WHEN "column" = 'payment_method' THEN 'expectation failed: not_null' WHEN "column" = 'amount' THEN 'schema: type' END,
          CASE WHEN violations > 0 THEN 'outside its domain: ' || array_to_string(bad, ', ') END], lambda e: e IS NOT NULL)) AS errors FROM r""",
)
def quality_report(t: Tables) -> DataFrame:
    """The merged report with its error texts."""
    rows = t.transactions_v.select("payment_method", "currency", "amount")
    return rounded(ql.quality_report(rows, _DOMAINS, {"amount": {"type": "categorical", "nullable": True}}), "missing_rate")


@query(
    "amount_chain", "transactions_v",
    """SELECT transaction_id, coalesce(CASE WHEN transaction_id % 3 = 0 THEN amount_usd END, CASE WHEN transaction_id % 2 = 0 THEN amount END, 0) AS value FROM transactions_v""",
)
def amount_chain(t: Tables) -> DataFrame:
    """The first amount that is there, else zero."""
    key = F.col("transaction_id")
    rows = t.transactions_v.select(key, F.when(key % 3 == 0, F.col("amount_usd")).alias("amount_usd"), F.when(key % 2 == 0, F.col("amount")).alias("amount"))
    return rows.select("transaction_id", prep.amount_or_zero(rows).alias("value"))


@query(
    "prepare_wide", "subscriptions_v",
    """WITH c AS (SELECT subscription_id, start_date, coalesce(mrr_amount, -999) AS mrr_amount, coalesce(arr_amount, -999) AS arr_amount,
        coalesce(dense_rank() OVER (ORDER BY plan_tier NULLS LAST) - 1, 0) AS pt, plan_tier, dense_rank() OVER (ORDER BY billing_frequency NULLS LAST) - 1 AS bf, billing_frequency FROM subscriptions_v)
      SELECT subscription_id, start_date, mrr_amount, arr_amount, CASE WHEN plan_tier IS NULL THEN -1 ELSE pt END AS plan_tier,
        CASE WHEN billing_frequency IS NULL THEN -1 ELSE bf END AS billing_frequency FROM c""",
)
def prepare_wide(t: Tables) -> DataFrame:
    rows = t.subscriptions_v.select("subscription_id", "start_date", "plan_tier", "mrr_amount", "arr_amount", "billing_frequency")
    rows = rows.withColumns({"empty": F.lit(None).cast("double"), "constant": F.lit(7)})
    return prep.prepare_wide(rows, ("subscription_id", "start_date"))


@query(
    "align_columns", "transactions_v",
    "SELECT transaction_id, -999e0 AS dist1, coalesce(amount, -999) AS amount, coalesce(amount_usd, -999) AS amount_usd, -999e0 AS score FROM transactions_v",
)
def align_columns(t: Tables) -> DataFrame:
    return prep.align_columns(t.transactions_v, ["dist1", "amount", "amount_usd", "score"], ("transaction_id",))


_CUT = "TIMESTAMP '1999-01-01 00:00:00'"
_DRIFT_NUM = ["l_quantity", "l_extendedprice"]


def _psi_sql(feature: str) -> str:
    q = ", ".join(f"quantile_cont({feature}, {i / 10}) AS q{i}" for i in range(1, 10))
    b = " + ".join(f"CASE WHEN {feature} >= q{i} THEN 1 ELSE 0 END" for i in range(1, 10))
    return f"""SELECT '{feature}' AS feature, round(sum((pa - pe) * ln(pa / pe)), 6) AS psi FROM (
      SELECT i, count(*) FILTER (side = 0 AND bin = i) / (max(ne) + 1e-6) + 1e-6 AS pe, count(*) FILTER (side = 1 AND bin = i) / (max(na) + 1e-6) + 1e-6 AS pa
      FROM (SELECT side, {b} AS bin, count(*) FILTER (side = 0) OVER () AS ne, count(*) FILTER (side = 1) OVER () AS na
        FROM (SELECT {feature}, CASE WHEN l_shipdate < {_CUT} THEN 0 ELSE 1 END AS side FROM lineitem),
             (SELECT {q} FROM lineitem WHERE l_shipdate < {_CUT})), range(10) g(i) GROUP BY i)"""


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    cut = moment("1999-01-01 00:00:00")
    return t.lineitem.filter(F.col("l_shipdate") < cut), t.lineitem.filter(F.col("l_shipdate") >= cut)


@query("psi_numeric", "lineitem", " UNION ALL ".join(_psi_sql(f) for f in _DRIFT_NUM))
def psi_numeric(t: Tables) -> DataFrame:
    base, current = _sides(t)
    return rounded(drift.psi_numeric(base, current, drift.baseline_edges(base, _DRIFT_NUM)), "psi")


@query(
    "psi_categorical", "lineitem part",
    f"""WITH x AS (SELECT p_brand AS v, CASE WHEN l_shipdate < {_CUT} THEN 0 ELSE 1 END AS side FROM lineitem JOIN part ON l_partkey = p_partkey),
      top AS (SELECT v FROM x WHERE side = 0 GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 10),
      b AS (SELECT side, CASE WHEN v IN (SELECT v FROM top) THEN v ELSE 'OTHER' END AS bin FROM x),
      c AS (SELECT g.v AS bin, (SELECT count(*) FROM b WHERE side = 0 AND bin = g.v) AS e, (SELECT count(*) FROM b WHERE side = 1 AND bin = g.v) AS a FROM (SELECT v FROM top UNION ALL SELECT 'OTHER') g),
      s AS (SELECT e / ((SELECT count(*) FROM b WHERE side = 0) + 1e-6) + 1e-6 AS pe, a / ((SELECT count(*) FROM b WHERE side = 1) + 1e-6) + 1e-6 AS pa FROM c)
      SELECT 'p_brand' AS feature, round(sum((pa - pe) * ln(pa / pe)), 6) AS psi FROM s""",
)
def psi_categorical(t: Tables) -> DataFrame:
    base, current = _sides(t)
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return rounded(drift.psi_categorical(base.join(brands, "l_partkey"), current.join(brands, "l_partkey"), ["p_brand"]), "psi")


def _ks_sql(feature: str) -> str:
    return f"""SELECT '{feature}' AS feature, round(max(abs(cb * 1e0 / nb - cc * 1e0 / nc)), 6) AS ks FROM (
      SELECT sum(b) OVER (ORDER BY v) AS cb, sum(c) OVER (ORDER BY v) AS cc, sum(b) OVER () AS nb, sum(c) OVER () AS nc
      FROM (SELECT {feature} AS v, count(*) FILTER (l_shipdate < {_CUT}) AS b, count(*) FILTER (l_shipdate >= {_CUT}) AS c FROM lineitem GROUP BY 1))"""


@query("ks", "lineitem", " UNION ALL ".join(_ks_sql(f) for f in _DRIFT_NUM))
def ks(t: Tables) -> DataFrame:
    base, current = _sides(t)
    return rounded(drift.ks_statistic(base, current, _DRIFT_NUM), "ks")


@query(
    "drift_report", "lineitem",
    "SELECT feature, psi, ks FROM (" + " UNION ALL ".join(_psi_sql(f) for f in _DRIFT_NUM) + ") JOIN (" + " UNION ALL ".join(_ks_sql(f) for f in _DRIFT_NUM) + ") USING (feature)",
)
def drift_report(t: Tables) -> DataFrame:
    base, current = _sides(t)
    return rounded(drift.drift_report(base, current, _DRIFT_NUM), "psi", "ks")


_WEEKS = """SELECT date_trunc('week', ts) AS wk, CASE WHEN event_type = 'purchase' THEN 'amount' WHEN event_type = 'error' THEN 'velocity_risk_score' ELSE 'score' END AS feature, avg(value) / 200 AS psi FROM events GROUP BY ALL"""


@query(
    "drift_triggers", "events",
    f"""WITH s AS ({_WEEKS}), h AS (SELECT *, coalesce(psi >= CASE WHEN feature = 'score' THEN 0.25 ELSE 0.30 END, FALSE) AS alert FROM s),
      b AS (SELECT *, sum(CASE WHEN alert THEN 0 ELSE 1 END) OVER (PARTITION BY feature ORDER BY wk) AS island FROM h),
      r AS (SELECT *, CASE WHEN alert THEN count(*) FILTER (alert) OVER (PARTITION BY feature, island ORDER BY wk) ELSE 0 END AS streak FROM b)
      SELECT feature, wk, round(psi, 6) AS psi, alert, streak, streak >= 2 AS retrain FROM r""",
)
def drift_triggers(t: Tables) -> DataFrame:
    week = F.date_trunc("week", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    kind = F.when(F.col("event_type") == "purchase", "amount").when(F.col("event_type") == "error", "velocity_risk_score").otherwise("score")
    series = t.events.groupBy(week.alias("wk"), kind.alias("feature")).agg((F.avg("value") / 200).alias("psi"))
    out = drift.drift_triggers(series, (), "wk", critical=drift.CRITICAL_FEATURES)
    return rounded(out, "psi")


_WEEK_EDGES = ", ".join(f"quantile_cont(value, {i / 10}) AS q{i}" for i in range(1, 10))
_WEEK_BIN = " + ".join(f"CASE WHEN value >= q{i} THEN 1 ELSE 0 END" for i in range(1, 10))


@query(
    "weekly_psi", "events",
    f"""WITH q AS (SELECT {_WEEK_EDGES} FROM events WHERE ts < TIMESTAMP '2024-01-08 00:00:00'),
      x AS (SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS wk, {_WEEK_BIN} AS bin FROM events, q),
      base AS (SELECT bin, count(*) AS e FROM x WHERE wk < TIMESTAMP '2024-01-08 00:00:00' GROUP BY 1),
      cur AS (SELECT wk, bin, count(*) AS a FROM x WHERE wk >= TIMESTAMP '2024-01-08 00:00:00' GROUP BY ALL),
      grid AS (SELECT wk, CAST(i AS INTEGER) AS bin, sum(a) AS na FROM cur, range(10) g(i) GROUP BY ALL),
      cells AS (SELECT wk, coalesce(e, 0) / ((SELECT sum(e) FROM base) + 1e-6) + 1e-6 AS pe, coalesce(a, 0) / (na + 1e-6) + 1e-6 AS pa
        FROM grid LEFT JOIN base USING (bin) LEFT JOIN cur USING (wk, bin))
      SELECT wk, 'value' AS feature, round(sum((pa - pe) * ln(pa / pe)), 6) AS psi, sum((pa - pe) * ln(pa / pe)) >= 0.3 AS alert, CAST(0 AS BIGINT) AS streak, FALSE AS retrain FROM cells GROUP BY 1""",
)
def weekly_psi(t: Tables) -> DataFrame:
    """PSI of each week against the first one and its triggers: the drift job as one plan."""
    first = moment("2024-01-08 00:00:00")
    rows = t.events.withColumn("wk", F.window(F.col("ts"), "7 days", startTime="4 days").start)
    base = rows.filter(F.col("ts") < first)
    edges = drift.baseline_edges(base, ["value"])
    series = drift.psi_numeric(base, rows.filter(F.col("ts") >= first), edges, ("wk",))
    return rounded(drift.drift_triggers(series, (), "wk", step=F.expr("INTERVAL 7 DAY")), "psi")


@query(
    "drift_alerts", "events",
    f"""SELECT feature, wk, round(psi, 6) AS psi, CASE feature WHEN 'score' THEN 'score_drift' ELSE 'feature_drift' END AS type, 'high' AS severity
      FROM ({_WEEKS}) WHERE psi >= CASE WHEN feature = 'score' THEN 0.25 ELSE 0.30 END""",
)
def drift_alerts(t: Tables) -> DataFrame:
    week = F.date_trunc("week", F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    kind = F.when(F.col("event_type") == "purchase", "amount").when(F.col("event_type") == "error", "velocity_risk_score").otherwise("score")
    series = t.events.groupBy(week.alias("wk"), kind.alias("feature")).agg((F.avg("value") / 200).alias("psi"))
    return rounded(drift.alerts(series), "psi")
