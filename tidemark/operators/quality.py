"""Contracts, domain sets, schema checks and the quality gate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import flagged
from ..functions.temporal import Moment, moment
from .profile import missing_rates


def not_future(c: str, now: Moment) -> Column:
    return F.col(c).isNull() | (F.col(c) <= moment(now))


def not_negative(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) >= 0)


def not_blank(c: str) -> Column:
    return F.length(F.trim(F.col(c).cast("string"))) > 0


def one_of(c: str, allowed: list) -> Column:
    return F.col(c).isin(allowed)


def between(c: str, lo: float, hi: float) -> Column:
    return F.col(c).between(lo, hi)


def check_contract(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``violations``: names of the broken rules. A NULL outcome breaks the rule."""
    broken = [(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]
    return df.withColumn("violations", flagged(broken))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with their violations) instead of a failing job."""
    checked = check_contract(df, rules)
    return checked.filter(F.size("violations") == 0).drop("violations"), checked.filter(F.size("violations") > 0)


def domain_check(df: DataFrame, domains: dict[str, list], shown: int = 10) -> DataFrame:
    """(column, violations, bad_values): NULL is allowed; bad values are listed from the distinct ones.

    Bad values are counted per distinct value first; only the ``shown``
    smallest reach the list, chosen with a bounded top-k.
    """
    names = [c for c in domains if c in df.columns]
    allowed = F.create_map(*[x for c in names for x in (F.lit(c), F.array(*[F.lit(str(v)) for v in domains[c]]))])
    long = df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "column", "value")
    bad = long.filter(F.col("value").isNotNull() & ~F.array_contains(F.try_element_at(allowed, F.col("column")), F.col("value")))
    counted = bad.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    from .ordered import top_k

    first = top_k(counted, ["column"], [("value", "asc")], shown).groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("bad_values"))
    totals = counted.groupBy("column").agg(F.sum("n").alias("violations"))
    every = df.sparkSession.createDataFrame([(c,) for c in names], "column string")
    out = every.join(totals, "column", "left").join(first, "column", "left")
    empty = F.array().cast("array<string>")
    return out.select("column", F.coalesce("violations", F.lit(0)).alias("violations"), F.coalesce("bad_values", empty).alias("bad_values"))


def valid_feature_values(df: DataFrame, spec: dict) -> Column:
    """TRUE when every feature value obeys its categories, else its domain set; unknown columns make it FALSE."""
    known = {f["name"]: f for f in spec["features"]}
    ok = F.lit(True)
    for name in df.columns:
        if name not in known:
            return F.lit(False)
        allowed = known[name].get("categories") or spec.get("domain_sets", {}).get(name)
        if allowed:
            ok = ok & F.coalesce(F.col(name).isin(allowed), F.lit(False))
    return ok


_FAMILY = {"numeric": T.NumericType, "boolean": T.BooleanType, "categorical": T.StringType, "string": T.StringType}


def schema_check(df: DataFrame, expected: dict[str, dict]) -> DataFrame:
    """(column, problem, n) for missing columns, wrong type family and NULLs in required columns."""
    types = {f.name: f.dataType for f in df.schema}
    static, required = [], []
    for name, spec in expected.items():
        if name not in types:
            static.append((name, "missing", 1))
            continue
        family = _FAMILY.get(spec.get("type", ""), T.DataType)
        if not isinstance(types[name], family):
            static.append((name, "type", 1))
        if not spec.get("nullable", False):
            required.append(name)
    out = df.sparkSession.createDataFrame(static, "column string, problem string, n bigint")
    if required:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).unpivot([], required, "column", "n")
        out = out.unionByName(nulls.filter("n > 0").select("column", F.lit("null").alias("problem"), "n"))
    return out


def expectation_report(df: DataFrame, columns: list[str] | None = None, mostly: float = 0.95) -> DataFrame:
    """Default suite: at least one row, columns in order, each column mostly non-null. One pass."""
    names = columns or df.columns
    in_order = list(names) == df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in df.columns])
    entry = F.struct
    rows = [
        entry(F.lit("row_count").alias("expectation"), F.lit("").alias("column"), F.col("__n").cast("double").alias("observed"), (F.col("__n") >= 1).alias("passed")),
        entry(F.lit("column_order").alias("expectation"), F.lit("").alias("column"), F.lit(float(in_order)).alias("observed"), F.lit(in_order).alias("passed")),
    ]
    for c in df.columns:
        rows.append(
            entry(F.lit("not_null").alias("expectation"), F.lit(c).alias("column"), F.col(c).alias("observed"), F.coalesce(F.col(c) >= mostly, F.lit(True)).alias("passed"))
        )
    return wide.select(F.inline(F.array(*rows)))


def merge_reports(reports: list[DataFrame]) -> DataFrame:
    """Reports are (column, missing_rate, schema_drift, violations, errors): missing takes the maximum, counts add up, error texts are gathered once each.

    A column has one text per failed check, so the gathered lists are short.
    """
    from .ordered import union_all

    return union_all(reports).groupBy("column").agg(
        F.max("missing_rate").alias("missing_rate"),
        F.sum("schema_drift").alias("schema_drift"),
        F.sum("violations").alias("violations"),
        F.sort_array(F.collect_set("errors")).alias("errors"),
    )


def quality_report(df: DataFrame, domains: dict[str, list] | None = None, expected: dict[str, dict] | None = None) -> DataFrame:
    """One row per column with its missing rate, drift and violation counts."""
    zero, one, none = F.lit(0).cast("bigint"), F.lit(1).cast("bigint"), F.lit(None).cast("string")

    def entry(rows: DataFrame, missing: Column, drift: Column, violations: Column, errors: Column) -> DataFrame:
        return rows.select("column", missing.alias("missing_rate"), drift.alias("schema_drift"), violations.alias("violations"), errors.alias("errors"))

    failed = expectation_report(df).filter(~F.col("passed"))
    parts = [
        entry(missing_rates(df), F.col("missing_rate"), zero, zero, none),
        entry(failed, F.lit(0.0), one, zero, F.concat(F.lit("expectation failed: "), F.col("expectation"))),
    ]
    if expected:
        parts.append(entry(schema_check(df, expected), F.lit(0.0), one, zero, F.concat(F.lit("schema: "), F.col("problem"))))
    if domains:
        seen = F.when(F.col("violations") > 0, F.concat(F.lit("outside its domain: "), F.array_join("bad_values", ", ")))
        parts.append(entry(domain_check(df, domains), F.lit(0.0), zero, F.col("violations"), seen))
    return merge_reports(parts)


def quality_gate(
    report: DataFrame, missing_rate_max: float = 0.02, schema_drift_max: int = 0, violations_max: int = 0
) -> DataFrame:
    """Verdict row: passed, action continue/block, reasons built from the configured limits."""
    total = report.agg(
        F.coalesce(F.max("missing_rate"), F.lit(0.0)).alias("max_missing_rate"),
        F.coalesce(F.sum("schema_drift"), F.lit(0)).alias("schema_drift"),
        F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"),
    )
    reasons = flagged(
        [
            (F.col("max_missing_rate") > missing_rate_max, "missing_rate_exceeded"),
            (F.col("schema_drift") > schema_drift_max, "schema_drift"),
            (F.col("violations") > violations_max, "domain_set_violations"),
        ]
    )
    out = total.withColumn("failure_reasons", reasons)
    passed = F.size("failure_reasons") == 0
    return out.withColumns({"passed": passed, "action": F.when(passed, "continue").otherwise("block")})


def transaction_contract(now: datetime | str, id_col: str = "transaction_id") -> dict[str, Column]:
    return {
        "event_time_in_future": not_future("event_time", now),
        "negative_amount": not_negative("amount"),
        "blank_id": not_blank(id_col),
    }
