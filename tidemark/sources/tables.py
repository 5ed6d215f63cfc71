"""Readers. Filters and projections stay lazy so they reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import finite
from ..functions.temporal import Moment, lenient_time, moment
from ..operators.ordered import latest_per_key
from ..operators.prep import keep_ids
from . import schemas


def read_saas_tables(spark: SparkSession, folder: str, pattern: str = "{name}.csv") -> dict[str, DataFrame]:
    """The five subscription-business CSV tables; unparsable dates become NULL."""
    out = {}
    for name, schema in schemas.SAAS.items():
        df = spark.read.schema(schema).option("header", True).csv(f"{folder}/{pattern.format(name=name)}")
        out[name] = df.withColumns({c: lenient_time(c) for c in schemas.SAAS_TIMES[name]})
    return out


def read_window(
    spark: SparkSession, path: str, start: Moment, end: Moment, ts: str = "event_time", ids: list | DataFrame | None = None,
    id_col: str = "transaction_id", schema: str | None = None,
) -> DataFrame:
    """Parquet rows of ``[start, end)``, optionally only some ids; both filters are pushed to the scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path).filter((F.col(ts) >= moment(start)) & (F.col(ts) < moment(end)))
    return keep_ids(df, id_col, ids)


def read_snapshot(
    spark: SparkSession, path: str, as_of: Moment, key: str = "user_id", ts: str = "snapshot_time", tie: str | None = None, ids: list | DataFrame | None = None
) -> DataFrame:
    """Latest row per key with snapshot time up to and including ``as_of``."""
    seen = keep_ids(spark.read.parquet(path).filter(F.col(ts) <= moment(as_of)), key, ids)
    return latest_per_key(seen, [key], [ts] + ([tie] if tie else []))


def read_labels(spark: SparkSession, path: str, as_of: Moment, as_of_col: str = "as_of_time") -> DataFrame:
    return spark.read.parquet(path).filter(F.col(as_of_col) == moment(as_of))


def read_wide_pair(
    spark: SparkSession, transactions: str, identity: str | None, key: str, label: str, schemas_of: tuple[str | None, str | None] = (None, None)
) -> DataFrame:
    """Wide CSV pair: transactions left-joined with an optional identity file; clashing names get ``_id``."""

    def read(path: str, schema: str | None) -> DataFrame:
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)

    left = read(transactions, schemas_of[0])
    if label not in left.columns:
        raise ValueError(f"{transactions} has no column {label}")
    if identity is None:
        return left
    return join_suffixed(left, read(identity, schemas_of[1]), key)


def join_suffixed(left: DataFrame, right: DataFrame, key: str, suffix: str = "_id") -> DataFrame:
    """Left join on one key; right columns that clash get a suffix."""
    renamed = right.select(key, *[F.col(c).alias(c + suffix if c in left.columns else c) for c in right.columns if c != key])
    return left.join(renamed, key, "left")


def read_eval_set(spark: SparkSession, path: str) -> DataFrame:
    """JSONL evaluation set; missing evidence is an empty list, blank lines are skipped."""
    df = spark.read.schema(schemas.EVAL_SET).json(path).filter(F.col("query").isNotNull())
    empty = F.array().cast("array<struct<chunk_id:string,page:string>>")
    return df.withColumns({"gold_answer": F.coalesce("gold_answer", F.lit("")), "gold_evidence": F.coalesce("gold_evidence", empty)})


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """JSONL chunks; blank lines are skipped."""
    return spark.read.schema(schemas.CHUNKS).json(path).filter(F.col("chunk_id").isNotNull())


def spread(df: DataFrame) -> DataFrame:
    """Rows of a few large input splits dealt out over all cores before CPU-heavy text work.

    A table that already has enough splits is left alone, so nothing is
    shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is missing: applied at ingest so that comparisons and aggregates skip it."""
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: finite(c) for c in floats})
