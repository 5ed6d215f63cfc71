"""Online features, audit, feedback, versioned indexes and report sinks.

There is no table format here, so mutable tables are append-only logs plus a
read-time latest-per-key, compacted into a new folder from time to time.  A
path is never overwritten while it is read, and a batch writes its own folder,
so a retried batch replaces only itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.temporal import Moment, moment
from ..operators.ordered import latest_per_key, union_all
from ..operators.quality import between, quarantine
from . import schemas

KEY = ["domain", "entity_key", "feature_set_version"]


def to_online(
    df: DataFrame, domain: str, version: str, entity: str, now: Moment, ttl_seconds: int | None = None, event_time: str | None = "event_time"
) -> DataFrame:
    """Feature rows -> online rows: key ``entity:id``, all other columns as one JSON text."""
    features = [c for c in df.columns if c not in (entity, "event_time", "materialized_at")]
    at = F.col(event_time) if event_time and event_time in df.columns else moment(now)
    return df.select(
        F.lit(domain).alias("domain"),
        F.concat(F.lit(f"{entity}:"), F.col(entity).cast("string")).alias("entity_key"),
        F.lit(version).alias("feature_set_version"),
        F.to_json(F.struct(*features), {"ignoreNullFields": "false"}).alias("features"),
        at.alias("event_time"),
        moment(now).alias("materialized_at"),
        F.lit(ttl_seconds).cast("bigint").alias("ttl_seconds"),
    )


def merge_online(*generations: DataFrame) -> DataFrame:
    """Latest row per key over generations given oldest first; at equal times the later generation wins."""
    tagged = [g.withColumn("__gen", F.lit(i)) for i, g in enumerate(generations)]
    return latest_per_key(union_all(tagged), KEY, ["materialized_at", "__gen", "event_time", "features"]).drop("__gen")


def expired(now: Moment, ttl: Column | None = None) -> Column:
    """Age strictly over the TTL; rows without a TTL never expire."""
    used = F.col("ttl_seconds") if ttl is None else F.when(F.col("ttl_seconds").isNotNull(), ttl)
    until = F.col("materialized_at") + F.make_dt_interval(secs=used)
    return F.coalesce(until < moment(now), F.lit(False))


def expire(store: DataFrame, now: Moment, domain: str | None = None, version: str | None = None) -> DataFrame:
    """Rows that stay after the TTL cleanup."""
    gone = expired(now)
    if domain is not None:
        gone = gone & (F.col("domain") == domain)
    if version is not None:
        gone = gone & (F.col("feature_set_version") == version)
    return store.filter(~gone)


def lookup(requests: DataFrame, store: DataFrame, domain: str, version: str, now: Moment, ttl_hours: int | None = None, key: str = "entity_key") -> DataFrame:
    """Requests with their unexpired features; NULL features when absent or expired.

    An override of the TTL applies only to rows that have one.
    """
    override = None if ttl_hours is None else F.lit(ttl_hours * 3600)
    live = store.filter((F.col("domain") == domain) & (F.col("feature_set_version") == version) & ~expired(now, override))
    return requests.join(live.select(F.col("entity_key").alias(key), "features", "event_time"), key, "left")


class OnlineStore:
    """Online feature table below one folder: ``log/`` of batches and compacted ``base/`` generations."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def upsert(self, rows: DataFrame, batch: int | str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/log/batch={batch}")

    def _read(self, part: str, schema: str) -> DataFrame:
        # A missing folder is an empty table: the glob matches nothing on the first read.
        try:
            return self.spark.read.schema(schema).option("basePath", f"{self.path}/{part}").parquet(f"{self.path}/{part}/*")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def current(self) -> DataFrame:
        """Latest row per key over the newest base and the batches after it."""
        log = self._read("log", schemas.ONLINE + ", batch bigint")
        base = self._read("base", schemas.ONLINE + ", upto bigint")
        newest = base.agg(F.coalesce(F.max("upto"), F.lit(-1))).first()[0]
        old = base.filter(F.col("upto") == newest).select(*[c for c in base.columns if c != "upto"], F.lit(-1).cast("bigint").alias("batch"))
        return latest_per_key(old.unionByName(log.filter(F.col("batch") > newest)), KEY, ["materialized_at", "batch", "event_time", "features"]).drop("batch")

    def compact(self, now: Moment | None = None) -> None:
        """Write a new base generation, leaving out expired rows when ``now`` is given."""
        upto = self._read("log", schemas.ONLINE + ", batch bigint").agg(F.max("batch")).first()[0]
        if upto is None:
            return
        rows = self.current()
        (rows if now is None else expire(rows, now)).write.mode("overwrite").parquet(f"{self.path}/base/upto={upto}")


def audit_rows(df: DataFrame, now: Moment | None = None) -> DataFrame:
    """Audit schema with defaults: 'n/a' for absent text, ["(none)"] for absent warnings."""
    have = set(df.columns)

    def text(c: str) -> Column:
        # Version and entity keep an empty string out as well.
        return F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("n/a")) if c in have else F.lit("n/a")

    def plain(c: str, kind: str) -> Column:
        return F.col(c).cast(kind) if c in have else F.lit(None).cast(kind)

    none = F.array(F.lit("(none)"))
    warnings = F.coalesce(F.col("warnings"), none) if "warnings" in have else none
    created = F.col("created_at") if "created_at" in have else moment(now)
    return df.select(
        plain("request_id", "string").alias("request_id"), plain("domain", "string").alias("domain"), plain("model_name", "string").alias("model_name"),
        text("model_version").alias("model_version"), text("feature_set_version").alias("feature_set_version"),
        text("feature_snapshot_hash").alias("feature_snapshot_hash"), text("entity_key").alias("entity_key"),
        plain("latency_ms", "int").alias("latency_ms"), plain("predictions", "string").alias("predictions"), plain("decision", "string").alias("decision"),
        warnings.alias("warnings"), text("trace_id").alias("trace_id"), created.alias("created_at"),
    )


def append_audit(df: DataFrame, path: str, now: Moment | None = None, *, batch: str) -> None:
    """Append one batch below (domain, day) partitions, so audit questions prune to what they read.

    A batch owns its folder: a retried one replaces itself and duplicates nothing.
    """
    rows = audit_rows(df, now).withColumn("day", F.to_date("created_at"))
    rows.write.mode("overwrite").partitionBy("domain", "day").parquet(f"{path.rstrip('/')}/batch={batch}")


def append_feedback(df: DataFrame, path: str, *, batch: str) -> DataFrame:
    """Append a batch of ratings from 1 to 5, as ``append_audit`` does; returns the rejected rows with their violations."""
    good, bad = quarantine(df, {"rating_out_of_range": between("rating", 1, 5)})
    good.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")
    return bad


class IndexStore:
    """Versioned chunk/vector index: one folder per version, a manifest row per version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(
        self, version: str, chunks: DataFrame, created_at: Moment, vectors: DataFrame | None = None, model: str | None = None,
        dim: int | None = None, backend: str = "parquet", tables: dict[str, DataFrame | Callable[[dict[str, DataFrame]], DataFrame]] | None = None,
    ) -> None:
        """Data first, manifest row last: a version is visible only when complete.

        A table given as a function is made from the tables written before it, as they are stored.
        """
        target = f"{self.path}/versions/index_version={version}"
        parts = {"chunks": chunks, **({"vectors": vectors} if vectors is not None else {}), **(tables or {})}
        written: dict[str, DataFrame] = {}
        for name, part in parts.items():
            df = part(written) if callable(part) else part
            df.write.mode("overwrite").parquet(f"{target}/{name}")
            written[name] = self.spark.read.schema(df.schema).parquet(f"{target}/{name}")
        count = self.spark.read.parquet(f"{target}/chunks").agg(F.count(F.lit(1)).alias("chunk_count"))
        manifest = count.select(
            F.lit(version).alias("index_version"), "chunk_count", F.lit(model).cast("string").alias("embedding_model"),
            F.lit(dim).cast("int").alias("embedding_dim"), F.lit(backend).alias("vector_backend"), moment(created_at).alias("created_at"),
        )
        manifest.write.mode("append").parquet(f"{self.path}/manifest")

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/manifest")

    def latest(self) -> str:
        try:
            row = self.manifest().agg(F.max_by("index_version", F.struct("created_at", "index_version"))).first()
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            raise FileNotFoundError(f"no index below {self.path}") from None
        return row[0]

    def load(self, table: str = "chunks", version: str | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/versions/index_version={version or self.latest()}/{table}")


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines: chunks, hard sets, baselines, quality reports."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header: stability and ablation tables."""
    df.write.mode("overwrite").option("header", True).csv(path)
