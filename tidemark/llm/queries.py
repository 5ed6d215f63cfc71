"""The registered queries of the training-data operators; comparison SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import collisions, extract, merkle, mixing, packing, pfor, quality, sharding, simhash, sketch, suffix, warc, whitening
from .common import TOKENIZER, table
from .tokens import vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "passes")


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_length")


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(table(spark, sf_dir, "documents"))


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query("op5_main_text")
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


@query("op6_suffix_arrays")
def op6_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix.deduplicated(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op7_quality", quality.ORACLE_SQL)
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.measure(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_warc", warc.ORACLE_SQL)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_token_ids")
def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor.digest(table(spark, sf_dir, "documents"), vocabulary(TOKENIZER))


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


@query("op11_collisions", collisions.ORACLE_SQL)
def op11_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op13_merkle", merkle.ORACLE_SQL)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))
