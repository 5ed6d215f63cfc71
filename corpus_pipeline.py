"""From raw documents to packed sequences: quality rules, near-duplicates, repeated passages, mixing, packing.

Each stage works on all rows of the stage before, which were written as
Parquet.  Rejected documents, copies and repeated bytes are gone from then on;
mixing decides how often a document occurs; packing gives the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import copies, mixing, packing, quality, suffix
from tidemark.llm.common import TOKENIZER, scratch_path, table, text_of
from tidemark.llm.tokens import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints (three bits) or five-word similarity (0.8 or more) connect."""
    return copies.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages that occur earlier; what is left without a word goes.  ``n_chars`` follows the text."""
    rest = suffix.cleaned(docs).filter(F.btrim(text_of(), F.lit(" \t\n\x0b\f\r")) != "")
    return rest.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rest


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, one row for each time it takes them.

    Rows that agree in id and text share their number of passes.
    """
    taken = mixing.mix(docs).filter("passes > 0").groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    taken = taken.agg(F.max("passes").alias("__passes"))
    own = docs.withColumn("__own", F.xxhash64(text_of()))
    rows = own.join(taken, own["doc_id"].eqNullSafe(taken["__id"]) & (own["__own"] == taken["__hash"]))
    return rows.withColumn("__pass", F.explode(F.sequence(F.lit(1), F.col("__passes").cast("int")))).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4,096 ids."""
    pieces = packing.pack(docs, vocabulary(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_length")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

#: SQL expresses neither the fingerprints, the passages nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written to the shared folder and read by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
