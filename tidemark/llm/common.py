"""What the training-data operators share: words, tables, ordered layouts, files that executors write."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.ordered import prefix_sum
from ..session import cut, scratch_path, shuffle_width

__all__ = [
    "SPACE", "WORD", "table", "text_of", "words_of", "word_count", "cut", "scratch_path", "shuffle_width", "prefix_sum", "ordered_layout",
    "open_fs", "fresh_name", "released", "sliced", "let", "TOKENIZER",
]

#: White space and words as every contract here defines them.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def words_of(text: Column) -> Column:
    """The words in order; an empty array where there are none."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` reads it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ordered_layout(df: DataFrame, *keys: Column, partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``keys``.

    A running row number ends the key, so that rows with equal keys can still
    be spread over partitions.
    """
    tie = "__row"
    numbered = df.withColumn(tie, F.monotonically_increasing_id())
    order = [*keys, F.col(tie).asc()]
    return numbered.repartitionByRange(partitions or shuffle_width(df.sparkSession), *order).sortWithinPartitions(*order).drop(tie)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for a folder that all executors share (file, hdfs, s3, gs, abfs URIs or a plain path)."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else ("file://" + uri.removeprefix("file:") if uri.startswith(("/", "file:/")) else uri))


def fresh_name(prefix: str, suffix: str) -> str:
    """A file name that no other task attempt uses: a retried task leaves an unlisted file, never a half-written listed one."""
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def release() -> None:
    """Hands freed memory back to the system."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(run):
    """``run`` for ``mapInArrow``, with its memory handed back at the end: workers outlive their tasks."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` holds about ``limit`` bytes; a longer single value is a run of its own."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
