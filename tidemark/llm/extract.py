"""Main text of HTML pages (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import Vectors, leaf_blocks
from .common import released, sliced, text_of
from .labeller import TRAINING_PAGES, Labeller, trained


def main_text(pages: list[str], model: Labeller, vectors: Vectors) -> list[str]:
    """The main text of each page: its main blocks in order, joined by one space."""
    blocks = [leaf_blocks(p) for p in pages]
    labels = model.label([vectors.of(b) for b in blocks])
    return [" ".join(text for (_, text, _), main in zip(b, found) if main) for b, found in zip(blocks, labels)]


def extract(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html).

    The labeller is fitted on the driver to ``training_pages`` made-up pages
    and sent to the tasks (about 0.2 MB).  Null html is empty; a page without
    main text has empty text; ids and urls pass through, also null or
    repeated; whole pages are read, of any length; no rows give no rows.
    Other columns are ignored.
    """
    model = trained(training_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        for part in sliced(batches, "html", 4 << 20):
            texts = main_text(part.column(2).to_pylist(), model, vectors)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
    return rows.mapInArrow(released(run), "page_id bigint, url string, text string").withColumn("n_chars", F.char_length("text").cast("bigint"))
