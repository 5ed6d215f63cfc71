"""HTML blocks and overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import strip_space

# Elements whose content is dropped, and tags that end a block of text.
_DROPPED = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>"
_BREAKS = (
    r"(?i)</?(?:html|body|p|div|ul|ol|li|h[1-6]|table|thead|tbody|tr|td|th|br|hr|nav|article|section|header|footer|main|aside|"
    r"blockquote|pre|form|dl|dt|dd|figure|figcaption)\b[^>]*>|<!doctype[^>]*>"
)
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
_MARK = "\u0001"


def html_blocks(df: DataFrame, source_id: str, html: str) -> DataFrame:
    """(source_id, block, content): one stripped row per non-empty text element, in order."""
    text = F.regexp_replace(F.col(html), _DROPPED, "")
    text = F.regexp_replace(text, _BREAKS, _MARK)
    text = F.regexp_replace(text, r"<[^>]*>", "")
    for entity, plain in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    parts = F.transform(F.split(text, _MARK), strip_space)
    blocks = F.filter(parts, lambda b: b != "")
    return df.select(F.col(source_id).alias("source_id"), F.posexplode(blocks).alias("block", "content"))


def document_pages(files: DataFrame, parse, schema: str = "source_id string, page int, section string, content string") -> DataFrame:
    """Binary files -> text blocks through a pluggable parser.

    ``files`` is a ``binaryFile`` table; ``parse(path, bytes)`` yields
    (page, section, text).  Files are read and parsed inside the tasks, one at
    a time; blank blocks are dropped.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                for page, section, text in parse(path, bytes(content)):
                    stripped = (text or "").strip()
                    if stripped:
                        rows.append((path, page, section, stripped))
            yield pd.DataFrame(rows, columns=["source_id", "page", "section", "content"])

    return files.select("path", "content").mapInPandas(run, schema)


def chunk_hash(source_id: Column, page: Column, content: Column) -> Column:
    """First 16 hex digits of sha256 over source, page (blank when 0 or missing) and content."""
    shown = F.when(page.isNotNull() & (page != 0), page.cast("string")).otherwise(F.lit(""))
    return F.substring(F.sha2(F.concat(source_id, shown, content), 256), 1, 16)


def chunk(
    blocks: DataFrame,
    source_id: str,
    text: str,
    page: str | None = None,
    section: str | None = None,
    size: int = 512,
    overlap: int = 64,
    created_at: Column | None = None,
) -> DataFrame:
    """Overlapping character chunks.

    The text is cut once into pieces of ``size - overlap`` characters; a chunk
    is a few neighbouring pieces cut to ``size``.  Work is linear in the text,
    also for very long documents.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than the chunk size")
    stride = size - overlap
    reach = -(-size // stride)
    body = F.col(text)
    n = F.when(F.length(body) <= size, F.lit(1)).otherwise(F.ceil((F.length(body) - overlap) / F.lit(stride))).cast("int")
    pieces = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    parts = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.substring(F.array_join(F.slice(F.col("__pieces"), i + 1, F.lit(reach)), ""), 1, size),
    )
    p = F.col(page).cast("int") if page else F.lit(None).cast("int")
    rows = blocks.filter(F.length(body) > 0).select(
        F.col(source_id).cast("string").alias("source_id"),
        p.alias("page"),
        (F.col(section) if section else F.lit(None).cast("string")).alias("section"),
        (created_at if created_at is not None else F.lit(None).cast("string")).alias("created_at"),
        body,
        pieces.alias("__pieces"),
    )
    out = rows.select("source_id", "page", "section", "created_at", F.posexplode(parts).alias("idx", "content"))
    chunk_id = F.concat(F.col("source_id"), F.lit(":p"), F.coalesce("page", F.lit(0)).cast("string"), F.lit(":"), F.col("idx").cast("string"))
    return out.select(
        chunk_id.alias("chunk_id"), "content", "source_id", "page", "section", "created_at",
        chunk_hash(F.col("source_id"), F.col("page"), F.col("content")).alias("hash"),
    )


def distinct_chunks(chunks: DataFrame) -> DataFrame:
    """One chunk per hash, the smallest id; combines map-side."""
    rest = [c for c in chunks.columns if c not in ("hash", "chunk_id")]
    best = chunks.groupBy("hash").agg(F.min(F.struct("chunk_id", *rest)).alias("c"))
    return best.select("c.chunk_id", *[F.col(f"c.{c}").alias(c) for c in rest], "hash").select(*chunks.columns)
