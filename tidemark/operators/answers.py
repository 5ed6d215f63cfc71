"""Query routing, extractive answers, citations and answer evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import strip_space
from ..session import cut
from .ordered import exact_quantiles
from .retrieval import within

# Answer without evidence, citation pattern, router prefixes, prompt text, separators.
IDK = "I don't know."
CITATION = r"(?U)\[[\w\-]+:p\d+\]"
FAQ_PREFIX = "^(what is|how to|how do|can i|where is|when does)"
LEAD = "Based on the retrieved context:\n\n"
BETWEEN = "\n\n---\n\n"
PROMPT_HEAD = (
    "Use the following context to answer the question. Cite each claim with [source_id:pPage]. "
    f"If the context does not contain relevant information, respond with exactly: {IDK}"
)


def route(query: str | Column, max_short: int = 50) -> Column:
    """'cheap' for short or FAQ-like questions, else 'full'."""
    q = strip_space(query)
    cheap = (F.length(q) <= max_short) | F.lower(q).rlike(FAQ_PREFIX)
    return F.when(cheap, "cheap").otherwise("full")


def plan_queries(queries: DataFrame, query: str = "query", top_k: int = 6, mode: str = "hybrid", max_short: int = 50) -> DataFrame:
    """Adds path, top_k and mode: the cheap path takes at most 3 chunks and turns hybrid into lexical."""
    path = route(query, max_short)
    cheap = path == "cheap"
    return queries.withColumns(
        {
            "path": path,
            "top_k": F.when(cheap, F.least(F.lit(top_k), F.lit(3))).otherwise(F.lit(top_k)),
            "mode": F.when(cheap & F.lit(mode == "hybrid"), F.lit("bm25_only")).otherwise(F.lit(mode)),
        }
    )


def _page(c: Column) -> Column:
    return F.coalesce(c["page"], F.lit(0)).cast("string")


def citation_tag(c: Column) -> Column:
    return F.concat(F.lit("["), c["source_id"], F.lit(":p"), _page(c), F.lit("]"))


def context_text(chunks: Column) -> Column:
    """'[i] [source:pN]' blocks in rank order."""
    parts = F.transform(chunks, lambda c, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), citation_tag(c), F.lit("\n"), c["content"]))
    return F.array_join(parts, "\n\n")


def prompt_text(query: Column, context: Column) -> Column:
    return F.concat(F.lit(PROMPT_HEAD + "\n\nContext:\n"), context, F.lit("\n\nQuestion: "), query, F.lit("\n\nAnswer:"))


def extractive_answer(chunks: Column, used: int = 5, excerpt: int = 500) -> Column:
    def shown(c: Column) -> Column:
        text = F.coalesce(c["content"], F.lit(""))
        cut = F.when(F.length(text) > excerpt, F.concat(F.substring(text, 1, excerpt), F.lit("..."))).otherwise(text)
        return F.concat(citation_tag(c), F.lit(" "), cut)

    body = F.array_join(F.transform(F.slice(chunks, 1, used), shown), BETWEEN)
    return F.when(F.size(chunks) > 0, F.concat(F.lit(LEAD), body)).otherwise(F.lit(IDK))


def parse_citations(answer: str | Column) -> Column:
    a = F.col(answer) if isinstance(answer, str) else answer
    return F.regexp_extract_all(a, F.lit(CITATION), F.lit(0))


def resolve_citations(chunks: Column, answer: Column) -> Column:
    """Chunks whose tag the answer cites; without any citation all chunks count."""
    refs = F.transform(parse_citations(answer), lambda r: F.replace(r, F.lit(" ")))
    return F.filter(chunks, lambda c: (F.size(refs) == 0) | F.array_contains(refs, F.replace(citation_tag(c), F.lit(" "))))


def gather(queries: DataFrame, hits: DataFrame, chunks: DataFrame, keys: tuple[str, ...] = ("query_id",), sent: int = 200_000) -> DataFrame:
    """Queries with their retrieved chunks as one ordered array.

    ``hits`` holds at most top-k rows per query, so the array is bounded; the
    chunk text joins in by id after ranking.  Up to ``sent`` hits go to the
    chunks, so that the texts of the corpus are not shuffled.
    """
    cols = ["chunk_id", "content", "source_id", "page"]
    hits = cut(hits)
    body = chunks.select(*cols).join(F.broadcast(hits) if within(hits, sent) else hits, "chunk_id")
    packed = body.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "score", *cols))).alias("retrieved"))
    out = queries.join(packed, list(keys), "left")
    return out.withColumn("retrieved", F.coalesce("retrieved", F.array().cast(packed.schema["retrieved"].dataType)))


def answer_queries(planned: DataFrame, hits: DataFrame, chunks: DataFrame, query: str = "query", answer: str | None = None, keys: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Route-limited retrieval -> answer, citations, contexts; one row per query.

    ``answer`` names a column with a generated answer; where it is missing or
    the IDK text, the extractive answer is used.
    """
    got = gather(planned, hits, chunks, keys).withColumn("retrieved", F.filter("retrieved", lambda c: c["rank"] <= F.col("top_k")))
    retrieved = F.col("retrieved")
    built = extractive_answer(retrieved)
    if answer:
        given = F.coalesce(F.col(answer), F.lit(IDK))
        built = F.when((strip_space(given) == IDK) | (F.size(retrieved) == 0), built).otherwise(given)
    got = got.withColumn("answer", built)
    cited = resolve_citations(retrieved, F.col("answer"))
    return got.withColumns(
        {
            "retrieved_chunk_ids": F.transform(retrieved, lambda c: c["chunk_id"]),
            "retrieved_contexts": F.transform(retrieved, lambda c: F.coalesce(c["content"], F.lit(""))),
            "citations": F.transform(cited, lambda c: c["chunk_id"]),
            "prompt": prompt_text(F.col(query), context_text(retrieved)),
            "no_evidence": strip_space("answer") == IDK,
        }
    ).drop("retrieved")


def gold_ids(gold: Column) -> Column:
    """chunk_id, else the page as text; blanks dropped, distinct."""
    ids = F.transform(gold, lambda e: F.coalesce(F.when(e["chunk_id"] != "", e["chunk_id"]), e["page"], F.lit("")))
    return F.array_distinct(F.filter(ids, lambda x: x != ""))


def _overlap(a: Column, b: Column) -> Column:
    """|a ∩ b| / |a| of distinct values, 0 for an empty ``a``."""
    a = F.array_distinct(a)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(a)), F.lit(0.0))


def score_answers(df: DataFrame, gold: str = "gold_evidence", k: int = 6) -> DataFrame:
    """Adds evidence recall, citation accuracy, coverage and the guardrail flags."""
    ids = gold_ids(F.col(gold))
    answer = F.col("answer")
    idk = strip_space(F.coalesce(answer, F.lit(""))) == IDK
    had = F.size("retrieved_chunk_ids") > 0
    has_ref = F.coalesce(answer, F.lit("")).rlike(CITATION)
    blank = answer.isNull() | (answer == "")
    return df.withColumns(
        {
            "evidence_recall_at_k": _overlap(ids, F.slice("retrieved_chunk_ids", 1, k)),
            "citation_accuracy": _overlap(F.col("citations"), ids),
            "citation_coverage": F.when(blank | idk | (F.size("citations") > 0), 1.0).otherwise(0.0),
            "idk_violation": F.when(~had & ~idk, 1.0).otherwise(0.0),
            "hallucination_flag": F.when(had & ~idk & ~has_ref, 1.0).otherwise(0.0),
        }
    )


def ablation(scored: DataFrame, by: tuple[str, ...] = ("mode",), latency: str = "latency_ms") -> DataFrame:
    """Means per mode, exact p95 latency and the guardrail rates."""
    means = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg("evidence_recall_at_k").alias("evidence_recall_at_k"),
        F.avg("citation_accuracy").alias("citation_accuracy"),
        F.avg("citation_coverage").alias("citation_coverage"),
        F.avg("idk_violation").alias("idk_violation_rate"),
        F.avg("hallucination_flag").alias("hallucination_flag_rate"),
    )
    if latency not in scored.columns:
        return means
    return means.join(exact_quantiles(scored, latency, {"latency_p95_ms": 0.95}, by), list(by), "left")


def hard_set(feedback: DataFrame, min_count: int | None = None, max_count: int | None = None, row_id: str = "request_id") -> DataFrame:
    """Low-rated or unfaithful requests; all of them unless the caller names bounds.

    With ``max_count`` only the lowest ratings (ties by id) up to that number;
    with ``min_count`` none where there are fewer.
    """
    low = feedback.filter((F.coalesce("rating", F.lit(5)) <= 2) | (F.coalesce("faithfulness", F.lit(1.0)) < 0.7))
    kept = low if max_count is None else low.orderBy("rating", row_id).limit(max_count)
    if min_count is None:
        return kept
    return kept.join(F.broadcast(kept.agg(F.count(F.lit(1)).alias("__n"))), F.col("__n") >= min_count).drop("__n")
