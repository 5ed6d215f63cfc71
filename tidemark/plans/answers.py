"""Retrieval pipeline: documents -> chunks -> index -> batch ask -> evaluation -> gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.temporal import Moment
from ..operators import answers, gates, metrics, retrieval, text
from ..session import cut
from ..sources.store import IndexStore


def build_index(blocks: DataFrame, store: IndexStore, version: str, now: Moment, size: int = 512, overlap: int = 64) -> None:
    """Chunk, then write chunks, postings, terms and stats as one version."""
    chunks = text.chunk(blocks, "source_id", "content", "page" if "page" in blocks.columns else None, size=size, overlap=overlap)
    store.save(version, chunks, now, tables=retrieval.index_tables())


def load_index(store: IndexStore, version: str | None = None) -> dict[str, DataFrame]:
    chosen = version or store.latest()
    return {name: store.load(name, chosen) for name in ("chunks", "postings", "terms", "stats")}


def ask(index: dict[str, DataFrame], queries: DataFrame, top_k: int = 6, vectors: DataFrame | None = None, modes: tuple[str, ...] = ("hybrid",)) -> DataFrame:
    """Answers for every (query, mode).

    ``queries`` has query_id, query and, for dense modes, vector; ``vectors``
    has chunk_id and embedding.  ``hybrid`` falls back from lexical to dense
    per query; ``weighted`` combines both lists.
    """
    requested = F.explode(F.array(*[F.lit(m) for m in modes])).alias("requested")
    planned = answers.plan_queries(queries.select("query_id", "query").withColumn("requested", requested), "query", top_k)
    # The router only changes the hybrid mode; every other request keeps its own.
    used = F.when(F.col("requested") == "hybrid", F.col("mode")).otherwise(F.col("requested"))
    planned = planned.withColumn("mode", F.when(used == "hybrid_rerank", F.lit("hybrid")).otherwise(used))
    lexical = cut(retrieval.bm25_search(index, queries, top_k))  # several modes read the lists: searched once
    found = [lexical.withColumn("mode", F.lit("bm25_only"))]
    if vectors is None:
        found.append(lexical.withColumn("mode", F.lit("hybrid")))
    else:
        dense = cut(retrieval.dense_topk(vectors, queries, top_k))
        found += [
            dense.withColumn("mode", F.lit("dense_only")),
            retrieval.hybrid_topk(lexical, dense, top_k, mode="fallback").withColumn("mode", F.lit("hybrid")),
            retrieval.hybrid_topk(lexical, dense, top_k).withColumn("mode", F.lit("weighted")),
        ]
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    return answers.answer_queries(planned, hits, index["chunks"], keys=("query_id", "mode"))


def evaluate(asked: DataFrame, gold: DataFrame, gate: dict, latency: str = "latency_ms") -> dict[str, DataFrame]:
    """Per-mode ablation and gate checks; ``gold`` has query_id and gold_evidence."""
    empty = F.array().cast("array<struct<chunk_id:string,page:string>>")
    rows = asked.join(gold, "query_id", "left").withColumn("gold_evidence", F.coalesce("gold_evidence", empty))
    scored = cut(answers.score_answers(rows))  # a row per question; the means and the quantiles read it several times
    table = answers.ablation(scored, ("requested",), latency)
    return {"scored": scored, "ablation": table, "checks": gates.rag_gate(metrics.to_long(table, ("requested",)), gate, ("requested",))}
