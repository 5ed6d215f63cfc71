"""Queries over chunking, retrieval, answers and their evaluation."""

from pyspark.sql import DataFrame, functions as F

from ..operators import answers as an, gates, metrics as mx, retrieval as rt, text as tx
from ..session import cut
from ..sources.tables import spread
from .feature_queries import rounded
from .registry import query
from .views import Tables

_CHUNKS = """chunks AS (SELECT concat('doc_', cast(doc_id AS string), ':p0:', cast(i AS string)) AS chunk_id, substring(text, i * 448 + 1, 512) AS content, concat('doc_', cast(doc_id AS string)) AS source_id
  FROM documents, LATERAL (SELECT unnest(range(CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= 512 THEN 1 ELSE CAST(ceil((length(text) - 64) / 448e0) AS BIGINT) END)) AS i))"""


def _docs(t: Tables) -> DataFrame:
    return spread(t.documents).select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("source_id"), "text")


def _chunks(t: Tables) -> DataFrame:
    return tx.chunk(_docs(t), "source_id", "text")


def _queries(t: Tables) -> DataFrame:
    return t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


@query(
    "chunks", "documents",
    f"WITH {_CHUNKS} SELECT chunk_id, content, source_id, CAST(NULL AS INTEGER) AS page, substring(sha256(concat(source_id, content)), 1, 16) AS hash FROM chunks",
)
def chunks(t: Tables) -> DataFrame:
    return _chunks(t).select("chunk_id", "content", "source_id", "page", "hash")


@query(
    "distinct_chunks", "documents",
    f"WITH {_CHUNKS} SELECT substring(sha256(concat(source_id, content)), 1, 16) AS hash, min(chunk_id) AS chunk_id FROM chunks GROUP BY 1",
)
def distinct_chunks(t: Tables) -> DataFrame:
    return tx.distinct_chunks(_chunks(t)).select("hash", "chunk_id")


_BREAK = r"</?(?:html|body|p|div|ul|ol|li|h[1-6]|table|thead|tbody|tr|td|th|br|hr|nav|article|section|header|footer|main|aside|blockquote|pre|form|dl|dt|dd|figure|figcaption)\b[^>]*>|<!doctype[^>]*>"


@query(
    "html_blocks", "pages",
    rf"""WITH a AS (SELECT page_id, regexp_replace(html, '<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>', '', 'gsi') AS h FROM pages),
      b AS (SELECT page_id, regexp_replace(regexp_replace(h, '{_BREAK}', chr(1), 'gi'), '<[^>]*>', '', 'g') AS h FROM a),
      c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(h, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS h FROM b),
      d AS (SELECT page_id, list_filter(list_transform(string_split(h, chr(1)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM c)
      SELECT page_id AS source_id, CAST(unnest(range(len(l))) AS INTEGER) AS block, unnest(l) AS content FROM d""",
)
def html_blocks(t: Tables) -> DataFrame:
    return tx.html_blocks(spread(t.pages), "page_id", "html")


_BM25 = """toks AS (SELECT {id} AS chunk_id, list_filter(regexp_split_to_array({text}, '\\s+'), lambda x: x <> '') AS w FROM {corpus}),
  st AS (SELECT count(*) AS n, avg(len(w)) AS avgdl FROM toks),
  post AS (SELECT chunk_id, dl, term, count(*) AS tf FROM (SELECT chunk_id, len(w) AS dl, unnest(w) AS term FROM toks) GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM post GROUP BY 1),
  raw AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS r FROM df, st),
  idf AS (SELECT term, df, CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM raw) ELSE r END AS idf FROM raw),
  qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS term FROM benchmark) GROUP BY ALL),
  sc AS (SELECT query_id, chunk_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))), 10) AS score FROM qt JOIN post USING (term) JOIN idf USING (term), st GROUP BY ALL),
  bm AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM sc)"""
_ON_CHUNKS = _CHUNKS + ", " + _BM25.format(id="chunk_id", text="content", corpus="chunks")
_ON_DOCS = _BM25.format(id="doc_id", text="text", corpus="documents")


#: The term table alone, each step made once.
_TERMS = _CHUNKS + """, words AS MATERIALIZED (SELECT chunk_id, unnest(list_distinct(list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> ''))) AS term FROM chunks),
  df AS MATERIALIZED (SELECT term, count(*) AS df FROM words GROUP BY 1), st AS MATERIALIZED (SELECT count(*) AS n FROM chunks),
  raw AS MATERIALIZED (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS r FROM df, st), mean AS (SELECT avg(r) AS m FROM raw)"""


@query("bm25_terms", "documents benchmark", f"WITH {_TERMS} SELECT term, df, round(CASE WHEN r < 0 THEN 0.25 * m ELSE r END, 6) AS idf FROM raw, mean")
def bm25_terms(t: Tables) -> DataFrame:
    return rounded(rt.term_table(_chunks(t)), "idf")


@query("bm25_stats", "documents benchmark", f"WITH {_ON_CHUNKS} SELECT n, round(avgdl, 6) AS avgdl FROM st")
def bm25_stats(t: Tables) -> DataFrame:
    return rounded(rt.corpus_stats(_chunks(t)), "avgdl")


@query("bm25_topk", "documents benchmark", f"WITH {_ON_CHUNKS} SELECT query_id, chunk_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM bm WHERE rank <= 6")
def bm25_topk(t: Tables) -> DataFrame:
    return rounded(rt.bm25_topk(_chunks(t), _queries(t)), "score")


@query(
    "dense_topk", "embeddings",
    """SELECT q.vec_id AS query_id, d.vec_id AS chunk_id, round(round(list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 10), 6) AS score,
      CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 10) DESC, d.vec_id) AS INTEGER) AS rank
      FROM embeddings q, embeddings d WHERE q.vec_id % 100 = 0 QUALIFY rank <= 6""",
)
def dense_topk(t: Tables) -> DataFrame:
    """The stated query set: vectors whose id is divisible by 100, against all vectors."""
    queries = t.embeddings.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return rounded(rt.dense_topk(spread(t.embeddings), queries, vector_id="vec_id"), "score")


@query(
    "dense_cosine_centroids", "embeddings",
    """WITH c AS (SELECT label, list(m ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY ALL) GROUP BY 1)
      SELECT c.label AS query_id, d.vec_id AS chunk_id, round(round(list_cosine_similarity(c.v, d.embedding::DOUBLE[]), 10), 6) AS score,
      CAST(row_number() OVER (PARTITION BY c.label ORDER BY round(list_cosine_similarity(c.v, d.embedding::DOUBLE[]), 10) DESC, d.vec_id) AS INTEGER) AS rank FROM c, embeddings d QUALIFY rank <= 10""",
)
def dense_cosine_centroids(t: Tables) -> DataFrame:
    cells = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    packed = cells.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("c"))
    centers = packed.select(F.col("label").alias("query_id"), F.transform("c", lambda e: e["m"]).alias("vector"))
    return rounded(rt.dense_topk(t.embeddings, centers, k=10, vector_id="vec_id", metric="cosine"), "score")


@query(
    "keyword_topk", "documents benchmark",
    f"""WITH {_CHUNKS}, qw AS (SELECT DISTINCT item_id AS query_id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS w FROM benchmark),
      vocab AS (SELECT DISTINCT w FROM qw), hit AS (SELECT chunk_id, w FROM chunks, vocab WHERE contains(lower(content), w)),
      sc AS (SELECT query_id, chunk_id, count(*) * 1e0 AS score FROM hit JOIN qw USING (w) GROUP BY ALL)
      SELECT query_id, chunk_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM sc QUALIFY rank <= 6""",
)
def keyword_topk(t: Tables) -> DataFrame:
    return rt.keyword_topk(_chunks(t), _queries(t))


_DENSE_ITEMS = """dn AS (SELECT q.vec_id AS query_id, d.vec_id AS doc_id, round(list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 10) AS score FROM embeddings q JOIN benchmark ON item_id = q.vec_id, embeddings d
    QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 10) DESC, d.vec_id) <= 10),
  lx AS (SELECT query_id, chunk_id AS doc_id, score FROM bm WHERE rank <= 10)"""


def _doc_candidates(t: Tables, k: int = 10) -> tuple[DataFrame, DataFrame]:
    lexical = rt.bm25_topk(spread(t.documents), _queries(t), k, "doc_id", "text")
    vectors = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    asked = vectors.join(_queries(t).select("query_id"), "query_id", "left_semi")
    return lexical, rt.dense_topk(t.embeddings, asked, k, vector_id="vec_id")


@query(
    "hybrid_topk", "documents benchmark embeddings",
    f"""WITH {_ON_DOCS}, {_DENSE_ITEMS},
      l AS (SELECT query_id, doc_id, coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 1) AS s FROM lx WINDOW w AS (PARTITION BY query_id)),
      d AS (SELECT query_id, doc_id, coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 1) AS s FROM dn WINDOW w AS (PARTITION BY query_id)),
      j AS (SELECT query_id, doc_id AS chunk_id, round(coalesce(l.s, 0) * 0.4 + coalesce(d.s, 0) * 0.6, 10) AS score FROM l FULL JOIN d USING (query_id, doc_id))
      SELECT query_id, chunk_id, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM j QUALIFY rank <= 10""",
)
def hybrid_topk(t: Tables) -> DataFrame:
    return rounded(rt.hybrid_topk(*_doc_candidates(t)), "score")


@query(
    "hybrid_fallback", "documents benchmark embeddings",
    f"""WITH {_ON_DOCS}, {_DENSE_ITEMS}, j AS (SELECT query_id, doc_id AS chunk_id, score FROM lx UNION ALL SELECT query_id, doc_id, score FROM dn WHERE query_id NOT IN (SELECT query_id FROM lx))
      SELECT query_id, chunk_id, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM j QUALIFY rank <= 10""",
)
def hybrid_fallback(t: Tables) -> DataFrame:
    return rounded(rt.hybrid_topk(*_doc_candidates(t), mode="fallback"), "score")


@query("gold_evidence", "gold_v", "SELECT query_id, doc_id FROM gold_v")
def gold_evidence(t: Tables) -> DataFrame:
    hits = rt.phrase_hits(spread(t.documents), t.benchmark, "doc_id", "text", "text")
    items = t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("phrase"))
    return hits.join(items, "phrase").select("query_id", F.col("chunk_id").alias("doc_id"))


_STRIPPED = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
_ROUTED = rf"""SELECT conv_id, turn, CASE WHEN length({_STRIPPED}) <= 50 OR regexp_matches(lower({_STRIPPED}), '^(what is|how to|how do|can i|where is|when does)') THEN 'cheap' ELSE 'full' END AS path FROM conversations"""


@query(
    "route", "conversations",
    f"SELECT conv_id, turn, path, CASE WHEN path = 'cheap' THEN 3 ELSE 6 END AS top_k, CASE WHEN path = 'cheap' THEN 'bm25_only' ELSE 'hybrid' END AS mode FROM ({_ROUTED})",
)
def route(t: Tables) -> DataFrame:
    return an.plan_queries(t.conversations, "text").select("conv_id", "turn", "path", "top_k", "mode")


_ASK = f"""{_ON_CHUNKS}, qs AS (SELECT item_id AS query_id, text AS query, CASE WHEN length(text) <= 50 THEN 3 ELSE 6 END AS top_k FROM benchmark),
  r AS (SELECT qs.query_id, bm.chunk_id, c.content, c.source_id, rank FROM qs JOIN bm USING (query_id) JOIN chunks c USING (chunk_id) WHERE rank <= top_k),
  a AS (SELECT query_id, list(chunk_id ORDER BY rank) AS retrieved_chunk_ids, list(source_id ORDER BY rank) AS sources,
    'Based on the retrieved context:' || chr(10) || chr(10) || string_agg(CASE WHEN rank <= 5 THEN '[' || source_id || ':p0] ' || CASE WHEN length(content) > 500 THEN substring(content, 1, 500) || '...' ELSE content END END, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS answer,
    string_agg('[' || cast(rank AS string) || '] [' || source_id || ':p0]' || chr(10) || content, chr(10) || chr(10) ORDER BY rank) AS context FROM r GROUP BY 1),
  asked AS (SELECT qs.query_id, coalesce(retrieved_chunk_ids, []) AS retrieved_chunk_ids, coalesce(answer, 'I don''t know.') AS answer, coalesce(context, '') AS context, query, answer IS NULL AS no_evidence,
    list_filter(coalesce(retrieved_chunk_ids, []), lambda x, i: contains(coalesce(answer, ''), '[' || sources[i] || ':p0]')) AS citations FROM qs LEFT JOIN a USING (query_id))"""


def _asked(t: Tables) -> DataFrame:
    base = _chunks(t)
    planned = an.plan_queries(_queries(t))
    return an.answer_queries(planned, rt.bm25_topk(base, planned), base)


@query("batch_ask", "documents benchmark", f"WITH {_ASK} SELECT query_id, retrieved_chunk_ids, answer, citations, no_evidence, sha256(context) AS context_hash FROM asked")
def batch_ask(t: Tables) -> DataFrame:
    out = _asked(t)
    context = F.regexp_extract(F.col("prompt"), r"(?s)\n\nContext:\n(.*)\n\nQuestion: ", 1)
    return out.select("query_id", "retrieved_chunk_ids", "answer", "citations", "no_evidence", F.sha2(context, 256).alias("context_hash"))


_GOLD_CHUNKS = """g AS (SELECT b.item_id AS query_id, list(DISTINCT c.chunk_id) AS gold FROM benchmark b JOIN chunks c ON contains(c.content, b.text) GROUP BY 1),
  scored AS (SELECT asked.*, coalesce(gold, []) AS gold FROM asked LEFT JOIN g USING (query_id)),
  m AS (SELECT query_id, retrieved_chunk_ids, citations, answer, CASE WHEN len(gold) = 0 THEN 0e0 ELSE len(list_intersect(gold, retrieved_chunk_ids)) * 1e0 / len(gold) END AS evidence_recall_at_k,
    CASE WHEN len(citations) = 0 THEN 0e0 ELSE len(list_intersect(citations, gold)) * 1e0 / len(citations) END AS citation_accuracy,
    CASE WHEN no_evidence OR len(citations) > 0 THEN 1e0 ELSE 0e0 END AS citation_coverage FROM scored)"""


def _scored(t: Tables) -> DataFrame:
    base = _chunks(t)
    items = t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("phrase"))
    found = rt.phrase_hits(base, items).join(items, "phrase")
    gold = found.groupBy("query_id").agg(
        F.collect_list(F.struct("chunk_id", F.lit(None).cast("string").alias("page"))).alias("gold_evidence")
    )
    empty = F.array().cast("array<struct<chunk_id:string,page:string>>")
    rows = _asked(t).join(gold, "query_id", "left").withColumn("gold_evidence", F.coalesce("gold_evidence", empty))
    # A row per question; the means and the quantiles read it several times.
    return cut(an.score_answers(rows).withColumn("latency_ms", F.length("query")))


@query(
    "answer_scores", "documents benchmark",
    f"WITH {_ASK}, {_GOLD_CHUNKS} SELECT query_id, round(evidence_recall_at_k, 6) AS evidence_recall_at_k, round(citation_accuracy, 6) AS citation_accuracy, citation_coverage, 0e0 AS idk_violation, 0e0 AS hallucination_flag FROM m",
)
def answer_scores(t: Tables) -> DataFrame:
    names = ["evidence_recall_at_k", "citation_accuracy"]
    return rounded(_scored(t).select("query_id", *names, "citation_coverage", "idk_violation", "hallucination_flag"), *names)


@query(
    "ablation", "documents benchmark",
    f"""WITH {_ASK}, {_GOLD_CHUNKS}, l AS (SELECT CASE WHEN length(query) <= 50 THEN 'bm25_only' ELSE 'hybrid' END AS mode, length(query) AS latency_ms, query_id FROM qs)
      SELECT mode, count(*) AS n_queries, round(avg(evidence_recall_at_k), 6) AS evidence_recall_at_k, round(avg(citation_accuracy), 6) AS citation_accuracy, round(avg(citation_coverage), 6) AS citation_coverage,
        0e0 AS idk_violation_rate, 0e0 AS hallucination_flag_rate, round(quantile_cont(latency_ms, 0.95), 6) AS latency_p95_ms FROM m JOIN l USING (query_id) GROUP BY 1""",
)
def ablation(t: Tables) -> DataFrame:
    out = an.ablation(_scored(t))
    return rounded(out, "evidence_recall_at_k", "citation_accuracy", "citation_coverage", "latency_p95_ms")


# Thresholds of the answer gate.
ANSWER_GATE = {
    "eval": {"faithfulness_min": 0.80, "answer_relevancy_min": 0.85, "context_recall_min": 0.75, "context_precision_min": 0.55, "citation_coverage_min": 0.90},
    "citation": {"evidence_recall_at_k_min": 0.75, "citation_accuracy_min": 0.70},
    "slo": {"latency_p95_max_ms": 1200, "avg_prompt_tokens_max": 2200, "avg_completion_tokens_max": 500},
    "guardrails": {"must_return_idk_when_no_evidence": True, "hallucination_flag_rate_max": 0.05},
}


@query(
    "answer_gate", "documents benchmark",
    f"""WITH {_ASK}, {_GOLD_CHUNKS}, a2 AS (SELECT avg(evidence_recall_at_k) AS er, avg(citation_accuracy) AS ca, avg(citation_coverage) AS cc FROM m),
      lat AS (SELECT quantile_cont(length(query), 0.95) AS p FROM qs)
      SELECT 'eval' AS section, 'citation_coverage' AS metric, 'min' AS rule, round(cc, 6) AS value, 0.9e0 AS threshold, cc >= 0.9 AS passed FROM a2
      UNION ALL SELECT 'citation', 'evidence_recall_at_k', 'min', round(er, 6), 0.75e0, er >= 0.75 FROM a2
      UNION ALL SELECT 'citation', 'citation_accuracy', 'min', round(ca, 6), 0.7e0, ca >= 0.7 FROM a2
      UNION ALL SELECT 'slo', 'latency_p95_ms', 'max', round(p, 6), 1200e0, p <= 1200 FROM lat""",
)
def answer_gate(t: Tables) -> DataFrame:
    wide = an.ablation(_scored(t).withColumn("run", F.lit("all")), ("run",))
    return rounded(gates.rag_gate(mx.to_long(wide.drop("run")), ANSWER_GATE), "value")


# Replies with and without evidence, reference and admission of not knowing, in all combinations.
_REPLIES = """replies AS (SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 'I don''t know.' WHEN 1 THEN concat(text, ' [doc_1:p0]') ELSE text END AS answer, conv_id % 3 <> 0 AS had
    FROM conversations WHERE role = 'assistant'),
  flags AS (SELECT conv_id, turn, CASE WHEN NOT had AND answer <> 'I don''t know.' THEN 1e0 ELSE 0e0 END AS idk_violation,
    CASE WHEN had AND answer <> 'I don''t know.' AND NOT regexp_matches(answer, '\\[[\\w\\-]+:p\\d+\\]') THEN 1e0 ELSE 0e0 END AS hallucination_flag FROM replies)"""


def _flagged(t: Tables) -> DataFrame:
    said = t.conversations.filter("role = 'assistant'")
    kind = F.col("conv_id") % 4
    answer = F.when(kind == 0, F.lit("I don't know.")).when(kind == 1, F.concat("text", F.lit(" [doc_1:p0]"))).otherwise(F.col("text"))
    none = F.array().cast("array<string>")
    found = F.when(F.col("conv_id") % 3 != 0, F.array(F.lit("c1"))).otherwise(none)
    gold = F.array().cast("array<struct<chunk_id:string,page:string>>")
    rows = said.select("conv_id", "turn", answer.alias("answer"), found.alias("retrieved_chunk_ids"), none.alias("citations"), gold.alias("gold_evidence"))
    return an.score_answers(rows)


@query("guardrail_flags", "conversations", f"WITH {_REPLIES} SELECT * FROM flags")
def guardrail_flags(t: Tables) -> DataFrame:
    return _flagged(t).select("conv_id", "turn", "idk_violation", "hallucination_flag")


@query(
    "guardrail_gate", "conversations",
    f"""WITH {_REPLIES}, r AS (SELECT avg(idk_violation) AS i, avg(hallucination_flag) AS h FROM flags)
      SELECT 'must_return_idk' AS metric, 'max' AS rule, round(i, 6) AS value, 0e0 AS threshold, FALSE AS passed FROM r WHERE i > 0
      UNION ALL SELECT 'hallucination_flag_rate', 'max', round(h, 6), 0.05e0, FALSE FROM r WHERE h > 0.05""",
)
def guardrail_gate(t: Tables) -> DataFrame:
    """Only broken guardrails show up in the checks."""
    rates = an.ablation(_flagged(t).withColumn("run", F.lit("all")), ("run",)).select("idk_violation_rate", "hallucination_flag_rate")
    checks = gates.rag_gate(mx.to_long(rates), {"guardrails": ANSWER_GATE["guardrails"]})
    return rounded(checks.filter("section = 'guardrails'").select("metric", "rule", "value", "threshold", "passed"), "value")


@query(
    "citations", "conversations",
    r"""WITH x AS (SELECT conv_id, turn, concat(text, ' [conv_', cast(conv_id AS string), ':p', cast(turn AS string), ']') AS answer FROM conversations WHERE role = 'assistant')
      SELECT conv_id, turn, regexp_extract_all(answer, '\[[\w\-]+:p\d+\]') AS refs FROM x""",
)
def citations(t: Tables) -> DataFrame:
    said = t.conversations.filter("role = 'assistant'")
    tag = F.concat(F.lit(" [conv_"), F.col("conv_id").cast("string"), F.lit(":p"), F.col("turn").cast("string"), F.lit("]"))
    return said.select("conv_id", "turn", an.parse_citations(F.concat("text", tag)).alias("refs"))


@query(
    "hard_set", "feedback_v",
    """SELECT * FROM feedback_v WHERE coalesce(rating, 5) <= 2 OR coalesce(faithfulness, 1) < 0.7
       QUALIFY row_number() OVER (ORDER BY rating, request_id) <= 500""",
)
def hard_set(t: Tables) -> DataFrame:
    return an.hard_set(t.feedback_v, min_count=20, max_count=500)
