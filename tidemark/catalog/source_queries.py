"""Queries through the readers and sinks: files written from the given tables and read back."""

from pyspark.sql import DataFrame, functions as F

from ..operators import answers as an, metrics as mx, retrieval as rt
from ..plans import answers as plan
from ..session import scratch_path
from ..sources import store as st, tables as tb
from .feature_queries import rounded
from .registry import query
from .text_queries import ANSWER_GATE, _CHUNKS, _ON_CHUNKS, _chunks, _docs, _queries
from .views import Tables

_FROM, _TO = "2024-01-10 00:00:00", "2024-01-12 00:00:00"
_BETWEEN = f"ts >= TIMESTAMP '{_FROM}' AND ts < TIMESTAMP '{_TO}'"


@query("window_scan", "events", f"SELECT event_id, user_id, ts, value FROM events WHERE {_BETWEEN} AND user_id IN (3, 5, 8, 13)")
def window_scan(t: Tables) -> DataFrame:
    path = f"{t.sf_dir}/events.parquet"
    return tb.read_window(t.spark, path, _FROM, _TO, "ts", [3, 5, 8, 13], "user_id").select("event_id", "user_id", "ts", "value")


@query("window_scan_by_table", "events", f"SELECT event_id, user_id FROM events WHERE {_BETWEEN} AND user_id IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 90)")
def window_scan_by_table(t: Tables) -> DataFrame:
    """A long id list is a table: a semi join instead of a literal list."""
    ids = t.events.filter("event_type = 'signup' AND value > 90").select("user_id").distinct()
    return tb.read_window(t.spark, f"{t.sf_dir}/events.parquet", _FROM, _TO, "ts", ids, "user_id").select("event_id", "user_id")


@query(
    "snapshot_scan", "events",
    "SELECT user_id, ts, event_id, value FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def snapshot_scan(t: Tables) -> DataFrame:
    out = tb.read_snapshot(t.spark, f"{t.sf_dir}/events.parquet", "2024-01-15 00:00:00", ts="ts", tie="event_id")
    return out.select("user_id", "ts", "event_id", "value")


@query("label_scan", "fraud_labels_v", "SELECT transaction_id, fraud_label FROM fraud_labels_v WHERE CAST(label_time AS DATE) = DATE '2024-01-20'")
def label_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "labels")
    t.fraud_labels_v.withColumn("as_of_time", F.to_date("label_time").cast("timestamp_ntz")).write.partitionBy("as_of_time").parquet(path)
    return tb.read_labels(t.spark, path, "2024-01-20 00:00:00").select("transaction_id", "fraud_label")


@query(
    "saas_csv_tables", "accounts_v subscriptions_v feature_usage_v support_tickets_v churn_events_v",
    """SELECT 'accounts' AS name, count(*) AS n, CAST(0 AS BIGINT) AS dated FROM accounts_v UNION ALL SELECT 'subscriptions', count(*), count(end_date) FROM subscriptions_v
      UNION ALL SELECT 'feature_usage', count(*), count(usage_date) FROM feature_usage_v UNION ALL SELECT 'support_tickets', count(*), count(submitted_at) FROM support_tickets_v
      UNION ALL SELECT 'churn_events', count(*), count(churn_date) FROM churn_events_v""",
)
def saas_csv_tables(t: Tables) -> DataFrame:
    """The five tables as CSV files; a missing end date is text that does not parse."""
    from ..sources import schemas

    folder = scratch_path(t.spark, "saas")
    views = {
        "accounts": t.accounts_v, "subscriptions": t.subscriptions_v, "feature_usage": t.feature_usage_v,
        "support_tickets": t.support_tickets_v, "churn_events": t.churn_events_v,
    }
    last = {"accounts": "signup_date", "subscriptions": "end_date", "feature_usage": "usage_date", "support_tickets": "submitted_at", "churn_events": "churn_date"}
    for name, view in views.items():
        fields = [p.strip().split(" ")[0] for p in schemas.SAAS[name].split(",")]
        text = [F.coalesce(F.col(c).cast("string"), F.lit("open")) if c in view.columns else F.lit(None).cast("string") for c in fields]
        view.select(*[x.alias(c) for x, c in zip(text, fields)]).write.option("header", True).csv(f"{folder}/{name}.csv")
    tables = tb.read_saas_tables(t.spark, folder)
    parts = [tables[n].agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"), F.count(last[n]).alias("dated")) for n in views]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "wide_pair", "orders customer",
    """SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, o_totalprice AS amount, c_acctbal AS amount_id, c_mktsegment AS segment
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey""",
)
def wide_pair(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "wide")
    left = t.orders.select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"), F.col("o_totalprice").alias("amount"), "o_custkey")
    owned = left.join(t.customer.filter("c_acctbal > 0"), F.col("c_custkey") == F.col("o_custkey"))
    left.drop("o_custkey").write.option("header", True).csv(f"{folder}/a")
    owned.select("k", F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("segment")).write.option("header", True).csv(f"{folder}/b")
    kinds = ("k bigint, label int, amount double", "k bigint, amount double, segment string")
    return tb.read_wide_pair(t.spark, f"{folder}/a", f"{folder}/b", "k", "label", kinds)


@query(
    "eval_set_jsonl", "benchmark gold_v",
    "SELECT b.text AS query, '' AS gold_answer, count(g.doc_id) AS n_gold FROM benchmark b LEFT JOIN gold_v g ON g.query_id = b.item_id GROUP BY b.item_id, b.text",
)
def eval_set_jsonl(t: Tables) -> DataFrame:
    items = t.benchmark.select("item_id", F.col("text").alias("phrase"))
    found = rt.phrase_hits(tb.spread(t.documents), items, "doc_id", "text").join(items, "phrase")
    gold = found.groupBy("item_id").agg(F.collect_list(F.struct(F.col("chunk_id").cast("string").alias("chunk_id"))).alias("gold_evidence"))
    path = scratch_path(t.spark, "eval")
    st.write_json(items.join(gold, "item_id", "left").select(F.col("phrase").alias("query"), "gold_evidence"), path)
    return tb.read_eval_set(t.spark, path).select("query", "gold_answer", F.size("gold_evidence").cast("bigint").alias("n_gold"))


@query("chunk_jsonl", "documents", f"WITH {_CHUNKS} SELECT chunk_id, source_id, sha256(content) AS content_hash FROM chunks")
def chunk_jsonl(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "chunks")
    st.write_json(_chunks(t), path)
    return tb.read_chunks(t.spark, path).select("chunk_id", "source_id", F.sha2("content", 256).alias("content_hash"))


@query(
    "index_versions", "documents",
    f"""WITH {_CHUNKS}, wide AS (SELECT unnest(range(CASE WHEN length(text) = 0 THEN 0 WHEN length(text) <= 1024 THEN 1 ELSE CAST(ceil((length(text) - 128) / 896e0) AS BIGINT) END)) AS k FROM documents)
      SELECT 'v1' AS index_version, (SELECT count(*) FROM wide) AS chunk_count, FALSE AS is_latest UNION ALL SELECT 'v2', count(*), TRUE FROM chunks""",
)
def index_versions(t: Tables) -> DataFrame:
    """Two versions over all documents, with chunks of 1,024 and of 512 characters."""
    box = st.IndexStore(t.spark, scratch_path(t.spark, "index"))
    every = _docs(t).withColumnRenamed("text", "content")
    plan.build_index(every, box, "v1", "2024-01-01 00:00:00", size=1024, overlap=128)
    plan.build_index(every, box, "v2", "2024-01-02 00:00:00")
    return box.manifest().select("index_version", "chunk_count", (F.col("index_version") == box.latest()).alias("is_latest"))


@query(
    "audit_append", "audit_v",
    "SELECT domain, count(*) AS n, count(*) FILTER (latency_ms > 200) AS slow, 'n/a' AS model_version FROM audit_v WHERE domain = 'fraud' AND CAST(created_at AS DATE) = DATE '2024-01-12' GROUP BY 1",
)
def audit_append(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "audit")
    for _ in range(2):  # the second is a retry
        st.append_audit(t.audit_v, path, batch="a")
    rows = t.spark.read.parquet(path).filter("domain = 'fraud' AND day = DATE '2024-01-12'")
    return rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("latency_ms") > 200).alias("slow"), F.max("model_version").alias("model_version"))


@query(
    "feedback_append", "feedback_v",
    "SELECT 'kept' AS part, count(*) FILTER (rating < 5) AS n FROM feedback_v UNION ALL SELECT 'rejected', count(*) FILTER (rating = 5) FROM feedback_v",
)
def feedback_append(t: Tables) -> DataFrame:
    """Ratings shifted up by one, so the highest falls out of range."""
    path = scratch_path(t.spark, "feedback")
    bad = st.append_feedback(t.feedback_v.withColumn("rating", F.col("rating") + 1), path, batch="a")
    good = t.spark.read.parquet(path)
    count = F.count(F.lit(1)).alias("n")
    return good.agg(F.lit("kept").alias("part"), count).unionByName(bad.agg(F.lit("rejected").alias("part"), count))


@query(
    "hard_set_jsonl", "feedback_v",
    """SELECT rating, count(*) AS n FROM (SELECT * FROM feedback_v WHERE coalesce(rating, 5) <= 2 OR coalesce(faithfulness, 1) < 0.7
       QUALIFY row_number() OVER (ORDER BY rating, request_id) <= 500) GROUP BY 1""",
)
def hard_set_jsonl(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "hard")
    st.write_json(an.hard_set(t.feedback_v, min_count=20, max_count=500), path)
    rows = t.spark.read.schema("request_id string, rating int, faithfulness double").json(path)
    return rows.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))


@query(
    "report_csv", "ltv_scored_v",
    "SELECT stratum, round(avg(abs(y - yhat)), 4) AS mae FROM ltv_scored_v GROUP BY 1",
)
def report_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "report")
    out = mx.regression_metrics(t.ltv_scored_v, "y", "yhat", ("stratum",))
    st.write_csv(out, path)
    rows = t.spark.read.schema("stratum string, mae double, rmse double, smape double").option("header", True).csv(path)
    return rounded(rows.select("stratum", "mae"), "mae", digits=4)


_MODES_SQL = f"""WITH {_ON_CHUNKS},
  qs AS (SELECT item_id AS query_id, text AS query, CASE WHEN length(text) <= 50 THEN 3 ELSE 6 END AS top_k FROM benchmark),
  lx AS (SELECT query_id, chunk_id, score FROM bm WHERE rank <= 6),
  dn AS (SELECT q.vec_id AS query_id, concat('doc_', cast(d.vec_id AS string), ':p0:0') AS chunk_id, round(list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 10) AS score
    FROM embeddings q JOIN benchmark ON item_id = q.vec_id, embeddings d QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 10) DESC, concat('doc_', cast(d.vec_id AS string), ':p0:0')) <= 6),
  ls AS (SELECT query_id, chunk_id, coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 1) AS s FROM lx WINDOW w AS (PARTITION BY query_id)),
  ds AS (SELECT query_id, chunk_id, coalesce((score - min(score) OVER w) / nullif(max(score) OVER w - min(score) OVER w, 0), 1) AS s FROM dn WINDOW w AS (PARTITION BY query_id)),
  hits AS (SELECT 'bm25_only' AS mode, * FROM lx UNION ALL SELECT 'dense_only', * FROM dn UNION ALL SELECT 'hybrid', * FROM lx
    UNION ALL SELECT 'hybrid', * FROM dn WHERE query_id NOT IN (SELECT query_id FROM lx)
    UNION ALL SELECT 'weighted', query_id, chunk_id, round(coalesce(ls.s, 0) * 0.4 + coalesce(ds.s, 0) * 0.6, 10) FROM ls FULL JOIN ds USING (query_id, chunk_id)),
  ranked AS (SELECT mode, query_id, chunk_id, row_number() OVER (PARTITION BY mode, query_id ORDER BY score DESC, chunk_id) AS rank FROM hits),
  req AS (SELECT qs.*, requested, CASE WHEN requested = 'hybrid' AND length(query) <= 50 THEN 'bm25_only' ELSE requested END AS mode
    FROM qs, (SELECT unnest(['bm25_only', 'dense_only', 'hybrid', 'weighted']) AS requested)),
  r AS (SELECT requested, req.query_id, chunk_id, source_id, rank, row_number() OVER (PARTITION BY requested, req.query_id ORDER BY rank) AS place FROM req JOIN ranked USING (mode, query_id) JOIN chunks USING (chunk_id) WHERE rank <= top_k),
  a AS (SELECT requested, query_id, list(chunk_id ORDER BY rank) AS ids, list(DISTINCT source_id) FILTER (place <= 5) AS told FROM r GROUP BY ALL),
  c AS (SELECT requested, query_id, list(r.chunk_id) AS cited FROM r JOIN a USING (requested, query_id) WHERE list_contains(told, source_id) GROUP BY ALL),
  g AS (SELECT b.item_id AS query_id, list(DISTINCT c.chunk_id) AS gold FROM benchmark b JOIN chunks c ON contains(c.content, b.text) GROUP BY 1),
  m AS (SELECT requested, query, CASE WHEN gold IS NULL THEN 0e0 ELSE len(list_intersect(gold, coalesce(ids, []))) * 1e0 / len(gold) END AS er,
    CASE WHEN cited IS NULL THEN 0e0 ELSE len(list_intersect(cited, coalesce(gold, []))) * 1e0 / len(cited) END AS ca
    FROM req LEFT JOIN a USING (requested, query_id) LEFT JOIN c USING (requested, query_id) LEFT JOIN g USING (query_id))
  SELECT requested, count(*) AS n_queries, round(avg(er), 6) AS evidence_recall_at_k, round(avg(ca), 6) AS citation_accuracy, 1e0 AS citation_coverage,
    round(quantile_cont(length(query), 0.95), 6) AS latency_p95_ms FROM m GROUP BY 1"""


@query("answer_modes", "documents benchmark embeddings", _MODES_SQL)
def answer_modes(t: Tables) -> DataFrame:
    """Index, ask in every mode, evaluate and gate. Vectors stand for the first chunk of the document of the same number."""
    box = st.IndexStore(t.spark, scratch_path(t.spark, "rag"))
    plan.build_index(_docs(t).withColumnRenamed("text", "content"), box, "v1", "2024-01-01 00:00:00")
    index = plan.load_index(box)
    vectors = t.embeddings.select(F.concat(F.lit("doc_"), F.col("vec_id").cast("string"), F.lit(":p0:0")).alias("chunk_id"), "embedding")
    asked = _queries(t).join(t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")), "query_id", "left")
    answered = plan.ask(index, asked, vectors=vectors, modes=("bm25_only", "dense_only", "hybrid", "weighted"))
    items = t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("phrase"))
    found = rt.phrase_hits(index["chunks"], items).join(items, "phrase")
    gold = found.groupBy("query_id").agg(F.collect_list(F.struct("chunk_id", F.lit(None).cast("string").alias("page"))).alias("gold_evidence"))
    table = plan.evaluate(answered.withColumn("latency_ms", F.length("query")), gold, ANSWER_GATE)["ablation"]
    names = ["evidence_recall_at_k", "citation_accuracy", "latency_p95_ms"]
    return rounded(table.select("requested", "n_queries", *names, "citation_coverage"), *names)


