import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import answers as an, retrieval as rt, text as tx


def split(text, size=512, overlap=64):
    out, start = [], 0
    while start < len(text):
        end = min(start + size, len(text))
        out.append(text[start:end])
        start = end - overlap if end < len(text) else len(text)
    return out


@pytest.mark.parametrize("size,overlap", [(512, 64), (10, 7), (5, 0)])
def test_chunks_equal_the_loop(spark, size, overlap):
    texts = ["", "x"] + ["".join(chr(97 + i % 26) if i % 7 else "é\n😀"[i % 3] for i in range(n)) for n in (5, 6, 10, 511, 512, 513, 960, 961, 1409)]
    df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "s string, t string")
    got = {}
    for r in tx.chunk(df, "s", "t", size=size, overlap=overlap).collect():
        got.setdefault(r.source_id, []).append((int(r.chunk_id.split(":")[2]), r.content))
    for i, t in enumerate(texts):
        assert [c for _, c in sorted(got.get(f"d{i}", []))] == split(t, size, overlap), i


def test_chunk_ids_pages_and_hash(spark):
    import hashlib

    df = spark.createDataFrame([("a", 3, "hello"), ("a", None, "hello")], "s string, p int, t string")
    rows = {r.chunk_id: r.hash for r in tx.chunk(df, "s", "t", "p").collect()}
    assert rows == {
        "a:p3:0": hashlib.sha256(b"a3hello").hexdigest()[:16],
        "a:p0:0": hashlib.sha256(b"ahello").hexdigest()[:16],
    }
    with pytest.raises(ValueError):
        tx.chunk(df, "s", "t", size=10, overlap=10)


def okapi(docs, query, k1=1.5, b=0.75, eps=0.25):
    toks = [d.split() for d in docs]
    n, avg = len(docs), sum(map(len, toks)) / len(docs)
    df = Counter(w for t in toks for w in set(t))
    raw = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    floor = eps * sum(raw.values()) / len(raw)
    idf = {w: floor if v < 0 else v for w, v in raw.items()}
    out = []
    for t in toks:
        tf = Counter(t)
        out.append(sum(idf.get(q, 0) * tf[q] * (k1 + 1) / (tf[q] + k1 * (1 - b + b * len(t) / avg)) for q in query.split()))
    return out


def test_bm25_against_direct_scores(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(12)]
    docs = [" ".join(rng.choices(words, k=rng.randint(1, 15))) for _ in range(30)] + [""]
    queries = ["w1 w2 w2", "w3 unknown", "nothing"]
    chunks = spark.createDataFrame([(f"c{i:02d}", d) for i, d in enumerate(docs)], "chunk_id string, content string")
    q = spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")
    got = rt.bm25_topk(chunks, q, k=5).collect()
    stored = rt.bm25_search(rt.bm25_index(chunks), q, k=5).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stored))
    shuffled = rt.bm25_topk(chunks, q, k=5, max_terms=2).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, shuffled))
    plan = rt.bm25_topk(chunks, q, k=5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(chunk_id" in plan and "hashpartitioning(query_id" in plan and ", query_id#" not in plan.split("hashpartitioning(chunk_id")[1][:40]
    for i, text in enumerate(queries):
        scores = okapi(docs, text)
        match = [j for j, d in enumerate(docs) if set(d.split()) & set(text.split())]
        want = sorted(match, key=lambda j: (-round(scores[j], 10), f"c{j:02d}"))[:5]
        mine = sorted((r for r in got if r.query_id == i), key=lambda r: r.rank)
        assert [r.chunk_id for r in mine] == [f"c{j:02d}" for j in want]
        assert [r.score for r in mine] == pytest.approx([scores[j] for j in want])


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_dense_small_and_blocked_agree_with_numpy(spark, metric):
    rng = np.random.default_rng(2)
    v, q = rng.normal(size=(200, 8)), rng.normal(size=(30, 8))
    v[10] = v[11]
    corpus = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "chunk_id long, embedding array<double>").repartition(5)
    queries = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(q)], "query_id long, vector array<double>")
    a = {(r.query_id, r["rank"]): r.chunk_id for r in rt.dense_topk(corpus, queries, 4, metric=metric).collect()}
    b = {(r.query_id, r["rank"]): r.chunk_id for r in rt.dense_topk(corpus, queries, 4, metric=metric, max_queries=7, block_rows=33).collect()}
    if metric == "cosine":
        v, q = v / np.linalg.norm(v, axis=1, keepdims=True), q / np.linalg.norm(q, axis=1, keepdims=True)
    s = np.round(q @ v.T, 10)
    want = {(i, r + 1): int(j) for i in range(30) for r, j in enumerate(np.argsort(-s[i], kind="stable")[:4])}
    assert a == want and b == want


def test_phrase_hits(spark):
    """Words inside tokens, of one and two letters, too, and phrases that begin and end inside tokens."""
    rng = random.Random(4)
    texts = ["".join(rng.choices("abc ", k=40)) for _ in range(50)] + ["", "  ", "one  two\nthree"]
    phrases = list({"".join(rng.choices("abc ", k=k)).strip() for k in (1, 2, 3, 5, 7) for _ in range(20)} - {""}) + ["aaa" * 20, "e  t", "two\nth", "two th"]
    c = spark.createDataFrame(list(enumerate(texts)), "chunk_id int, content string")
    p = spark.createDataFrame([(x,) for x in phrases], "phrase string")
    want = sorted((i, x) for i, t in enumerate(texts) for x in phrases if x in t)
    assert sorted(map(tuple, rt.phrase_hits(c, p).collect())) == want


def test_keyword_counts_distinct_words_inside_text(spark):
    c = spark.createDataFrame([("a", "The Cat sat"), ("b", "concatenate"), ("c", "dog")], "chunk_id string, content string")
    q = spark.createDataFrame([(1, "CAT cat the")], "query_id int, query string")
    assert [(r.chunk_id, r.score, r["rank"]) for r in rt.keyword_topk(c, q).collect()] == [("a", 2.0, 1), ("b", 1.0, 2)]


def test_router(spark):
    rows = ["  what  ", "x" * 50, "x" * 51, "What is " + "x" * 60, " " + "y" * 50 + "\n", "tell me how to " + "x" * 60]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, q string")
    got = [r.p for r in df.select("i", an.route("q").alias("p")).orderBy("i").collect()]
    assert got == ["cheap", "cheap", "full", "cheap", "cheap", "full"]


def test_answers_citations_and_scores(spark):
    chunks = spark.createDataFrame(
        [("doc-1:p0:0", "alpha " * 120, "doc-1", None), ("dé:p2:0", "beta", "dé", 2)], "chunk_id string, content string, source_id string, page int"
    )
    planned = spark.createDataFrame([(1, "q1", 6, None), (2, "q2", 6, None), (3, "q3", 6, "See [dé:p2]."), (4, "q4", 6, "No refs here")], "query_id int, query string, top_k int, given string")
    hits = spark.createDataFrame([(q, c, 1.0, r) for q in (1, 3, 4) for c, r in (("doc-1:p0:0", 1), ("dé:p2:0", 2))], "query_id int, chunk_id string, score double, rank int")
    out = {r.query_id: r for r in an.answer_queries(planned, hits, chunks, answer="given").collect()}
    assert out[2].answer == an.IDK and out[2].no_evidence and out[2].citations == []
    assert out[1].answer.startswith(an.LEAD + "[doc-1:p0] alpha") and "..." in out[1].answer and out[1].citations == ["doc-1:p0:0", "dé:p2:0"]
    assert out[3].citations == ["dé:p2:0"]
    assert out[4].citations == ["doc-1:p0:0", "dé:p2:0"]
    assert "\n\nQuestion: q1\n\nAnswer:" in out[1].prompt and "[2] [dé:p2]\nbeta" in out[1].prompt
    gold = spark.createDataFrame(
        [(1, [("dé:p2:0", None), ("", "7")]), (2, []), (3, [("dé:p2:0", "1")]), (4, [])], "query_id int, gold_evidence array<struct<chunk_id:string,page:string>>"
    )
    rows = {r.query_id: r for r in an.score_answers(an.answer_queries(planned, hits, chunks, answer="given").join(gold, "query_id")).collect()}
    assert (rows[1].evidence_recall_at_k, rows[1].citation_accuracy) == (0.5, 0.5)
    assert (rows[2].evidence_recall_at_k, rows[2].citation_accuracy, rows[2].citation_coverage) == (0.0, 0.0, 1.0)
    assert rows[3].citation_accuracy == 1.0
    assert rows[4].hallucination_flag == 1.0 and rows[1].hallucination_flag == 0.0


def test_hard_set_needs_enough_rows(spark):
    df = spark.range(30).select(F.concat(F.lit("r"), "id").alias("request_id"), F.when(F.col("id") < 15, 1).otherwise(5).alias("rating"), F.lit(None).cast("double").alias("faithfulness"))
    assert an.hard_set(df, min_count=20, max_count=500).count() == 0
    assert an.hard_set(df).count() == an.hard_set(df, min_count=1).count() > an.hard_set(df, max_count=3).count() == 3
    assert an.hard_set(df, min_count=10, max_count=12).count() == 12


def test_html_blocks(spark):
    html = "<html><head><title>x</title></head><body><script>a<b</script><p> One &amp; <b>two</b></p><!-- no --><ul><li>three</li><li> </li></ul></body></html>"
    df = spark.createDataFrame([(1, html)], "id int, h string")
    assert [(r.block, r.content) for r in tx.html_blocks(df, "id", "h").collect()] == [(0, "One & two"), (1, "three")]


def test_parser_hook(spark, tmp_path):
    (tmp_path / "a.txt").write_text("first\f\fsecond")

    def parse(path, data):
        for i, page in enumerate(data.decode().split("\f")):
            yield i + 1, None, page

    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert [(r.page, r.content) for r in tx.document_pages(files, parse).collect()] == [(1, "first"), (3, "second")]


@pytest.mark.parametrize("more", [{}, {"max_queries": 0}, {"max_bytes": 10}])
def test_keyword_search_against_all_pairs(spark, more):
    """Words inside tokens, odd characters, nulls and ties; by the dictionary and, beyond its bounds, by shuffles."""
    rng = random.Random(3)
    parts = ["an", "na", "Ban", "ana", "é", "z", "banana", "日本", "x" * 50]
    texts = [" ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(0, 12))) for _ in range(120)] + [None, "", " \t "]
    asked = [" ".join(rng.sample(parts, rng.randrange(0, 5))) for _ in range(15)] + ["AN an", None, "  ", "nothing-like-it"]
    chunks = spark.createDataFrame([(f"c{i:03d}", t) for i, t in enumerate(texts)], "chunk_id string, content string").repartition(4)
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, query string")
    want = []
    for q, text in enumerate(asked):
        words = set((text or "").lower().split())
        scored = sorted((-sum(w in t.lower() for w in words), f"c{i:03d}") for i, t in enumerate(texts) if t)
        want += [(q, c, float(-s), r) for r, (s, c) in enumerate([x for x in scored if x[0] < 0][:4], 1)]
    got = rt.keyword_topk(chunks, queries, k=4, **more).select("query_id", "chunk_id", "score", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_tokens_are_looked_up_in_bounded_memory():
    words = rt._WordsIn(["a", "ab", "bc"], kept=2)
    assert [sorted(words.of(t)) for t in ("abc", "xa", "none", "bcbc", "abc")] == [[0, 1, 2], [0], [], [2], [0, 1, 2]] and len(words.known) <= 2
