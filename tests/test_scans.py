"""Searches that read the corpus in scans: what moves is bounded by matches, not by tokens times queries."""

import random

import numpy as np
import pytest

from tidemark.operators import answers as an, retrieval as rt
from tidemark.plans import answers as plan
from tidemark.sources.store import IndexStore


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def corpus(spark, n=300):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)] + ["common"] * 20
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 25))) for _ in range(n)] + ["", None, " \t "]
    rows = [(f"c{i // 2:03d}" if i % 9 == 0 else f"d{i:03d}", t) for i, t in enumerate(texts)] + [("d001", "w1 w1 common"), ("d001", "w1 w2 w3"), ("d001", "w5")]
    asked = [" ".join(rng.choices(words, k=6)) for _ in range(12)] + ["common common", "none", "", None]
    chunks = spark.createDataFrame(rows, "chunk_id string, content string").repartition(5)
    return chunks, spark.createDataFrame(list(enumerate(asked)), "query_id int, query string")


def test_scan_finds_what_the_shuffle_finds(spark):
    """Ids with several rows, of equal and of other lengths, empty and null texts, ties; matches are never rows."""
    chunks, queries = corpus(spark)
    scan = rt.bm25_topk(chunks, queries, k=4)
    want = sorted(map(tuple, rt.bm25_topk(chunks, queries, k=4, max_terms=1).collect()))
    assert sorted(map(tuple, scan.collect())) == want and len(want) > 40
    assert sorted(map(tuple, rt.bm25_search(rt.bm25_index(chunks), queries, k=4).collect())) == want
    assert "MapInArrow" in plan_of(scan) and "Join" not in plan_of(scan)


def test_small_slices_give_the_same(spark):
    chunks, queries = corpus(spark)
    tokens = rt._tokens(chunks, "chunk_id", "content")
    weighted = [(q, f"w{t}", 0.5 + t) for q in range(3) for t in range(q, 30, q + 1)]
    rows = rt._counted(tokens, "string", [f"w{i}" for i in range(30)]).repartition("chunk_id").sortWithinPartitions("chunk_id")
    schema = "query_id int, chunk_id string, score double"
    one, many = (sorted(map(tuple, rt.top_k(rt._bm25_scan(rows, weighted, [f"w{i}" for i in range(30)], 9.0, 5, schema, 1.5, 0.75, c), ["query_id"], [("score", "desc"), ("chunk_id", "asc")], 5).collect())) for c in (1 << 21, 7))
    assert one == many and len(one) == 15


def test_kept_against_a_sort():
    rng = np.random.default_rng(1)
    scores = np.where(rng.random((500, 4)) < 0.3, -np.inf, rng.integers(0, 9, (500, 4)).astype(float))
    ids = [f"c{i:03d}" for i in rng.permutation(500)]
    kept = rt._Kept(4, 6)
    for start in range(0, 500, 37):
        kept.add(ids[start : start + 37], scores[start : start + 37])
    got = sorted((int(q), -s, kept.ids[p]) for q, p, s in zip(kept.query, kept.place, kept.score))
    assert got == sorted(x for q in range(4) for x in sorted((q, -scores[i, q], ids[i]) for i in range(500) if scores[i, q] > -np.inf)[:6])


@pytest.mark.parametrize("more", [{}, {"max_phrases": 0}, {"max_bytes": 3}])
def test_phrases_in_one_scan(spark, more):
    texts = ["one two\x1cthree", "xone twox", "\x1c", "", None, "onetwo"]
    phrases = ["one two", "two\x1cth", "\x1c", "x", "twox", "absent", "e two"]
    c = spark.createDataFrame(list(enumerate(texts)), "chunk_id int, content string")
    hits = rt.phrase_hits(c, spark.createDataFrame([(p,) for p in phrases], "phrase string"), **more)
    assert sorted(map(tuple, hits.collect())) == sorted((i, p) for i, t in enumerate(texts) if t for p in phrases if p in t)
    assert more or ("Exchange" not in plan_of(hits) and "MapInArrow" in plan_of(hits))


def test_texts_of_the_corpus_stay_where_they_are(spark):
    chunks = spark.range(1000).selectExpr("concat('c', id) AS chunk_id", "concat('text ', id) AS content", "'s' AS source_id", "cast(null AS int) AS page")
    hits = spark.createDataFrame([(1, "c7", 2.0, 1), (1, "c9", 1.0, 2), (3, "c7", 1.0, 1)], "query_id int, chunk_id string, score double, rank int")
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "query_id int, query string")
    out, far = an.gather(asked, hits, chunks), an.gather(asked, hits, chunks, sent=1)
    assert sorted(map(str, out.collect())) == sorted(map(str, far.collect()))
    assert "hashpartitioning(chunk_id" not in plan_of(out)


def test_index_has_a_posting_row_a_chunk(spark, tmp_path):
    box = IndexStore(spark, str(tmp_path / "ix"))
    blocks = spark.createDataFrame([("a", "red fox red"), ("b", "blue fox " * 200)], "source_id string, content string")
    plan.build_index(blocks, box, "v1", "2024-01-01")
    rows = {r.chunk_id: dict(zip(r.terms, r.tfs)) for r in box.load("postings").collect()}
    assert rows["a:p0:0"] == {"red": 2, "fox": 1} and len(rows) == box.load().count() > 2
    assert {r.term: r.df for r in box.load("terms").collect()}["red"] == 1
