"""Lexical, dense, hybrid and keyword retrieval for batches of queries.

Every search ends in a per-query top-k whose literal bound lets a task keep
only k rows per query before anything is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ..functions.scalars import split_words
from ..session import cut
from .ordered import top_k

# BM25 constants, the floor share for negative idf, hybrid weights and sizes.
K1, B, IDF_FLOOR = 1.5, 0.75, 0.25
HYBRID_WEIGHTS = (0.4, 0.6)
TOP_K, FINAL_TOP_K = 6, 10


def corpus_stats(chunks: DataFrame, text: str = "content") -> DataFrame:
    """One row: number of chunks and mean length in tokens (empty chunks count)."""
    return chunks.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size(split_words(F.coalesce(F.col(text), F.lit(""))))).alias("avgdl"))


def _idf(counts: DataFrame, n: Column) -> DataFrame:
    """(term, df, idf) from document frequencies; a negative idf becomes a share of the mean idf."""
    raw = counts.withColumn("raw", F.ln(n - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5))
    mean = raw.agg(F.avg("raw")).scalar()
    idf = F.when(F.col("raw") < 0, F.lit(IDF_FLOOR) * mean).otherwise(F.col("raw"))
    return raw.select("term", "df", idf.alias("idf"))


def term_table(chunks: DataFrame, text: str = "content") -> DataFrame:
    """(term, df, idf) over the whole vocabulary."""
    terms = chunks.select(F.explode(F.array_distinct(split_words(text))).alias("term"))
    counts = cut(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    return _idf(counts, corpus_stats(chunks, text).select("n").scalar())


def _tokens(chunks: DataFrame, chunk_id: str, text: str) -> DataFrame:
    return chunks.select(F.col(chunk_id).alias("chunk_id"), split_words(text).alias("w"))


def _pieces(batch, limit: int = 1 << 20):
    """Runs of rows of about ``limit`` list entries in all -> (rows, entries a row); a longer row is a run of its own."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.list_value_length(batch.column("w")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right")))
        yield batch.slice(start, stop - start), sizes[start:stop]
        start = stop


def _counted(rows: DataFrame, id_type: str, words: list[str] | None = None, counts: bool = False) -> DataFrame:
    """(chunk_id, dl, terms, tfs), a row for each row that has terms: all of its tokens ``w``, or those in ``words`` by their number.

    With ``counts`` the tokens are distinct already, ``n`` has their counts and ``dl`` the length.
    """
    kind = "string" if words is None else "int"
    schema = f"chunk_id {id_type}, dl int, terms array<{kind}>, tfs array<int>"
    types = [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema)]
    shared = None if words is None else rows.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        known = None if shared is None else pa.array(shared.value, pa.string())
        for batch in batches:
            for some, sizes in _pieces(batch):
                flat, row = some.column("w").flatten(), np.repeat(np.arange(len(sizes)), sizes)
                if known is None:
                    coded = flat.dictionary_encode()
                    code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
                else:
                    found = pc.index_in(flat, value_set=known)
                    code, names = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64), None
                n = some.column("n").flatten().to_numpy(zero_copy_only=False) if counts else None
                row, n, code = row[code >= 0], n[code >= 0] if counts else None, code[code >= 0]
                if not counts:
                    width = len(known) if names is None else max(len(names), 1)
                    key, n = np.unique(row * width + code, return_counts=True)
                    row, code = key // width, key % width
                at, per = np.unique(row, return_counts=True)
                if not len(at):
                    continue
                ends = pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32())
                terms = pa.array(code, pa.int32()) if names is None else names.take(pa.array(code))
                dl = some.column("dl").take(pa.array(at)) if counts else pa.array(sizes[at], pa.int32())
                columns = [some.column("chunk_id").take(pa.array(at)), dl, pa.ListArray.from_arrays(ends, terms), pa.ListArray.from_arrays(ends, pa.array(n, pa.int32()))]
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types)], names=["chunk_id", "dl", "terms", "tfs"])

    return rows.mapInArrow(run, schema)


def postings(chunks: DataFrame, chunk_id: str = "chunk_id", text: str = "content") -> DataFrame:
    """(chunk_id, dl, terms, tfs): a row for each chunk with its distinct terms and how often it has them; nothing is shuffled."""
    return _counted(_tokens(chunks, chunk_id, text), chunks.schema[chunk_id].dataType.simpleString())


def _document_counts(rows: DataFrame, terms: str, apart: bool) -> DataFrame:
    """(term, df) of rows with distinct ``terms``; where ids repeat (not ``apart``), equal (chunk_id, dl, term) count once."""
    each = rows.select("chunk_id", "dl", F.explode(terms).alias("term"))
    each = each.select("term") if apart else each.distinct()
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def _are_apart(rows: DataFrame) -> bool:
    """Whether no (chunk_id, dl) repeats."""
    row = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct("chunk_id", "dl")).alias("d")).first()
    return row["n"] == row["d"]


def index_tables(chunk_id: str = "chunk_id", text: str = "content") -> dict:
    """How each table of an index is made from those made before it, chunks first."""

    def terms(made: dict[str, DataFrame]) -> DataFrame:
        rows = made["postings"]
        return _idf(cut(_document_counts(rows, "terms", _are_apart(rows))), made["stats"].select("n").scalar())

    return {
        "postings": lambda made: postings(made["chunks"], chunk_id, text),
        "stats": lambda made: corpus_stats(made["chunks"], text),
        "terms": terms,
    }


def bm25_index(chunks: DataFrame, chunk_id: str = "chunk_id", text: str = "content") -> dict[str, DataFrame]:
    """postings, terms and stats tables, ready to be written and searched later.

    The corpus is tokenised once for the postings, which are written; the
    terms are counted from them, and the lengths take a second scan.
    """
    made = {"chunks": chunks}
    for name, make in index_tables(chunk_id, text).items():
        made[name] = cut(make(made))
    return {name: made[name] for name in ("postings", "terms", "stats")}


def query_terms(queries: DataFrame, query_id: str = "query_id", query: str = "query") -> DataFrame:
    rows = queries.select(F.col(query_id).alias("query_id"), F.explode(split_words(query)).alias("term"))
    return rows.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))


class _Kept:
    """The best ``k`` (score, then id) of each of ``n`` queries among blocks of scores, one after the other."""

    def __init__(self, n: int, k: int):
        import numpy as np

        self.n, self.k = n, k
        self.query, self.place, self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), []
        self.least = np.full(n, -np.inf)

    def add(self, ids, scores) -> None:
        """``scores``: a row for each id, a column for each query, -inf where there is no match."""
        import numpy as np

        last = max(0, len(scores) - self.k)
        least = np.maximum(np.partition(scores, last, axis=0)[last], self.least)
        at, query = np.nonzero((scores >= least) & (scores > -np.inf))
        if not len(at):
            return
        names, place = np.unique(at, return_inverse=True)
        score = np.concatenate([self.score, scores[at, query]])
        query, place = np.concatenate([self.query, query]), np.concatenate([self.place, place + len(self.ids)])
        held = self.ids + [ids[int(i)] for i in names]
        order = sorted(range(len(query)), key=lambda i: (query[i], -score[i], held[place[i]] is not None, held[place[i]]))
        order = np.array(order, np.int64)
        first = np.searchsorted(query[order], np.arange(self.n))
        order = order[np.arange(len(order)) - first[query[order]] < self.k]
        used, self.place = np.unique(place[order], return_inverse=True)
        self.query, self.score, self.ids = query[order], score[order], [held[i] for i in used]
        full = np.bincount(self.query, minlength=self.n) >= self.k
        worst = np.full(self.n, np.inf)
        np.minimum.at(worst, self.query, self.score)
        self.least = np.where(full, worst, -np.inf)

    def batches(self, asked: list, types: list):
        import pyarrow as pa

        if len(self.query):
            columns = [[asked[q] for q in self.query], [self.ids[i] for i in self.place], self.score]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "chunk_id", "score"])


def _unfolded(starts, counts):
    """Places ``starts[i] .. starts[i] + counts[i] - 1`` for all i, one after the other."""
    import numpy as np

    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _lists(keys: list[int], n: int):
    """(order, starts, sizes): where entries with the keys 0 .. n - 1 stand once sorted by key."""
    import numpy as np

    keys = np.asarray(keys, np.int64)
    sizes = np.bincount(keys, minlength=n)
    return np.argsort(keys, kind="stable"), np.cumsum(sizes) - sizes, sizes


def _bm25_scan(rows: DataFrame, weighted: list, words: list[str], avgdl: float, k: int, schema: str, k1: float, b: float, cells: int = 1 << 21) -> DataFrame:
    """The best ``k`` chunks of each task for every query; ``rows`` (chunk_id, dl, terms, tfs) have all rows of a chunk in one task, side by side.

    ``weighted`` has (query_id, term, weight).  A task holds about ``cells`` (chunk, term, query) matches and k rows per query.
    """
    types = [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema)]
    asked = list(dict.fromkeys(q for q, _, _ in weighted))
    shared = rows.sparkSession.sparkContext.broadcast((asked, words, weighted))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        asked, words, weighted = shared.value
        n, number, place = len(asked), {w: i for i, w in enumerate(words)}, {q: i for i, q in enumerate(asked)}
        order, starts, sizes = _lists([number[t] for _, t, _ in weighted], len(words))
        query = np.array([place[q] for q, _, _ in weighted], np.int64)[order]
        weight = np.array([w for _, _, w in weighted])[order]
        kept = _Kept(n, k)

        def take(some, group):
            dl = some.column("dl").to_numpy().astype(np.int64)
            term = some.column("terms").flatten().to_numpy().astype(np.int64)
            tf = some.column("tfs").flatten().to_numpy().astype(np.float64)
            row = np.repeat(np.arange(len(dl)), some.column("terms").value_lengths().to_numpy())
            first = np.flatnonzero(np.diff(group, prepend=-1))
            if len(first) < len(dl):  # an id with several rows: equal lengths are one chunk, their counts add up
                pairs, part = np.unique(np.column_stack([group, dl]), axis=0, return_inverse=True)
                key, back = np.unique(part.ravel()[row] * len(words) + term, return_inverse=True)
                tf = np.bincount(back.ravel(), weights=tf)
                row, term = key // len(words), key % len(words)
                group, dl = pairs[:, 0], pairs[:, 1]
            top, under = tf * (k1 + 1), tf + k1 * (1 - b + b * dl[row] / avgdl)
            owner = group[row]
            work = np.cumsum(np.maximum(np.bincount(owner, weights=sizes[term], minlength=len(first)), n))
            ends, start = np.searchsorted(owner, np.arange(len(first)), side="right"), 0
            while start < len(first):
                stop = max(start + 1, int(np.searchsorted(work, (work[start - 1] if start else 0) + cells, side="right")))
                these = slice(ends[start - 1] if start else 0, ends[stop - 1])
                counts = sizes[term[these]]
                at = _unfolded(starts[term[these]], counts)
                part = weight[at] * np.repeat(top[these], counts) / np.repeat(under[these], counts)
                cell = np.repeat(owner[these] - start, counts) * n + query[at]
                scores = np.round(np.bincount(cell, weights=part, minlength=(stop - start) * n), 10)
                hit = np.zeros(len(scores), bool)
                hit[cell] = True
                names = some.column("chunk_id").take(pa.array(first[start:stop]))
                kept.add(_Names(names), np.where(hit, scores, -np.inf).reshape(-1, n))
                start = stop

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            code = batch.column("chunk_id").dictionary_encode(null_encoding="encode").indices.to_numpy()
            group = np.cumsum(np.diff(code, prepend=code[0]) != 0)
            # The last chunk may go on in the next batch.
            last = int(np.searchsorted(group, group[-1]))
            if last:
                take(batch.slice(0, last), group[:last])
            held = batch.slice(last)
        if held is not None:
            take(held, np.zeros(held.num_rows, np.int64))
        yield from kept.batches(asked, types)

    return rows.mapInArrow(run, schema)


class _Names:
    """Values of an Arrow array by place, made one at a time."""

    def __init__(self, values):
        self.values = values

    def __getitem__(self, i: int):
        return self.values[i].as_py()


def _ranked_hits(rows: DataFrame, weighted: DataFrame, avgdl: float | None, k: int, k1: float, b: float) -> DataFrame:
    """Scores of (chunk_id, dl, terms, tfs) by shuffles of single terms, for query sides too large to be sent."""
    each = rows.select("chunk_id", "dl", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf"))))
    each = each.repartition("chunk_id").groupBy("chunk_id", "dl", "term").agg(F.sum("tf").alias("tf"))
    hits = each.join(weighted, "term")
    tf, dl = F.col("tf").cast("double"), F.col("dl").cast("double")
    part = F.col("qtf") * F.col("idf") * (tf * (k1 + 1)) / (tf + k1 * (1 - b + b * dl / F.lit(avgdl)))
    scores = hits.groupBy("chunk_id", "query_id").agg(F.round(F.sum(part), 10).alias("score"))
    return top_k(scores, ["query_id"], [("score", "desc"), ("chunk_id", "asc")], k)


def _search(matches, weighted: DataFrame, avgdl: float | None, types: tuple[str, str], k: int, k1: float, b: float, by_chunk: bool) -> DataFrame:
    """``matches(words)`` gives (chunk_id, dl, terms, tfs) of these words; the query side goes to every task."""
    rows = [(r["query_id"], r["term"], float(r["qtf"]) * r["idf"]) for r in weighted.select("query_id", "term", "qtf", "idf").collect()]
    schema = "query_id {1}, chunk_id {0}, score double".format(*types)
    if not rows:
        found = weighted.sparkSession.createDataFrame([], schema)
    else:
        words = sorted({t for _, t, _ in rows})
        found = matches(words) if by_chunk else matches(words).repartition("chunk_id")
        found = _bm25_scan(found.sortWithinPartitions("chunk_id"), rows, words, avgdl, k, schema, k1, b)
    return top_k(found.select("chunk_id", "query_id", "score"), ["query_id"], [("score", "desc"), ("chunk_id", "asc")], k)


def bm25_search(
    index: dict[str, DataFrame], queries: DataFrame, k: int = TOP_K, query_id: str = "query_id", query: str = "query", k1: float = K1, b: float = B,
    by_chunk: bool = False, max_terms: int = 500_000,
) -> DataFrame:
    """(query_id, chunk_id, score, rank); repeated query terms count repeatedly; chunks without a match are not returned.

    With up to ``max_terms`` (query, term) rows the query side goes to the
    postings, of which only the query terms move, a row for each chunk
    (``by_chunk`` says that all rows of a chunk lie in one partition already):
    the far larger set of (query, chunk, term) matches exists only slice by
    slice inside a task, which keeps its best k rows per query.  Beyond that
    the join shuffles on the term.
    """
    wanted = query_terms(queries, query_id, query)
    small = within(wanted, max_terms)
    weighted = index["terms"].select("term", "idf").join(F.broadcast(wanted) if small else wanted, "term")
    avgdl = index["stats"].first()["avgdl"]
    rows = index["postings"]
    if not small:
        return _ranked_hits(rows, weighted, avgdl, k, k1, b)
    types = (rows.schema["chunk_id"].dataType.simpleString(), queries.schema[query_id].dataType.simpleString())
    stored = rows.select("chunk_id", "dl", F.col("terms").alias("w"), F.col("tfs").alias("n"))
    return _search(lambda words: _counted(stored, types[0], words, counts=True), weighted, avgdl, types, k, k1, b, by_chunk)


def bm25_topk(
    chunks: DataFrame, queries: DataFrame, k: int = TOP_K, chunk_id: str = "chunk_id", text: str = "content",
    query_id: str = "query_id", query: str = "query", max_terms: int = 500_000,
) -> DataFrame:
    """Search without a stored index.

    With up to ``max_terms`` (query, term) rows no postings are made of other
    words than those asked for: one scan for lengths, one for the document
    frequency of every term, one for the matches.
    """
    wanted = query_terms(queries, query_id, query)
    if not within(wanted, max_terms):
        return bm25_search(bm25_index(chunks, chunk_id, text), queries, k, query_id, query, max_terms=max_terms)
    tokens = _tokens(chunks, chunk_id, text)
    each = tokens.select("chunk_id", F.coalesce(F.size("w"), F.lit(0)).alias("dl"), F.array_distinct("w").alias("terms"))
    length = F.when(F.col("dl") > 0, F.col("dl")).otherwise(0)
    row = each.agg(F.count(F.lit(1)).alias("n"), F.avg(length).alias("avgdl"), F.count_distinct(F.struct("chunk_id", "dl")).alias("d")).first()
    counts = cut(_document_counts(each, "terms", row["n"] == row["d"]))
    weighted = _idf(counts, F.lit(row["n"])).select("term", "idf").join(F.broadcast(wanted), "term")
    types = (chunks.schema[chunk_id].dataType.simpleString(), queries.schema[query_id].dataType.simpleString())
    return _search(lambda words: _counted(tokens, types[0], words), weighted, row["avgdl"], types, k, K1, B, False)


def within(df: DataFrame, rows: int) -> bool:
    """Whether a side is small enough to be sent whole to the tasks; stops counting past the bound."""
    return df.limit(rows + 1).count() <= rows


def dense_topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    vector_id: str = "chunk_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "vector",
    metric: str = "dot",
    max_queries: int = 4096,
    block_rows: int = 8192,
    max_bytes: int = 64 << 20,
) -> DataFrame:
    """Exact nearest vectors by dot product or cosine: (query_id, chunk_id, score, rank).

    Up to ``max_queries`` queries of ``max_bytes`` in all go to every task as
    one matrix; a task multiplies slice by slice and keeps its own best k per
    query.  Beyond that both sides are cut into blocks which meet in one
    shuffle, each pair of blocks again keeping only its best k.
    """
    id_type = corpus.schema[vector_id].dataType.simpleString()
    q_type = queries.schema[query_id].dataType.simpleString()
    schema = f"query_id {q_type}, chunk_id {id_type}, score double"
    left = corpus.select(F.col(vector_id).alias("chunk_id"), F.col(vector).alias("v")).filter(F.col("v").isNotNull())
    right = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("v")).filter(F.col("v").isNotNull())
    asked = right.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("cells")).first()
    if asked["n"] <= max_queries and 8 * asked["cells"] <= max_bytes:
        found = _dense_small(left, right, k, metric, schema)
    else:
        found = _dense_blocks(left, right, k, metric, schema, max_queries, block_rows)
    return top_k(found, ["query_id"], [("score", "desc"), ("chunk_id", "asc")], k)


def _matrix(values, metric: str):
    import numpy as np

    m = np.stack([np.asarray(v, dtype=np.float64) for v in values])
    if metric == "cosine":
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        m = m / np.where(norms == 0, 1.0, norms)
    return m


def _best(q_ids, q_matrix, ids, vectors, k: int, metric: str, rows: int = 2048):
    """Top-k rows of one block of vectors for every query, ties by id; memory holds the scores of ``rows`` vectors."""
    import numpy as np
    import pandas as pd

    order = np.argsort(ids, kind="stable")
    vectors = list(vectors)
    held_ids = np.empty((len(q_ids), 0), ids.dtype)
    held = np.empty((len(q_ids), 0))
    for a in range(0, len(order), rows):
        some = order[a : a + rows]
        scores = np.round(q_matrix @ _matrix([vectors[i] for i in some], metric).T, 10)
        scores = np.concatenate([held, scores], axis=1)
        names = np.concatenate([held_ids, np.broadcast_to(ids[some], (len(q_ids), len(some)))], axis=1)
        keep = min(k, scores.shape[1])
        # All that reach the k-th best score, ties included; then the first k of them by score and id.
        least = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1]
        at, column = np.nonzero(scores >= least[:, None])
        first = np.lexsort((column, -scores[at, column], at))
        place = np.arange(len(first)) - np.searchsorted(at[first], at[first])
        first = first[place < keep]
        held, held_ids = scores[at[first], column[first]].reshape(-1, keep), names[at[first], column[first]].reshape(-1, keep)
    return pd.DataFrame({"query_id": np.repeat(q_ids, held.shape[1]), "chunk_id": held_ids.ravel(), "score": held.ravel()})


def _dense_small(left: DataFrame, right: DataFrame, k: int, metric: str, schema: str) -> DataFrame:
    rows = right.collect()
    if not rows:
        return left.sparkSession.createDataFrame([], schema)
    q_ids = [r["query_id"] for r in rows]
    shared = left.sparkSession.sparkContext.broadcast((q_ids, _matrix([r["v"] for r in rows], metric)))

    def run(batches):
        import numpy as np
        import pandas as pd

        ids, matrix = shared.value
        ids = np.asarray(ids)
        held = None
        for batch in batches:
            if len(batch) == 0:
                continue
            part = _best(ids, matrix, batch["chunk_id"].to_numpy(), batch["v"], k, metric)
            held = part if held is None else pd.concat([held, part])
            held = held.sort_values(["query_id", "score", "chunk_id"], ascending=[True, False, True]).groupby("query_id").head(k)
        if held is not None:
            yield held

    return left.mapInPandas(run, schema)


def _dense_blocks(left: DataFrame, right: DataFrame, k: int, metric: str, schema: str, q_rows: int, v_rows: int) -> DataFrame:
    q_blocks = max(1, math.ceil(right.count() / q_rows))
    v_blocks = max(1, math.ceil(left.count() / v_rows))
    a = left.withColumn("vb", F.pmod(F.xxhash64("chunk_id"), F.lit(v_blocks)).cast("int")).withColumn("qb", _copies(q_blocks))
    b = right.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int")).withColumn("vb", _copies(v_blocks))

    def run(_, vectors, asked):
        import pandas as pd

        if len(vectors) == 0 or len(asked) == 0:
            return pd.DataFrame({"query_id": [], "chunk_id": [], "score": []})
        return _best(asked["query_id"].to_numpy(), _matrix(asked["v"], metric), vectors["chunk_id"].to_numpy(), vectors["v"], k, metric)

    return a.groupBy("qb", "vb").cogroup(b.groupBy("qb", "vb")).applyInPandas(run, schema)


def _copies(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _grams(token: Column) -> Column:
    """All substrings of one to three characters."""

    def of(n: int) -> Column:
        places = F.sequence(F.lit(1), F.length(token) - n + 1)
        return F.when(F.length(token) >= n, F.transform(places, lambda i: F.substring(token, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(of(1), of(2), of(3)))


def phrase_hits(
    chunks: DataFrame, phrases: DataFrame, chunk_id: str = "chunk_id", text: str = "content", phrase: str = "phrase", lower: bool = False,
    max_phrases: int = 50_000, max_bytes: int = 32 << 20,
) -> DataFrame:
    """(chunk_id, phrase): phrases contained in a text as a substring, each pair once.

    A phrase's longest word lies inside one token of any text that has the
    phrase.  Distinct tokens that contain such a word are found by an equi
    join on one of its three-character grams; they lead to the texts, which
    are searched for the whole phrase only then.  Up to ``max_phrases`` of
    ``max_bytes`` in all go to every task instead, which looks each token up
    in a dictionary: one scan, nothing is shuffled.  A phrase of white space
    alone has no word and no hits.  ``chunk_id`` tells texts apart.
    """
    body = F.lower(F.col(text)) if lower else F.col(text)
    rows = chunks.select(F.col(chunk_id).alias("chunk_id"), body.alias("body")).filter(F.col("body").isNotNull())
    words = phrases.select(F.col(phrase).alias("phrase")).filter(F.length("phrase") > 0).distinct()
    longest = F.array_max(F.transform(split_words("phrase"), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    asked = words.withColumn("piece", longest).filter(F.col("piece").isNotNull())
    sent = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0)).alias("bytes")).first()
    if sent["n"] <= max_phrases and sent["bytes"] <= max_bytes:
        return _phrase_scan(rows, [(r["phrase"], r["piece"]) for r in asked.collect()], chunks.schema[chunk_id].dataType.simpleString())
    size = F.length("piece")
    middle = F.when(size < 3, F.col("piece")).otherwise(F.substring(F.col("piece"), F.floor((size - 3) / 2).cast("int") + 1, F.lit(3)))
    pieces = asked.select("piece", middle.alias("gram")).distinct()
    tokens = rows.select("chunk_id", F.explode(F.array_distinct(split_words("body"))).alias("token"))
    vocabulary = tokens.select("token").distinct().select("token", F.explode(_grams(F.col("token"))).alias("gram"))
    holds = vocabulary.join(pieces, "gram").filter(F.contains("token", "piece")).select("token", "piece")
    near = tokens.join(holds, "token").select("chunk_id", "piece").distinct().join(asked, "piece")
    whole = near.filter("phrase = piece").select("chunk_id", "phrase")
    longer = near.filter("phrase <> piece").join(rows, "chunk_id").filter(F.contains("body", "phrase")).select("chunk_id", "phrase")
    return whole.unionByName(longer)


class _WordsIn:
    """Which of the given words each token contains; tokens that were seen before are looked up, in a dictionary of bounded size."""

    def __init__(self, words: list[str], kept: int = 1 << 18):
        self.number = {w: i for i, w in enumerate(words)}
        self.lengths = sorted({len(w) for w in words})
        self.kept, self.known = kept, {}

    def of(self, token: str) -> tuple[int, ...]:
        found = self.known.get(token)
        if found is None:
            n, number = len(token), self.number
            hits = {number.get(token[i : i + size]) for size in self.lengths if size <= n for i in range(n - size + 1)}
            hits.discard(None)
            found = tuple(hits)
            if len(self.known) >= self.kept:
                self.known.clear()
            self.known[token] = found
        return found


def _phrase_scan(rows: DataFrame, asked: list[tuple[str, str]], id_type: str) -> DataFrame:
    """(chunk_id, phrase) of ``rows`` (chunk_id, body); ``asked`` has each phrase with its longest word."""
    schema = f"chunk_id {id_type}, phrase string"
    types = [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema)]
    shared = rows.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        import pyarrow as pa

        # ``split`` ends words at a few more characters than Spark's pattern; a word may have to be cut again.
        owners: dict[str, list[str]] = {}
        for phrase, piece in shared.value:
            owners.setdefault(max(piece.split(), key=len, default=""), []).append(phrase)
        always = owners.pop("", [])
        words = list(owners)
        within_token = _WordsIn(words)
        for batch in batches:
            ids, hits = [], []
            for i, body in enumerate(batch.column("body").to_pylist()):
                near = {w for t in set(body.split()) for w in within_token.of(t)}
                for phrase in [*always, *[p for w in near for p in owners[words[w]]]]:
                    if phrase in body:
                        ids.append(i)
                        hits.append(phrase)
            if ids:
                yield pa.RecordBatch.from_arrays([batch.column("chunk_id").take(pa.array(ids)).cast(types[0]), pa.array(hits, types[1])], names=["chunk_id", "phrase"])

    return rows.mapInArrow(run, schema)


def _keyword_scan(rows: DataFrame, asked: list[tuple], k: int, schema: str, cells: int = 1 << 21) -> DataFrame:
    """The best ``k`` chunks of each task for every query; ``rows`` (chunk_id, w: tokens), ``asked`` (query_id, distinct words).

    Each distinct token of a run of rows is looked up once.  A task holds
    about ``cells`` (row, word, query) matches and k rows per query.
    """
    words = sorted({w for _, own in asked for w in own})
    types = [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema)]
    shared = rows.sparkSession.sparkContext.broadcast((words, asked))

    def run(batches):
        import numpy as np

        words, asked = shared.value
        within_token, number = _WordsIn(words), {w: i for i, w in enumerate(words)}
        n, entries = len(asked), [(number[w], q) for q, (_, own) in enumerate(asked) for w in own]
        order, starts, sizes = _lists([w for w, _ in entries], len(words))
        query = np.array([q for _, q in entries], np.int64)[order]
        kept = _Kept(n, k)
        for batch in batches:
            for some, lengths in _pieces(batch):
                coded = some.column("w").flatten().dictionary_encode()
                found = [within_token.of(t) for t in coded.dictionary.to_pylist()]
                per = np.array([len(f) for f in found], np.int64)
                inside, begin = np.array([w for f in found for w in f], np.int64), np.cumsum(per) - per
                token, row = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)
                counts = per[token]
                # Each word counts once a row, however many tokens have it.
                key = np.unique(np.repeat(row, counts) * len(words) + inside[_unfolded(begin[token], counts)])
                row, word = key // len(words), key % len(words)
                work = np.cumsum(np.maximum(np.bincount(row, weights=sizes[word], minlength=len(lengths)), n))
                ends, start = np.searchsorted(row, np.arange(len(lengths)), side="right"), 0
                while start < len(lengths):
                    stop = max(start + 1, int(np.searchsorted(work, (work[start - 1] if start else 0) + cells, side="right")))
                    these = slice(ends[start - 1] if start else 0, ends[stop - 1])
                    counts = sizes[word[these]]
                    cell = np.repeat(row[these] - start, counts) * n + query[_unfolded(starts[word[these]], counts)]
                    scores = np.bincount(cell, minlength=(stop - start) * n).reshape(-1, n).astype(float)
                    kept.add(_Names(some.column("chunk_id").slice(start, stop - start)), np.where(scores > 0, scores, -np.inf))
                    start = stop
        yield from kept.batches([q for q, _ in asked], types)

    return rows.mapInArrow(run, schema)


def keyword_topk(
    chunks: DataFrame, queries: DataFrame, k: int = TOP_K, chunk_id: str = "chunk_id", text: str = "content",
    query_id: str = "query_id", query: str = "query", max_queries: int = 50_000, max_bytes: int = 32 << 20,
) -> DataFrame:
    """Score = number of distinct lower-cased query words contained in the lower-cased text; only positive scores.

    A word has no white space, so a text contains it where one of its tokens
    does.  Up to ``max_queries`` queries whose words have ``max_bytes`` in all
    go to every task, which looks each distinct token up in a dictionary from
    tokens to the words inside them, counts inside the row and keeps its best k
    rows a query: one scan, nothing else is shuffled.  Beyond that words and tokens
    meet in shuffles.  ``chunk_id`` tells chunks apart.
    """
    id_type, q_type = (df.schema[c].dataType.simpleString() for df, c in ((chunks, chunk_id), (queries, query_id)))
    words = queries.select(F.col(query_id).alias("query_id"), F.array_distinct(split_words(F.lower(F.col(query)))).alias("words")).filter(F.size("words") > 0)
    size = words.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.array_join("words", " "))), F.lit(0)).alias("bytes")).first()
    if size["n"] <= max_queries and size["bytes"] <= max_bytes:
        asked = [(r["query_id"], r["words"]) for r in words.collect()]
        tokens = F.array_distinct(split_words(F.lower(F.col(text))))
        schema = f"query_id {q_type}, chunk_id {id_type}, score double"
        found = _keyword_scan(chunks.select(F.col(chunk_id).alias("chunk_id"), tokens.alias("w")), asked, k, schema) if asked else chunks.sparkSession.createDataFrame([], schema)
        return top_k(found, ["query_id"], [("score", "desc"), ("chunk_id", "asc")], k)
    each = words.select("query_id", F.explode("words").alias("phrase"))
    hits = phrase_hits(chunks, each, chunk_id, text, lower=True)
    scores = hits.join(each, "phrase").groupBy("query_id", "chunk_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    return top_k(scores, ["query_id"], [("score", "desc"), ("chunk_id", "asc")], k)


def _scaled(hits: DataFrame, out: str) -> DataFrame:
    """Min-max per query; the range comes from one small row per query. A single value scales to 1."""
    ends = hits.groupBy("query_id").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    scaled = F.coalesce(F.try_divide(F.col("score") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(1.0))
    return hits.join(ends, "query_id").select("query_id", "chunk_id", scaled.alias(out))


def hybrid_topk(
    lexical: DataFrame, dense: DataFrame, k: int = FINAL_TOP_K, weights: tuple[float, float] = HYBRID_WEIGHTS, mode: str = "weighted"
) -> DataFrame:
    """Combine two candidate lists per query.

    ``weighted``: min-max scaled scores of both lists, a missing side counts 0.
    ``fallback``: the lexical list where a query has one, else the dense list.
    """
    if mode == "fallback":
        answered = lexical.select("query_id").distinct()
        rest = dense.select("query_id", "chunk_id", "score").join(answered, "query_id", "left_anti")
        both = lexical.select("query_id", "chunk_id", "score").unionByName(rest)
    else:
        sides = _scaled(lexical, "l").unionByName(_scaled(dense, "d"), allowMissingColumns=True)
        merged = sides.groupBy("query_id", "chunk_id").agg(F.max("l").alias("l"), F.max("d").alias("d"))
        score = F.coalesce("l", F.lit(0.0)) * weights[0] + F.coalesce("d", F.lit(0.0)) * weights[1]
        both = merged.select("query_id", "chunk_id", F.round(score, 10).alias("score"))
    return top_k(both, ["query_id"], [("score", "desc"), ("chunk_id", "asc")], k)
