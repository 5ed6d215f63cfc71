import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import connected_components


def plain_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, near):
    """Smallest member index of each item's component, by flooding."""
    label = list(range(len(items)))
    changed = True
    while changed:
        changed = False
        for i in range(len(items)):
            for j in range(i):
                if label[i] != label[j] and near(items[i], items[j]):
                    low = min(label[i], label[j])
                    label = [low if x in (label[i], label[j]) else x for x in label]
                    changed = True
    return label


def check(got, rows):
    prints = [(d, plain_print(t)) for d, t, _ in rows]
    words = sorted({p for _, p in prints})
    label = dict(zip(words, classes(words, lambda a, b: (a ^ b).bit_count() <= 3)))
    low = {}
    for d, p in prints:
        if d is not None:
            low[label[p]] = min(d, low.get(label[p], d))
    want = Counter((d, f"{p:016x}", low.get(label[p])) for d, p in prints)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def run(docs, **more):
    return simhash.near_duplicates(docs, **more).withColumn("fingerprint", simhash.as_hex(F.col("fingerprint"))).collect()


def test_hard_rows(documents, hard_rows):
    check(run(documents(hard_rows)), hard_rows)


def test_no_rows(documents):
    assert run(documents([])) == []


@pytest.fixture(scope="module")
def near_rows():
    rng = np.random.default_rng(9)
    base = [[f"w{x}" for x in rng.integers(0, 400, 400)] for _ in range(12)]
    rows = []
    for i in range(150):
        words = list(base[i % 12])
        for at in rng.integers(0, 400, i % 3):
            words[at] = f"new{rng.integers(0, 50)}"
        rows.append((int(rng.integers(0, 10**9)), " ".join(words).title() if i % 5 == 0 else "  ".join(words), "s"))
    return rows


@pytest.mark.parametrize("limit", [simhash.GROUP_LIMIT, 3])
def test_near_copies(documents, near_rows, limit):
    """Also with groups dealt again by their other bits, and again."""
    check(run(documents(near_rows), limit=limit), near_rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(run(docs), [(r["doc_id"], r["text"], None) for r in docs.collect()])


@pytest.mark.parametrize("n, kinds", [(1, 1), (60, 2), (900, 3)])
def test_search_against_brute_force(n, kinds):
    rng = np.random.default_rng(n)
    words = rng.integers(0, 2**63, max(1, n // 12)).astype(np.uint64)[rng.integers(0, max(1, n // 12), n)]
    for _ in range(3):
        words = words ^ np.where(rng.random(n) < 0.7, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
    words = np.unique(words)
    groups = rng.integers(0, kinds, len(words))
    a, b = simhash.search(groups, words)
    items = list(zip(groups.tolist(), words.tolist()))
    want = classes(items, lambda x, y: x[0] == y[0] and (x[1] ^ y[1]).bit_count() <= 3)
    parent = {w: w for w in words.tolist()}
    for x, y in zip(a.tolist(), b.tolist()):
        assert parent[x] == x and parent[y] == y
        parent[x] = y
    assert len(set(zip(parent.values(), want))) == len(set(parent.values())) == len(set(want))


def test_gray_neighbours_differ_in_one_bit():
    code = np.arange(4096, dtype=np.uint64)
    ranks = simhash.gray_rank(code)
    walk = code[np.argsort(ranks)]
    assert (np.bitwise_count(walk[1:] ^ walk[:-1]) == 1).all()


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(-50, 50, (45, 2))] + [(1000, x) for x in range(1001, 1200)] + [(-(2**63) + x, -(2**63) + x + 1) for x in range(40)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    nodes = sorted({x for a, b in edges if a != b for x in (a, b)})
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in nodes}


def test_one_of_each_group_stays(documents, near_rows, hard_rows):
    rows = near_rows + hard_rows
    kept = simhash.deduplicate(documents(rows))
    assert kept.columns == documents([]).columns
    prints = {(d, t or ""): plain_print(t) for d, t, _ in rows}
    words = sorted(set(prints.values()))
    label = dict(zip(words, classes(words, lambda a, b: (a ^ b).bit_count() <= 3)))
    got = Counter(label[prints[(r["doc_id"], r["text"] or "")]] for r in kept.collect())
    assert set(got) == set(label.values()) and set(got.values()) == {1}
