import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import suffix

N = suffix.LENGTH


def plain(rows):
    """Every window in document order; a window seen before covers its bytes."""
    import xxhash

    signed = lambda h: h - 2**64 if h >> 63 else h
    docs = {(d is not None, d or 0, signed(xxhash.xxh64_intdigest((t or "").encode(), 42))): (t or "").encode() for d, t, _ in rows}
    seen, out = set(), {}
    for key in sorted(docs):
        text = docs[key]
        gone = np.zeros(len(text) + 1, np.int64)
        for i in range(len(text) - N + 1):
            window = text[i : i + N]
            if window in seen:
                gone[i] += 1
                gone[min(i + N, len(text))] -= 1
            else:
                seen.add(window)
        mask = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(text, np.uint8)[~mask])
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], mask.astype(int)])) == 1))
        out[key] = (len(text), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest())
    return Counter((d, *out[(d is not None, d or 0, signed(xxhash.xxh64_intdigest((t or "").encode(), 42)))]) for d, t, _ in rows)


def check(docs, rows, **more):
    got = suffix.deduplicated(docs, **more).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == plain(rows)


@pytest.fixture(scope="module")
def shared_rows():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeéö ") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(n) for n in (8, 14, 20, 21, 30, 90)]
    rows = []
    for i in range(70):
        parts = [text(rng.randint(0, 40)) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        rows.append((rng.randint(0, 10**6), "".join(parts), "s"))
    rows += [(-5, rows[3][1], "s"), (10**9, rows[4][1] + "x", "s"), (7, "ab" * 300, "s"), (8, "b" + "ab" * 200, "s"), (9, "a" * 99, "s"), (10, "a" * 100, "s"), (11, "a" * 101, "s")]
    return rows


@pytest.mark.parametrize("crowded", [suffix.CROWDED, 2])
def test_shared_passages(documents, shared_rows, crowded):
    """With few and with most grams dealt window by window."""
    check(documents(shared_rows), shared_rows, crowded=crowded)


def test_hard_rows(documents, hard_rows):
    check(documents(hard_rows), hard_rows)


def test_no_rows(documents):
    check(documents([]), [])


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, [(r["doc_id"], r["text"], None) for r in docs.collect()])


@pytest.mark.parametrize("batch", [1, 7, 64])
def test_family(batch):
    rng = np.random.default_rng(batch)
    keys = np.array([f"{x:016d}" for x in rng.integers(0, 900, 2000)], "S16")
    family = suffix.IndexFamily()
    seen = np.concatenate([family.add(keys[k : k + batch]) for k in range(0, len(keys), batch)])
    had, want = set(), []
    for key in keys.tolist():
        want.append(key in had)
        had.add(key)
    assert seen.tolist() == want
    sizes = [len(level) for level in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == len(had)
    assert family.all().tolist() == sorted(had)


def test_long_documents_are_cut_into_pieces(documents, monkeypatch):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh") for _ in range(9000))
    rows = [(1, long, "s"), (2, long[4000:4500] + "z" + long[100:3000], "s")]
    monkeypatch.setattr(suffix, "CHUNK", 1000)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([0, 0]), pa.array([r[1] for r in rows])], names=["k", "d", "text"])
    found = suffix.Rows.joined(list(suffix.runs_of(batch, np.empty(0, np.uint64))))
    windows = Counter((int(k), int(a) + i) for k, a, n in zip(found["k"], found["at"], found["n"]) for i in range(int(n)))
    assert windows == Counter((k, i) for k, t, _ in rows for i in range(len(t) - N + 1))


def test_cleaned_keeps_columns(documents, shared_rows):
    docs = documents(shared_rows)
    got = suffix.cleaned(docs)
    assert got.columns == docs.columns
    want = Counter(r["doc_id"] for r in docs.collect())
    rows = got.collect()
    assert Counter(r["doc_id"] for r in rows) == want
    by = {(r["doc_id"], r["text_hash"]): r["n_removed"] for r in suffix.deduplicated(docs).collect()}
    assert sum(len((t or "").encode()) for _, t, _ in shared_rows) - sum(by.values()) >= sum(len(r["text"].encode()) for r in rows)
