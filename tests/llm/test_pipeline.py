import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_copies import joint_kept
from test_mixing_sharding import plain_targets, size
from test_quality_sketch import features
from test_suffix import plain
from test_tokens_files_packing import plain_ids

import __spark_entry__ as entry
import corpus_pipeline


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{tmp_path_factory.mktemp(name)}/rows"
        stage(spark, held[-1], "/root/testdata/sf0.001").write.parquet(path)
        held.append(spark.read.parquet(path))
    assert all(h.columns == docs.columns for h in held[:-1])
    return [h.collect() for h in held]


def triples(rows):
    return [(r["doc_id"], r["text"], r["source"]) for r in rows]


def test_quality(stages):
    assert Counter(triples(stages[1])) == Counter(t for t in triples(stages[0]) if features(t[1])[-1])


def test_near_duplicates(stages):
    """One document of each group that three-bit fingerprints or a five-word similarity of 0.8 connect."""
    before, after = triples(stages[1]), triples(stages[2])
    kept = joint_kept(before)
    assert Counter(after) == Counter(t for t in before if t[0] in kept)
    assert len(kept) < len({d for d, _, _ in before})


def test_passages(stages):
    before, after = triples(stages[2]), {r["doc_id"]: r for r in stages[3]}
    removed = {row[0]: row[2] for row in plain(before)}
    for d, t, _ in before:
        if d not in after:
            assert removed[d] > 0
        elif removed[d] == 0:
            assert after[d]["text"] == t
        else:
            left = len(after[d]["text"].encode())
            assert 0 <= len(t.encode()) - removed[d] - left <= 3 * 2 * len(t) and after[d]["n_chars"] == len(after[d]["text"])


def test_mix(stages):
    before, after = triples(stages[3]), triples(stages[4])
    sizes, taken = Counter(), Counter()
    for _, t, s in before:
        sizes[s] += size(t)
    for _, t, s in after:
        taken[s] += size(t)
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3
    most = max(size(t) for _, t, _ in before)
    assert all(abs(taken[s] - target) <= 21 * most for s, target in plain_targets(sizes).items())


def test_packing(stages):
    docs, pieces = triples(stages[4]), stages[5]
    want = Counter((d, len(plain_ids(t)) + 1) for d, t, _ in docs)
    whole = defaultdict(int)
    for r in pieces:
        whole[r["doc_id"]] += r["length"]
    assert whole == {d: sum(n * c for (e, n), c in want.items() if e == d) for d, _ in want}
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    ids = {d: np.array([*plain_ids(t), 2], "<u4") for d, t, _ in docs}
    assert all(r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) for r in pieces)


def test_run_is_the_stages(spark, stages):
    rows = entry.queries()["pipeline"](spark, "/root/testdata/sf0.001").collect()
    key = lambda r: (r["doc_id"], r["doc_tokens"])
    assert sum(r["length"] for r in rows) == sum(r["length"] for r in stages[5])
    assert {key(r) for r in rows} == {key(r) for r in stages[5]}


def test_stages_of_nothing(documents):
    docs = documents([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(docs.sparkSession, docs, "")
        assert docs.collect() == []


def test_stages_with_odd_columns(documents, hard_rows):
    docs = documents(hard_rows + [(100 + i, f"Some text number {i} with " + " ".join(f"w{(i * 7 + k) % 91}" for k in range(80)), "a") for i in range(20)])
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(docs.sparkSession, docs, "")
        assert docs.columns == columns
    assert docs.count() > 0
