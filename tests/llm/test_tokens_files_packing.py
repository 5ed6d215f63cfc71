import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import packing, pfor
from tidemark.llm.tokens import WordEncoder, spread, vocabulary

VOCABULARY = vocabulary("word_bpe_49k.json")


def plain_ids(text):
    return WordEncoder.get(VOCABULARY).whole.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.sampled_from(["don't 's 'T", "Éa É ﬁ İI ΣΑΣ", "a.b c... <|endoftext|>x <|", " x y\x85z 12½"])), max_size=8))
def test_word_wise_ids_are_the_tokenizers(texts):
    ids, sizes, _, _ = WordEncoder.get(VOCABULARY).encode(pa.array(texts, pa.string()), 7)
    assert sizes.tolist() == [len(plain_ids(t)) + 1 for t in texts]
    assert ids.tolist() == [i for t in texts for i in [*plain_ids(t), 7]]


def test_spread():
    assert spread(np.array([5, 9, 0]), np.array([2, 0, 3])).tolist() == [5, 6, 0, 1, 2]


@pytest.mark.parametrize("top", [1, 2, 300, 49_408, 2**32])
def test_blocks_round_trip(top):
    values = np.random.default_rng(top).integers(0, top, 8 * pfor.BLOCK).astype(np.uint32)
    values[: pfor.BLOCK] = 7
    values[::97] = top - 1
    blocks = pfor.encode_blocks(values)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert (pfor.decode_blocks(np.frombuffer(b"".join(blocks), np.uint8), starts) == values).all()


def test_outliers_are_exceptions():
    values = np.full(pfor.BLOCK, 5, np.uint32)
    values[3] = 2**31
    (block,) = pfor.encode_blocks(values)
    assert len(block) == pfor.HEAD + 2 + 4


def test_token_files(documents, hard_rows, tmp_path):
    got = [tuple(r) for r in pfor.digest(documents(hard_rows), VOCABULARY, f"file://{tmp_path}/ids").select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    want = [(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, t, _ in hard_rows for ids in [[*plain_ids(t), 1]]]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted([(key(r), r[2], r[3]) for r in got]) == sorted([(key(r), r[1], r[2]) for r in want])
    at = 0
    for r in sorted(got, key=lambda r: r[1]):
        assert r[1] == at
        at += r[2]
    assert [key(r) for r in sorted(got, key=lambda r: r[1])] == sorted(key(r) for r in want)


def test_token_files_of_nothing(documents):
    assert pfor.digest(documents([]), VOCABULARY).collect() == []


def brute_cost(pos, pen, capacity):
    best = [0.0]
    for j in range(1, len(pos)):
        best.append(min(best[i] + capacity - (pos[j] - pos[i]) + pen[j] for i in range(j) if pos[j] - pos[i] <= capacity))
    return best[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        pos = np.cumsum([0] + [rng.randint(1, 9) for _ in range(rng.randint(1, 40))])
        pen = np.array([0.0] + [rng.choice([0, 1, 2.5, 7]) for _ in pos[1:]])
        cuts = packing.best_cuts(pos, pen, 12)
        starts = [0, *pos[cuts][:-1]]
        assert all(0 < b - a <= 12 for a, b in zip(starts, pos[cuts]))
        assert sum(12 - (pos[j] - a) + pen[j] for a, j in zip(starts, cuts)) == pytest.approx(brute_cost(pos.tolist(), pen.tolist(), 12))


@pytest.mark.parametrize("horizon", [packing.HORIZON, 9000])
def test_packing_keeps_every_id_in_order(documents, hard_rows, horizon):
    rows = packing.pack(documents(hard_rows), VOCABULARY, horizon=horizon, partitions=3).collect()
    pieces = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    stream = [i for r in pieces for i in np.frombuffer(r["ids"], "<u4").tolist()]
    key = lambda d: (d is not None, d or 0)
    want = sorted([(key(d), [*plain_ids(t), 2]) for d, t, _ in hard_rows])
    seen, ids, left = [], [], 0
    for r in pieces:
        if not left:
            ids, left = [], r["doc_tokens"]
            seen.append((key(r["doc_id"]), ids))
        assert r["start"] == len(ids) and r["length"] == len(r["ids"]) // 4
        ids += np.frombuffer(r["ids"], "<u4").tolist()
        left -= r["length"]
    assert left == 0 and sorted(seen) == want and len(stream) == sum(len(i) for _, i in want)
    assert [k for k, _ in seen] == [k for k, _ in want]
    sizes = {}
    for r in pieces:
        assert r["offset"] == sizes.get(r["sequence_id"], 0)
        sizes[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sizes.values()) <= 4096
    assert all(r["padded_length"] == int(packing.padded(np.array([sizes[r["sequence_id"]]]))[0]) for r in pieces)


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.pack(docs, VOCABULARY, partitions=1).selectExpr("sequence_id", "length", "padded_length").groupBy("sequence_id").agg({"length": "sum", "padded_length": "max"}).toPandas()
    assert pieces["sum(length)"].sum() / pieces["max(padded_length)"].sum() > 0.99


def test_packing_nothing(documents):
    assert packing.pack(documents([]), VOCABULARY).collect() == []
