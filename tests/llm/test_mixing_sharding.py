import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import mixing, sharding

DOCS = "/root/testdata/sf0.001/documents.parquet"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Round by round: what is above a limit goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, budget = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        total = sum(weight[s] for s in rest)
        share = {s: (budget - sum(full.values())) * weight[s] / total for s in rest}
        above = [s for s in rest if share[s] > 3 * sizes[s]]
        if not above:
            return full | share
        full |= {s: 3 * sizes[s] for s in above}


def check_mix(rows, docs):
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in rows) == Counter((d, size(t), s) for d, t, s in docs)
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += size(t)
    want = plain_targets(sizes) if docs else {}
    taken, largest = Counter(), max([size(t) for _, t, _ in docs] or [0])
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert sum(taken.values()) == sum(sizes.values())
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest * len(sizes)


def test_mix_of_hard_rows(documents, hard_rows):
    check_mix(mixing.mix(documents(hard_rows)).collect(), hard_rows)


def test_mix_of_given_documents(spark):
    docs = spark.read.parquet(DOCS)
    first, again = (sorted(map(tuple, mixing.mix(d).collect())) for d in (docs, docs.repartition(5)))
    assert first == again
    check_mix(mixing.mix(docs).collect(), [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])


def test_one_source_and_one_hot_source(documents):
    one = [(i, "a b c", None) for i in range(9)]
    check_mix(mixing.mix(documents(one)).collect(), one)
    hot = [(i, "a " * (i % 7 + 1), "b" if i % 10 else f"s{i}") for i in range(200)]
    check_mix(mixing.mix(documents(hot)).collect(), hot)


def test_mix_of_nothing_and_of_empty_texts(documents):
    assert mixing.mix(documents([])).collect() == []
    assert [(r["taken"], r["target"]) for r in mixing.mix(documents([(1, "", "a"), (2, None, "b")])).collect()] == [(0, 0.0), (0, 0.0)]


def test_curve_visits_neighbours():
    axes = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    place = sharding.hilbert_index(axes, 3)
    assert sorted(place) == list(range(512))
    walk = axes[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("copies", [0, 1, 30])
def test_shards(documents, hard_rows, copies):
    rows = hard_rows * copies
    got = sharding.assign(documents(rows)).collect()
    crc = lambda t: zlib.crc32((t or "").encode())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len((t or "").encode()) + 16, crc(t)) for d, t, _ in rows)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(40))
    counts = [len(slots.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["hilbert"] for r in ordered] == sorted(r["hilbert"] for r in got)


def test_borders_come_from_all_rows(spark):
    """A table far above any draw: the borders are those of its sorted values, nulls left out, whatever the partitions."""
    n = 30_011
    rows = spark.range(n).selectExpr("id * 7919 % 30011 AS size", "if(id % 10 = 0, null, concat('s', id % 23)) AS source", "'x' AS lang")
    columns = {c: rows[c] for c in ("source", "lang", "size")}
    want = {"lang": [], "size": sorted({n * k // 16 for k in range(1, 16)})}
    values = sorted(f"s{i % 23}" for i in range(n) if i % 10)
    want["source"] = sorted({values[len(values) * k // 16] for k in range(1, 16)} - {values[0]})
    assert sharding.borders(rows, columns, 16) == sharding.borders(rows.repartition(7), columns, 16) == want
    assert sharding.borders(rows.limit(0), columns, 16) == {"source": [], "lang": [], "size": []}


def test_written_shards_can_be_pruned(spark, tmp_path):
    docs = spark.read.parquet(DOCS)
    sharding.write_shards(docs, sharding.assign(docs, shards=8), f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == docs.count()
    spans = back.groupBy("shard").agg({"source": "approx_count_distinct"}).collect()
    assert len(spans) == 8
